from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lateline.llm import packing, token_files, tokenise
from lateline.llm.spans import texts
from lateline.session import shared_folder, stage
from tests.llm.conftest import messy_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer(plain, monkeypatch):
    rows = [r[1] for r in messy_rows()] + ["a  b\n\n c", " lead", "trail ", "é à  ß", "it's don't\t x", "\n", "  "]
    for remembered in (tokenise.REMEMBERED_BYTES, 2_000):
        monkeypatch.setattr(tokenise, "REMEMBERED_BYTES", remembered)
        encode = tokenise.Encoder(PATH)
        for part in (rows, rows[::-1], rows[5:9]):
            ids, edges = encode(texts(pa.array(part, pa.string())))
            assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [plain(t) for t in part]


def test_encoder_equals_tokenizer_on_added_tokens(plain):
    rows = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b", "x  <|endoftext|>\n\n y", "none", None, "<|endof"]
    encode = tokenise.Encoder(PATH)
    ids, edges = encode(texts(pa.array(rows, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [plain(t) for t in rows]
    assert plain(rows[0]) == [31373, 220, 50256, 995]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t 1.'s  ñ!", max_size=30), max_size=6))
def test_encoder_equals_tokenizer_on_any_text(rows):
    tokenizer = Tokenizer.from_file(PATH)
    ids, edges = tokenise.encoder(PATH)(texts(pa.array(rows, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in rows]


@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=70), st.booleans())
def test_planes_round_trip(ids, bits):
    block = np.array(ids, np.uint32)
    assert np.array_equal(token_files.ids_of(token_files.planes_of(block, bits), len(block), bits), block)


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_checksums_join(a, b):
    assert token_files.crc32_behind(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_round_trip(shipped, messy, plain, bits, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 1_000)
    path = f"{shared_folder(shipped)}/tokens-test-{bits}"
    token_files.write_token_files(messy, path, PATH, 2, bits)
    got = token_files.read_token_digests(shipped, path).collect()
    rows = {}
    for r in messy_rows():
        rows.setdefault(r[0], []).append(np.array(plain(r[1]) + [2], "<u4"))
    want = Counter((d, len(x), zlib.crc32(x)) for d, v in rows.items() for x in v)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)
    index = shipped.read.parquet(f"{path}/index").orderBy("start").collect()
    assert index[0].start == 0 and sum(r.n_ids for r in index) == sum(r.n_tokens for r in got)


def test_token_files_of_nothing(shipped, nothing):
    path = f"{shared_folder(shipped)}/tokens-none"
    token_files.write_token_files(nothing, path, PATH, 2)
    assert token_files.read_token_digests(shipped, path).collect() == []


def check_packed(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_documents(shipped, messy, nothing, plain):
    got = packing.packed_documents(messy, PATH, 0, 256).collect()
    want = Counter()
    for r in messy_rows():
        ids = np.array(plain(r[1]) + [0], "<u4")
        head = len(ids) % 256 or 256
        cuts = [0, *range(head, len(ids) + 1, 256)]
        want.update((r[0], k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert check_packed(got, 256) <= -(-sum(r.length for r in got) // 256) + 1
    assert packing.packed_documents(nothing, PATH, 0, 256).collect() == []


def test_pack_in_slices(shipped, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 7)
    rows = [(k, 0, 2 + (k % 5 == 0) * (k % 9)) for k in range(400)]
    pieces = stage(shipped.createDataFrame(rows, "doc_id long, piece int, length long"), "pieces")
    got = packing.pack(pieces, 10).collect()
    assert len(got) == 400
    check_packed(got, 10)


def test_pack_refuses_lengths_that_fit_no_sequence(shipped):
    for wrong in (0, 11, -3, None):
        pieces = shipped.createDataFrame([(1, 0, 4), (2, 0, wrong)], "doc_id long, piece int, length long")
        with pytest.raises(ValueError, match="1 to 10"):
            packing.pack(pieces, 10)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60))
def test_plan_uses_each_piece_once(lengths):
    counts = np.bincount(np.array(lengths, np.int64), minlength=25)
    kinds = packing.plan(counts, 24)
    used = Counter()
    for kind, times in kinds:
        assert sum(kind) <= 24 and times > 0
        used.update({n: k * times for n, k in Counter(kind).items()})
    assert used == Counter(lengths)
    assert sum(t for _, t in kinds) <= 2 * -(-sum(lengths) // 24) + 1


def test_plan_prefers_exact_complements():
    counts = np.zeros(11, np.int64)
    counts[[7, 3, 5, 2]] = [4, 4, 1, 1]
    counts[1] = 2
    full = [k for k, t in packing.plan(counts, 10) for _ in range(t) if sum(k) == 10]
    assert full.count((7, 3)) == 4


def test_encoding_needs_no_slow_set_operations(plain, monkeypatch):
    """Hashed sets of numpy took more of an encoding than any step but the tokenizer's."""
    def slow(*_, **__):
        raise AssertionError("a set operation of numpy")

    rows = ["one two  two\none", "", None, "two one é à\n\nx", " one"]
    encode = tokenise.Encoder(PATH)
    monkeypatch.setattr(np, "unique", slow)
    monkeypatch.setattr(np, "union1d", slow)
    ids, edges = encode(texts(pa.array(rows, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [plain(t) for t in rows]
    unique, first, inverse = tokenise._distinct(np.array([5, 3, 5, 9, 3], np.uint64))
    assert unique.tolist() == [3, 5, 9] and inverse.tolist() == [1, 0, 1, 2, 0]
    assert first[1] in (0, 2) and first[0] in (1, 4) and first[2] == 3
    assert [len(x) for x in tokenise._distinct(np.zeros(0, np.uint64))] == [0, 0, 0]
