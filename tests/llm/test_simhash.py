from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lateline.llm import simhash_join
from lateline.llm.components import least_connected
from lateline.llm.spans import texts
from tests.llm.conftest import messy_rows


def brute_fingerprint(text, width=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(k) for k in range(len(prints))]


def test_hash_equals_the_library_and_spark(shipped):
    rng = random.Random(3)
    strings = ["".join(rng.choices("abcdé ", k=k)) for k in range(140)]
    t = texts(pa.array(strings))
    got = simhash_join.xxh64(t.data, t.edges[:-1], np.diff(t.edges)).tolist()
    assert got == [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in strings]
    spark_own = [r[0] for r in shipped.createDataFrame([(s,) for s in strings], "s string").select(F.xxhash64("s")).collect()]
    assert [x & (1 << 64) - 1 for x in spark_own] == got


def test_components_of_texts_match_brute_force(messy, nothing):
    rows = [(r[0], r[1]) for r in messy_rows()]
    got = simhash_join.simhash_components(messy).collect()
    prints = [brute_fingerprint(text) for _, text in rows]
    label = brute_components(prints, 3)
    least = {}
    for (doc_id, _), at in zip(rows, label):
        least[at] = min((x for x in (least.get(at), doc_id) if x is not None), default=None)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = [(doc_id, f"{p:016x}", least[at]) for (doc_id, _), p, at in zip(rows, prints, label)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash_join.simhash_components(nothing).collect() == []


def fingerprints_near_each_other(seed):
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5])):
            out.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    hub = rng.getrandbits(64)  # many neighbours of one value, in its leading bits too
    out |= {hub ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 6]))) for _ in range(90)}
    return sorted(out)


@pytest.mark.parametrize("radius, split", [(0, 2_048), (1, 2_048), (2, 2_048), (3, 2_048), (3, 60), (4, 2_048)])
def test_links_connect_what_brute_force_connects(shipped, monkeypatch, radius, split):
    """The small bound deals the buckets around one value out again by more bits."""
    monkeypatch.setattr(simhash_join, "SPLIT_ROWS", split)
    monkeypatch.setattr(simhash_join, "SPLIT_BITS", 20)
    monkeypatch.setattr(simhash_join, "BUCKET_ROWS", 64)
    prints = fingerprints_near_each_other(radius)
    frame = shipped.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fingerprint long").repartition(3)
    edges = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash_join.links(frame, radius).collect()]
    at = {p: k for k, p in enumerate(prints)}
    label = np.arange(len(prints))
    if edges:
        a, b = np.array([(at[x], at[y]) for x, y in edges]).T
        label = least_connected(len(prints), a, b)
    want = brute_components(prints, radius)
    pairs = set(zip(label.tolist(), want))
    assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)


def test_long_rows_have_more_than_255_hashes():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    edges = np.array([0, 0, 255, 256, 1500, 5000, 5000])
    got = simhash_join._fingerprints(hashes, edges).tolist()
    want = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes[i:j]) > j - i) for i, j in zip(edges, edges[1:])]
    assert got == want
