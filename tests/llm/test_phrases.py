from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from lateline.llm import collocations
from tests.llm.conftest import messy_rows


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_phrases(rows, depth=3, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by plain loops over ``(lang, text)``."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, depth + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner = p[i:i + size]
                    if 100 * a >= 50 * f[inner]:
                        gone.add(inner)
        scored = []
        for p, a in candidates.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def as_rows(got):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got.collect())


def wordy(seed, count):
    rng = random.Random(seed)
    few = ["a", "Of", "the", "é", "ñu", "of-the", "x" * 40]
    many = [f"w{k}" for k in range(60)]
    out = []
    for k in range(count):
        words = [rng.choice(few if rng.random() < 0.6 else many) for _ in range(rng.randint(0, 60))]
        out.append(([None, "en", "de"][k % 3], "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ; "]) for w in words)))
    return out


@pytest.mark.parametrize("group, depth, top", [(2_000_000, 3, 2000), (50, 3, 2000), (5, 3, 7), (40, 4, 2000), (30, 2, 10)])
def test_phrases_match_brute_force(shipped, group, depth, top):
    """The small budgets of a group extend most prefixes by a word or two."""
    rows = wordy(1, 90) + wordy(1, 3) + [("en", None), (None, ""), ("de", " ;., ")]
    docs = shipped.createDataFrame(rows, "lang string, text string").repartition(4)
    got = collocations.collocations(docs, depth=depth, least=4, top=top, group_suffixes=group)
    want = brute_phrases(rows, depth, 4, top)
    assert want and as_rows(got) == want


def test_phrases_of_messy_rows_and_of_nothing(messy, nothing):
    want = brute_phrases([(r[2], r[1]) for r in messy_rows()], least=2)
    assert as_rows(collocations.collocations(messy, least=2, group_suffixes=1000)) == want
    assert collocations.collocations(nothing).collect() == []


def test_scores_pass_64_bits(shipped):
    """A pair of three million occurrences has a product beyond 64 bits."""
    rows = [("en", "b a " * 30_000 + "c a")] * 100
    docs = shipped.createDataFrame([rows[0]], "lang string, text string").crossJoin(shipped.range(100)).repartition(8)
    got = as_rows(collocations.collocations(docs))
    assert got == brute_phrases(rows)


def test_frequent_filter_lets_all_of_its_keys_through(shipped, monkeypatch):
    keys = shipped.range(5000).selectExpr("xxhash64(id) AS key")
    values = keys.toPandas()["key"].to_numpy().view("uint64")
    for most in (1 << 27, 1 << 10):
        monkeypatch.setattr(collocations, "MOST_FILTER_BITS", most)
        assert collocations._may_have(collocations._frequent_filter(keys, 5000), values).all()
