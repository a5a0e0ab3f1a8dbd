from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lateline.llm import language_id, lm_score, quality_fm, vector_search
from lateline.llm.spans import texts
from tests.llm.conftest import messy_rows, prose


def language_rows():
    import random

    sounds = {"aa": ["ka", "lo", "mi", "te"], "bb": ["schr", "ung", "heit", "ver"], "cc": ["eau", "ouX", "ç", "ére"]}
    rows, number = [], 0
    for lang, parts in sounds.items():
        rng = random.Random(lang)
        for _ in range(60):
            words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 300))]
            rows.append((number, " ".join(words), lang))
            number += 1
    return rows


def test_language_of_held_out_texts(shipped):
    docs = shipped.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    apart = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(docs.filter(~apart))
    got = language_id.identify(docs.filter(apart), model).collect()
    assert len(got) > 10 and all(r.lang_pred == r.lang and r.accepted and 0 <= r.score <= 1 for r in got)
    assert all(len(d) <= language_id.PIECES * (2 * language_id.PIECE_CHARS + 1) for d in model.dictionaries)


def test_language_of_odd_rows(shipped, messy, nothing):
    docs = shipped.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    got = language_id.identify(messy, model)
    assert set(messy.columns) - {"score"} <= set(got.columns) and got.count() == len(messy_rows())
    for r in got.collect():
        if r.text is None or not re.search(r"[^\W\d_]", r.text):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred in model.languages and 0 <= r.score <= 1
    assert language_id.identify(nothing, model).collect() == []
    none = language_id.learn(nothing)
    assert {r.lang_pred for r in language_id.identify(messy, none).collect()} == {"und"}
    single = language_id.learn(docs.filter("lang = 'aa'"))
    assert {r.lang_pred for r in language_id.identify(docs, single).collect()} == {"aa"}


def test_a_mixed_text_is_rejected(shipped):
    docs = shipped.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    odd = shipped.createDataFrame([(1, "zzq wxj yfd")], "doc_id long, text string")
    assert not language_id.identify(odd, model, min_margin=0.02).first().accepted


def test_machine_equals_sum_over_pairs():
    x = quality_fm.features(texts(pa.array(["Some words, some MORE words!\nnext", "", None, "x" * 5_000])))
    rng = np.random.default_rng(0)
    machine = quality_fm.Machine(0.3, rng.standard_normal(quality_fm._FEATURES), rng.standard_normal((quality_fm._FEATURES, 4)))
    for i, logit in enumerate(machine.logits(x)):
        index, value = x.index[x.edges[i]:x.edges[i + 1]], x.value[x.edges[i]:x.edges[i + 1]].astype(float)
        pairs = sum(machine.factor[index[a]] @ machine.factor[index[b]] * value[a] * value[b]
                    for a in range(len(index)) for b in range(a))
        assert logit == pytest.approx(0.3 + machine.weight[index] @ value + pairs, rel=1e-5)
        assert len(set(index.tolist())) == len(index)


def test_quality_of_held_out_rows(shipped):
    rows = [(k, prose(k, 40 + k % 60) if k % 3 else " ".join(w.upper() + "!!" for w in prose(k, 50).split()), 10)
            for k in range(400)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    apart = language_id.held_out(F.col("doc_id"))
    machine = quality_fm.learn(docs, labels.filter(~apart))
    got = quality_fm.score(docs.filter(apart), machine, ["doc_id"]).collect()
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 3 != 0) for r in got]) > 0.95


def test_quality_of_odd_rows(messy, nothing):
    machine = quality_fm.learn(messy, messy.select("doc_id", F.lit(1).alias("quality")))
    got = quality_fm.score(messy, machine, ["doc_id", "a b.c"]).collect()
    assert len(got) == len(messy_rows()) and all(0 <= r.score <= 1 for r in got)
    assert quality_fm.score(nothing, machine, ["doc_id"]).collect() == []
    unlabelled = quality_fm.learn(messy, messy.select("doc_id", F.lit(None).cast("int").alias("quality")).limit(3))
    assert all(0.4 < r.score < 0.6 for r in quality_fm.score(messy, unlabelled, ["doc_id"]).collect())


def test_scores_match_brute_force(messy, nothing):
    got = Counter((r.doc_id, r.words, r.seen, None if r.score is None else round(r.score, 9))
                  for r in lm_score.lm_scores(messy).collect())
    part = pa.RecordBatch.from_arrays([pa.array([(r[1] or "").lower() for r in messy_rows()])], ["text"])
    numbers, edges = lm_score._word_numbers(part)
    rows = [numbers[a:b].tolist() for a, b in zip(edges, edges[1:])]
    one, two = Counter(), Counter()
    for w in rows:
        one.update(w)
        one[0] += bool(w)
        two.update(zip([0] + w, w))
    total, want = sum(one.values()) - one[0], Counter()
    for r, w in zip(messy_rows(), rows):
        own, score, seen = Counter(zip([0] + w, w)), 0.0, 0
        for (u, v), n in own.items():
            others = two[(u, v)] - n
            score += n * (math.log(others / one[u]) if others else math.log(0.4 * one[v] / total))
            seen += n * (others > 0)
        want[(r[0], len(w), seen, round(score / len(w), 9) if w else None)] += 1
    assert got == want
    assert lm_score.lm_scores(nothing).collect() == []


def test_scores_of_many_different_words(shipped):
    rows = [(d, " ".join(f"w{d}x{k}" for k in range(8_000))) for d in range(2)]
    total = 16_000
    want = (7_999 * math.log(0.4 / total) + math.log(0.4 / total)) / 8_000  # each word and bigram once
    got = lm_score.lm_scores(shipped.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.words, r.seen) for r in got] == [(8_000, 0)] * 2
    assert all(r.score == pytest.approx(want, rel=1e-9) for r in got)


def test_bigrams_are_added_up_before_they_meet(messy):
    plan = lm_score.lm_scores(messy)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" in plan


def test_scores_of_many_chunks(messy, monkeypatch):
    """The texts move once and their counts are arrays, so no bigram is a row of a shuffle."""
    one = Counter((r.doc_id, r.words, r.seen, r.score) for r in lm_score.lm_scores(messy).collect())
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 200)
    scores = lm_score.lm_scores(messy)
    rounded = lambda found: Counter((d, w, s, x and round(x, 9)) for (d, w, s, x) in found.elements())
    assert rounded(Counter((r.doc_id, r.words, r.seen, r.score) for r in scores.collect())) == rounded(one)
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("FlatMapGroupsInArrow") == 2


def test_equal_keys_are_told_apart_by_their_marks():
    keys, marks = np.array([7, 3, 7, 7, 3], np.uint64), np.array([2, 1, 1, 2, 1], np.uint8)
    got = lm_score._added_up(keys, marks, np.array([1, 10, 100, 1000, 10000], np.int64))
    assert [x.tolist() for x in got[:3]] == [[3, 7, 7], [1, 1, 2], [10010, 100, 1001]] and got[4].tolist() == [0, 2, 3]
    totals = lm_score._everywhere(pa.table({
        "chunk": pa.array([0, 1], pa.int32()), "part": pa.array([0, 0], pa.int32()),
        "keys": pa.array([[3, 7], [7, 7]], pa.list_(pa.int64())), "marks": pa.array([[1, 2], [1, 2]], pa.list_(pa.int8())),
        "counts": pa.array([[1, 2], [4, 8]], pa.list_(pa.int32()))}))
    assert totals.column("everywhere").to_pylist() == [[1, 10], [4, 10]]


def vector_rows():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    rows = [(k, (centres[k % 12] + 0.4 * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(3_000)]
    rows += [(5_000 + k, rows[7][1]) for k in range(300)]  # a common vector
    odd = [None, [], [0.0] * 16, [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(6_000 + 20 * k, v) for k, v in enumerate(odd)] + [(None, rows[1][1])]
    return rows


def brute_nearest(rows, k=20):
    sound = [(i, v) for i, v in rows if i is not None and v and len(v) == 16 and None not in v
             and np.isfinite(v).all() and any(v)]
    ids, x = np.array([i for i, _ in sound]), np.array([v for _, v in sound])
    out = {}
    for i, v in sound:
        if i % 20 == 0:
            scores = (x * np.array(v)).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


@pytest.mark.parametrize("part_items", [100, 10_000])
def test_nearest_vectors(shipped, part_items, monkeypatch):
    monkeypatch.setattr(vector_search, "ITEM_BLOCK", 150)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 40)
    rows = vector_rows()
    table = shipped.createDataFrame(rows, "vec_id long, embedding array<float>")
    got: dict[int, list] = {}
    for r in vector_search.nearest(table, F.col("vec_id") % 20 == 0, part_items=part_items).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_nearest(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    if part_items == 10_000:  # one partition: nothing is left out, ties included
        for q in want:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
            assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)
    for q, found in got.items():
        assert q not in [i for i, _ in found]


def test_few_or_no_vectors(shipped):
    def run(rows):
        table = shipped.createDataFrame(rows, "vec_id long, embedding array<float>")
        return vector_search.nearest(table, F.col("vec_id") % 20 == 0).collect()

    assert run([]) == [] and run([(20, None), (1, [0.0])]) == [] and run([(20, [1.0])]) == []
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in run([(20, [2.0]), (3, [1.0]), (2, [1.0]), (2, [1.0])])] == [
        (20, 1, 2, 2.0), (20, 2, 3, 2.0)]


def test_partitions_are_balanced():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1_000, 8)).astype(np.float32)
    part = vector_search.balanced_partition(x, vector_search.neighbour_graph(x), 7)
    assert np.bincount(part, minlength=7).max() <= np.ceil(1.05 * 1_000 / 7)
