from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from lateline.llm import language_id, mixing
from lateline.llm.queries import QUERIES, SQL
from lateline.session import stage
from tests.llm.conftest import messy_rows, prose
from tests.llm.test_dedup import brute_classes, brute_lines
from tests.llm.test_tokens import check_packed

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def poured(sizes, weights, share=1.5, most=2.0):
    """Pour the budget by weight, cap what overflows and pour the rest again."""
    aims, budget, free = dict.fromkeys(sizes, 0.0), share * sum(sizes.values()), set(sizes)
    while budget > 1e-9 and free:
        total = sum(weights[s] for s in free)
        add = {s: budget * weights[s] / total for s in free}
        budget = 0.0
        for s, more in add.items():
            aims[s] += more
            if aims[s] >= most * sizes[s]:
                budget += aims[s] - most * sizes[s]
                aims[s] = most * sizes[s]
                free.discard(s)
    return aims


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 400, "c": 30, None: 5}, {"a": 0, "b": 7}, {"x": 3}, {"é": 5, "z": 5, "f": 90}])
def test_targets(sizes):
    weights = mixing.cyclic_weights(list(sizes))
    assert mixing.targets(sizes, weights) == pytest.approx(poured(sizes, weights))


def test_weights_go_by_code_point_null_last():
    assert mixing.cyclic_weights([None, "é", "z", "a"]) == {"a": 3, "z": 1, "é": 2, None: 3}


def test_mix_matches_brute_force(messy, nothing, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 3)
    got = mixing.mix(messy).collect()
    rows = messy_rows()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    aims = poured(sizes, mixing.cyclic_weights(list(sizes)))
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(aims[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.epochs * r["size"] + r.part and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(aims[s] - 1.001 <= taken[s] <= aims[s] + 1e-6 for s in sizes)
    for s in sizes:  # a prefix of the random order is taken once more
        own = sorted((r for r in got if r.source == s), key=lambda r: hashlib.md5(
            str(r.doc_id if r.doc_id is not None else "").encode()).hexdigest())
        whole = [r.part == r["size"] for r in own if r["size"]]
        if len({r.doc_id for r in own}) == len(own):
            assert whole == sorted(whole, reverse=True)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(messy.repartition(3)).collect()))
    assert mixing.mix(nothing).collect() == []


def test_mixed_documents(messy, nothing):
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == messy.columns and mixing.mixed_documents(nothing).collect() == []
    want = {(r.doc_id, r.source): 0 for r in mixing.mix(messy).collect()}
    for r in mixing.mix(messy).collect():
        want[(r.doc_id, r.source)] += r.taken
    got = Counter()
    for r in mixed.collect():
        got[(r.doc_id, r.source)] += len(WORD.findall(r.text))
    assert got == Counter({k: v for k, v in want.items() if v})


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {k.split("_")[0] for k in SQL} == {"op2", "op3", "op5", "op11"}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "source_mix", "best_fit_packing"]


def test_pipeline_stages_against_brute_force(shipped, messy):
    rows = [(500 + k, prose(300 + k, 60), "en", "a", 1) for k in range(30)]
    docs = messy.unionByName(shipped.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    docs = docs.selectExpr("*", "1 AS `__id`", "2 AS dropped", "3 AS `__k1`", "4 AS k2", "5 AS gone", "6 AS id", "7 AS copy")
    folder = "unused"
    columns = docs.columns
    docs = stage(docs, "raw")
    model = language_id.learn(docs)
    first = stage(corpus_pipeline.STAGES[0][1](shipped, docs, folder), "one")
    accepted = language_id.identify(docs, model).filter("accepted")
    assert Counter(r.doc_id for r in first.collect()) == Counter(r.doc_id for r in accepted.collect())

    second = stage(corpus_pipeline.STAGES[1][1](shipped, first, folder), "two")
    before = [(r.doc_id, r.text) for r in first.collect()]
    want = Counter({(d, t): n for (d, t), n in brute_lines(before).items() if t.strip(" ") or (d, t) in set(before)})
    assert Counter((r.doc_id, r.text) for r in second.collect()) == want

    third = stage(corpus_pipeline.STAGES[2][1](shipped, second, folder), "three")
    classes = {c for _, c, _ in brute_classes([(r.doc_id, r.text) for r in second.collect()])}
    assert Counter(r.doc_id for r in third.collect()) == Counter(classes)

    fourth = stage(corpus_pipeline.STAGES[3][1](shipped, third, folder), "four")
    assert [d.columns for d in (first, second, third, fourth)] == [columns] * 4
    taken = sum(r.taken for r in mixing.mix(third).collect())
    assert sum(len(WORD.findall(r.text)) for r in fourth.collect()) == taken
    packed = corpus_pipeline.STAGES[4][1](shipped, fourth, folder).collect()
    check_packed(packed, 2048)
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in fourth.collect())


def test_pipeline_of_nothing(shipped, tmp_path):
    empty = shipped.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(shipped, str(tmp_path)).collect() == []
