from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from lateline.llm import exact_dedup, line_dedup, ngram_join
from lateline.session import stage
from tests.llm.conftest import messy_rows, prose


def test_exact_duplicates_match_brute_force(messy):
    for runs in (None, 1_000):  # the second treats every repeated text as frequent
        got = exact_dedup.exact_duplicates(messy, runs=runs).collect()
        groups = defaultdict(list)
        for r in messy_rows():
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
        want = Counter()
        for norm, ids in groups.items():
            known = [i for i in ids if i is not None]
            for i in ids:
                want[(i, min(known, default=None), len(ids), hashlib.sha256(norm.encode()).hexdigest())] += 1
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        kept = Counter(r.text_sha256 for r in got if r.kept)
        assert set(kept.values()) == {1} and len(kept) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_duplicates_of_nothing(nothing):
    assert exact_dedup.exact_duplicates(nothing).collect() == []


def brute_lines(rows, depth=3, min_docs=4, share=0.6, leaf_share=0.3, long_tokens=40, long_docs=2):
    """What is left of each text, by templates from plain loops."""
    def spark_hash(text):
        value = xxhash.xxh64_intdigest(text.encode(), seed=42)
        return value - (1 << 64) if value >> 63 else value

    def enough(docs, tokens):
        return docs >= min_docs or docs >= long_docs and tokens >= long_tokens

    lines = []
    for doc_id, text in rows:
        for no, line in enumerate(text.split("\n") if text is not None else []):
            tokens = [t for t in re.split(r"[\x20\x09\x0B-\x0D]+", line) if t]
            tokens = ["<*>" if re.search("[0-9]", t) else t for t in tokens]
            if tokens:
                lines.append(((doc_id is None, doc_id or 0, spark_hash(text)), no, tuple(tokens)))
    leaf = lambda t: (len(t), t[:depth])
    in_leaf, holders = defaultdict(set), defaultdict(set)
    for doc, _, t in lines:
        in_leaf[leaf(t)].add(doc)
        holders[t].add(doc)
    support = Counter()
    for t, who in holders.items():
        for at, token in enumerate(t):
            support[(leaf(t), at, token)] += len(who)
    found = defaultdict(set)
    for doc, no, t in lines:
        docs = len(in_leaf[leaf(t)])
        if not enough(docs, len(t)):
            continue
        if enough(len(holders[t]), len(t)):
            found[("alike", t)].add((*doc, no))
        if docs >= min_docs and len(t) > depth:
            constant = [v != "<*>" and support[(leaf(t), at, v)] >= max(min_docs, leaf_share * docs) for at, v in enumerate(t)]
            if sum(constant[depth:]) >= share * (len(t) - depth):
                template = (*t[:depth], *[v if c else "<*>" for v, c in zip(t[depth:], constant[depth:])])
                found[("general", template)].add((*doc, no))
    gone = set()
    for (_, template), same in found.items():
        if enough(len({x[:3] for x in same}), len(template)):
            gone |= same - {min(same)}
    out = Counter()
    for d, x in rows:
        kept = None if x is None else "\n".join(
            line for no, line in enumerate(x.split("\n")) if (d is None, d or 0, spark_hash(x), no) not in gone)
        out[(d, kept)] += 1
    return out


def test_line_dedup_matches_brute_force(messy):
    got = line_dedup.drop_recurring_lines(messy)
    assert got.columns == [*messy.columns, "dropped"]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == brute_lines([r[:2] for r in messy_rows()])


def test_line_dedup_of_many_small_templates_matches_brute_force(shipped):
    rng = random.Random(5)
    words = ["red", "blue", "x9", "to", "from", "at", "the"]
    rows = [(k if k % 7 else None, "\n".join(" ".join(rng.choices(words, k=rng.choice([2, 3, 4, 5, 45]))) for _ in range(6))) for k in range(150)]
    rows += [(500 + k, rows[k][1] + "\nA b c d e") for k in range(0, 40, 3)]
    got = line_dedup.drop_recurring_lines(shipped.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == brute_lines(rows)


@pytest.mark.parametrize("lines", [30, 100, 400, 1500, 6000])
def test_line_dedup_finds_one_template_at_any_size(shipped, lines):
    rng = random.Random(lines)
    cities, names = [f"City{chr(97 + k)}" for k in range(26)], [f"N{chr(97 + k % 26)}{'xy'[k // 26]}" for k in range(52)]
    rows = [(k, f"Posted today in forum {rng.choice(cities)} by member {rng.choice(names)} again") for k in range(lines)]
    got = line_dedup.drop_recurring_lines(shipped.createDataFrame(rows, "doc_id long, text string")).agg(
        F.sum("dropped").alias("n"), F.min_by("dropped", "doc_id").alias("first")).first()
    assert got["n"] == lines - 1 and got["first"] == 0


def test_line_dedup_leaves_leading_tokens_alone_and_finds_long_lines(shipped):
    long = " ".join(prose(3, 80).split()[:80])
    rows = [(k, f"He said to {name}.") for k, name in enumerate(["Bob", "Alice", "Carol", "Dan", "Eve", "Fay"])]
    rows += [(10 + k, long + f"\nown words of {'abc'[k]}") for k in range(3)] + [(20, "One short line"), (21, "One short line")]
    got = {r.doc_id: (r.text, r.dropped) for r in line_dedup.drop_recurring_lines(
        shipped.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] == (rows[k][1], 0) for k in range(6)) and got[20][1] == got[21][1] == 0
    assert got[10] == (rows[6][1], 0) and got[11] == ("own words of b", 1) and got[12] == ("own words of c", 1)


def test_line_dedup_generalises_fields_and_keeps_the_first(shipped):
    rows = [(k, f"Posted by user{k} on day {k} in the forum\n{chr(97 + k)} has words alone") for k in range(6)]
    rows += [(9, None), (10, "\n\n")]
    got = {r.doc_id: (r.text, r.dropped) for r in line_dedup.drop_recurring_lines(
        shipped.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[k] == (f"{chr(97 + k)} has words alone", 1) for k in range(1, 6))
    assert got[9] == (None, 0) and got[10] == ("\n\n", 0)


def test_line_dedup_takes_any_column_names(shipped):
    names = ["doc_id", "text", "__id", "__hash", "__gone", "__dropped", "gone", "gone_id", "row", "dropped", "a b.c"]
    rows = [(k, "The same line stands here\n" * 2, *range(9)) for k in range(5)]
    got = line_dedup.drop_recurring_lines(shipped.createDataFrame(rows, names)).orderBy("doc_id").collect()
    assert got[0].asDict().keys() == set(names) and got[0]["a b.c"] == 8 and got[3]["__gone"] == 2
    assert [r["dropped"] for r in got] == [1, 2, 2, 2, 2] and got[1]["text"] == ""


def test_line_dedup_keeps_every_row(messy, nothing):
    assert line_dedup.drop_recurring_lines(messy).count() == len(messy_rows())
    assert line_dedup.drop_recurring_lines(nothing).collect() == []


def gram_set(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_classes(rows):
    sets = [gram_set(t) for _, t in rows]
    label = list(range(len(rows)))
    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    ids = defaultdict(list)
    for (doc_id, _), x in zip(rows, label):
        ids[x].append(doc_id)
    least = {x: min((i for i in v if i is not None), default=None) for x, v in ids.items()}
    return Counter((d, least[x], n) for (d, _), x, n in zip(rows, label, links))


def test_similar_documents_match_brute_force(messy):
    got = Counter((r.doc_id, r.class_id, r.links) for r in ngram_join.similar_documents(messy).collect())
    assert got == brute_classes([r[:2] for r in messy_rows()])


def test_similar_documents_split_large_buckets_and_blocks(shipped, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "TILE", 3)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(18):
        words = list(base)
        words[4 * k] = f"new{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(base[:30]) + f" own{k} " + " ".join(f"z{k}v{j}" for j in range(90))) for k in range(15)]
    got = Counter((r.doc_id, r.class_id, r.links) for r in ngram_join.similar_documents(
        shipped.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_classes(rows)


def test_similar_documents_find_large_classes_of_one_core(shipped):
    rows = []
    for c in range(4):
        core = " ".join(f"c{c}w{k}" for k in range(60))
        rows += [(1_000 * c + k, f"{core} own{k} tail{k}") for k in range(300)]
    got = ngram_join.similar_documents(shipped.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.class_id, r.links) for r in got) == Counter(
        (i, i // 1_000 * 1_000, 299) for i, _ in rows)


def test_similar_documents_move_only_what_is_compared(shipped, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", 3)
    tables = {}

    def staged(df, label):
        tables.setdefault(label, []).append(stage(df, label))
        return tables[label][-1]

    monkeypatch.setattr(ngram_join, "stage", staged)
    near = [(k, " ".join(f"new{k}" if j == 4 * k else f"w{j}" for j in range(80))) for k in range(12)]
    rows = near + [(100 + k, " ".join(f"own{k}x{j}" for j in range(80))) for k in range(200)]
    got = Counter((r.doc_id, r.class_id, r.links) for r in ngram_join.similar_documents(
        shipped.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_classes(rows)
    # No set has all nodes below it written, and texts that meet no other are not gathered.
    assert "tree" not in tables and 12 <= tables["grams"][0].count() < 40


def test_similar_documents_compare_once_what_several_runs_find(shipped, monkeypatch):
    tables = {}

    def staged(df, label):
        tables[label] = stage(df, label)
        return tables[label]

    monkeypatch.setattr(ngram_join, "stage", staged)
    rows = [(2 * k + i, prose(k, 60) + f" end{i}") for k in range(30) for i in range(2)]
    got = ngram_join.similar_documents(shipped.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.class_id, r.links) for r in got) == Counter((i, i // 2 * 2, 1) for i, _ in rows)
    assert tables["compared"].count() == 60


def test_filter_lets_all_wanted_keys_through_and_few_others(shipped):
    keys = shipped.range(4000).select(F.xxhash64("id").alias("key"), "id")
    bits = ngram_join._frequent_filter(keys.filter("id < 300"), 300)
    left = {r.id for r in ngram_join._only(keys, F.col("key"), bits).collect()}
    assert set(range(300)) <= left and len(left) < 600


def test_one_of_each(messy, nothing):
    kept = ngram_join.one_of_each(messy)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.collect()]
    classes = {r.class_id for r in ngram_join.similar_documents(messy).collect()}
    assert {i for i in ids if i is not None} == {c for c in classes if c is not None}
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert ngram_join.one_of_each(nothing).collect() == []
    assert ngram_join.similar_documents(nothing).collect() == []


def test_one_of_each_takes_any_column_names(shipped):
    names = ["doc_id", "text", "__k1", "__k2", "k1", "k2", "row", "a b.c"]
    rows = [(k, prose(k // 2, 30), *range(6)) for k in range(6)]
    got = ngram_join.one_of_each(shipped.createDataFrame(rows, names))
    assert got.columns == names and sorted(r["doc_id"] for r in got.collect()) == [0, 2, 4]


def test_runs_for():
    assert ngram_join.runs_for(0.99) > ngram_join.runs_for(0.9) >= 1
