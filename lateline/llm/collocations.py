"""Phrases scored as collocations, counted in depth-truncated suffix trees of groups of word prefixes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.spans import Texts, mix, slices, span_hashes, texts
from lateline.operators.ranks import with_running_totals
from lateline.session import stage

DEPTH, LEAST, TOP = 3, 10, 2_000
#: Suffixes of a group of prefixes; a prefix of more is extended by a word.
GROUP_SUFFIXES = 250_000
#: Bits of the filter of frequent words for each of them, and at most.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 27
SLICE_BYTES = 2_000_000
# The characters that end a piece, and those that part words in one.
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, 0x09]] = True


@dataclass
class Pieces:
    """Words of some rows as numbers of a vocabulary of the slice.

    ``word`` has the number of each word, ``row`` its row, ``room`` how many words its piece has from it on.
    """

    vocabulary: pa.Array
    hashes: np.ndarray
    word: np.ndarray
    row: np.ndarray
    room: np.ndarray


def _pieces(column: pa.Array) -> Pieces:
    t = texts(column)
    data = t.data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    raw = data[:t.size]
    ends = _ENDS[raw]
    solid = ~(ends | _BLANKS[raw])
    apart = np.zeros(t.size + 1, bool)
    apart[t.edges] = True
    before, after = np.zeros(t.size, bool), np.zeros(t.size, bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    starts = np.flatnonzero(solid & (~before | apart[:-1]))
    stops = np.flatnonzero(solid & (~after | apart[1:])) + 1
    row = np.searchsorted(t.edges, starts, side="right") - 1
    piece = np.cumsum(ends, dtype=np.int32)[starts]
    count = len(starts)
    new = np.ones(count, bool)
    new[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    room = np.repeat(np.append(first[1:], count), np.diff(np.append(first, count))) - np.arange(count)
    lengths = stops - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    spelled = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), count, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[solid])])
    numbered = spelled.dictionary_encode()
    spans = texts(numbered.dictionary)
    hashes = span_hashes(spans, spans.edges[:-1], np.diff(spans.edges))
    return Pieces(numbered.dictionary, hashes, numbered.indices.to_numpy(zero_copy_only=False).astype(np.int64), row, room)


def _text(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_string()).cast(pa.string())


def _phrases(p: Pieces, words: list[np.ndarray]) -> pa.Array:
    """Space-joined phrases of columns of word numbers; -1 is no word."""
    columns = [pc.take(p.vocabulary, pa.array(w, mask=w < 0)) for w in words]
    if len(columns) == 1:
        return _text(columns[0])
    return _text(pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()), null_handling="skip"))


def _different(size: int, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First places and times of the different tuples of numbers from -1 to ``size`` - 1."""
    key, reach = columns[0] + 1, size + 1
    for column in columns[1:]:
        if reach > (1 << 62) // (size + 1):
            _, key = np.unique(key, return_inverse=True)
            reach = len(key) + 1
        key, reach = key * (size + 1) + column + 1, reach * (size + 1)
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    return first, times


def _langs(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names of the languages, the language number of each row, and a hash of each."""
    numbered = batch.column("lang").dictionary_encode()
    names = numbered.dictionary.to_pylist()
    spans = texts(numbered.dictionary)
    return names, numbered.indices.to_numpy(zero_copy_only=False).astype(np.int64), span_hashes(
        spans, spans.edges[:-1], np.diff(spans.edges))


def _prefix_keys(p: Pieces, lang_hash: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """64 bits that stand for the language and the words of a prefix; they place it in a group."""
    key = mix(lang_hash)
    for w in words:
        key = mix(key ^ p.hashes[w])
    return key


def _sorted_has(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
    return values[at] == keys


def _prefix_counts(rows: DataFrame, depth: int, heavy: np.ndarray | None) -> DataFrame:
    """``lang, phrase, key, f`` of all prefixes of ``depth`` words whose own prefix is ``heavy`` (None: of all).

    A slice is added up before anything is sent, and so is a task.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                p = _pieces(part.column("text"))
                names, lang, hashes = _langs(part)
                at = np.flatnonzero(p.room >= depth)
                words = [p.word[at + k] for k in range(depth)]
                if heavy is not None:
                    near = _sorted_has(heavy, _prefix_keys(p, hashes[lang[p.row[at]]], words[:-1]))
                    at, words = at[near], [w[near] for w in words]
                own = lang[p.row[at]]
                if not len(at):
                    continue
                first, times = _different(max(len(p.vocabulary), len(names)), [own, *words])
                own, words = own[first], [w[first] for w in words]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()).take(pa.array(own)), _phrases(p, words),
                     pa.array(_prefix_keys(p, hashes[own], words).view(np.int64)), pa.array(times)],
                    ["lang", "phrase", "key", "f"])

    return rows.mapInArrow(count, "lang string, phrase string, key long, f long").groupBy("lang", "phrase", "key").agg(
        F.sum("f").alias("f"))


def _frequent_filter(keys: DataFrame, number: int) -> np.ndarray:
    """Bits set at two places of each key; ``FILTER_BITS`` for a key, ``MOST_FILTER_BITS`` at most.

    Beyond that it lets more through, never less.
    """
    size = 64
    while size < min(number * FILTER_BITS, MOST_FILTER_BITS):
        size *= 2
    places = F.explode(F.array(*[F.shiftrightunsigned("key", shift).bitwiseAND(size - 1) for shift in (0, 32)])).alias("at")
    words = keys.select(places).groupBy(F.expr("at div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _may_have(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for shift in (0, 32):
        at = (keys >> np.uint64(shift)) & np.uint64(64 * len(bits) - 1)
        out &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


def _starts(light: DataFrame, suffixes: int) -> np.ndarray:
    """Least keys of the groups: prefixes in the order of their keys, cut where their suffixes pass the budget.

    One number for each ``suffixes`` suffixes of the input reaches the driver.
    """
    totals = with_running_totals(light, [F.col("key"), F.col("lang"), F.col("phrase")], {"until": F.col("f")}, staged=True)
    group = F.expr(f"(until - f) div {suffixes}").alias("group")
    return np.sort(totals.groupBy(group).agg(F.min("key").alias("key")).select("key").toArrow().column("key").to_numpy())


def _subtrees(depth: int, prefix: int) -> Callable[[pa.Table], pa.Table]:
    """Counts of all nodes below the prefixes of a group, from the totals of the leaves up."""
    def build(table: pa.Table) -> pa.Table:
        nodes = pa.table({"lang": table.column("lang"), "phrase": table.column("phrase"), "f": table.column("f"),
                          "size": table.column("size")})
        out = []
        for level in range(depth, prefix, -1):
            at = nodes.filter(pc.equal(nodes.column("size"), level)).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
            out.append(at.rename_columns(["lang", "phrase", "f"]))
            # A node's parent is its phrase without the last word; its total comes on top of suffixes that end there.
            above = pc.replace_substring_regex(at.column("phrase"), " [^ ]*$", "")
            parents = pa.table({"lang": at.column("lang"), "phrase": above, "f": at.column("f_sum"),
                                "size": pa.array(np.full(len(at), level - 1, np.int32))})
            nodes = pa.concat_tables([nodes.filter(pc.less(nodes.column("size"), level)), parents])
        return pa.concat_tables(out).select(["lang", "phrase", "f"]).cast(
            pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())]))
    return build


def phrase_counts(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, group_suffixes: int = GROUP_SUFFIXES,
                  lang_column: str = "lang", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Counts of phrases and words: ``lang, phrase, f, size`` of those of at least ``least`` occurrences, and ``lang, n``.

    Suffixes of ``depth`` words are counted in trees. First the input is cut vertically: words are counted as
    prefixes, and prefixes in the order of a hash are put together in groups of
    ``group_suffixes`` suffixes. A prefix of more is extended by a word and counted again,
    until the parts fit or have all ``depth`` words, when their count is all that is wanted. Then each
    suffix goes to the group of its prefix, added up by slice before, and every group builds its
    trees on its own and reads the counts of the nodes from the totals of its leaves.

    Only suffixes of frequent words are sent, by a filter of bounded size that lets some others
    through: what is rarer than ``least`` can't be part of what isn't.
    """
    rows = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    words = stage(_prefix_counts(rows, 1, None), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= least)
    number = frequent.count()
    bits = _frequent_filter(frequent, number)
    counted = [frequent.select("lang", "phrase", "f", F.lit(1).alias("size"))]

    level, prefixes, heavy = 1, frequent, None
    cuts: list[tuple[int, np.ndarray, np.ndarray | None, np.ndarray]] = []  # words, starts, own heavy prefix, heavy here
    while True:
        if level == depth:
            break
        large = F.col("f") > group_suffixes
        over = np.sort(prefixes.filter(large).select("key").toArrow().column("key").to_numpy().view(np.uint64))
        cuts.append((level, _starts(prefixes.filter(~large), group_suffixes), heavy, over))
        if not len(over):
            break
        level, heavy = level + 1, over
        prefixes = stage(_prefix_counts(rows, level, heavy).filter(F.col("f") >= least), "prefixes")
        counted.append(prefixes.select("lang", "phrase", "f", F.lit(level).alias("size")))

    for words_of, starts, own_heavy, over in cuts:
        def suffixes(batches: Iterator[pa.RecordBatch], words_of=words_of, starts=starts, own_heavy=own_heavy,
                     over=over) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text", SLICE_BYTES):
                    p = _pieces(part.column("text"))
                    names, lang, hashes = _langs(part)
                    own = lang[p.row]
                    known = np.zeros(len(p.word), bool)
                    at, times = _different(max(len(p.vocabulary), len(names)), [own, p.word])
                    tells = np.zeros((len(names), len(p.vocabulary)), bool)
                    tells[own[at], p.word[at]] = _may_have(bits, _prefix_keys(p, hashes[own[at]], [p.word[at]]))
                    known = tells[own, p.word]
                    # How many frequent words of the piece follow without a gap, itself included.
                    run = np.minimum(p.room, 1) * known
                    for k in range(1, depth):
                        longer = np.zeros(len(run), bool)
                        there = np.flatnonzero((run == k) & (p.room > k))
                        longer[there] = known[there + k]
                        run = run + longer
                    at = np.flatnonzero(run > words_of)
                    if not len(at):
                        continue
                    columns = [np.where(run[at] > k, p.word[np.minimum(at + k, len(p.word) - 1)], -1) for k in range(depth)]
                    first, times = _different(max(len(p.vocabulary), len(names)), [own[at], *columns])
                    columns, langs, size = [c[first] for c in columns], own[at][first], run[at][first]
                    key = _prefix_keys(p, hashes[langs], columns[:words_of])
                    mine = ~_sorted_has(over, key)
                    if own_heavy is not None:
                        mine &= _sorted_has(own_heavy, _prefix_keys(p, hashes[langs], columns[:words_of - 1]))
                    group = np.maximum(np.searchsorted(starts, key.view(np.int64), side="right") - 1, 0)
                    order = np.flatnonzero(mine)
                    order = order[np.argsort(group[order], kind="stable")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(group[order].astype(np.int32)), pa.array(names, pa.string()).take(pa.array(langs[order])),
                         _phrases(p, [c[order] for c in columns]), pa.array(times[order]), pa.array(size[order].astype(np.int32))],
                        ["group", "lang", "phrase", "f", "size"])

        if len(starts):
            dealt = rows.mapInArrow(suffixes, "group int, lang string, phrase string, f long, size int")
            found = dealt.groupBy("group").applyInArrow(_subtrees(depth, words_of), "lang string, phrase string, f long")
            counted.append(found.filter(F.col("f") >= least).select(
                "lang", "phrase", "f", F.size(F.split("phrase", " ")).alias("size")))
    every = counted[0]
    for more in counted[1:]:
        every = every.union(more)
    return stage(every, "phrases"), totals


def _part(words: Column, begin: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, top: int = TOP,
                 group_suffixes: int = GROUP_SUFFIXES, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z become lower case; ``.,;:!?`` and the characters 10 to 13 end a piece, blanks and tabs part its
    words. Candidates have 2 to ``depth`` words and occur at least ``least`` times inside pieces.
    Cut after its first words, a candidate of ``a`` occurrences whose parts have ``l`` and ``r``
    scores floor(1000000 a a / (l r)); its lowest cut counts, of equal ones that with the
    shortest first part. A candidate goes if a longer one that holds it has half of its
    occurrences. The order is by score and ``a``, falling, then by the bytes of the phrase. The
    arithmetic is on decimals of 38 digits, exact up to 10^15 occurrences.

    A null language is ``und``; a null text is empty. Repeated rows count each. An empty table gives
    an empty result. Only the two named columns are read.
    """
    counts, totals = phrase_counts(docs, depth, least, group_suffixes, lang_column, text_column)
    candidates = counts.filter("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = candidates.select(
        "lang", "phrase", "size", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "size", "a", "k", _part(F.col("words"), 1, F.col("k")).alias("first"),
        _part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    plain = counts.select("lang", "phrase", "f")
    sized = cuts.join(plain.toDF("lang", "first", "l"), ["lang", "first"]).join(plain.toDF("lang", "rest", "r"), ["lang", "rest"])
    a, left, right = (F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r"))
    score = F.expr("(cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0)))) div "
                   "(cast(l as decimal(15,0)) * cast(r as decimal(15,0)))").alias("score")
    scored = sized.select("lang", "phrase", "size", "a", "k", "l", "r", score).groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.filter("size > 2").select(
        "lang", F.col("f").alias("longer"), "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")).select(
        "lang", "longer", "words", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("begin")).select(
        "lang", "longer", _part(F.col("words"), F.col("begin"), F.col("length")).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left_over = scored.join(held, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.expr("cast(longer as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * 50")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left_over.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: What ``collocations`` gives with its usual parameters, over ``documents``.
COLLOCATIONS_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, doc_id, row_number() OVER () AS rid,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(x, '[\x20\x09]+'), lambda w: w != '') AS w FROM (
        SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS x FROM t)),
g AS (SELECT lang, w[i:i + s - 1] AS ph, s FROM (
        SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM (
          SELECT lang, w, unnest([1, 2, 3]) AS s FROM p) WHERE len(w) >= s)),
c AS (SELECT lang, array_to_string(ph, ' ') AS phrase, any_value(ph) AS ph, s, count(*) AS f FROM g GROUP BY lang, phrase, s),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE s = 1 GROUP BY lang),
d AS (SELECT * FROM c WHERE s > 1 AND f >= 10),
k AS (SELECT lang, phrase, s, f AS a, k, array_to_string(ph[1:k], ' ') AS p1, array_to_string(ph[k + 1:s], ' ') AS p2
      FROM (SELECT *, unnest(range(1, s)) AS k FROM d)),
z AS (SELECT k.lang, k.phrase, k.s, k.a, k.k, x.f AS l, y.f AS r,
             (1000000::HUGEINT * k.a * k.a) // (x.f::HUGEINT * y.f) AS score
      FROM k JOIN c x ON x.lang = k.lang AND x.phrase = k.p1 JOIN c y ON y.lang = k.lang AND y.phrase = k.p2),
m AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pos FROM z),
h AS (SELECT lang, phrase, max(f) AS longer FROM (
        SELECT lang, f, array_to_string(ph[1:2], ' ') AS phrase FROM d WHERE s = 3
        UNION ALL SELECT lang, f, array_to_string(ph[2:3], ' ') FROM d WHERE s = 3) GROUP BY ALL),
o AS (SELECT m.lang, m.phrase, a, l, r, score FROM m LEFT JOIN h ON h.lang = m.lang AND h.phrase = m.phrase
      WHERE pos = 1 AND (longer IS NULL OR 100 * longer < 50 * a)),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT q.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM q JOIN n ON n.lang = q.lang WHERE rank <= 2000
"""
