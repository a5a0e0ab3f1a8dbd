"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted

_WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one slice of a source's hash range has on average.
SLICE_ROWS = 5_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], share: float = 1.5,
            most: float = 2.0) -> dict[str | None, float]:
    """Tokens that each source gives: ``share`` of all by weight, none above ``most`` times its size.

    What a full source can't give is shared again among the others by weight. With
    the sources in ascending order of size by weight, the full ones come first, and the
    others get their weight times one level.
    """
    budget, full, rest = share * sum(sizes.values()), 0.0, float(sum(weights.values()))
    order = sorted(sizes, key=lambda s: (most * sizes[s] / weights[s], s is None, s or ""))
    out: dict[str | None, float] = {}
    for k, s in enumerate(order):
        level = (budget - full) / rest
        if most * sizes[s] >= level * weights[s]:
            out.update({r: level * weights[r] for r in order[k:]})
            break
        out[s] = most * sizes[s]
        full, rest = full + out[s], rest - weights[s]
    return out


def cyclic_weights(sources: list[str | None], cycle: tuple[int, ...] = (3, 1, 2)) -> dict[str | None, float]:
    """Weights that repeat over the sources in code-point order, null last."""
    ranked = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
    return {s: cycle[k % len(cycle)] for k, s in enumerate(ranked)}


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, share: float = 1.5, most: float = 2.0,
        id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        seed: str = "", carry: tuple[str, ...] = ()) -> DataFrame:
    """How many words the mix takes of each document.

    Each document has a random key, a hash of seed and identifier. Each source's rows are
    range-sorted by key: the key range is cut into slices of about ``SLICE_ROWS``
    rows, sums of the slices give every slice its start, and a running sum inside a
    slice gives every document its start in the source. The source is then cut at
    exactly its budget: documents before the cut are taken once more than those after
    it, and the one at the cut gives its first words up to it. Sources asked for more
    than they have are repeated in whole epochs before that.

    The table of sources and weights is a setting of the mix, one row for each source; it
    passes the driver. Weights default to 3, 1, 2 in turn.

    Result: id, source, ``size`` (words), ``source_size``, ``target``, ``epochs`` (times the whole
    document is taken), ``part`` (words of it taken once more), ``taken`` (all words), and
    the columns named in ``carry``. Null text has size 0 and gives nothing; null is a source
    of its own; a source without words has target 0. Rows that repeat are mixed like
    others, ties of the key ordered by text. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(id_column).alias("_id"), F.col(source_column).alias("_source"), word_count(F.col(text_column)).alias("size"),
        key.alias("_key"), F.xxhash64(text_column).alias("_tie"), *[quoted(c).alias(f"_carry_{c}") for c in carry])
    known = rows.groupBy("_source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")).collect()
    sizes = {r["_source"]: r["words"] for r in known}
    weights = weights or cyclic_weights(list(sizes))
    aims = targets(sizes, weights, share, most) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    plan = spark.createDataFrame(
        [(r["_source"], r["words"], float(aims[r["_source"]]), max(1, -(-r["rows"] // SLICE_ROWS))) for r in known],
        "_plan_source string, source_size long, target double, _slices long")
    # One row for each source of the setting above.
    rows = rows.join(F.broadcast(plan), F.col("_source").eqNullSafe(F.col("_plan_source"))).drop("_plan_source")
    unit = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("_slice", F.floor(unit * F.col("_slices") / F.lit(1 << 32)))
    by_slice = Window.partitionBy("_source", "_slice")
    starts = rows.groupBy("_source", "_slice").agg(F.sum("size").alias("_sum")).select(
        F.col("_source").alias("_s"), F.col("_slice").alias("_n"),
        (F.sum("_sum").over(Window.partitionBy("_source").orderBy("_slice")) - F.col("_sum")).alias("_before"))
    inside = F.sum("size").over(by_slice.orderBy("_key", "_id", "_tie").rowsBetween(Window.unboundedPreceding, 0))
    ranged = rows.repartitionByRange("_source", "_slice").withColumn("_inside", inside - F.col("size"))
    placed = ranged.join(starts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_n")))
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    cut = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), cut - F.col("_before") - F.col("_inside"))).cast("long")
    return placed.select(
        F.col("_id").alias(id_column), F.col("_source").alias(source_column), "size", "source_size", "target",
        F.when(F.col("size") > 0, whole).otherwise(F.lit(0)).alias("epochs"), part.alias("part"),
        (whole * F.col("size") + part).alias("taken"), *[quoted(f"_carry_{c}").alias(c) for c in carry])


def mixed_documents(docs: DataFrame, weights: Mapping[str | None, float] | None = None, share: float = 1.5,
                    most: float = 2.0, id_column: str = "doc_id", text_column: str = "text",
                    source_column: str = "source") -> DataFrame:
    """The rows of the mix, repeated as often as taken; one cut at its source's budget has its first words only.

    Columns are those of the input, whatever their names. Rows without words are no part of a mix by words.
    """
    rows = docs.select(*[F.col(c).alias(n) for c, n in ((id_column, "id"), (text_column, "text"), (source_column, "source"))],
                       F.struct(*map(quoted, docs.columns)).alias("row"))
    taken = mix(rows, weights, share, most, "id", "text", "source", carry=("row",))
    times = F.col("epochs") + (F.col("part") > 0).cast("long")
    copies = taken.filter(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    text = F.col("row")[text_column]
    short = (F.col("copy") > F.col("epochs")) & (F.col("part") < F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({_WORD})")), F.lit(1), F.col("part").cast("int")), " ")
    return copies.select(*[F.when(short, cut).otherwise(text).alias(c) if c == text_column else F.col("row")[c].alias(c)
                           for c in docs.columns])


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS z,
             list_value(3, 1, 2)[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY 2.0 * z / w, source NULLS LAST) AS k FROM s),
l AS (SELECT *, coalesce(sum(2 * z) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
             sum(z) OVER () AS every FROM o),
v AS (SELECT *, (1.5 * CAST(every AS DOUBLE) - CAST(before AS DOUBLE)) / CAST(rest AS DOUBLE) AS level FROM l),
c AS (SELECT min(k) AS k FROM v WHERE 2.0 * z >= level * w),
t AS (SELECT source, z, CASE WHEN v.k < c.k THEN 2.0 * z ELSE (SELECT level FROM v v2, c c2 WHERE v2.k = c2.k) * w END AS target
      FROM v, c),
p AS (SELECT d.*, t.z, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
             ROWS UNBOUNDED PRECEDING) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN z > 0 THEN floor(floor(target) / z) ELSE 0 END AS whole FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, z AS source_size, target,
       CAST(whole * size + greatest(0, least(size, floor(target) - whole * z - start)) AS BIGINT) AS taken FROM q
"""
