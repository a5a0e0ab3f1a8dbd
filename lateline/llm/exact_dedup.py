"""Exact duplicates by content sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Runs of white space other than a single blank.
_SPACES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Leading characters that the splitters hold; texts that begin alike are split by their hash.
_LEAD = 32


def normalised(text: Column) -> Column:
    """Each run of white space as one blank; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACES, " ")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     runs: int | None = None) -> DataFrame:
    """Mark, for every row, the row that stays among those of equal text.

    The normalised bytes are range-partitioned by splitters that Spark samples (their
    first characters, then a hash of the whole, so that a splitter is small and a common
    beginning is no hot spot), each part is sorted outside memory, and the sorted neighbours are compared in full: a
    new group begins where a text differs from the one before it. The smallest
    identifier of a group stays.

    A text frequent enough to fill a part is cut into several sorted runs by a hash
    of the identifier. Frequent means more than 1 in ``runs`` of all rows (default:
    the number of shuffle partitions), so there are fewer than ``runs`` such texts and
    fewer than 2 x ``runs`` heads of runs, whatever the data; only those heads meet
    again, compared in full once more.

    Result: ``id_column``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``; one row for
    each input row. Null text equals empty text. Null identifiers come last; a group of
    nothing else has a null ``keep_id``. Of repeated rows with the same identifier and
    text exactly one is kept. An empty table gives an empty result; other columns of
    the input, whatever their names, are not read.
    """
    spark = docs.sparkSession
    runs = runs or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_column).alias("id"), normalised(F.col(text_column)).alias("norm"))
    rows = rows.withColumn("digest", F.xxhash64("norm"))
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    total = docs.count()
    # Fewer than `runs` rows by the condition, so small whatever the input.
    frequent = counts.filter(F.col("copies") * runs > total).select(
        "digest", F.ceil(F.col("copies") * runs / max(total, 1)).alias("cuts"))
    rows = rows.join(F.broadcast(frequent), "digest", "left").withColumn(
        "run", F.when(F.col("cuts") > 1, F.pmod(F.xxhash64("id"), F.col("cuts"))).otherwise(F.lit(-1)))
    rows = rows.withColumn("lead", F.substring("norm", 1, _LEAD))
    group = Window.partitionBy("lead", "digest", "norm", "run")
    order = group.orderBy(F.col("id").asc_nulls_last())

    def runs_of(part: DataFrame) -> DataFrame:
        return (part.withColumn("place", F.row_number().over(order))
                .withColumn("head", F.first("id").over(order))
                .withColumn("size", F.count(F.lit(1)).over(group)))

    heads = runs_of(rows.filter(F.col("run") >= 0)).filter("place = 1")
    whole = Window.partitionBy("norm")
    heads = heads.select(
        "norm", "run", F.min("id").over(whole).alias("keep"), F.sum("size").over(whole).alias("group_size"),
        F.row_number().over(whole.orderBy(F.col("id").asc_nulls_last())).alias("rank"))
    heads = heads.select(F.sha2("norm", 256).alias("text_sha256"), "run", "keep", "group_size", "rank")
    ranged = rows.select("id", "norm", "lead", "digest", "run").repartitionByRange("lead", "digest", "run")
    sorted_rows = runs_of(ranged).select(
        "id", "run", "head", "place", "size", F.sha2("norm", 256).alias("text_sha256"))
    met = sorted_rows.join(F.broadcast(heads), ["text_sha256", "run"], "left")
    return met.select(
        F.col("id").alias(id_column),
        F.when(F.col("run") < 0, F.col("head")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("group_size", "size").alias("group_size"),
        ((F.col("place") == 1) & (F.coalesce("rank", F.lit(1)) == 1)).alias("kept"),
        "text_sha256")


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""
