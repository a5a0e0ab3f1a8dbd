"""CSV input with known types, detected encoding and delimiter, and samples of it."""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions.expressions import quoted
from lateline.schema import COLUMN_TYPES, DATE_COLUMNS, ORDER_ID, SEED

DATE_FORMAT = "M/d/yyyy H:mm"
# Spellings of a missing value.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# File names preferred as the main table.
PREFERRED = [r"DataCo", r"(?i)supply"]
DELIMITERS = [",", ";", "\t", "|"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.text(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise FileNotFoundError(path) from problem
        raise


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 when every line is valid UTF-8, else Latin-1, which reads any byte."""
    return inspect(spark, path)[0]


def inspect(spark: SparkSession, path: str) -> tuple[str, bool]:
    """Encoding, and whether a quoted value may hold a line break: a line with an odd number of quotes. One pass."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    row = _lines(spark, path).agg(F.coalesce(F.bool_and(F.is_valid_utf8("value")), F.lit(True)).alias("valid"),
                                  F.coalesce(F.bool_or(quotes % 2 == 1), F.lit(False)).alias("broken")).first()
    return "UTF-8" if row["valid"] else "ISO-8859-1", row["broken"]


@dataclass(frozen=True)
class CsvFile:
    """What one file holds: where it is, how it is written, and the line of its column names."""

    path: str
    encoding: str
    broken: bool
    header: str


def inspect_files(spark: SparkSession, path: str) -> list[CsvFile]:
    """``inspect`` for each file on its own, and its first line, in one pass. One row a file reaches the driver."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = _lines(spark, path).select("value", F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    found = lines.groupBy("file").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("valid"), F.bool_or(quotes % 2 == 1).alias("broken"),
        F.min_by(F.col("value").cast("binary"), F.struct("block", "place")).alias("header")).collect()
    out = []
    for row in sorted(found, key=lambda r: r["file"]):
        encoding = "UTF-8" if row["valid"] else "ISO-8859-1"
        header = bytes(row["header"]).decode("utf-8-sig" if row["valid"] else "latin-1")
        out.append(CsvFile(unquote(row["file"]), encoding, row["broken"], header))
    return out


def detect_delimiters(spark: SparkSession, path: str, lines: int = 50) -> DataFrame:
    """``file`` and the ``delimiter`` that splits its first ``lines`` lines most steadily.

    Delimiters are counted outside quotes. For each, the commonest count above zero and the share of lines that have it
    tell how steady it is; the highest share wins, then the higher count, then the order of ``DELIMITERS``. A file
    without any is taken to have commas.
    """
    first = _lines(spark, path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"),
                                       F.col("_metadata.file_block_start").alias("block")).filter("block = 0 AND length(value) > 0")
    sample = first.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("place"))).filter(F.col("line") <= lines)
    bare = F.regexp_replace("value", r'"[^"]*("|$)', "")
    counts = F.array(*[F.struct(F.lit(-k).alias("order"), F.lit(d).alias("delimiter"),
                                (F.length(bare) - F.length(F.replace(bare, F.lit(d), F.lit("")))).alias("count"))
                       for k, d in enumerate(DELIMITERS)])
    spread = sample.select("file", F.explode(counts).alias("c")).select("file", "c.*")
    steady = spread.filter("count > 0").groupBy("file", "order", "delimiter", "count").agg(F.count(F.lit(1)).alias("lines"))
    best = steady.groupBy("file").agg(F.max(F.struct("lines", "count", "order", "delimiter")).alias("best"))
    return sample.select("file").distinct().join(best, "file", "left").select(
        "file", F.coalesce("best.delimiter", F.lit(",")).alias("delimiter"))


def _header(spark: SparkSession, path: str, delimiter: str | None, encoding: str) -> tuple[list[str], str]:
    reader = spark.read.option("encoding", encoding)
    first = reader.csv(path, sep="\u0001", quote="", schema="line string").first()
    line = first["line"].lstrip("﻿") if first and first["line"] else ""
    delimiter = delimiter or detect_delimiter(line)
    names = next(csv.reader(io.StringIO(line), delimiter=delimiter), [])
    return [n.strip() for n in names], delimiter


def detect_delimiter(header: str) -> str:
    """The delimiter that splits the header line into the most names."""
    return max(DELIMITERS, key=header.count) if any(d in header for d in DELIMITERS) else ","


def _typed(text: Column, kind: T.DataType) -> Column:
    """The value of a text in a type, null if it has none. Whole numbers may be written with a decimal point."""
    if isinstance(kind, T.DoubleType):
        value = text.try_cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(kind, T.IntegralType):
        value = text.try_cast("double")
        return F.coalesce(text.try_cast(kind), F.when(value == F.floor(value), value.try_cast(kind)))
    if isinstance(kind, T.TimestampType):
        return F.coalesce(F.try_to_timestamp(text, F.lit(DATE_FORMAT)), F.try_to_timestamp(text))
    return text


def _unreadable(text: Column, kind: T.DataType) -> Column:
    return F.count_if(text.isNotNull() & _typed(text, kind).isNull())


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, parse_dates: bool = True,
             encoding: str | None = None, delimiter: str | None = ",", rename: Mapping[str, str] | None = None,
             infer_unknown: bool = True, unreadable: str = "error", multi_line: bool | None = None) -> DataFrame:
    """Order lines from CSV files with a header; nothing is lost without a word.

    Every value is read as text (quotes doubled inside quotes, line breaks inside quotes)
    and then typed. One pass over the columns asked for counts the values that their
    type can't hold: above zero that is an error, or with ``unreadable="null"`` they become
    null. The same pass keeps order ids as text unless all are whole numbers, and with
    ``infer_unknown`` makes unknown columns of numbers numeric.

    Another pass finds the encoding, the line breaks inside quotes and the column names of every file on its
    own; pass ``encoding`` and ``multi_line`` to skip it (files with such breaks can't be read in parts).
    ``delimiter=None`` detects the delimiter of every file. Files that are written alike are read together, and
    the groups are put together by column names, absent ones null. ``rename`` maps other names.
    """
    if unreadable not in ("error", "null"):
        raise ValueError(f"unreadable must be error or null, not {unreadable!r}")
    _lines(spark, path)
    groups: dict[tuple, list[str]] = defaultdict(list)
    if encoding is None or multi_line is None or delimiter is None:
        files = inspect_files(spark, path)
        split = {} if delimiter else {unquote(r["file"]): r["delimiter"] for r in detect_delimiters(spark, path).collect()}
        for f in files:
            key = (encoding or f.encoding, f.broken if multi_line is None else multi_line, delimiter or split.get(f.path, ","), f.header)
            groups[key].append(f.path)
    if len(groups) == 1:
        groups = {key: [path] for key in groups}
    if not groups:
        names, delimiter = _header(spark, path, delimiter or ",", encoding or "UTF-8")
        groups[(encoding or "UTF-8", bool(multi_line), delimiter, None)] = [path]
    parts, standard = [], []
    for (own_encoding, lines_broken, own_delimiter, line), paths in groups.items():
        own = names if line is None else [n.strip() for n in next(csv.reader(io.StringIO(line), delimiter=own_delimiter), [])]
        own = [(rename or {}).get(n, n) for n in own]
        standard += [n for n in own if n not in standard]
        parts.append(spark.read.options(header=True, sep=own_delimiter, encoding=own_encoding, quote='"', escape='"', multiLine=lines_broken)
                     .schema(T.StructType([T.StructField(n, T.StringType()) for n in own])).csv(paths))
    absent = [c for c in columns or () if c not in standard]
    if absent:
        raise ValueError(f"columns not in file: {absent}")
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    df = df.select(*[F.when(~quoted(c).isin(MISSING), quoted(c)).alias(c) for c in (columns or standard)])

    kinds = {c: COLUMN_TYPES.get(c, T.StringType()) for c in df.columns}
    if parse_dates:
        kinds.update({c: T.TimestampType() for c in DATE_COLUMNS if c in kinds})
    open_kinds = [c for c in df.columns if c == ORDER_ID or infer_unknown and c not in COLUMN_TYPES]
    typed = [c for c in df.columns if c not in open_kinds and not isinstance(kinds[c], T.StringType)]
    counts = [_unreadable(quoted(c), kinds[c]).alias(f"bad{i}") for i, c in enumerate(typed) if unreadable == "error"]
    counts += [_unreadable(quoted(c), k).alias(f"{n}{i}") for i, c in enumerate(open_kinds)
               for n, k in (("long", T.LongType()), ("double", T.DoubleType()))]
    counts += [F.count(quoted(c)).alias(f"some{i}") for i, c in enumerate(open_kinds)]
    row = df.agg(*counts).first() if counts else {}
    bad = {c: row[f"bad{i}"] for i, c in enumerate(typed) if unreadable == "error" and row[f"bad{i}"]}
    if bad:
        raise ValueError(f"values that can't be read, by column: {bad}; unreadable='null' makes them null")
    for i, c in enumerate(open_kinds):
        kinds[c] = T.StringType()
        if row[f"some{i}"] and not row[f"long{i}"]:
            kinds[c] = T.LongType()
        elif row[f"some{i}"] and not row[f"double{i}"] and c != ORDER_ID:
            kinds[c] = T.DoubleType()
    return df.withColumns({c: _typed(quoted(c), kinds[c]) for c in df.columns if not isinstance(kinds[c], T.StringType)})


def unreadable_values(df: DataFrame) -> DataFrame:
    """For a table read as text: ``column`` and ``rows`` of the values that the column's type can't hold, where there are any."""
    kinds = {c: T.TimestampType() if c in DATE_COLUMNS else COLUMN_TYPES[c] for c in df.columns if c in COLUMN_TYPES}
    kinds = {c: k for c, k in kinds.items() if not isinstance(k, T.StringType) and c != ORDER_ID}
    if not kinds:
        return df.sparkSession.createDataFrame([], "column string, rows long")
    text = {c: F.when(~quoted(c).cast("string").isin(MISSING), quoted(c).cast("string")) for c in kinds}
    counted = df.agg(*[_unreadable(text[c], k).alias(f"bad{i}") for i, (c, k) in enumerate(kinds.items())])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"bad{i}").alias("rows")) for i, c in enumerate(kinds)])
    return counted.select(F.explode(pairs).alias("p")).select("p.column", "p.rows").filter("rows > 0")


def discover_csv(spark: SparkSession, folder: str) -> str:
    """Path of the main CSV table in a folder: the first with a preferred name, else the first.

    A table is a file, or a folder of part files, whose name ends in ``.csv``. Other
    folders are not searched.
    """
    found = None
    for level in ("*.csv", "*.csv/*.csv"):
        try:
            files = spark.read.format("binaryFile").load(f"{folder}/{level}").select("path")
        except AnalysisException:
            continue
        found = files if found is None else found.union(files)
    if found is None:
        raise FileNotFoundError(f"no CSV files in {folder}")
    found = found.select(F.regexp_extract("path", r"^(.*?/[^/]+\.csv)(/|$)", 1).alias("path"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    preferred = F.lit(False)
    for pattern in PREFERRED:
        preferred = preferred | name.rlike(pattern)
    row = found.agg(F.min(F.when(preferred, F.col("path"))).alias("preferred"), F.min("path").alias("any")).first()
    if row["any"] is None:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return row["preferred"] or row["any"]


def head_sample(df: DataFrame, rows: int = 1000, order_by: Sequence[str] = ()) -> DataFrame:
    """First rows in the given order, or as stored."""
    return (df.orderBy(*[quoted(c).asc_nulls_last() for c in order_by]) if order_by else df).limit(rows)


def random_sample(df: DataFrame, rows: int = 1000, seed: int = SEED) -> DataFrame:
    """Exactly ``rows`` rows (or all of them) in the order of a seeded row hash."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[quoted(c) for c in df.columns])).limit(rows)
