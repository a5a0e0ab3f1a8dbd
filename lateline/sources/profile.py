"""Column profiles and integer narrowing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions.expressions import quoted, round_half_even, sql_name, sql_text
from lateline.operators.ranks import value_counts

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Largest magnitude of each integer type.
_LIMITS = [("tinyint", 2 ** 7), ("smallint", 2 ** 15), ("int", 2 ** 31), ("bigint", 2 ** 63)]


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """dtype, null and distinct counts and the three smallest values of every column.

    The exact form is one grouped count of (column, value); ``approx`` replaces it
    by sketches in a single aggregate and leaves the samples out.
    """
    kinds = "map(" + ", ".join(f"{sql_text(f.name)}, {sql_text(f.dataType.simpleString())}" for f in df.schema) + ")"
    if approx:
        row = df.agg(F.count(F.lit(1)).alias("total"), *[
            F.expr(f"struct(count({sql_name(c)}) as known, approx_count_distinct({sql_name(c)}) as distinct)").alias(f"c{i}")
            for i, c in enumerate(df.columns)])
        items = ", ".join(f"struct({sql_text(c)} as name, c{i}.known, c{i}.distinct, total)"
                          for i, c in enumerate(df.columns))
        table = row.select(F.expr(f"inline(array({items}))")).withColumn("samples", F.lit(None).cast("string"))
    else:
        counts = value_counts(df, {c: quoted(c).cast("string") for c in df.columns})
        table = counts.groupBy("name").agg(
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("known"),
            F.count("value").alias("distinct"), F.sum("n").alias("total"))
        smallest = Window.partitionBy("name").orderBy("value")
        samples = (counts.filter(F.col("value").isNotNull()).withColumn("k", F.row_number().over(smallest))
                   .filter(F.col("k") <= 3).groupBy("name")
                   .agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("samples")))
        # One row per column of the table.
        table = table.join(F.broadcast(samples), "name", "left")
    nulls = F.col("total") - F.col("known")
    percent = F.try_divide(nulls * 100.0, F.col("total").cast("double"))
    return table.select(
        F.col("name").alias("column"), F.element_at(F.expr(kinds), F.col("name")).alias("dtype"),
        F.col("known").alias("non_null_count"), nulls.alias("null_count"),
        round_half_even(percent, 2).alias("null_percent"), F.col("distinct").alias("unique_count"),
        F.coalesce("samples", F.lit("")).alias("sample_values"))


def narrowing_plan(df: DataFrame) -> DataFrame:
    """Smallest integer type that holds each integer column, from one min/max aggregate."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGERS)]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, dtype string, low long, high long, narrow string")
    row = df.agg(*[F.expr(f"struct(cast(min({sql_name(c)}) as bigint) as low, cast(max({sql_name(c)}) as bigint) as high)")
                   .alias(f"c{i}") for i, c in enumerate(names)])
    items = ", ".join(f"struct({sql_text(c)} as column, {sql_text(df.schema[c].dataType.simpleString())} as dtype, "
                      f"c{i}.low as low, c{i}.high as high)" for i, c in enumerate(names))
    narrow = None
    for kind, limit in _LIMITS[:-1]:
        fits = (F.col("low") >= -limit) & (F.col("high") < limit)
        narrow = F.when(fits, kind) if narrow is None else narrow.when(fits, kind)
    narrow = F.when(F.col("low").isNull(), F.col("dtype")).otherwise(narrow.otherwise("bigint"))
    return row.select(F.expr(f"inline(array({items}))")).withColumn("narrow", narrow)


def narrowed(df: DataFrame) -> DataFrame:
    """Integer columns cast to the types of ``narrowing_plan``."""
    plan = narrowing_plan(df).collect()
    return df.withColumns({r["column"]: quoted(r["column"]).cast(r["narrow"]) for r in plan}) if plan else df


# Bytes of one value of each type of fixed width.
_WIDTHS = [(T.BooleanType, 1), (T.ByteType, 1), (T.ShortType, 2), (T.IntegerType, 4), (T.LongType, 8), (T.FloatType, 4),
           (T.DoubleType, 8), (T.DateType, 4), (T.TimestampType, 8), (T.TimestampNTZType, 8)]
_INTEGER_BYTES = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}
OFFSET_BYTES, SKETCH_BITS, DICTIONARY_SHARE = 4, 16, 0.5


def memory_plan(df: DataFrame, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Bytes of each column before and after narrowing: ``column, dtype, plain_bytes, stored_as, narrow_bytes``.

    Plain bytes are the width of the type times the rows; a text or binary value has its own bytes and an offset.
    Integers narrow to the smallest type that holds them, doubles to floats if no value changes by
    it, and texts to a dictionary if less than half of the known values are different: a code of 1, 2 or 4
    bytes a row, and the different values with their mean length. Columns without known values, and all others,
    stay; nested ones have null sizes. Validity bits are left out.

    All comes from one aggregate. The number of different texts is that of a mergeable sketch of
    ``2 ** sketch_bits`` bytes a column: exact up to some thousands, beyond with a standard error of
    1.04 / sqrt(2 ** sketch_bits), 0.4 % for 16.
    """
    widths = {f.name: next((w for kind, w in _WIDTHS if isinstance(f.dataType, kind)), None) for f in df.schema}
    schema = "column string, dtype string, plain_bytes long, stored_as string, narrow_bytes long"
    aggregates, items = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        name, own = sql_name(f.name), f"c{i}"
        if isinstance(f.dataType, _INTEGERS):
            facts = f"cast(min({name}) as bigint) as low, cast(max({name}) as bigint) as high"
        elif isinstance(f.dataType, T.DoubleType):
            facts = f"count({name}) as known, bool_and(isnan({name}) or cast(cast({name} as float) as double) = {name}) as same"
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            facts = (f"count({name}) as known, coalesce(sum(octet_length({name})), 0) as bytes, "
                     f"coalesce(hll_sketch_estimate(hll_sketch_agg({name}, {sketch_bits})), 0) as distinct")
        else:
            facts = "1 as none"
        aggregates.append(F.expr(f"struct({facts})").alias(own))
        row, kind = "rows", f.dataType.simpleString()
        width = widths[f.name]
        if isinstance(f.dataType, T.DecimalType):
            width = 8 if f.dataType.precision <= 18 else 16
        plain, stored, narrow = (f"{row} * {width}" if width else "cast(null as bigint)"), sql_text(kind), None
        if isinstance(f.dataType, _INTEGERS):
            tests = "".join(f"when {own}.low >= -{limit} and {own}.high < {limit} then '{t}' " for t, limit in _LIMITS[:-1])
            stored = f"case when {own}.low is null then {sql_text(kind)} {tests}else 'bigint' end"
            narrow = f"{row} * case {stored} " + " ".join(f"when '{t}' then {b}" for t, b in _INTEGER_BYTES.items()) + " end"
        elif isinstance(f.dataType, T.DoubleType):
            stored = f"case when {own}.known > 0 and {own}.same then 'float' else 'double' end"
            narrow = f"{row} * case when {own}.known > 0 and {own}.same then 4 else 8 end"
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            plain = f"{row} * {OFFSET_BYTES} + {own}.bytes"
            few = f"{own}.known > 0 and {own}.distinct < {DICTIONARY_SHARE} * {own}.known"
            code = f"case when {own}.distinct <= 256 then 1 when {own}.distinct <= 65536 then 2 else 4 end"
            stored = f"case when {few} then 'dictionary' else {sql_text(kind)} end"
            narrow = (f"case when {few} then {row} * {code} + {own}.distinct * {OFFSET_BYTES} + "
                      f"{own}.distinct * {own}.bytes div {own}.known else {plain} end")
        items.append(f"named_struct('column', {sql_text(f.name)}, 'dtype', {sql_text(kind)}, 'plain_bytes', cast({plain} as bigint), "
                     f"'stored_as', {stored}, 'narrow_bytes', cast({narrow or plain} as bigint))")
    if not items:
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(*aggregates).select(F.expr(f"inline(array({', '.join(items)}))"))


def memory_summary(plan: DataFrame) -> DataFrame:
    """Megabytes before and after, and the percentage saved."""
    total = plan.agg(F.sum("plain_bytes").alias("b"), F.sum("narrow_bytes").alias("a"))
    return total.select(
        round_half_even(F.col("b") / 1e6, 2).alias("before_mb"), round_half_even(F.col("a") / 1e6, 2).alias("after_mb"),
        round_half_even(F.try_divide((F.col("b") - F.col("a")) * 100.0, F.col("b").cast("double")), 1).alias("saved_percent"))
