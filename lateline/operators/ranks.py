"""Exact order statistics and running totals that no single task has to hold.

Values are first reduced to (name, value, n) counts, which combine on the map
side, so a value that fills a third of the table costs one row per map task.
Ranks are then found on the counts: a large bracket of values is cut into slots,
one pass counts the slots, and only the slot that holds the rank is searched
further. Numbers are cut into slots of equal width, other values (and numbers
that equal width does not separate) at splitters from a hash-ordered sample.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions.expressions import quoted
from lateline.session import kept, stage

#: Most rows one window partition may hold.
WINDOW_ROWS = 100_000
_SAMPLE = 2048
_SLOTS = 64
_EQUAL_SLOTS = 1024


def encode(column: Column, kind: T.DataType) -> Column:
    """Form in which a value travels through the driver without time-zone shifts."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return column.cast("string")
    return column


def decode(value: Any, kind: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)


@dataclass
class Bracket:
    """Values of one name from low to high (both included), with the ranks to be found there."""

    name: str
    ranks: list[int]
    below: int
    distinct: int
    low: Any = None
    high: Any = None
    stuck: bool = False


@dataclass
class Hit:
    """The value that covers a rank, the rows below it and the rows equal to it."""

    value: Any
    below: int
    rows: int


def number(column: Column) -> Column:
    """As double, with NaN read as missing."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def value_counts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Rows per (name, value) over columns of one common type; nulls are counted."""
    wide = df.select(*[column.alias(name) for name, column in columns.items()])
    if len(columns) == 1:
        name = next(iter(columns))
        return (wide.groupBy(quoted(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(name).alias("name"), "value", "n"))
    return (wide.unpivot([], [quoted(name) for name in columns], "name", "value")
            .groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")))


@dataclass
class Totals:
    """Known rows, distinct known values and null rows of one name, and the span of its numbers."""

    rows: int = 0
    distinct: int = 0
    nulls: int = 0
    low: Any = None
    high: Any = None


def count_totals(counts: DataFrame) -> dict[str, Totals]:
    known = F.col("value").isNotNull()
    span = F.col("value") if isinstance(counts.schema["value"].dataType, T.DoubleType) else F.lit(None)
    rows = counts.groupBy("name").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("rows"),
        F.count(F.when(known, 1)).alias("distinct"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
        F.min(span).alias("low"), F.max(span).alias("high"),
    ).collect()
    return {r["name"]: Totals(r["rows"], r["distinct"], r["nulls"], r["low"], r["high"]) for r in rows}


def _bracket_id(brackets: Sequence[Bracket], kind: T.DataType) -> Column:
    chain = None
    for index, b in enumerate(brackets):
        inside = (F.col("name") == b.name) & F.col("value").isNotNull()
        if b.low is not None:
            inside = inside & (F.col("value") >= decode(b.low, kind))
        if b.high is not None:
            inside = inside & (F.col("value") <= decode(b.high, kind))
        chain = F.when(inside, index) if chain is None else chain.when(inside, index)
    return chain


def _sampled_slots(marked: DataFrame, brackets: Sequence[Bracket], kind: T.DataType) -> Column:
    """Slots between splitters from a sample of each bracket's values by hash, about ``_SAMPLE`` of them.

    The share that is drawn follows from the known number of different values, so no task sorts
    or holds more than the sample.
    """
    share = F.element_at(F.array(*[F.lit(min(1.0, _SAMPLE / max(b.distinct, 1))) for b in brackets]), F.col("b") + 1)
    drawn = (F.xxhash64("value") / F.lit(float(1 << 63)) + 1) / 2 <= share
    sample = (marked.filter(drawn).groupBy("b").agg(F.array_sort(F.collect_list("value")).alias("values"))
              .select("b", F.transform("values", lambda v: encode(v, kind)).alias("values")).collect())
    slot = None
    for row in sample:
        step = max(1, len(row["values"]) // _SLOTS)
        edges = F.array(*[decode(v, kind) for v in row["values"][step - 1::step]])
        position = F.size(F.filter(edges, lambda edge: edge < F.col("value"))).cast("long")
        slot = F.when(F.col("b") == row["b"], position) if slot is None else slot.when(F.col("b") == row["b"], position)
    return slot


def _equal_slots(brackets: Sequence[Bracket]) -> Column:
    def of_bracket(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("b") + 1)

    width = of_bracket([(b.high - b.low) / _EQUAL_SLOTS for b in brackets])
    place = F.floor((F.col("value") - of_bracket([b.low for b in brackets])) / width)
    return F.least(place, F.lit(_EQUAL_SLOTS - 1).cast("long"))


def _spans_evenly(b: Bracket) -> bool:
    if not isinstance(b.low, float) or not isinstance(b.high, float):
        return False
    width = (b.high - b.low) / _EQUAL_SLOTS
    return math.isfinite(width) and width > 0.0 and not b.stuck


def _narrow(counts: DataFrame, brackets: list[Bracket], kind: T.DataType) -> list[Bracket]:
    marked = counts.withColumn("b", _bracket_id(brackets, kind)).filter(F.col("b").isNotNull())
    equal = all(_spans_evenly(b) for b in brackets)
    slot = _equal_slots(brackets) if equal else _sampled_slots(marked, brackets, kind)
    # At most brackets x slots rows.
    slots = (marked.withColumn("slot", slot).groupBy("b", "slot")
             .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct"),
                  encode(F.min("value"), kind).alias("low"), encode(F.max("value"), kind).alias("high"))
             .orderBy("b", "slot").collect())
    narrowed = []
    for index, bracket in enumerate(brackets):
        below = bracket.below
        for row in (s for s in slots if s["b"] == index):
            inside = [r for r in bracket.ranks if below <= r < below + row["rows"]]
            if inside:
                narrowed.append(Bracket(bracket.name, inside, below, row["distinct"], row["low"], row["high"],
                                        stuck=row["distinct"] * 2 > bracket.distinct))
            below += row["rows"]
    return narrowed


def values_at(counts: DataFrame, wanted: Mapping[str, Sequence[int]],
              totals: Mapping[str, Totals],
              window_rows: int | None = None) -> dict[tuple[str, int], Hit]:
    """The value at each wanted rank (0-based, ascending, nulls left out)."""
    window_rows = window_rows or WINDOW_ROWS
    kind = counts.schema["value"].dataType
    brackets = [Bracket(name, sorted(set(ranks)), 0, totals[name].distinct, totals[name].low, totals[name].high)
                for name, ranks in wanted.items() if ranks]
    while any(b.distinct > window_rows for b in brackets):
        large = [b for b in brackets if b.distinct > window_rows]
        brackets = [b for b in brackets if b.distinct <= window_rows] + _narrow(counts, large, kind)
    if not brackets:
        return {}

    marked = counts.withColumn("b", _bracket_id(brackets, kind)).filter(F.col("b").isNotNull())
    order = Window.partitionBy("b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    offset = F.element_at(F.array(*[F.lit(b.below) for b in brackets]), F.col("b") + 1)
    sought = F.element_at(F.array(*[F.array(*[F.lit(r) for r in b.ranks]) for b in brackets]), F.col("b") + 1)
    running = marked.withColumn("end", F.sum("n").over(order) + offset).withColumn("start", F.col("end") - F.col("n"))
    covered = F.exists(sought, lambda rank: (F.col("start") <= rank) & (F.col("end") > rank))
    hits = (running.filter(covered)
            .select("name", encode(F.col("value"), kind).alias("value"), "start", "n").collect())
    found = {}
    for b in brackets:
        for rank in b.ranks:
            for h in hits:
                if h["name"] == b.name and h["start"] <= rank < h["start"] + h["n"]:
                    found[(b.name, rank)] = Hit(h["value"], h["start"], h["n"])
    return found


def percentiles_from_counts(counts: DataFrame, wanted: Mapping[str, Sequence[float]],
                            totals: Mapping[str, Totals] | None = None) -> dict[str, list[float | None]]:
    """Linearly interpolated percentiles of (name, value, n) counts."""
    totals = totals if totals is not None else count_totals(counts)
    ranks = {}
    for name, fractions in wanted.items():
        rows = totals.get(name, Totals()).rows
        if rows:
            spots = [p * (rows - 1) for p in fractions]
            ranks[name] = [r for s in spots for r in (int(s), min(int(s) + 1, rows - 1))]
    found = values_at(counts, ranks, totals)
    result: dict[str, list[float | None]] = {}
    for name, fractions in wanted.items():
        rows = totals.get(name, Totals()).rows
        if not rows:
            result[name] = [None] * len(fractions)
            continue
        result[name] = []
        for p in fractions:
            spot = p * (rows - 1)
            low = found[(name, int(spot))].value
            high = found[(name, min(int(spot) + 1, rows - 1))].value
            result[name].append(low + (high - low) * (spot - int(spot)))
    return result


def percentile_ranks(rows: int, fractions: Sequence[float]) -> list[tuple[int, int, float]]:
    """Lower rank, upper rank and weight of the upper one for each fraction."""
    spots = [p * (rows - 1) for p in fractions]
    return [(int(s), min(int(s) + 1, rows - 1), s - int(s)) for s in spots]


def exact_percentiles(df: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[float]]],
                      approx: bool = False) -> dict[str, list[float | None]]:
    """Percentiles of numeric columns; ``approx`` trades exactness for one map-side sketch."""
    if approx:
        row = df.agg(*[F.percentile_approx(column.cast("double"), list(fractions), 10_000).alias(name)
                       for name, (column, fractions) in wanted.items()]).first()
        return {name: list(row[name]) if row[name] else [None] * len(wanted[name][1]) for name in wanted}
    counts = value_counts(df, {name: number(column) for name, (column, _) in wanted.items()})
    with kept(counts) as counts:
        return percentiles_from_counts(counts, {name: p for name, (_, p) in wanted.items()})


@dataclass
class Cut:
    """A place in the order: rows before ``prefix``, plus ``copies`` rows equal to it, lie left."""

    prefix: list[tuple[str, Any]] = field(default_factory=list)
    copies: int = 0
    whole: bool = False


def find_cuts(df: DataFrame, order: Sequence[str], positions: Sequence[int],
              window_rows: int | None = None) -> list[Cut]:
    """Cuts that put exactly ``positions[i]`` rows on the left, nulls ordered last.

    One count per value of the first column places every cut; only the rows that
    share the boundary value are looked at again, with the next column.
    """
    window_rows = window_rows or WINDOW_ROWS
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return _cuts_in_group(df, list(order), kinds, list(positions), [], window_rows)


def _cuts_in_group(group: DataFrame, order: list[str], kinds: Mapping[str, T.DataType],
                   positions: list[int], prefix: list[tuple[str, Any]], window_rows: int) -> list[Cut]:
    first, rest = order[0], order[1:]
    kind = kinds[first]
    with kept(value_counts(group, {first: quoted(first)})) as counts:
        totals = count_totals(counts)
        known, nulls = totals.get(first, Totals()).rows, totals.get(first, Totals()).nulls
        hits = values_at(counts, {first: [p for p in positions if p < known]}, totals, window_rows)
    cuts: list[Cut] = []
    for position in positions:
        if position >= known + nulls:
            cuts.append(Cut(whole=True))
            continue
        hit = hits[(first, position)] if position < known else Hit(None, known, nulls)
        inside, here = position - hit.below, prefix + [(first, hit.value)]
        if inside == 0:
            cuts.append(Cut(here))
        elif not rest:
            cuts.append(Cut(here, copies=inside))
        else:
            ties = group.filter(quoted(first).eqNullSafe(decode(hit.value, kind)))
            if hit.rows <= window_rows:
                cuts.append(_cut_among_few(ties, rest, kinds, inside, here))
            else:
                cuts += _cuts_in_group(ties, rest, kinds, [inside], here, window_rows)
    return cuts


def _cut_among_few(ties: DataFrame, order: list[str], kinds: Mapping[str, T.DataType],
                   position: int, prefix: list[tuple[str, Any]]) -> Cut:
    window = Window.partitionBy(F.lit(0)).orderBy(*[quoted(c).asc_nulls_last() for c in order])
    row = (ties.select(*[quoted(c) for c in order])
           .withColumn("_at", F.row_number().over(window)).withColumn("_first", F.rank().over(window))
           .filter(F.col("_at") == position + 1)
           .select("_at", "_first", *[encode(quoted(c), kinds[c]).alias(c) for c in order]).first())
    return Cut(prefix + [(c, row[c]) for c in order], copies=row["_at"] - row["_first"])


def _precedes(column: Column, value: Any, kind: T.DataType) -> Column:
    if value is None:
        return column.isNotNull()
    return F.coalesce(column < decode(value, kind), F.lit(False))


def _ordering_key(values: Sequence[Column]) -> Column:
    """Struct that compares like the listed values, nulls last."""
    return F.struct(*[part for i, v in enumerate(values)
                      for part in (v.isNull().alias(f"gap{i}"), v.alias(f"value{i}"))])


def _tuple_precedes(own: Sequence[Column], other: Sequence[Column]) -> Column:
    return _ordering_key(own) < _ordering_key(other)


def left_of(cut: Cut, kinds: Mapping[str, T.DataType]) -> Column:
    """Whether a row comes before the cut's prefix.

    Nearly every row is decided by the first column; only ties build the key.
    """
    if cut.whole:
        return F.lit(True)
    (name, value), rest = cut.prefix[0], cut.prefix[1:]
    before = _precedes(quoted(name), value, kinds[name])
    if not rest:
        return before
    ties = _tuple_precedes([quoted(n) for n, _ in rest], [decode(v, kinds[n]) for n, v in rest])
    return F.when(quoted(name).eqNullSafe(decode(value, kinds[name])), ties).otherwise(before)


def label_by_cuts(df: DataFrame, cuts: Sequence[Cut], labels: Sequence[str], column: str) -> DataFrame:
    """Label each row by the cuts it lies between.

    Rows that agree in every column of the order cannot be told apart; where a cut falls
    inside such a group its rows are written once and numbered: by their place in a part,
    behind the rows of the parts before.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    chain = None
    for cut, label in zip(cuts, labels):
        test = left_of(cut, kinds)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    chain = chain.otherwise(labels[-1])

    groups: dict[tuple, Column] = {}
    for cut in cuts:
        if cut.copies:
            same = F.lit(True)
            for name, value in cut.prefix:
                same = same & quoted(name).eqNullSafe(decode(value, kinds[name]))
            groups[tuple(cut.prefix)] = same
    plain = df
    for same in groups.values():
        plain = plain.filter(~same)
    result = plain.withColumn(column, chain)
    for key, same in groups.items():
        row_values = dict(key)
        ties, number_of = _numbered(df.filter(same))
        copy_label = None
        for cut, label in zip(cuts, labels):
            if not cut.whole and tuple(cut.prefix) == key:
                test = number_of < cut.copies
            else:
                test = F.lit(True) if cut.whole else _tuple_before(row_values, cut, kinds)
            copy_label = F.when(test, label) if copy_label is None else copy_label.when(test, label)
        result = result.unionByName(ties.withColumn(column, copy_label.otherwise(labels[-1])).select(*result.columns))
    return result


def _numbered(df: DataFrame) -> tuple[DataFrame, Column]:
    """The rows, written once, and a column that numbers them from 0 without a gap."""
    written = stage(df.withColumn("_spot", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("_spot", 33)
    before, starts = 0, []
    for row in sorted(written.groupBy(part.alias("part")).count().collect()):  # one row a part written
        starts += [F.lit(row["part"]), F.lit(before)]
        before += row["count"]
    inside = F.col("_spot").bitwiseAND((1 << 33) - 1)
    return written, (F.create_map(*starts)[part] + inside if starts else inside)


def _tuple_before(row: Mapping[str, Any], cut: Cut, kinds: Mapping[str, T.DataType]) -> Column:
    return _tuple_precedes([decode(row[n], kinds[n]) for n, _ in cut.prefix],
                           [decode(v, kinds[n]) for n, v in cut.prefix])


def with_running_totals(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column],
                        by: Sequence[str] = (), rows_bound: int | None = None, staged: bool = False,
                        window_rows: int | None = None) -> DataFrame:
    """Inclusive running sums along ``order`` within each ``by`` group.

    ``order`` should be unique within a group. A table beyond one window is range
    partitioned and written; part totals give each part its starting offset.
    ``rows_bound`` is a known bound on the rows, ``staged`` says they are written already.
    """
    window_rows = window_rows or WINDOW_ROWS
    if rows_bound is None or rows_bound > window_rows:
        df = df if staged else stage(df, "running")
        rows = df.count()
    else:
        rows = rows_bound
    if rows <= window_rows:
        window = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({name: F.sum(column).over(window) for name, column in sums.items()})

    parts = -(-rows // window_rows)
    keys = [*by, "_part"]
    ranged = stage(df.repartitionByRange(parts, *[F.col(b) for b in by], *order)
                   .withColumn("_part", F.spark_partition_id()), "ranged")
    part_order = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
               .select(*keys, *[F.coalesce(F.sum(f"_sum_{n}").over(part_order), F.lit(0)).alias(f"_off_{n}")
                                for n in sums]))
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.withColumns({n: F.sum(c).over(window) for n, c in sums.items()}).join(offsets, keys)
    return joined.withColumns({n: F.col(n) + F.col(f"_off_{n}") for n in sums}).drop(
        "_part", *[f"_off_{n}" for n in sums])
