"""Cleaning of order lines: drop, deduplicate, impute, winsorise, standardise, type.

``Cleaner.fit`` learns fill values and bounds from grouped value counts: the
counts of a column give its nulls, median, mode, the percentiles after
imputation and the number of capped rows, so the table itself is read once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions.expressions import clip, quoted, round_half_even, strip, text_or_nan, title
from lateline.operators.ranks import (Totals, count_totals, exact_percentiles, number, percentile_ranks,
                                      value_counts, values_at)
from lateline.schema import (CATEGORICALS, CATEGORY_FILL, CRITICAL, DATE_COLUMNS, NUMERIC_FILL, NUMERICALS,
                             TARGET, UNUSED, WINSOR)
from lateline.session import kept, stage, together

COPIES = "_copies"
DATE_FORMAT = "M/d/yyyy H:mm"


@dataclass
class CleanOptions:
    remove_duplicates: bool = True
    handle_missing: bool = True
    handle_outliers: bool = True
    standardize_categories: bool = True
    drop_unused: bool = True
    numeric_fill: dict[str, str] = field(default_factory=lambda: dict(NUMERIC_FILL))
    category_fill: dict[str, str] = field(default_factory=lambda: dict(CATEGORY_FILL))
    winsor: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(WINSOR))


@dataclass
class CleaningState:
    """Learned values of every listed column, and the counts behind the report."""

    fills: dict[str, float | str] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    imputed: dict[str, int] = field(default_factory=dict)
    capped: dict[str, int] = field(default_factory=dict)
    merged: dict[str, tuple[int, int]] = field(default_factory=dict)
    critical: dict[str, int] = field(default_factory=dict)
    initial_rows: int = 0
    distinct_rows: int = 0
    final_rows: int = 0

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> CleaningState:
        return CleaningState(**json.loads(text))


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in UNUSED if c in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row per group of identical rows, with the group's size in ``_copies``.

    All columns are grouping keys, so copies merge before the shuffle.
    """
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES))


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    present = [c for c in CRITICAL if c in df.columns]
    return df.dropna(subset=present) if present else df


def standardize(df: DataFrame, columns: Sequence[str] = tuple(CATEGORICALS)) -> DataFrame:
    text = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: title(strip(text_or_nan(quoted(c)))) for c in text})


def fix_types(df: DataFrame) -> DataFrame:
    """Integer target, double numbers, timestamp dates; unreadable values become null."""
    changes = {c: quoted(c).try_cast("double") for c in NUMERICALS if c in df.columns}
    if TARGET in df.columns:
        changes[TARGET] = quoted(TARGET).try_cast("double").cast("int")
    for c in DATE_COLUMNS:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            changes[c] = F.coalesce(F.try_to_timestamp(quoted(c), F.lit(DATE_FORMAT)), F.try_to_timestamp(quoted(c)))
        elif c in df.columns and isinstance(df.schema[c].dataType, T.DateType):
            changes[c] = quoted(c).cast("timestamp")
    return df.withColumns(changes)


@dataclass
class CleanerModel:
    state: CleaningState
    options: CleanOptions

    def transform(self, df: DataFrame) -> DataFrame:
        """Clean a table with the learned values."""
        if self.options.drop_unused:
            df = drop_unused(df)
        if self.options.remove_duplicates:
            df = df.dropDuplicates()
        return self.apply(drop_critical_nulls(df))

    def apply(self, df: DataFrame) -> DataFrame:
        """The row-wise part: fill, cap, standardise, type."""
        changes = {}
        for c in {**self.options.numeric_fill, **self.options.winsor}:
            if c not in df.columns:
                continue
            value = quoted(c).cast("double")
            if self.options.handle_missing and c in self.state.fills:
                value = F.coalesce(value, F.lit(float(self.state.fills[c])))
            if self.options.handle_outliers and c in self.state.bounds:
                value = clip(value, *self.state.bounds[c])
            changes[c] = value
        for c in self.options.category_fill:
            if c in df.columns and self.options.handle_missing and c in self.state.fills:
                changes[c] = F.coalesce(quoted(c), F.lit(self.state.fills[c]))
        df = df.withColumns(changes) if changes else df
        if self.options.standardize_categories:
            df = standardize(df)
        return fix_types(df)

    def report(self, spark: SparkSession) -> DataFrame:
        """(step, column, rows, detail) rows."""
        s = self.state
        rows = [("initial_rows", None, s.initial_rows, None), ("final_rows", None, s.final_rows, None),
                ("rows_removed", None, s.initial_rows - s.final_rows, None),
                ("duplicates_removed", None, s.initial_rows - s.distinct_rows, None)]
        rows += [("critical_null", c, n, None) for c, n in s.critical.items()]
        rows += [("imputed", c, n, str(s.fills[c])) for c, n in s.imputed.items()]
        rows += [("capped", c, n, f"[{s.bounds[c][0]:.2f}, {s.bounds[c][1]:.2f}]") for c, n in s.capped.items()]
        rows += [("standardized", c, after, f"{before} -> {after}") for c, (before, after) in s.merged.items()
                 if after < before]
        return spark.createDataFrame(rows, "step string, column string, rows long, detail string")

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"state": asdict(self.state), "options": asdict(self.options)})
        spark.createDataFrame([(text,)], "state string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> CleanerModel:
        text = json.loads(spark.read.parquet(path).first()["state"])
        return CleanerModel(CleaningState(**text["state"]), CleanOptions(**text["options"]))


class Cleaner:
    """Estimator of a ``CleanerModel``."""

    def __init__(self, **options) -> None:
        self.options = CleanOptions(**options)

    def _distinct(self, df: DataFrame) -> DataFrame:
        if self.options.drop_unused:
            df = drop_unused(df)
        if self.options.remove_duplicates:
            # The group-by shuffles whole rows; its result is written once and
            # read by the fit and by every later use of the cleaned table.
            return stage(distinct_rows(df), "distinct")
        return df.withColumn(COPIES, F.lit(1).cast("long"))

    def fit(self, df: DataFrame) -> CleanerModel:
        return self._fit(self._distinct(df))

    def fit_transform(self, df: DataFrame) -> tuple[DataFrame, CleanerModel]:
        """Clean the table the values are learned from."""
        base = self._distinct(df)
        model = self._fit(base)
        return model.apply(drop_critical_nulls(base.drop(COPIES))), model

    def _fit(self, base: DataFrame) -> CleanerModel:
        state = CleaningState()
        self._count_rows(base, state)
        rows = drop_critical_nulls(base)
        tasks = []
        if self.options.handle_missing or self.options.handle_outliers:
            tasks.append(self._learn_numbers)
        if self.options.handle_missing or self.options.standardize_categories:
            tasks.append(self._learn_categories)
        together(*[lambda learn=learn: learn(rows, state) for learn in tasks])
        return CleanerModel(state, self.options)

    def _count_rows(self, base: DataFrame, state: CleaningState) -> None:
        aggregates = {"initial": F.coalesce(F.sum(COPIES), F.lit(0)), "distinct": F.count(F.lit(1))}
        earlier = F.lit(True)
        present = [c for c in CRITICAL if c in base.columns]
        for index, c in enumerate(present):
            aggregates[f"null_{index}"] = F.count_if(earlier & quoted(c).isNull())
            earlier = earlier & quoted(c).isNotNull()
        aggregates["final"] = F.count_if(earlier)
        row = base.agg(*[a.alias(n) for n, a in aggregates.items()]).first()
        state.initial_rows, state.distinct_rows, state.final_rows = row["initial"], row["distinct"], row["final"]
        state.critical = {c: row[f"null_{i}"] for i, c in enumerate(present) if row[f"null_{i}"]}

    def _learn_numbers(self, rows: DataFrame, state: CleaningState) -> None:
        o = self.options
        wanted = [c for c in {**o.numeric_fill, **o.winsor} if c in rows.columns]
        if not wanted:
            return
        with kept(value_counts(rows, {c: number(quoted(c)) for c in wanted})) as counts:
            totals = count_totals(counts)
            gaps = {c: rule for c, rule in o.numeric_fill.items()
                    if o.handle_missing and totals.get(c, Totals()).rows}
            bounded = [c for c in o.winsor if o.handle_outliers and totals.get(c, Totals()).rows]
            found = self._find_values(counts, totals, gaps, bounded)
            self._numeric_fills(counts, totals, gaps, found, state)
            self._winsor_bounds(counts, totals, bounded, found, state)

    def _find_values(self, counts: DataFrame, totals: dict[str, Totals], gaps: dict[str, str],
                     bounded: list[str]) -> dict:
        """Every value the fills and bounds may need, in one search.

        Filling k nulls with m moves the values above m by k ranks and leaves the
        rest in place, so rank r of the filled column is rank r or r - k of the
        column as it is, or m itself.
        """
        ranks: dict[str, list[int]] = {}
        for c, rule in gaps.items():
            if rule not in ("mean", "zero", "mode"):
                ranks.setdefault(c, []).extend(r for low, high, _ in percentile_ranks(totals[c].rows, [0.5])
                                               for r in (low, high))
        for c in bounded:
            shift = totals[c].nulls if c in gaps else 0
            for low, high, _ in percentile_ranks(totals[c].rows + shift, self.options.winsor[c]):
                ranks.setdefault(c, []).extend(r for at in (low, high) for r in (at, at - shift)
                                               if 0 <= r < totals[c].rows)
        return values_at(counts, ranks, totals)

    def _numeric_fills(self, counts: DataFrame, totals: dict[str, Totals], gaps: dict[str, str], found: dict,
                       state: CleaningState) -> None:
        means, modes = {}, {}
        if any(rule in ("mean", "mode") for rule in gaps.values()):
            for row in (counts.filter(F.col("value").isNotNull()).groupBy("name").agg(
                    F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n")).alias("mean"),
                    F.min(F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()):
                means[row["name"]], modes[row["name"]] = row["mean"], row["mode"]["value"]
        for c, rule in gaps.items():
            if rule in ("mean", "zero", "mode"):
                value = {"zero": 0.0, "mean": means.get(c), "mode": modes.get(c)}[rule]
            else:
                low, high, part = percentile_ranks(totals[c].rows, [0.5])[0]
                bottom, top = found[(c, low)].value, found[(c, high)].value
                value = bottom + (top - bottom) * part
            state.fills[c] = value
            if totals[c].nulls:
                state.imputed[c] = totals[c].nulls

    def _winsor_bounds(self, counts: DataFrame, totals: dict[str, Totals], bounded: list[str], found: dict,
                       state: CleaningState) -> None:
        def filled_value(c: str, rank: int) -> float:
            if c not in state.fills:
                return found[(c, rank)].value
            here, moved = found.get((c, rank)), found.get((c, rank - totals[c].nulls))
            if here is not None and here.value <= state.fills[c]:
                return here.value
            if moved is None or moved.value <= state.fills[c]:
                return state.fills[c]
            return moved.value

        outside, bounds = F.lit(0), {}
        for c in bounded:
            shift = totals[c].nulls if c in state.fills else 0
            bounds[c] = []
            for low, high, part in percentile_ranks(totals[c].rows + shift, self.options.winsor[c]):
                bottom, top = filled_value(c, low), filled_value(c, high)
                bounds[c].append(bottom + (top - bottom) * part)
            value = F.coalesce("value", F.lit(state.fills[c])) if c in state.fills else F.col("value")
            beyond = (value < bounds[c][0]) | (value > bounds[c][1])
            outside = F.when(F.col("name") == c, F.when(beyond, F.col("n")).otherwise(0)).otherwise(outside)
        if not bounds:
            return
        for row in counts.groupBy("name").agg(F.sum(outside).alias("rows")).collect():
            if row["rows"]:
                state.capped[row["name"]] = row["rows"]
        state.bounds.update({c: tuple(pair) for c, pair in bounds.items()})

    def _learn_categories(self, rows: DataFrame, state: CleaningState) -> None:
        wanted = [c for c in dict.fromkeys([*self.options.category_fill, *CATEGORICALS]) if c in rows.columns]
        if not wanted:
            return
        with kept(value_counts(rows, {c: quoted(c).cast("string") for c in wanted})) as counts:
            totals = count_totals(counts)
            if self.options.handle_missing:
                gaps = {c: rule for c, rule in self.options.category_fill.items() if c in rows.columns}
                modes = {r["name"]: r["mode"]["value"] for r in (
                    counts.filter(F.col("value").isNotNull()).groupBy("name")
                    .agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect())} if gaps else {}
                for c, rule in gaps.items():
                    state.fills[c] = modes.get(c, "Unknown") if rule == "mode" else rule
                    if totals.get(c, Totals()).nulls:
                        state.imputed[c] = totals[c].nulls
            if self.options.standardize_categories:
                value = F.col("value")
                for c in (c for c in CATEGORICALS if c in state.fills):
                    value = F.when(F.col("name") == c, F.coalesce("value", F.lit(state.fills[c]))).otherwise(value)
                spelled = counts.filter(F.col("name").isin(CATEGORICALS)).withColumn("value", value)
                for row in (spelled.groupBy("name").agg(
                        F.count_distinct("value").alias("before"),
                        F.count_distinct(title(strip(F.coalesce("value", F.lit("nan"))))).alias("after")).collect()):
                    state.merged[row["name"]] = (row["before"], row["after"])


def clean(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Cleaned table and its report."""
    cleaned, model = Cleaner(**options).fit_transform(df)
    return cleaned, model.report(df.sparkSession)


def missing_summary(df: DataFrame) -> DataFrame:
    """Null count and percent of each column that has nulls, most nulls first."""
    counts = {f"c{i}": F.count_if(quoted(c).isNull()) for i, c in enumerate(df.columns)}
    row = df.agg(F.count(F.lit(1)).alias("total"), *[a.alias(n) for n, a in counts.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("missing_count"))
                      for i, c in enumerate(df.columns)])
    percent = F.try_divide(F.col("p.missing_count").cast("double"), F.col("total").cast("double")) * 100.0
    return (row.select("total", F.explode(pairs).alias("p"))
            .filter(F.col("p.missing_count") > 0)
            .select("p.column", "p.missing_count", round_half_even(percent, 2).alias("missing_percent"))
            .orderBy(F.desc("missing_count"), "column"))


def outlier_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    """Rows beyond 1.5 interquartile ranges from the quartiles, per numeric column."""
    present = [c for c in NUMERICALS if c in df.columns]
    quartiles = exact_percentiles(df, {c: (quoted(c), [0.25, 0.75]) for c in present}, approx)
    aggregates, pairs = [F.count(F.lit(1)).alias("total")], []
    for i, c in enumerate(present):
        first, third = quartiles[c]
        if first is None:
            continue
        spread = third - first
        low, high = first - 1.5 * spread, third + 1.5 * spread
        aggregates += [F.count_if(quoted(c) < low).alias(f"below{i}"), F.count_if(quoted(c) > high).alias(f"above{i}")]
        pairs.append(F.struct(
            F.lit(c).alias("column"), F.col(f"below{i}").alias("below_lower"), F.col(f"above{i}").alias("above_upper"),
            (F.col(f"below{i}") + F.col(f"above{i}")).alias("total_outliers"),
            round_half_even(F.lit(low), 2).alias("lower_bound"), round_half_even(F.lit(high), 2).alias("upper_bound")))
    if not pairs:
        return df.sparkSession.createDataFrame([], (
            "column string, below_lower long, above_upper long, total_outliers long, lower_bound double,"
            "upper_bound double, outlier_percent double"))
    percent = F.try_divide(F.col("p.total_outliers").cast("double"), F.col("total").cast("double")) * 100.0
    return (df.agg(*aggregates).select("total", F.explode(F.array(*pairs)).alias("p"))
            .filter(F.col("p.total_outliers") > 0)
            .select("p.*", round_half_even(percent, 2).alias("outlier_percent"))
            .orderBy(F.desc("total_outliers"), "column"))
