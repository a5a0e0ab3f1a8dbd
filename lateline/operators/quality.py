"""Quality rules over an order-line table, reported as rows.

Every rule that needs only counts is an expression of one shared aggregate; the
duplicate rule and the category rules are grouped counts. Nothing is collected
while a report is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions.expressions import quoted, round_half_even, sql_name, sql_text
from lateline.operators.ranks import value_counts
from lateline.schema import (DATE_COLUMNS, DATE_RANGE, DOMAINS, ORDER_DATE, ORDER_ID, RANGES, REAL_DAYS,
                             REQUIRED, SCHEDULED_DAYS, SHIP_DATE, TARGET)

def is_timestamp(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))


@dataclass
class Rule:
    """Rows that meet ``condition`` break the rule; more than ``over`` percent of them is an issue."""

    check: str
    column: str | None
    condition: str
    text: str
    level: str = "warning"
    over: float = 0.0


def _finding(total: Column) -> list[Column]:
    """Report columns from a rule's row count."""
    share = F.coalesce(F.try_divide(F.col("r.rows") * F.lit(100.0), total.cast("double")), F.lit(0.0))
    return [F.col("r.check").alias("check"), F.col("r.column").alias("column"),
            F.when((F.col("r.rows") > 0) & (share > F.col("r.over")), F.col("r.level")).otherwise("ok").alias("severity"),
            F.col("r.rows").cast("long").alias("rows"), round_half_even(share, 4).alias("percent"),
            F.concat(F.format_number("r.rows", 0), F.lit(" "), F.col("r.text")).alias("message")]


def report_rules(df: DataFrame, rules: Sequence[Rule], with_row_count: bool = False) -> DataFrame:
    """All rules in one aggregate, one row each."""
    row = df.agg(F.count(F.lit(1)).alias("total"),
                 *[F.expr(f"count_if({r.condition})").alias(f"n{i}") for i, r in enumerate(rules)])
    made = [f"named_struct('check', {sql_text(r.check)}, 'column', {sql_text(r.column)}, 'rows', n{i}, 'text', "
            f"{sql_text(r.text)}, 'level', {sql_text(r.level)}, 'over', {float(r.over)!r}D)"
            for i, r in enumerate(rules)]
    if with_row_count:
        made.insert(0, "named_struct('check', 'row_count', 'column', cast(null as string), 'rows', total, 'text', 'rows', "
                       "'level', 'ok', 'over', 100.0D)")
    if not made:
        return _no_findings(df)
    report = row.select("total", F.expr(f"explode(array({', '.join(made)}))").alias("r")).select(*_finding(F.col("total")))
    if not with_row_count:
        return report
    counted = F.col("check") == "row_count"
    return report.withColumns({
        "severity": F.when(counted & (F.col("rows") == 0), "error").when(counted & (F.col("rows") < 100), "warning")
                    .otherwise(F.col("severity")),
        "percent": F.when(counted, 100.0).otherwise(F.col("percent"))})


def target_rules(df: DataFrame) -> list[Rule]:
    if TARGET not in df.columns:
        return [Rule("target_missing", TARGET, "true", "rows without a target column", "error")]
    name = sql_name(TARGET)
    return [Rule("target_nulls", TARGET, f"{name} is null", "missing values", "error"),
            Rule("target_values", TARGET, f"{name} not in (0, 1)", "values other than 0 and 1", "error")]


def missing_rules(df: DataFrame) -> list[Rule]:
    return [Rule("missing_values", c, f"{sql_name(c)} is null", "missing values",
                 "warning" if c in REQUIRED else "ok", 10.0) for c in df.columns]


def range_rules(df: DataFrame) -> list[Rule]:
    rules = []
    for c, (low, high) in RANGES.items():
        if c in df.columns:
            rules += [Rule("below_minimum", c, f"{sql_name(c)} < {low}", f"values below {low}"),
                      Rule("above_maximum", c, f"{sql_name(c)} > {high!r}", f"values above {high:g}")]
            if low >= 0:
                rules.append(Rule("negative", c, f"{sql_name(c)} < 0", "negative values"))
    return rules


def date_rules(df: DataFrame) -> list[Rule]:
    rules = []
    for c in (c for c in DATE_COLUMNS if c in df.columns):
        if not is_timestamp(df, c):
            kind = df.schema[c].dataType.simpleString()
            rules.append(Rule("date_type", c, "true", f"rows of type {kind}, not timestamp"))
            continue
        kind = df.schema[c].dataType.simpleString()
        rules += [Rule(f"date_too_{word}", c, f"{sql_name(c)} {sign} cast('{limit}' as {kind})", f"dates beyond {limit}")
                  for word, sign, limit in (("early", "<", DATE_RANGE[0]), ("late", ">", DATE_RANGE[1]))]
    return rules


def consistency_rules(df: DataFrame) -> list[Rule]:
    has, rules = set(df.columns), []
    if {ORDER_DATE, SHIP_DATE} <= has and is_timestamp(df, ORDER_DATE) and is_timestamp(df, SHIP_DATE):
        rules.append(Rule("shipped_before_ordered", SHIP_DATE, f"{sql_name(SHIP_DATE)} < {sql_name(ORDER_DATE)}",
                          "rows shipped before they were ordered"))
    if {TARGET, REAL_DAYS, SCHEDULED_DAYS} <= has:
        late = f"cast(coalesce({sql_name(REAL_DAYS)} > {sql_name(SCHEDULED_DAYS)}, false) as int)"
        rules.append(Rule("late_flag_mismatch", TARGET, f"not ({late} <=> {sql_name(TARGET)})",
                          "rows disagree with the shipping days", over=5.0))
    return rules


def _no_findings(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "check string, column string, severity string, rows long, percent double, message string")


def row_count_check(df: DataFrame) -> DataFrame:
    return report_rules(df, [], with_row_count=True)


def target_check(df: DataFrame) -> DataFrame:
    return report_rules(df, target_rules(df))


def missing_check(df: DataFrame) -> DataFrame:
    return report_rules(df, missing_rules(df))


def range_check(df: DataFrame) -> DataFrame:
    return report_rules(df, range_rules(df))


def date_check(df: DataFrame) -> DataFrame:
    return report_rules(df, date_rules(df))


def consistency_check(df: DataFrame) -> DataFrame:
    return report_rules(df, consistency_rules(df))


def required_columns_check(df: DataFrame) -> DataFrame:
    """One error naming the missing columns; decided from the schema alone."""
    missing = sorted(set(REQUIRED) - set(df.columns))
    return df.sparkSession.range(1).select(
        F.lit("required_columns").alias("check"), F.lit(None).cast("string").alias("column"),
        F.lit("error" if missing else "ok").alias("severity"), F.lit(len(missing)).cast("long").alias("rows"),
        F.lit(0.0).alias("percent"),
        F.lit("missing: " + ", ".join(missing) if missing else "all present").alias("message"))


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), F.lit(0.0))


def _balance_from_counts(counts: DataFrame) -> DataFrame:
    known = counts.filter((F.col("name") == TARGET) & F.col("value").isNotNull())
    row = known.agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("minority"), F.sum("n").alias("known"))
    percent, two = share(F.col("minority"), F.col("known")), F.col("classes") == 2
    wording = F.when(~two, "not two classes").when(percent < 10, "severe imbalance").when(
        percent < 30, "moderate imbalance").otherwise("balanced enough")
    return row.select(
        F.lit("class_balance").alias("check"), F.lit(TARGET).alias("column"),
        F.when(two & (percent < 30), "warning").otherwise("ok").alias("severity"), F.col("minority").alias("rows"),
        round_half_even(percent, 4).alias("percent"), wording.alias("message"))


def balance_check(df: DataFrame) -> DataFrame:
    """Minority share when the target has exactly two classes."""
    return _balance_from_counts(value_counts(df, {TARGET: quoted(TARGET).cast("string")}))


def _domain_from_counts(counts: DataFrame) -> DataFrame:
    outside = None
    for name, accepted in DOMAINS.items():
        test = (F.col("name") == name) & ~F.col("value").isin(accepted)
        outside = test if outside is None else outside | test
    return counts.filter(F.col("value").isNotNull() & outside).select(
        F.lit("unexpected_value").alias("check"), F.col("name").alias("column"), F.lit("warning").alias("severity"),
        F.col("n").alias("rows"), F.lit(None).cast("double").alias("percent"), F.col("value").alias("message"))


def domain_check(df: DataFrame) -> DataFrame:
    """One warning per unexpected spelling, with its row count."""
    present = {c: quoted(c) for c in DOMAINS if c in df.columns}
    return _domain_from_counts(value_counts(df, present)) if present else _no_findings(df)


def _repeats(df: DataFrame, check: str, column: str | None, keys: Sequence[str], over: float, text: str,
             level: str) -> DataFrame:
    groups = df.groupBy(*[quoted(c) for c in keys]).agg(F.count(F.lit(1)).alias("_n"))
    row = groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("rows"),
                     F.coalesce(F.sum("_n"), F.lit(0)).alias("total"))
    rule = F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"), F.col("rows"),
                    F.lit(text).alias("text"), F.lit(level).alias("level"), F.lit(over).alias("over"))
    return row.select("total", rule.alias("r")).select(*_finding(F.col("total")))


def duplicate_check(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical group; order-id repeats are informational.

    Grouping by every column lets copies merge before the shuffle.
    """
    report = _repeats(df, "duplicate_rows", None, df.columns, 5.0, "duplicate rows", "warning")
    if ORDER_ID in df.columns:
        report = report.unionByName(_repeats(df, "repeated_order_id", ORDER_ID, [ORDER_ID], 0.0,
                                             "repeated order ids, expected for orders of several items", "ok"))
    return report


def table_statistics(df: DataFrame) -> DataFrame:
    """Rows, columns, target shares and order-date span as (statistic, value) text rows."""
    aggregates = {"total_rows": F.count(F.lit(1)).cast("string"),
                  "total_columns": F.lit(len(df.columns)).cast("string")}
    if ORDER_DATE in df.columns and is_timestamp(df, ORDER_DATE):
        aggregates["date_range_start"] = F.min(quoted(ORDER_DATE)).cast("date").cast("string")
        aggregates["date_range_end"] = F.max(quoted(ORDER_DATE)).cast("date").cast("string")
    row = df.agg(*[a.alias(n) for n, a in aggregates.items()])
    stats = row.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("statistic"), F.col(n).alias("value")) for n in aggregates])).alias("s")).select("s.*")
    if TARGET in df.columns:
        counts = df.filter(quoted(TARGET).isNotNull()).groupBy(quoted(TARGET).alias("t")).agg(
            F.count(F.lit(1)).alias("n"))
        stats = stats.unionByName(_target_shares(counts))
    return stats


def _target_shares(counts: DataFrame) -> DataFrame:
    # The two classes meet in one row, so no whole-table window is needed.
    row = counts.agg(F.sum("n").alias("known"),
                     F.sum(F.when(F.col("t") == 0, F.col("n")).otherwise(0)).alias("zero"),
                     F.sum(F.when(F.col("t") == 1, F.col("n")).otherwise(0)).alias("one"))
    pairs = F.array(*[
        F.struct(F.lit(f"target_share_{label}").alias("statistic"),
                 F.format_string("%.4f", F.col(name) / F.col("known")).alias("value"))
        for label, name in ((0, "zero"), (1, "one"))])
    return row.select(F.explode(pairs).alias("s")).select("s.*")


def class_balance_report(df: DataFrame, split_column: str | None = None) -> DataFrame:
    """Late and on-time counts, shares and the max/min ratio, over all rows or per split."""
    keys = [split_column] if split_column else []
    late = quoted(TARGET)
    row = df.filter(late.isNotNull()).groupBy(*keys).agg(
        F.count_if(late == 0).alias("on_time"), F.count_if(late == 1).alias("late"))
    total = F.col("on_time") + F.col("late")
    ratio = F.try_divide(F.greatest("on_time", "late").cast("double"), F.least("on_time", "late").cast("double"))
    return row.select(
        *keys, "on_time", "late",
        round_half_even(share(F.col("on_time"), total), 4).alias("on_time_percent"),
        round_half_even(share(F.col("late"), total), 4).alias("late_percent"),
        round_half_even(ratio, 6).alias("imbalance_ratio"),
        F.when(ratio < 1.5, "balanced").when(ratio < 3, "moderate").otherwise("significant").alias("verdict"))


@dataclass
class ValidationResult:
    """All findings; errors decide validity, warnings do not."""

    report: DataFrame
    statistics: DataFrame

    @property
    def issues(self) -> DataFrame:
        return self.report.filter(F.col("severity") != "ok")

    @property
    def is_valid(self) -> bool:
        return self.report.filter(F.col("severity") == "error").isEmpty()


def validate(df: DataFrame) -> ValidationResult:
    """Run every rule: one aggregate, one grouped count of categories, two duplicate counts."""
    rules = [rule for family in (target_rules, missing_rules, range_rules, date_rules, consistency_rules)
             for rule in family(df)]
    report = (report_rules(df, rules, with_row_count=True).unionByName(required_columns_check(df))
              .unionByName(duplicate_check(df)))
    grouped = {c: quoted(c).cast("string") for c in [*DOMAINS, TARGET] if c in df.columns}
    if grouped:
        counts = value_counts(df, grouped)
        report = report.unionByName(_domain_from_counts(counts))
        if TARGET in df.columns:
            report = report.unionByName(_balance_from_counts(counts))
    return ValidationResult(report, table_statistics(df))
