"""Column expressions whose result is defined for nulls, bin edges and zero."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Remove every kind of leading and trailing white space."""
    # Only before a last line break of Unicode do the pattern and a plain trim differ.
    return F.when(F.right(text, F.lit(1)).isin("\u0085", "\u2028", "\u2029"), F.regexp_replace(text, r"^\s+|\s+$", "")).otherwise(
        F.btrim(text, F.lit(" \t\n\x0b\f\r")))


def title(text: Column) -> Column:
    """Capitalise each letter that follows a non-letter, lower-case the rest."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})")
    parts = F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), "")
    # Plain letters and spaces, nearly every category, need no words of their own.
    return F.when(F.rlike(text, F.lit(r"\A[A-Za-z ]*\z")), F.initcap(text)).otherwise(parts)


def text_or_nan(column: Column) -> Column:
    """Null becomes its own category, spelled ``nan``."""
    return F.coalesce(column.cast("string"), F.lit("nan"))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clip(column: Column, low: float | None, high: float | None) -> Column:
    """Limit to [low, high], keeping nulls."""
    limited = column
    if high is not None:
        limited = F.least(limited, F.lit(high))
    if low is not None:
        limited = F.greatest(limited, F.lit(low))
    return F.when(column.isNotNull(), limited)


def round_half_even(column: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back."""
    scale = float(10 ** digits)
    return F.rint(column.cast("double") * F.lit(scale)) / F.lit(scale)


def right_closed_bins(column: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the bin (edge, next edge]; null outside every bin."""
    result = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (column > F.lit(low)) & (column <= F.lit(high))
        result = F.when(inside, F.lit(label)) if result is None else result.when(inside, F.lit(label))
    return result


def lookup(key: Column, table: Mapping, default) -> Column:
    """Value of a small fixed table, or the default for unknown and null keys."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def per_nonzero(numerator: Column, denominator: Column) -> Column:
    """Quotient with a zero denominator read as one."""
    safe = F.when(denominator == 0, F.lit(1.0)).otherwise(denominator.cast("double"))
    return numerator.cast("double") / safe


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def mean_of_known(columns: Sequence[Column]) -> Column:
    """Row mean over the non-null columns."""
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns[1:]),
                F.coalesce(columns[0].cast("double"), F.lit(0.0)))
    known = sum((c.isNotNull().cast("int") for c in columns[1:]), columns[0].isNotNull().cast("int"))
    return F.when(known > 0, total / known)


def quoted(name: str) -> Column:
    """Column whose name may hold dots or brackets."""
    return F.col(sql_name(name))


def sql_name(name: str) -> str:
    """Column name as written in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str | None) -> str:
    """String literal as written in SQL text."""
    if text is None:
        return "cast(null as string)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
