"""Column functions with the null rules of the panel: missing is NULL, never NaN; a zero denominator gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def not_below(x: Column, low: float = 0.0) -> Column:
    """max(x, low), NULL where x is (greatest alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def flag(cond: Column) -> Column:
    """1 or 0; a missing comparison counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def tier(x: Column, tiers) -> Column:
    """The value of the half-open band [low, high) that x falls into."""
    out = F.lit(None).cast("double")
    for low, high, value in tiers:
        out = F.when((x >= low) & (x < high), F.lit(float(value))).otherwise(out)
    return out


def significant(x: Column, digits: int = 6) -> Column:
    """Rounded to so many significant digits, as a number."""
    places = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), places.cast("double"))
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def first_usable(df, candidates, by: str | list[str]) -> Column:
    """The first of the candidate columns that holds any value in each group of `by`, whole."""
    from pyspark.sql import Window

    w = Window.partitionBy(by)
    out = F.lit(None).cast("double")
    for c in reversed([c for c in candidates if c in df.columns]):
        out = F.when(F.max(F.col(c).isNotNull()).over(w), F.col(c)).otherwise(out)
    return out
