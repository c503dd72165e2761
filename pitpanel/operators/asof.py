"""As-of joins and calendars, as windows over the union of both sides (one shuffle, no range join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], at: str, right_at: str, tolerance: int | None, ties: str, columns: list[str]) -> DataFrame:
    """left with `columns` of the newest right row whose date is at most left's, none older than `tolerance` days.

    Of right rows with the same date, that with the greatest `ties` counts; right rows without date are ignored.
    """
    r = right.where(F.col(right_at).isNotNull()).select(*by, F.col(right_at).alias(at), F.struct(F.col(right_at).alias("_at"), *columns).alias("_r"), F.col(ties).alias("_tie"), F.lit(0).alias("_side"))
    u = left.withColumn("_side", F.lit(1)).unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(F.col(at), "_side", F.col("_tie")).rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    ok = F.datediff(F.col(at), F.col("_m._at")) <= tolerance if tolerance is not None else F.lit(True)
    return u.select(*left.columns, *(F.when(ok, F.col(f"_m.{c}")).alias(c) for c in columns))


def asof_nearest(left: DataFrame, right: DataFrame, by: list[str], target: Column, right_at: str, value: str, tolerance: int, name: str) -> DataFrame:
    """left with the value of the right row nearest to the target date within `tolerance` days; of two, the later."""
    r = right.select(*by, F.col(right_at).alias("_t"), F.struct(F.col(right_at).alias("d"), F.col(value).alias("v")).alias("_r"), F.lit(1).alias("_side"))
    u = left.withColumn("_t", target).withColumn("_side", F.lit(2)).unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy("_t", "_side")
    back = F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("_r", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    u = u.withColumn("_b", back).withColumn("_a", ahead).where("_side = 2")
    gap_b, gap_a = F.datediff("_t", F.col("_b.d")), F.datediff(F.col("_a.d"), F.col("_t"))
    b_ok, a_ok = F.coalesce(gap_b <= tolerance, F.lit(False)), F.coalesce(gap_a <= tolerance, F.lit(False))
    pick = F.when(a_ok & (~b_ok | (gap_a <= gap_b)), F.col("_a.v")).when(b_ok, F.col("_b.v"))
    return u.withColumn(name, pick).select(*left.columns, name)


def calendar(df: DataFrame, start: Column, end: Column, by: list[str] | None = None, name: str = "date") -> DataFrame:
    """Every day from start to end (aggregates of df), per key of `by` or once."""
    span = df.groupBy(*(by or [])).agg(start.alias("_a"), end.alias("_z")).where("_a is not null")
    return span.select(*(by or []), F.explode(F.sequence("_a", "_z", F.expr("interval 1 day"))).alias(name))


def densify(obs: DataFrame, days: DataFrame, by: list[str], at: str) -> DataFrame:
    """One row per key and day, with the observation of that day if any; then fill forward with Series.ffill."""
    keys = obs.select(*by).distinct()
    # days: one row a day; keys: one row a series. Both are small beside the grid they span.
    return keys.join(days).join(obs.withColumnRenamed(at, days.columns[0]), [*by, days.columns[0]], "left")
