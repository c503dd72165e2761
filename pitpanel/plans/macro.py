"""Macro features: release chains, year-over-year, daily grid with surprises, changes, z-scores and stale marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.config import Macro
from pitpanel.functions.scalar import div
from pitpanel.operators.asof import asof_nearest, calendar, densify
from pitpanel.operators.dedupe import keep_last
from pitpanel.operators.windows import Series

c = F.col
S = Series("series", "date")


def choose_source(rows: DataFrame) -> DataFrame:
    """Of each series, the rows of the source with the smallest `priority` that returned any."""
    w = Window.partitionBy("series")
    return rows.withColumn("_m", F.min("priority").over(w)).where("priority = _m").drop("_m")


def observations(rows: DataFrame, lags: dict[str, int], default_lag: int = 0) -> DataFrame:
    """(series, date, value) -> one per date, with effective_date = date + publication lag."""
    lag = F.coalesce(*(F.when(c("series") == s, n) for s, n in lags.items()), F.lit(default_lag))
    return keep_last(rows, ["series", "date"], ["value"]).withColumn("effective_date", F.date_add("date", lag))


def year_over_year(obs: DataFrame, tolerance: int = 20) -> DataFrame:
    """Value to percent change from the observation nearest to a year before; rows without one go."""
    d = asof_nearest(obs, obs, ["series"], F.add_months("date", -12), "date", "value", tolerance, "_y")
    return d.withColumn("value", div(c("value") - c("_y"), F.abs("_y")) * 100.0).drop("_y").where("value is not null")


def daily_grid(obs: DataFrame, as_of=None) -> DataFrame:
    """Observations by effective date -> series x day with value, surprise, chg_pct, last_date, all carried forward."""
    e = Series("series", "effective_date")
    obs = keep_last(obs, ["series", "effective_date"], ["date"]) if "date" in obs.columns else obs
    prev = e.lag(c("value"))
    obs = obs.select("series", "effective_date", "value", (c("value") - prev).alias("surprise"), div(c("value") - prev, F.abs(prev)).alias("chg_pct"), c("effective_date").alias("last_date"))
    end = F.max("effective_date") if as_of is None else F.greatest(F.max("effective_date"), F.lit(as_of).cast("date"))
    grid = densify(obs, calendar(obs, F.min("effective_date"), end), ["series"], "effective_date")
    return grid.select("series", "date", *(S.ffill(c(x)).alias(x) for x in ("value", "surprise", "chg_pct", "last_date")))


def series_features(grid: DataFrame, daily_series=None, staleness: dict[str, int] | None = None, m: Macro = Macro()) -> DataFrame:
    """Adds pct_{n}d (of the daily series; of all where none are named), z252 and stale (NULL before the first observation or without threshold)."""
    d = grid
    for n in m.change_windows:
        change = S.change(c("value"), n)
        d = d.withColumn(f"pct_{n}d", change if daily_series is None else F.when(c("series").isin(*daily_series), change))
    d = d.withColumn("z252", S.zscore(c("value"), m.z_window, m.z_window // 4))
    limit = F.coalesce(*(F.when(c("series") == s, n) for s, n in (staleness or {}).items()), F.lit(None).cast("int"))
    return d.withColumn("stale", F.when(c("value").isNotNull(), (F.datediff("date", "last_date") > limit).cast("int")))


def wide(features: DataFrame, series: list[str], daily_series=None, staleness: dict[str, int] | None = None, m: Macro = Macro()) -> DataFrame:
    """One row per day, a block of columns per series; the names are given, so no job looks for them."""
    outs = {"value": "", "surprise": "_surprise", "chg_pct": "_chg_pct", **{f"pct_{n}d": f"_pct_{n}d" for n in m.change_windows}, "z252": "_z252", "stale": "_stale"}
    cols = []
    for s in series:
        for x, suffix in outs.items():
            if (x.startswith("pct_") and daily_series is not None and s not in daily_series) or (x == "stale" and s not in (staleness or {})):
                continue
            cols.append(F.max(F.when(c("series") == s, c(x))).alias(s + suffix))
    return features.groupBy("date").agg(*cols)


def sector_factor(grid: DataFrame, sector_map, window: int = 20) -> DataFrame:
    """Mean over a sector's series of their change over `window` days, missing ones left out."""
    of = F.filter(F.array(*(F.struct(F.lit(sec).alias("sector"), F.lit(s).alias("s")) for sec, names in sector_map for s in names)), lambda p: p["s"] == c("series"))
    d = grid.withColumn("r", S.change(c("value"), window)).select("date", "r", F.explode(of).alias("p"))
    return d.groupBy("date", "p.sector").agg(F.avg("r").alias("sector_cmdty_ret"))
