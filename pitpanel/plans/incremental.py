"""Features kept by month and brought up to date from the changed raw rows alone.

A changed bar makes its ticker's rows dirty from its month on (means with an endless memory carry a change forward); rows before
that month stay. The dirty rows are computed anew with a halo, as many earlier rows as the longest frame reaches back, and the
exponential means are taken up from their states at the last row before. Features across tickers are computed anew on
every date of the dirty months, from the new rows and the stored ones of the other tickers. Only dirty months are written
(dynamic partition overwrite). Raw rows lie in a KeyedTable by ticker, whose change log says what is dirty; the version that the features
stand for is noted last, so a run that fails is simply done again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.config import Flow, Technical, Universe
from pitpanel.functions.scalar import div, finite
from pitpanel.operators.windows import Series
from pitpanel.plans import flow, technical
from pitpanel.sources import folders
from pitpanel.sources.keyed import KeyedTable

c = F.col
S = Series("ticker", "date")


@dataclass(frozen=True)
class Plan:
    """Features of raw rows (ticker, date, ...): `prepare` cleans rows one by one, `series` adds the features of a ticker's own
    rows, `across` those of a date. `back` rows are all that frames reach; `states` names columns with an endless memory, which
    `series` takes up from `_known` (a struct of them) at `_known_at`. `factor` tells rows that hold what earlier ones lack."""

    prepare: Callable[[DataFrame], DataFrame]
    series: Callable[[DataFrame], DataFrame]
    back: int
    across: Callable[[DataFrame], DataFrame] | None = None
    across_columns: tuple[str, ...] = ()
    states: tuple[str, ...] = ()
    factor: str | None = None
    least_rows: int = 0


def technical_plan(u: Universe = Universe(), t: Technical = Technical(), adjusted: bool = True) -> Plan:
    factor = div(c("adj_close"), c("close"))
    return Plan(
        prepare=lambda raw: technical.clean(raw).withColumn("_has_factor", finite(factor).isNotNull() if adjusted else F.lit(True)),
        series=lambda d: technical.series_features(d, u, t, states=True).drop("adj_close", "dividends", "stock_splits", "n"),
        back=technical.look_back(u, t), across=lambda d: technical.cross_section(d, t), across_columns=tuple(f"{x}_cs_z" for x in t.cross_section),
        states=technical.STATES, factor="_has_factor", least_rows=u.min_rows,
    )


def flow_plan(f: Flow = Flow(), start: str | None = None) -> Plan:
    return Plan(
        prepare=lambda raw: raw.where(c("date") >= F.lit(start).cast("date")) if start else raw,
        series=lambda d: flow.flow_features(d, f), back=max(f.z_window, f.sum_window) - 1,
    )


class MonthlyFeatures:
    """PATH/rows/month=2024-05/..., PATH/states/month=..., PATH/processed/VERSION.json."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def processed(self) -> int:
        """The version of the raw table that the rows stand for."""
        done = folders.names(self.spark, f"{self.path}/processed")
        return int(done[-1][:-5]) if done else 0

    def _read(self, part: str) -> DataFrame | None:
        months = folders.names(self.spark, f"{self.path}/{part}")
        return self.spark.read.parquet(f"{self.path}/{part}") if any(m.startswith("month=") for m in months) else None

    def read(self) -> DataFrame | None:
        d = self._read("rows")
        return None if d is None else d.drop("month")

    def _replace(self, part: str, d: DataFrame, since: str) -> None:
        """Months from `since` on become those of d, and no others are touched."""
        at = f"{self.path}/{part}"
        d.repartition("month").sortWithinPartitions("month", "ticker", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(at)
        have = {r[0] for r in d.select("month").distinct().collect()}  # months
        for folder in folders.names(self.spark, at):
            month = folder.removeprefix("month=")
            if month != folder and month >= since and month not in have:
                folders.drop(self.spark, f"{at}/{folder}")

    def refresh(self, raw: KeyedTable, plan: Plan) -> dict:
        """Bring the rows up to the newest version of `raw`. -> {version, since (first month written, None if nothing was), tickers}"""
        version, before = raw.manifest()["version"], self.processed()
        changed = raw.changes(before) if version > before else None
        out = {"version": version, "since": None, "tickers": 0}
        scratch = folders.shared_folder(self.spark, "refresh")
        try:
            if changed is not None:
                ranges = self._ranges(raw, plan, changed, f"{scratch}/ranges")
                out["tickers"], since, halo = ranges.agg(F.count("*"), F.min("month"), F.min("halo")).first()
                if out["tickers"]:
                    self._recompute(raw, plan, ranges, since, halo, scratch)
                    out["since"] = since
            if version > before:
                folders.put_new(self.spark, f"{self.path}/processed/{version:012d}.json", json.dumps(out))
        finally:
            folders.drop(self.spark, scratch)
        return out

    def _ranges(self, raw: KeyedTable, plan: Plan, changed: DataFrame, path: str) -> DataFrame:
        """ticker, month (the first dirty one), halo (the first date to read), n (all its rows)."""
        first = changed.groupBy("ticker").agg(F.min("date").alias("first"))
        stored = self._read("rows")
        if stored is None:
            known = first.select("ticker", F.lit(False).alias("_stored")).where("false")
        else:
            known = stored.join(first, "ticker", "left_semi").select("ticker").distinct().withColumn("_stored", F.lit(True))
        rows = raw.of_keys(first)
        n = rows.groupBy("ticker").agg(F.count("*").alias("n"))
        d = plan.prepare(rows).select("ticker", "date", (c(plan.factor) if plan.factor else F.lit(True)).alias("_f"))
        ends = d.groupBy("ticker").agg(F.min("date").alias("_a"), F.min(F.when(c("_f"), c("date"))).alias("_filled"))
        ends = first.join(ends, "ticker", "left").join(known, "ticker", "left")
        # what no earlier row has is filled backward: while the first row that has it may be new, all rows are dirty
        whole = c("_stored").isNull() | c("_filled").isNull() | (c("_filled") >= c("first"))
        start = F.trunc(F.when(whole, F.least("_a", "first")).otherwise(c("first")), "month")
        starts = ends.select("ticker", start.alias("start"))
        halo = d.join(starts, "ticker").where("date < start")
        halo = halo.withColumn("_k", S.number()).withColumn("_n", F.count("*").over(Window.partitionBy("ticker")))
        halo = halo.withColumn("_last", S.ffill(F.when(c("_f"), c("date")))).where(c("_k") == F.greatest(F.lit(1), c("_n") - plan.back + 1))
        halo = halo.select("ticker", F.coalesce(F.least("date", "_last"), c("date")).alias("halo"))
        ranges = starts.join(halo, "ticker", "left").join(n, "ticker").select("ticker", F.date_format("start", "yyyy-MM").alias("month"), F.coalesce("halo", "start").alias("halo"), "start", "n")
        ranges.write.parquet(path)
        return self.spark.read.parquet(path)

    def _recompute(self, raw: KeyedTable, plan: Plan, ranges: DataFrame, since: str, halo, scratch: str) -> None:
        rows = raw.of_keys(ranges).where(c("date") >= F.lit(halo)).join(ranges.where(c("n") >= plan.least_rows), "ticker").where("date >= halo")
        d = plan.prepare(rows.drop("n", "month")).drop("halo")
        if plan.states:
            d = self._with_states(d, plan, ranges)
        d = plan.series(d)
        keep = [x for x in d.columns if x not in ("start", "_known", "_known_at", plan.factor)]
        d = d.where("date >= start").select(*keep, F.date_format("date", "yyyy-MM").alias("month"))
        new = self._written(d, f"{scratch}/new")
        rows = new.drop(*plan.states)
        kept = self._kept("rows", ranges, since)
        if kept is not None:
            rows = rows.unionByName(kept.drop(*plan.across_columns))
        rows = plan.across(rows) if plan.across else rows
        self._replace("rows", self._written(rows, f"{scratch}/rows"), since)
        if plan.states:
            last = new.groupBy("ticker", "month").agg(F.max_by(F.struct("date", *plan.states), "date").alias("s")).select("ticker", "month", "s.*")
            kept = self._kept("states", ranges, since)
            states = last if kept is None else last.unionByName(kept)
            self._replace("states", self._written(states, f"{scratch}/states"), since)

    def _written(self, d: DataFrame, path: str) -> DataFrame:
        d.write.parquet(path)
        return self.spark.read.schema(d.schema).parquet(path)

    def _kept(self, part: str, ranges: DataFrame, since: str) -> DataFrame | None:
        """Stored rows of the months to be written that stay as they are: other tickers, and months before a ticker's first dirty one."""
        d = self._read(part)
        if d is None:
            return None
        d = d.withColumn("month", c("month").cast("string")).where(c("month") >= since)
        return d.join(ranges.select("ticker", c("month").alias("_from")), "ticker", "left").where("_from is null or month < _from").drop("_from")

    def _with_states(self, d: DataFrame, plan: Plan, ranges: DataFrame) -> DataFrame:
        """Rows with the states at the last row before their ticker's first dirty month."""
        stored = self._read("states")
        if stored is None:
            kind = "struct<" + ",".join(f"{x}:double" for x in plan.states) + ">"
            return d.withColumn("_known_at", F.lit(None).cast("date")).withColumn("_known", F.lit(None).cast(kind))
        s = stored.join(ranges.select("ticker", c("month").alias("_from")), "ticker").where(c("month").cast("string") < c("_from"))
        last = s.groupBy("ticker").agg(F.max_by(F.struct("date", *plan.states), "date").alias("s"))
        return d.join(last.select("ticker", c("s.date").alias("_known_at"), F.struct(*(c(f"s.{x}") for x in plan.states)).alias("_known")), "ticker", "left")
