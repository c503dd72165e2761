"""Payloads that cannot be used, kept with the reason: a table keyed by source and content, so that reruns add nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.sources.keyed import KeyedTable
from pitpanel.sources.readers import day, number

c = F.col
#: Of every driver: where its entries lie, their kind, and what makes an entry usable.
SHAPES: dict[str, tuple] = {
    "observations": ("observations", "observations array<struct<date:string,value:string>>", lambda e: day(e["date"]).isNotNull() & number(e["value"]).isNotNull()),
    "series_docs": ("series.docs", "series struct<docs:array<struct<period_start_day:array<string>,value:array<string>>>>", None),
    "dynamic_table": ("datacontent", "datacontent map<string,string>, tahun array<struct<val:string,label:string>>", None),
    "monthly_statistic": ("seriesData", "seriesData array<struct<x:string,y:string>>", lambda e: number(e["y"]).isNotNull()),
    "flow": ("data", "data array<struct<StockCode:string,ForeignBuy:string,ForeignSell:string>>", None),
    "statements": ("nodes", "nodes array<struct<type:string,data:array<string>>>", None),
}


def reason(driver: str, payload: Column) -> Column:
    """NULL for a payload with usable entries, else `empty`, `not JSON`, `no <field>` or `no usable entry`.

    A flow payload without entries is good: it tells of a day without any.
    """
    field, schema, usable = SHAPES[driver]
    x = F.from_json(payload, schema)
    for part in field.split("."):
        x = x[part]
    blank = F.trim(F.coalesce(payload, F.lit(""))) == ""
    out = F.when(blank, "empty").when(F.try_parse_json(payload).isNull() | ~F.ltrim(payload).startswith("{"), "not JSON").when(x.isNull(), f"no {field}")
    if driver == "series_docs":
        first = F.get(x, F.lit(0))
        entry = F.exists(F.arrays_zip(first["period_start_day"].alias("d"), first["value"].alias("v")), lambda e: day(e["d"]).isNotNull() & number(e["v"]).isNotNull())
        return out.when(~F.coalesce(entry, F.lit(False)), "no usable entry")
    if driver == "dynamic_table":
        entry = F.exists(F.map_values(x), lambda v: number(v).isNotNull()) & F.exists(F.from_json(payload, schema)["tahun"], lambda t: t["label"].try_cast("int").isNotNull())
        return out.when(~F.coalesce(entry, F.lit(False)), "no usable entry")
    if driver == "statements":
        return out.when(~F.exists(x, lambda n: n["type"].eqNullSafe("data") & n["data"].isNotNull()), "no usable entry")
    return out.when(~F.exists(x, usable), "no usable entry") if usable else out


class DeadLetters:
    """PATH keyed by source and sha: source, sha, place (what the payload was to tell of), reason, payload (its first `limit` characters), seen."""

    def __init__(self, spark: SparkSession, path: str, as_of: str = "", limit: int = 300_000):
        self.table, self.as_of, self.limit = KeyedTable(spark, path, ["source", "sha"], buckets=16), as_of, limit

    def read(self) -> DataFrame | None:
        return self.table.read()

    def counts(self) -> dict[tuple[str, str], int]:
        """Payloads by source and reason: a row for each of the few reasons."""
        d = self.read()
        return {} if d is None else {(r["source"], r["reason"]): r["n"] for r in d.groupBy("source", "reason").agg(F.count("*").alias("n")).collect()}

    def put(self, bad: DataFrame, source: str, writer: str | None = None, number_: int = 0) -> None:
        """(payload, reason, place): what is there already stays as it first came."""
        d = bad.select(F.lit(source).alias("source"), F.sha2(F.coalesce("payload", F.lit("")), 256).alias("sha"), c("place").cast("string").alias("place"), "reason", F.substring("payload", 1, self.limit).alias("payload"), F.lit(self.as_of or None).cast("string").alias("seen"))
        have = self.read()
        if have is not None:
            d = d.join(have.where(c("source") == source).select("sha"), "sha", "left_anti").select("source", "sha", "place", "reason", "payload", "seen")
        if writer is not None or not d.isEmpty():
            self.table.upsert(d, writer, number_)

    def sift(self, landed: DataFrame, driver: str, place: Column, source: str | None = None, writer: str | None = None, number_: int = 0) -> DataFrame:
        """Landed rows (payload, ...) -> those with usable entries; the others are put here with their reason."""
        d = landed.withColumn("_reason", reason(driver, c("payload")))
        self.put(d.where("_reason is not null").select("payload", c("_reason").alias("reason"), place.alias("place")), source or driver, writer, number_)
        return d.where("_reason is null").drop("_reason")
