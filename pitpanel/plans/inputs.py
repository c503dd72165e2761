"""Inputs of the panel derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

c = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars by supplier nation: price = extended price / quantity, in a total order of the day's lines."""
    l = table(spark, sf_dir, "lineitem").where("l_quantity > 0")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", c("s_nationkey").cast("int").alias("ticker"))
    d = l.join(s, l.l_suppkey == s.s_suppkey).withColumn("date", F.to_date("l_shipdate")).withColumn("px", c("l_extendedprice") / c("l_quantity"))
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return d.groupBy("ticker", "date").agg(
        F.min_by("px", order).alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", order).alias("close"),
        F.sum("l_quantity").cast("double").alias("volume"), F.count("*").alias("n"),
    )


def statements(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Income rows and balance rows by customer nation and quarter (and year), as two one-sided tables."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", c("c_nationkey").cast("int").alias("ticker")), c("o_custkey") == c("c_custkey"))
    out = []
    for freq, unit, months in (("Q", "quarter", 2), ("A", "year", 11)):
        end = F.last_day(F.add_months(F.trunc(c("o_orderdate").cast("date"), unit), months))
        g = o.groupBy("ticker", F.lit(freq).alias("freq"), end.alias("report_period"))
        out.append(g.agg(
            F.sum("o_totalprice").alias("revenue"), F.sum(F.when(c("o_orderstatus") == "F", c("o_totalprice")).otherwise(0.0)).alias("net_income"),
            F.sum(F.when(c("o_orderstatus") == "O", c("o_totalprice")).otherwise(0.0)).alias("cogs"), F.count("*").cast("double").alias("shares_out"),
            F.sum(F.when(c("o_orderpriority") < "3", c("o_totalprice")).otherwise(0.0)).alias("total_equity"),
            F.sum(F.when(c("o_orderpriority") < "5", c("o_totalprice")).otherwise(0.0)).alias("total_assets"),
        ))
    rows = out[0].unionByName(out[1])
    income = rows.select("ticker", "freq", "report_period", "revenue", "net_income", "cogs", "shares_out", (c("net_income") / c("shares_out")).alias("eps")).where("month(report_period) <> 6 or ticker <> 3")
    balance = rows.select("ticker", "freq", "report_period", "total_equity", "total_assets").where("month(report_period) <> 9 or ticker <> 4")
    return income, balance


def macro_rows(spark: SparkSession, sf_dir: str, daily: bool = False) -> DataFrame:
    """Average order price by priority: month-end series, or one a day."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(c("o_orderpriority").alias("series"), (day if daily else F.last_day(day)).alias("date")).agg(F.avg("o_totalprice").alias("value"))


def flow_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").where("l_quantity > 0")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", c("s_nationkey").cast("int").alias("ticker"))
    side = lambda f: F.sum(F.when(c("l_returnflag") == f, c("l_quantity")).otherwise(0.0))
    return l.join(s, l.l_suppkey == s.s_suppkey).groupBy(F.to_date("l_shipdate").alias("date"), "ticker").agg(side("R").alias("foreign_buy"), side("A").alias("foreign_sell"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(c("n_nationkey").cast("int").alias("ticker"), c("n_name").alias("name"), c("r_name").alias("sector"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: no title, the text as summary, ninety days of dates, odd ids as backfill."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", "lang", "source", F.lit("").alias("title"), c("text").alias("summary"),
        F.date_add(F.lit("2024-01-01").cast("date"), (c("doc_id") % 90).cast("int")).alias("published"),
        F.when(c("doc_id") % 2 == 0, "live").otherwise("backfill").alias("source_type"),
    )
