"""Queries whose results come out of stores kept up to date batch by batch; the SQL of each computes the same from all rows at once."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from pitpanel.config import Config
from pitpanel.oracles import ARTICLES, BARS, FLAGS, LEXICON, MACD, RANGE, RET, RSI, VOL, _r6, _z
from pitpanel.plans import incremental, inputs, sentiment, technical
from pitpanel.sources.folders import shared_folder
from pitpanel.sources.keyed import KeyedTable
from pitpanel.streaming import decay

c, CFG = F.col, Config()
QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


@query("""with b as (select user_id, cast(ts as date) as date, event_id, event_type, value, case event_id % 3 when 1 then 0 when 2 then 1 else 2 end as batch from events)
select user_id, date, event_id, event_type, value from (select *, row_number() over (partition by user_id, date order by batch desc, event_id desc) as k from b) where k = 1""")
def keyed_table_batches(spark, sf_dir):
    """Events as three batches of two writers into a keyed table; a batch that is brought again changes nothing."""
    events = inputs.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date"), "event_id", "event_type", "value")
    part = lambda k: events.where(c("event_id") % 3 == k)
    t = KeyedTable(spark, shared_folder(spark, "keyed"), ["user_id", "date"], by=["user_id"], buckets=16)
    t.upsert(part(1), "first", 0, ["event_id"])
    t.upsert(part(2), "first", 1, ["event_id"])
    t.upsert(part(1), "first", 0, ["event_id"])
    t.upsert(part(0), "second", 0, ["event_id"])
    return t.read().select("user_id", "date", "event_id", "event_type", "value")


_ENOUGH = f"enough as (select ticker from bars group by 1 having count(*) >= {CFG.universe.min_rows})"


@query(", ".join(("with " + MACD, RSI, RET, VOL, RANGE, _ENOUGH)) + f""", x as (select ret.ticker, ret.date, ret_20d, price_sma60_ratio, macd.h as macd_hist, case when rsi.rn >= 15 then rsi end as rsi_14, obv_slope_20d, realized_vol_20d
  from ret join vol using (ticker, date) join rng using (ticker, date) join rsi on rsi.ticker = ret.ticker and rsi.date = ret.date join macd on macd.ticker = ret.ticker and macd.date = ret.date where ret.ticker in (select ticker from enough))
select ticker, date, {_r6('ret_20d', 'price_sma60_ratio', 'macd_hist', 'rsi_14', 'obv_slope_20d', 'realized_vol_20d')}, round({_z('ret_20d')}, 6) as ret_20d_cs_z from x""")
def incremental_recompute(spark, sf_dir):
    """The technical panel after two refreshes: first without late bars and with wrong ones, then with what arrived late and was
    corrected; only what that makes dirty is computed again."""
    work = shared_folder(spark, "recompute")
    whole = inputs.bars(spark, sf_dir).drop("n")
    whole.write.parquet(f"{work}/bars")
    whole = spark.read.parquet(f"{work}/bars")
    late = (c("ticker") % 5 == 2) & (F.year("date") >= 2000) & (F.dayofmonth("date") == 17)
    wrong = (c("ticker") % 7 == 3) & (F.year("date") == 1999) & (F.dayofmonth("date") <= 2)
    late, wrong = F.coalesce(late, F.lit(False)), F.coalesce(wrong, F.lit(False))
    raw = KeyedTable(spark, f"{work}/raw", ["ticker", "date"], by=["ticker"], buckets=16)
    features, plan = incremental.MonthlyFeatures(spark, f"{work}/features"), incremental.technical_plan(CFG.universe, CFG.technical, adjusted=False)
    raw.upsert(whole.where(~late).withColumn("close", F.when(wrong, c("close") * 1.5).otherwise(c("close"))), "first", 0)
    features.refresh(raw, plan)
    raw.upsert(whole.where(late | wrong), "second", 0)
    features.refresh(raw, plan)
    names = ("ret_20d", "price_sma60_ratio", "macd_hist", "rsi_14", "obv_slope_20d", "realized_vol_20d", "ret_20d_cs_z")
    return features.read().select("ticker", "date", *(F.round(n, 6).alias(n) for n in names))


@query(", ".join(("with " + MACD, RSI, RET, VOL, RANGE, FLAGS)) + f""", x as (select ret.ticker, ret.date, ret_250d, price_sma60_ratio, macd.h as macd_hist, case when rsi.rn >= 15 then rsi end as rsi_14, obv_slope_20d, realized_vol_20d, is_liquid, dist_52w_high
  from ret join vol using (ticker, date) join rng using (ticker, date) join flg using (ticker, date) join rsi on rsi.ticker = ret.ticker and rsi.date = ret.date join macd on macd.ticker = ret.ticker and macd.date = ret.date)
select ticker, date, {_r6('ret_250d', 'price_sma60_ratio', 'macd_hist', 'rsi_14', 'obv_slope_20d', 'realized_vol_20d', 'dist_52w_high')}, is_liquid, case when month(date) = 12 and row_number() over (partition by ticker, year(date), month(date) order by date desc) <= 5 then 1 else 0 end as window_dressing_flag from x""")
def sharded_series(spark, sf_dir):
    """The series features with every ticker's bars in shards of about 400 rows and their halos, as a hot ticker's would be."""
    u = dataclasses.replace(CFG.universe, min_median_turnover=40_000.0, tiers=((0.0, 1500.0, 0.35), (1500.0, 5000.0, 0.25), (5000.0, 1e12, 0.20)))
    d = technical.sharded_features(technical.clean(inputs.bars(spark, sf_dir)), u, CFG.technical, rows=400)
    names = ("ret_250d", "price_sma60_ratio", "macd_hist", "rsi_14", "obv_slope_20d", "realized_vol_20d", "dist_52w_high")
    return d.select("ticker", "date", *(F.round(n, 6).alias(n) for n in names), "is_liquid", "window_dressing_flag")


@query(f"""with {BARS}, b as (select ticker, date, close, volume from bars) select ticker, strftime(date, '%Y-%m') as month, count(*) as n, round(sum(volume), 4) as volume from b group by 1, 2""")
def keyed_change_log(spark, sf_dir):
    """Bars in yearly batches; what the change log calls changed since the first is read back by key, with what came first."""
    work = shared_folder(spark, "changes")
    whole = inputs.bars(spark, sf_dir).select("ticker", "date", "close", "volume")
    whole.write.parquet(f"{work}/bars")
    whole = spark.read.parquet(f"{work}/bars")
    t = KeyedTable(spark, f"{work}/t", ["ticker", "date"], by=["ticker"], buckets=16)
    t.upsert(whole.where(F.year("date") < 1998), "w", 0)
    t.upsert(whole.where(F.year("date") < 2001), "w", 1)  # rows brought again unchanged are no changes
    t.upsert(whole, "w", 2)
    more = t.read().join(t.changes(1), ["ticker", "date"], "left_semi")
    both = t.read(1).unionByName(more)
    return both.groupBy("ticker", F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.round(F.sum("volume"), 4).alias("volume"))


_FACTOR = "pow(0.5::double, 1 / 3::double)"


@query(f"""with {ARTICLES}, d as (select lang as key, date, sum(score) as a, count(*) as n from art2 where score is not null group by 1, 2),
g as (select key, cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp) + interval 14 day, interval 1 day)) as date) as date from (select key, min(date) as lo, max(date) as hi from d group by 1)),
s as (select g.key, g.date, sum(a * pow({_FACTOR}, date_diff('day', d.date, g.date))) as a, sum(n * pow({_FACTOR}, date_diff('day', d.date, g.date))) as w, max(d.date) as last from g join d on d.key = g.key and d.date <= g.date group by 1, 2)
select key, date, round(a / w, 6) as sent_decay from s where date_diff('day', last, date) <= 14""")
def decay_stream(spark, sf_dir):
    """Scored articles by language as a stream of daily sums; every day comes out until the decay ends."""
    work = shared_folder(spark, "decay")
    rows = sentiment.score_articles(inputs.articles(spark, sf_dir), LEXICON)
    daily = sentiment.scored_daily(rows, ["lang"]).select(c("lang").alias("key"), "date", "score_sum", "n")
    daily.coalesce(1).write.parquet(f"{work}/daily")  # a row per language and day
    daily = spark.read.parquet(f"{work}/daily")
    end = daily.agg(F.date_add(F.max("date"), 17).alias("date")).select(F.lit("").alias("key"), "date", F.lit(0.0).alias("score_sum"), F.lit(0).cast("long").alias("n"))
    daily.unionByName(end).coalesce(1).write.parquet(f"{work}/landed")
    with decay.state_store(spark):
        stream = spark.readStream.schema("key string, date date, score_sum double, n long").parquet(f"{work}/landed")
        out = decay.decay_days(stream, CFG.sentiment.half_life, CFG.sentiment.window_days).writeStream.format("parquet").option("path", f"{work}/out")
        out.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(decay.OUT).parquet(f"{work}/out").select("key", "date", F.round("sent_decay", 6).alias("sent_decay"))
