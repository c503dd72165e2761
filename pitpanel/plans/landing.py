"""Landed payloads to raw tables: the source stages. Transport is not here; each folder below `landed/` holds what it brought.

| folder | rows |
| --- | --- |
| `bars` (JSON lines) | bars under the provider's column names, with ticker |
| `metadata` (JSON lines) | ticker, long_name, sector, sub_sector, ipo_epoch |
| `statements` (JSON lines) | ticker, freq, kind (income or balance), payload |
| `fallback_statements` (JSON lines) | ticker, freq, report_period, label, value: the second provider's tables, a row per cell |
| `macro` (JSON lines) | series, driver, year, month, payload |
| `macro_closes` (JSON lines) | series, date, close |
| `flow` (JSON lines) | date, payload |
| `feeds/NAME` (XML) | a feed named in the settings, RSS or Atom; NAME may be that of a search, whose articles bear its `query` |
| `archive_index` (JSON lines) | feed_url, timestamp, statuscode: what an archive has of a feed |
| `archive_bodies` (JSON lines) | feed_url, timestamp, status, body: what was fetched of it |

A payload that cannot be read counts as none, so that the next source of its chain is taken; it goes to the dead letters with the
reason. Of two rows of one key the one that landed later counts. One source never stops another.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.config import Config, Source
from pitpanel.operators.dedupe import article_key, keep_first, keep_last
from pitpanel.plans import fundamental, macro
from pitpanel.sources import feeds, readers
from pitpanel.sources.deadletters import DeadLetters
from pitpanel.sources.keyed import KeyedTable

c = F.col
LANDED = {
    "bars": "ticker string, Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume double, Dividends double, `Stock Splits` double",
    "metadata": "ticker string, long_name string, sector string, sub_sector string, ipo_epoch long",
    "statements": "ticker string, freq string, kind string, payload string",
    "fallback_statements": "ticker string, freq string, report_period date, label string, value double",
    "macro": "series string, driver string, year int, month int, payload string",
    "macro_closes": "series string, date date, close double",
    "flow": "date date, payload string",
    "archive_index": "feed_url string, timestamp string, statuscode string",
    "archive_bodies": "feed_url string, timestamp string, status int, body string",
}
INCOME = ("revenue", "cogs", "gross_profit", "operating_profit", "pretax_income", "net_income", "eps", "shares_out")
BALANCE = tuple(x for x in fundamental.FIELDS if x not in INCOME)


def landed(spark, cfg: Config, name: str) -> DataFrame | None:
    """The landed rows of a folder, None where there is no such folder."""
    path = cfg.path(f"landed/{name}")
    return readers.with_place(spark.read.schema(LANDED[name]).json(path)) if readers.exists(spark, path) else None


def dead_letters(spark, cfg: Config) -> DeadLetters:
    return DeadLetters(spark, cfg.path("tables/dead_letters"), cfg.as_of)


def shaped(df: DataFrame, table: str) -> DataFrame:
    """The columns of a raw table in its order and types; those that df lacks are missing."""
    want = df.sparkSession.createDataFrame([], readers.SCHEMAS[table]).schema
    return df.select(*((c(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want))


def bars(spark, cfg: Config) -> DataFrame | None:
    rows = landed(spark, cfg, "bars")
    return None if rows is None else shaped(readers.normalize_bars(rows.where("ticker is not null")), "raw_prices")


def stock_metadata(spark, cfg: Config, prices: DataFrame) -> DataFrame | None:
    """The universe with what the provider says of it; without a universe file there is none."""
    path = cfg.path("config/universe.json")
    if not readers.exists(spark, path):
        return None
    fetched = landed(spark, cfg, "metadata")
    fetched = spark.createDataFrame([], LANDED["metadata"]) if fetched is None else keep_last(fetched, ["ticker"], ["_seq"]).drop("_seq")
    first = prices.groupBy("ticker").agg(F.min("date").alias("first_data_date"))
    return shaped(readers.metadata(fetched, readers.universe(spark, path), first), "stock_metadata")


def statement_rows(rows: DataFrame, kind: str, cfg: Config) -> DataFrame:
    """Statement payloads of a kind (income or balance) -> its fields, a row per ticker, frequency and report period."""
    fields = INCOME if kind == "income" else BALANCE
    arrays = readers.financial_arrays(readers.statements(rows.where(c("kind") == kind)), cfg.fundamental)
    return keep_last(readers.statement_rows(arrays, fields, cfg.fundamental), ["ticker", "freq", "report_period"], ["_seq"])


def chosen_fundamentals(kinds: list[DataFrame] | None, cells: DataFrame | None, cfg: Config) -> DataFrame | None:
    """Rows of both kinds of statements, and cells of the second provider's tables -> of each ticker the first provider that has rows."""
    parts = []
    if kinds is not None:
        parts.append(fundamental.merge_statements(*kinds).withColumn("provider", F.lit("statements")))
    if cells is not None:
        parts.append(readers.fallback_statement(cells, dict(cfg.fundamental.fallback_map)).withColumn("provider", F.lit("fallback")))
    if not parts:
        return None
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return shaped(fundamental.canonical(fundamental.first_provider(both, cfg.fundamental.chain), cfg.fundamental), "raw_fundamentals")


def fundamentals(spark, cfg: Config) -> DataFrame | None:
    """Of each ticker the first provider of the chain that has rows, one row per report period."""
    rows, kinds = landed(spark, cfg, "statements"), None
    if rows is not None:
        rows = dead_letters(spark, cfg).sift(rows, "statements", F.concat_ws(" ", "ticker", "freq", "kind"))
        kinds = [statement_rows(rows, kind, cfg).drop("_seq") for kind in ("income", "balance")]
    return chosen_fundamentals(kinds, landed(spark, cfg, "fallback_statements"), cfg)


def decoded(rows: DataFrame, driver: str, as_of: str) -> DataFrame:
    """Payloads of a driver (with the `variable` of dynamic tables) -> series, date, value."""
    if driver == "observations":
        return readers.observations_api(rows)
    if driver == "series_docs":
        return readers.series_docs(rows)
    if driver == "dynamic_table":
        return readers.dynamic_table(rows, c("variable"))
    if driver == "monthly_statistic":
        return readers.monthly_statistic(rows, as_of)
    raise ValueError(f"unknown driver {driver}")


def macro_sources(spark, cfg: Config) -> DataFrame:
    """The sources of all series in the settings: a row each, with what holds for it, and a `number` that stays when others come and go."""
    out, seen = [], Counter()
    for series in cfg.macro.series:
        for priority, s in enumerate(series.sources):
            transform, lag = series.transform if s.transform is None else s.transform, series.lag if s.lag is None else s.lag
            if transform not in ("none", "yoy_pct"):
                raise ValueError(f"unknown transform {transform}")
            number = "|".join((series.name, s.driver, s.variable))
            seen[number] += 1
            out.append((f"{number}|{seen[number]}", series.name, s.driver, priority, transform, lag, s.frequency or series.frequency, series.group, s.variable))
    return spark.createDataFrame(out, "number string, name string, driver string, priority int, transform string, lag int, frequency string, group string, variable string")


def macro_values(rows: DataFrame, driver: str, sources: DataFrame, cfg: Config, as_of: str) -> DataFrame:
    """Landed payloads (or closes) of a driver, all series together -> number (of the source), date, value, _seq."""
    own = F.broadcast(sources.where(c("driver") == driver).select("number", c("name").alias("series"), "variable"))  # as many rows as the settings name
    d = rows.join(own, "series").drop("series").withColumnRenamed("number", "series")  # while it is decoded, its number stands for the series
    d = d.withColumnRenamed("close", "value") if driver == "closes" else decoded(d, driver, as_of)
    d = d.where("date is not null and value is not null")
    return keep_last(d, ["series", "date"], ["_seq"]).select(c("series").alias("number"), "date", "value", "_seq")


def chosen_observations(values: DataFrame, sources: DataFrame, cfg: Config) -> DataFrame:
    """(number, date, value) of all sources -> each series by the first source of its chain that leaves any rows, after that
    source's transform and with its lag."""
    d = values.select(c("number").alias("series"), "date", "value")
    yearly = F.broadcast(sources.where("transform = 'yoy_pct'").select(c("number").alias("series")))
    changed = macro.year_over_year(d.join(yearly, "series", "left_semi"), cfg.macro.yoy_tolerance)
    d = d.join(yearly, "series", "left_anti").unionByName(changed.select("series", "date", "value"))
    d = d.withColumnRenamed("series", "number").join(F.broadcast(sources), "number")
    d = d.select(c("name").alias("series"), "date", "value", F.date_add("date", c("lag")).alias("effective_date"), "priority", "driver", "frequency", "group")
    return shaped(macro.choose_source(d), "macro_observations")


def drivers(cfg: Config) -> list[str]:
    return list(dict.fromkeys(s.driver for series in cfg.macro.series for s in series.sources))


def macro_observations(spark, cfg: Config, as_of: str) -> DataFrame | None:
    """The observations of all series; payloads are decoded once per driver."""
    rows, closes = landed(spark, cfg, "macro"), landed(spark, cfg, "macro_closes")
    sources, parts = macro_sources(spark, cfg), []
    for driver in drivers(cfg):
        d = closes if driver == "closes" else rows
        if d is not None and driver != "closes":
            d = dead_letters(spark, cfg).sift(d.where(c("driver") == driver), driver, c("series"))
        if d is not None:
            parts.append(macro_values(d, driver, sources, cfg, as_of))
    return chosen_observations(reduce(DataFrame.unionByName, parts), sources, cfg) if parts else None


def flow_days(spark, cfg: Config, universe: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(new rows, new days without rows) of the landed days that neither raw_flow nor the list of empty days has."""
    rows = landed(spark, cfg, "flow")
    if rows is None:
        return None
    done = readers.read(spark, cfg.path("raw/raw_flow"), "raw_flow").select("date").union(readers.read(spark, cfg.path("raw/empty_dates"), "empty_dates"))
    todo = rows.where(c("date") >= cfg.flow.start_date).join(done.distinct(), "date", "left_anti")
    good = dead_letters(spark, cfg).sift(todo, "flow", c("date"))
    found = keep_last(readers.stock_flow(good, universe), ["date", "ticker"], ["_seq"])
    empty = good.select("date").distinct().join(found.select("date").distinct(), "date", "left_anti")
    return shaped(found, "raw_flow"), shaped(empty, "empty_dates")


def articles(spark, cfg: Config, as_of: str) -> DataFrame | None:
    """Articles of the landed feeds that the store has not yet, by link or else source and title; the first of each."""
    parts = []
    for f in cfg.sentiment.feeds:
        path = cfg.path(f"landed/feeds/{f.name}")
        if readers.exists(spark, path):
            parts.append(readers.feed(spark, path, f.source or f.name, f.lang, f.url, as_of, f.query))
    if not parts:
        return None
    new = reduce(DataFrame.unionByName, parts).where("title <> ''").withColumn("_key", article_key(c("link"), c("source"), c("title")))
    have = readers.read(spark, cfg.path("raw/articles"), "articles").select(article_key(c("link"), c("source"), c("title")).alias("_key"))
    new = keep_first(new, ["_key"], ["published", "title", "summary", "feed_url"]).join(have, "_key", "left_anti")
    return shaped(new.drop("_key"), "articles")


def archive_ledger(spark, cfg: Config) -> KeyedTable:
    return KeyedTable(spark, cfg.path("tables/archive_ledger"), ["feed_url", "timestamp"], buckets=16)


def archived_articles(spark, cfg: Config, per_run: int = 5000) -> DataFrame | None:
    """Bodies of the archive that landed and are not in the ledger yet -> new historical articles; the outcome of each is noted.

    A run that fails between the two does the bodies again, and articles that are there already are not added twice.
    """
    index, bodies = landed(spark, cfg, "archive_index"), landed(spark, cfg, "archive_bodies")
    if index is None or bodies is None:
        return None
    names = [(f.url, f.source or f.name, f.lang) for f in cfg.sentiment.feeds]
    names = spark.createDataFrame(names, "feed_url string, source string, lang string").dropDuplicates(["feed_url"])
    ledger = archive_ledger(spark, cfg)
    have = ledger.read()
    todo = feeds.wanted(index, spark.createDataFrame([], feeds.LEDGER) if have is None else have, per_run)
    bodies_, rows = feeds.outcomes(todo, bodies, names)
    new = feeds.articles(bodies_.drop("timestamp")).withColumn("_key", article_key(c("link"), c("source"), c("title")))
    past = readers.read(spark, cfg.path("raw/articles_historical"), "articles").select(article_key(c("link"), c("source"), c("title")).alias("_key"))
    new = keep_first(new, ["_key"], [F.asc_nulls_last("published"), "title", "summary", "feed_url"]).join(past, "_key", "left_anti")
    shaped(new.drop("_key"), "articles").write.mode("append").parquet(cfg.path("raw/articles_historical"))
    bad = bodies_.where("reason is not null").join(bodies.select("feed_url", "timestamp", "body"), ["feed_url", "timestamp"])
    dead_letters(spark, cfg).put(bad.select(F.coalesce("body", F.lit("")).alias("payload"), "reason", F.concat_ws(" ", "feed_url", "timestamp").alias("place")), "archive")
    ledger.upsert(rows)
    return readers.read(spark, cfg.path("raw/articles_historical"), "articles")
