"""Scheduled refresh: every landed folder is a stream of files with a checkpoint of its own; a run takes what has landed and ends.

Each source has one function for its micro-batches: payloads are decoded there, once, into keyed tables, which know a batch by
the query's id and number; so a batch that failed half-way is done again from its checkpoint and changes nothing twice, and a
source that fails leaves the others. Then the features follow: technical and flow panels for their dirty months only, reports and
macro series from the decoded rows if those have changed. A scheduler calls `run` (or the stage `refresh`) as often as it likes.

| landed folder | keyed table |
| --- | --- |
| bars | raw_prices (ticker, date) |
| flow | raw_flow (ticker, date), empty_dates (date) |
| macro, macro_closes | macro_values (number of the source, date) |
| statements, fallback_statements | statement_rows (kind, ticker, freq, report_period), fallback_cells (ticker, freq, report_period, label) |
| feeds/NAME | articles (key), the first arrival of each |
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.config import Config
from pitpanel.operators.dedupe import article_key, keep_first
from pitpanel.plans import incremental, landing
from pitpanel.sources import feeds, folders, readers
from pitpanel.sources.keyed import KeyedTable

log = logging.getLogger("pitpanel")
c = F.col
FIELDS = (*landing.INCOME, *landing.BALANCE)


class Refresh:
    def __init__(self, spark: SparkSession, cfg: Config, files_per_batch: int = 1000, buckets: int = 64):
        self.spark, self.cfg, self.files_per_batch, self.buckets = spark, cfg, files_per_batch, buckets
        self.letters = landing.dead_letters(spark, cfg)

    def table(self, name: str) -> KeyedTable:
        keys, by = {
            "raw_prices": (["ticker", "date"], ["ticker"]), "raw_flow": (["ticker", "date"], ["ticker"]), "empty_dates": (["date"], None),
            "macro_values": (["number", "date"], ["number"]), "statement_rows": (["kind", "ticker", "freq", "report_period"], ["ticker"]),
            "fallback_cells": (["ticker", "freq", "report_period", "label"], ["ticker"]), "articles": (["key"], None),
        }[name]
        return KeyedTable(self.spark, self.cfg.path(f"tables/{name}"), keys, by, self.buckets)

    # micro-batches --------------------------------------------------------------------------------------------------
    def bars(self, batch: DataFrame, writer: str, number: int) -> None:
        rows = readers.normalize_bars(batch.where("ticker is not null"))
        self.table("raw_prices").upsert(landing.shaped(rows, "raw_prices"), writer, number)

    def flow(self, batch: DataFrame, writer: str, number: int) -> None:
        good = self.letters.sift(batch.where(c("date") >= F.lit(self.cfg.flow.start_date).cast("date")), "flow", c("date"))
        universe = readers.universe(self.spark, self.cfg.path("config/universe.json"))
        found = readers.stock_flow(good, universe)
        self.table("raw_flow").upsert(found, writer, number, ["_seq"])
        empty = good.select("date").distinct().join(found.select("date").distinct(), "date", "left_anti")
        self.table("empty_dates").upsert(empty, writer, number)

    def macro(self, batch: DataFrame, writer: str, number: int) -> None:
        if not self.cfg.as_of:
            raise ValueError("macro payloads need the day of the run (as_of)")
        sources, parts = landing.macro_sources(self.spark, self.cfg), []
        for driver in landing.drivers(self.cfg):
            if driver != "closes":
                good = self.letters.sift(batch.where(c("driver") == driver), driver, c("series"))
                parts.append(landing.macro_values(good, driver, sources, self.cfg, self.cfg.as_of))
        if parts:
            self.table("macro_values").upsert(reduce(DataFrame.unionByName, parts), writer, number, ["_seq"])

    def macro_closes(self, batch: DataFrame, writer: str, number: int) -> None:
        values = landing.macro_values(batch, "closes", landing.macro_sources(self.spark, self.cfg), self.cfg, self.cfg.as_of)
        self.table("macro_values").upsert(values, writer, number, ["_seq"])

    def statements(self, batch: DataFrame, writer: str, number: int) -> None:
        good = self.letters.sift(batch, "statements", F.concat_ws(" ", "ticker", "freq", "kind"))
        rows = [landing.statement_rows(good, kind, self.cfg).withColumn("kind", F.lit(kind)) for kind in ("income", "balance")]
        both = rows[0].unionByName(rows[1], allowMissingColumns=True)
        self.table("statement_rows").upsert(both.select("kind", "ticker", "freq", "report_period", *FIELDS, "_seq"), writer, number, ["_seq"])

    def fallback_statements(self, batch: DataFrame, writer: str, number: int) -> None:
        self.table("fallback_cells").upsert(batch.where("value is not null"), writer, number, ["_seq"])

    def feeds(self, batch: DataFrame, writer: str, number: int) -> None:
        """Bodies with the name of their folder; an article's first arrival stays."""
        if not self.cfg.as_of:
            raise ValueError("feeds need the day of the run (as_of)")
        names = [(f.name, f.source or f.name, f.url, f.lang, f.query) for f in self.cfg.sentiment.feeds]
        names = F.broadcast(self.spark.createDataFrame(names, "name string, source string, feed_url string, lang string, query string"))
        d = feeds.items(batch.join(names, "name").select("source", "feed_url", "lang", "query", "_seq", c("value").alias("body")))
        bodies = batch.select(c("value").alias("payload"), c("name").alias("place"))
        bad = feeds.items(bodies.withColumn("body", c("payload"))).where("reason is not null")
        self.letters.put(bad.select("payload", "place", "reason"), "feeds")
        new = feeds.articles(d, self.cfg.as_of).withColumn("fetched_at", F.lit(self.cfg.as_of).cast("timestamp"))
        new = new.withColumn("key", F.sha2(article_key(c("link"), c("source"), c("title")), 256))
        new = keep_first(new, ["key"], ["_seq", "published", "title", "summary"])
        t = self.table("articles")
        # rows of this very batch may be stored already: then the table knows its number
        have = t.read()
        new = new if have is None else new.join(have.select("key"), "key", "left_anti")
        columns = [f.name for f in self.spark.createDataFrame([], readers.SCHEMAS["articles"]).schema]
        t.upsert(new.select("key", *columns), writer, number)

    # runs -----------------------------------------------------------------------------------------------------------
    def stream(self, name: str) -> DataFrame | None:
        """The files of a landed folder as a stream, None where there is no such folder."""
        path = self.cfg.path(f"landed/{name}")
        if not folders.exists(self.spark, path):
            return None
        reader = self.spark.readStream.option("maxFilesPerTrigger", self.files_per_batch)
        if name == "feeds":
            d = reader.option("recursiveFileLookup", True).option("wholetext", True).text(path)
            return readers.with_file(d).withColumn("name", F.regexp_extract("_seq.file", r"/feeds/([^/]+)/[^/]*$", 1))
        return readers.with_file(reader.schema(landing.LANDED[name]).json(path))

    def start(self, name: str):
        """The source's query over what has landed until now; None where nothing ever has."""
        stream = self.stream(name)
        if stream is None:
            return None
        take = getattr(self, name)

        def run(batch: DataFrame, number: int) -> None:
            cut = readers.with_row(batch).persist()  # a batch is used several times; its files are read once
            try:
                take(cut, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or name, number)
            finally:
                cut.unpersist()

        return stream.writeStream.foreachBatch(run).option("checkpointLocation", self.cfg.path(f"checkpoints/{name}")).trigger(availableNow=True).start()

    def run(self, sources=("bars", "flow", "macro", "macro_closes", "statements", "fallback_statements", "feeds")) -> dict[str, str]:
        """Every source, then the features. -> per source and feature what came of it: `ok ...`, `nothing` or `failed: ...`."""
        told = {}
        for name in sources:
            try:
                query = self.start(name)
                if query is None:
                    continue
                query.awaitTermination()
                told[name] = f"ok, {sum(p.numInputRows for p in query.recentProgress)} rows"
            except Exception as e:  # one source never stops another
                log.warning("refresh of %s failed", name, exc_info=True)
                told[name] = f"failed: {str(e).splitlines()[0][:200]}"
        for name, step in (("metadata", self.metadata), ("technical", self.technical), ("flow-features", self.flow_features), ("fundamentals", self.fundamentals), ("macro-observations", self.observations)):
            try:
                told[name] = step()
            except Exception as e:
                log.warning("refresh of %s failed", name, exc_info=True)
                told[name] = f"failed: {str(e).splitlines()[0][:200]}"
        return told

    # features -------------------------------------------------------------------------------------------------------
    def technical(self) -> str:
        plan = incremental.technical_plan(self.cfg.universe, self.cfg.technical)
        done = incremental.MonthlyFeatures(self.spark, self.cfg.path("monthly/technical")).refresh(self.table("raw_prices"), plan)
        return f"ok, {done['tickers']} tickers since {done['since']}" if done["since"] else "nothing"

    def flow_features(self) -> str:
        plan = incremental.flow_plan(self.cfg.flow, self.cfg.flow.start_date)
        done = incremental.MonthlyFeatures(self.spark, self.cfg.path("monthly/flow")).refresh(self.table("raw_flow"), plan)
        return f"ok, {done['tickers']} tickers since {done['since']}" if done["since"] else "nothing"

    def _if_changed(self, name: str, tables: list[str], make) -> str:
        """Write raw/`name` anew if any of the tables has a newer version than the one it was made of."""
        versions = "-".join(str(self.table(t).manifest()["version"]) for t in tables)
        mark = self.cfg.path(f"checkpoints/made/{name}-{versions}")
        if versions.strip("0-") == "" or folders.exists(self.spark, mark):
            return "nothing"
        df = make(*(self.table(t).read() for t in tables))
        if df is not None:
            df.write.mode("overwrite").parquet(self.cfg.path(f"raw/{name}"))
        folders.put_new(self.spark, mark, "")
        return "ok"

    def metadata(self) -> str:
        prices = self.table("raw_prices").read()
        df = None if prices is None else landing.stock_metadata(self.spark, self.cfg, prices)
        if df is None:
            return "nothing"
        df.write.mode("overwrite").parquet(self.cfg.path("raw/stock_metadata"))
        return "ok"

    def fundamentals(self) -> str:
        def make(rows, cells):
            kinds = None if rows is None else [rows.where(c("kind") == k).select("ticker", "freq", "report_period", *f) for k, f in (("income", landing.INCOME), ("balance", landing.BALANCE))]
            return landing.chosen_fundamentals(kinds, cells, self.cfg)

        return self._if_changed("raw_fundamentals", ["statement_rows", "fallback_cells"], make)

    def observations(self) -> str:
        return self._if_changed("macro_observations", ["macro_values"], lambda v: landing.chosen_observations(v, landing.macro_sources(self.spark, self.cfg), self.cfg))
