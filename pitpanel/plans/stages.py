"""Stages in order, each reading and writing Parquet tables under one root, and the command line that runs them."""

from __future__ import annotations

import argparse
import datetime
import logging
import logging.handlers
import os
import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.config import Config, load_config, load_dotenv
from pitpanel.functions.lexicon import load_lexicon
from pitpanel.plans import align, flow, fundamental, landing, ledger, macro, sentiment, technical
from pitpanel.plans.incremental import MonthlyFeatures
from pitpanel.sources import readers, sinks
from pitpanel.sources.keyed import KeyedTable

log = logging.getLogger("pitpanel")
#: Stages of `all`, in order; sentiment-backfill and refresh run only by name.
ORDER = ("ohlcv", "technical", "fundamentals", "funda-features", "macro", "macro-features", "flow", "flow-features", "news", "sentiment", "align")
MANUAL = ("sentiment-backfill", "refresh")
#: Stages whose failure leaves the others.
SOURCES = ("ohlcv", "fundamentals", "macro", "flow", "news", "sentiment-backfill")


def setup_logging(folder: str, level: int = logging.INFO) -> None:
    os.makedirs(folder, exist_ok=True)
    rotating = logging.handlers.RotatingFileHandler(f"{folder}/pitpanel.log", maxBytes=5_000_000, backupCount=3)
    logging.basicConfig(level=level, handlers=[logging.StreamHandler(), rotating], format="%(asctime)s %(levelname)s %(message)s", force=True)


def resolve(names: list[str]) -> list[str]:
    """Stage names in canonical order; `all` takes the default ones whatever else is named; unknown names are errors."""
    unknown = [n for n in names if n not in (*ORDER, *MANUAL, "all")]
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(unknown)}")
    return list(ORDER) if "all" in names else [n for n in (*ORDER, *MANUAL) if n in names]
#: Feature tables that may lie in buckets: by which key, and sorted by what.
BUCKETED = {"technical": ("ticker", ["date"]), "fundamental": ("ticker", ["release_date"]), "flow": ("ticker", ["date"]), "sentiment": ("ticker", ["date"]), "panel": ("ticker", ["date"])}


class Store:
    """Tables by name under one root."""

    def __init__(self, spark: SparkSession, cfg: Config):
        self.spark, self.cfg = spark, cfg
        self.written: list[tuple] = []  # what the tables written so far tell of themselves, for the ledger

    def raw(self, table: str) -> DataFrame:
        """A raw table: the keyed one that refreshes maintain, where there is one, else the one that stages write."""
        kept = KeyedTable(self.spark, self.cfg.path(f"tables/{table}"), ["-"]).read()
        if kept is not None:
            return landing.shaped(kept, table)
        return readers.read(self.spark, self.cfg.path(f"raw/{table}"), table)

    def land(self, table: str, df: DataFrame, mode: str = "overwrite") -> None:
        df, seen = ledger.observed(df, table)
        df.write.mode(mode).parquet(self.cfg.path(f"raw/{table}"))
        self.written.append(ledger.told(table, seen))

    def get(self, name: str) -> DataFrame | None:
        monthly = MonthlyFeatures(self.spark, self.cfg.path(f"monthly/{name}")).read()
        if monthly is not None:
            return monthly
        path = self.cfg.path(f"features/{name}")
        if not readers.exists(self.spark, path):
            return None
        if self.cfg.buckets and name in BUCKETED:
            return sinks.read_bucketed(self.spark, path, *BUCKETED[name], self.cfg.buckets)
        return self.spark.read.parquet(path)

    def put(self, name: str, df: DataFrame, sort: list[str]) -> None:
        df, seen = ledger.observed(df, name)
        if self.cfg.buckets and name in BUCKETED:
            sinks.write_bucketed(df, self.cfg.path(f"features/{name}"), *BUCKETED[name], self.cfg.buckets)
        else:
            sinks.write_parquet(df, self.cfg.path(f"features/{name}"), sort=sort)
        self.written.append(ledger.told(name, seen))


def _as_of(s: Store) -> str:
    """The day of the run, which the command line sets to today where none is given; no plan asks the clock."""
    if not s.cfg.as_of:
        raise ValueError("this stage needs the day of the run (as_of)")
    return s.cfg.as_of


def _bars(s: Store) -> dict:
    prices = landing.bars(s.spark, s.cfg)
    if prices is None:
        return {}
    s.land("raw_prices", prices)
    return {"stock_metadata": landing.stock_metadata(s.spark, s.cfg, s.raw("raw_prices"))}


def _flow_days(s: Store) -> dict:
    """New days are added to those there; days without rows are remembered, so that they are not asked for again."""
    new = landing.flow_days(s.spark, s.cfg, s.raw("stock_metadata"))
    if new is not None:
        rows, empty = (cut.persist() for cut in new)
        rows.count(), empty.count()  # both are told apart from what is stored before either is added to it
        s.land("raw_flow", rows, "append")
        s.land("empty_dates", empty, "append")
        rows.unpersist(), empty.unpersist()
    return {}


def _articles(s: Store) -> dict:
    new = landing.articles(s.spark, s.cfg, _as_of(s))
    if new is not None:
        s.land("articles", new, "append")
    return {}


def source(table: str, decode: Callable[[Store], dict]) -> Callable[[Store], None]:
    """A source stage: what has landed is decoded into raw tables; tables put there ready are taken; nothing at all is an error.

    Stores that grow by days or articles are always brought up to date; others may be taken as they are (`use_cache`).
    """
    def run(s: Store) -> None:
        grows = table in ("raw_flow", "articles")
        if not grows and readers.cached(s.spark, s.cfg.path(f"raw/{table}"), table, s.cfg.use_cache) is not None:
            return
        for name, df in decode(s).items():
            if df is not None:
                s.land(name, df)
            if df is not None and name == "macro_observations":  # each series by itself, too
                sinks.write_parquet(s.raw(name), s.cfg.path("raw/macro_by_series"), partition_by="series", sort=["series", "date"])
        if s.raw(table).isEmpty():
            raise RuntimeError(f"no rows of {table} were landed")
    return run


def _technical(s: Store) -> None:
    from pitpanel.operators.dedupe import has_history

    raw = has_history(s.raw("raw_prices"), "ticker", s.cfg.universe.min_rows)
    s.put("technical", technical.technical_panel(raw, s.cfg.universe, s.cfg.technical), ["ticker", "date"])
    s.put("corporate_actions", technical.corporate_actions(raw), ["ticker", "date"])


def _fundamental(s: Store) -> None:
    s.put("fundamental", fundamental.fundamental_features(s.raw("raw_fundamentals"), s.cfg.fundamental), ["ticker", "report_period"])


def _macro(s: Store) -> None:
    obs = s.raw("macro_observations")
    names = [r[0] for r in obs.select("series").distinct().orderBy("series").collect()]  # a few dozen series
    daily = [r[0] for r in obs.where("frequency = 'daily'").select("series").distinct().collect()]  # may be none
    grid, stale = macro.daily_grid(obs, s.cfg.as_of or None), dict(s.cfg.macro.staleness)
    s.put("macro", macro.wide(macro.series_features(grid, daily, stale, s.cfg.macro), names, daily, stale, s.cfg.macro), ["date"])
    s.put("macro_sector", macro.sector_factor(grid, s.cfg.macro.sector_map, s.cfg.macro.sector_window), ["date", "sector"])


def _flow(s: Store) -> None:
    s.put("flow", flow.flow_features(s.raw("raw_flow").drop("foreign_net"), s.cfg.flow, s.cfg.flow.start_date), ["ticker", "date"])


def _sentiment(s: Store) -> None:
    lex = load_lexicon()
    live = sentiment.dedupe_articles(s.raw("articles"))
    past = readers.read(s.spark, s.cfg.path("raw/articles_historical"), "articles")
    rows = sentiment.score_articles(sentiment.union_articles(live, past), lex)
    rows = rows.withColumn("doc_id", F.xxhash64("source", "link", "title", "published", "source_type"))
    ents = sentiment.entities(s.raw("stock_metadata"), s.cfg.sentiment)
    own, hits, sectors = sentiment.facts(rows, ents, lex["sector_keywords"])
    sectors = sectors.join(own, "doc_id")
    s.put("sentiment", sentiment.stock_sentiment(sentiment.stock_daily(hits.join(own, "doc_id")), s.cfg.sentiment), ["ticker", "date"])
    s.put("sentiment_market", sentiment.market_sentiment(own, s.cfg.sentiment), ["date"])
    s.put("sentiment_sector", sentiment.sector_sentiment(sectors, s.cfg.sentiment), ["sector", "date"])


def _backfill(s: Store) -> None:
    readers.backfill_backend("wayback")
    landing.archived_articles(s.spark, s.cfg)
    path = s.cfg.path("raw/articles_historical")
    d = readers.read(s.spark, path, "articles").where(F.length(F.trim("title")) > 0)
    from pitpanel.operators.dedupe import keep_first

    s.put("articles_historical", keep_first(d, ["link"], ["published", "title", "summary"]), ["link"])


def _align(s: Store) -> None:
    d = align.panel(s.get("technical"), s.raw("stock_metadata"), s.get("fundamental"), s.get("macro"), s.get("macro_sector"), s.get("flow"), s.cfg.fundamental)
    s.put("panel", d, ["ticker", "date"])
    s.put("coverage", align.coverage(s.get("panel"), s.cfg.macro), ["year"])
    parts = [s.get(x) for x in ("sentiment", "sentiment_market", "sentiment_sector")]
    if all(p is not None for p in parts):
        s.put("sentimen", sentiment.sentiment_union(*parts), ["level", "entity", "date"])
    tables = {n: s.get(n) for n in ("panel", "sentimen", "coverage")}
    if s.cfg.csv:
        for n, t in tables.items():
            if t is not None:
                sinks.write_csv(t, s.cfg.path(f"csv/{n}"), sort=[x for x in ("level", "entity", "ticker", "date", "year") if x in t.columns])
    sinks.push_tables({n: t for n, t in tables.items() if t is not None}, os.environ.get("PANEL_JDBC_URL"))


def _refresh(s: Store) -> None:
    """What has landed since the last refresh, and the features that it makes dirty; the other feature stages follow by name."""
    from pitpanel.streaming.refresh import Refresh

    told = Refresh(s.spark, s.cfg).run()
    bad = {k: v for k, v in told.items() if v.startswith("failed")}
    for name, outcome in told.items():
        (log.warning if name in bad else log.info)("refresh of %s: %s", name, outcome)
    if told and len(bad) == len(told):
        raise RuntimeError("no source could be refreshed")


RUN: dict[str, Callable[[Store], None]] = {
    "ohlcv": source("raw_prices", _bars), "technical": _technical,
    "fundamentals": source("raw_fundamentals", lambda s: {"raw_fundamentals": landing.fundamentals(s.spark, s.cfg)}), "funda-features": _fundamental,
    "macro": source("macro_observations", lambda s: {"macro_observations": landing.macro_observations(s.spark, s.cfg, _as_of(s))}), "macro-features": _macro,
    "flow": source("raw_flow", _flow_days), "flow-features": _flow,
    "news": source("articles", _articles), "sentiment": _sentiment, "align": _align, "sentiment-backfill": _backfill, "refresh": _refresh,
}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="pitpanel")
    p.add_argument("stages", nargs="+")
    p.add_argument("--root", default=".")
    p.add_argument("--config")
    p.add_argument("--as-of", default="", help="the day of the run: calendars reach it, undated articles get it; today unless given")
    p.add_argument("--use-cache", action="store_true")
    p.add_argument("--csv", action="store_true", help="the last tables also as CSV, doubles with six significant digits")
    p.add_argument("--buckets", type=int, default=0, help="feature tables by ticker in so many buckets")
    a = p.parse_args(argv)
    load_dotenv(a.root)
    cfg = load_config(a.config, a.root)
    from dataclasses import replace

    from pitpanel.session import session

    setup_logging(f"{a.root}/logs")
    today = datetime.date.today().isoformat()
    cfg = replace(cfg, use_cache=a.use_cache, csv=a.csv or cfg.csv, buckets=a.buckets or cfg.buckets, as_of=a.as_of or cfg.as_of or today)
    return run_stages(Store(session(), cfg), resolve(a.stages))


def run_stages(store: Store, names: list[str]) -> int:
    """The stages in order, each with a row in the ledger; a source that fails leaves the others, any other failure ends the run
    and the stages left are noted as skipped. -> 0, or 1 if every stage failed."""
    book, failed = ledger.Ledger(store.spark, store.cfg.path("runs")), 0
    for i, name in enumerate(names):
        at, began = datetime.datetime.now(), time.time()
        store.written.clear()
        try:
            RUN[name](store)
        except Exception as e:
            reason = (str(e).splitlines() or [type(e).__name__])[0][:500]
            book.add(at, name, "failed", reason, time.time() - began, list(store.written))
            if name not in SOURCES or not isinstance(e, (RuntimeError, PySparkException, Py4JJavaError)):
                for left in names[i + 1 :]:
                    book.add(at, left, "skipped", f"{name} failed", 0.0, [])
                raise
            log.warning("%s: %s", name, reason)
            failed += 1
        else:
            book.add(at, name, "ok", None, time.time() - began, list(store.written))
            log.info("%s: %.1f s", name, time.time() - began)
    return 0 if failed < len(names) else 1


if __name__ == "__main__":
    raise SystemExit(main())
