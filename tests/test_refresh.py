"""Runs of the scheduled refresh over growing folders, against the stages that take everything at once."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitpanel.config import load_config
from pitpanel.plans import flow, stages, technical
from pitpanel.sources.keyed import KeyedTable
from pitpanel.streaming.refresh import Refresh

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(80)]
RSS = "<rss><channel><item><title>alpha beta gains {0}</title><link>l{0}</link></item></channel></rss>"


class Landing:
    def __init__(self, root):
        self.root, self.n = root, 0

    def put(self, name, rows):
        self.n += 1
        (self.root / "landed" / name).mkdir(parents=True, exist_ok=True)
        (self.root / "landed" / name / f"{self.n:03d}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))

    def bars(self, days, tickers=("A.JK", "B.JK"), close=10.5):
        self.put("bars", [{"ticker": t, "Date": str(d), "Open": 10.0 + i % 7, "High": 19.0, "Low": 9.0, "Close": close + i % 7, "Adj Close": close + i % 7, "Volume": 100.0 + i} for t in tickers for i, d in enumerate(days)])

    def flow(self, days, code="A"):
        self.put("flow", [{"date": str(d), "payload": json.dumps({"recordsTotal": 1, "data": [{"StockCode": code, "ForeignBuy": 5 + d.day, "ForeignSell": 2}]})} for d in days])

    def feed(self, k):
        folder = self.root / "landed" / "feeds" / "f"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{k}.xml").write_text(RSS.format(k))


@pytest.fixture
def world(spark, tmp_path):
    (tmp_path / "config").mkdir()
    (tmp_path / "config" / "universe.json").write_text(json.dumps({"id": [{"ticker": "A.JK", "name": "Alpha Beta"}, {"ticker": "B.JK", "name": "Bravo"}]}))
    settings = {"as_of": "2024-03-31", "universe": {"min_rows": 20}, "macro": {"series": [
        {"name": "brent_oil", "frequency": "daily", "sources": [{"driver": "observations"}, {"driver": "closes", "lag": 1}]}]},
        "sentiment": {"feeds": [{"name": "f", "source": "paper", "lang": "id", "url": "u", "query": "q"}]}}
    (tmp_path / "settings.json").write_text(json.dumps(settings))
    return Landing(tmp_path), load_config(str(tmp_path / "settings.json"), str(tmp_path))


def sorted_rows(d):
    return sorted((tuple(None if x is None else round(x, 6) if isinstance(x, float) else x for x in r) for r in d.select(*sorted(d.columns)).collect()), key=str)


def test_three_runs(spark, world, monkeypatch):
    land, cfg = world
    seen = []
    for name in ("bars", "flow", "feeds"):
        plain = getattr(Refresh, name)
        monkeypatch.setattr(Refresh, name, lambda self, b, w, n, name=name, plain=plain: (seen.append((name, n, b.count())), plain(self, b, w, n))[1])
    land.bars(DAYS[:50]), land.flow(DAYS[:40]), land.feed(1)
    land.put("macro_closes", [{"series": "brent_oil", "date": str(d), "close": 5.0} for d in DAYS[:30]])
    flat = [{"financialData": 1}, {"datekey": 2, "revenue": 4}, [3], "2023-09-30", [5], 7.0]
    land.put("statements", [{"ticker": "A.JK", "freq": "Q", "kind": "income", "payload": json.dumps({"nodes": [{"type": "data", "data": flat}]})}])
    told = Refresh(spark, cfg, buckets=4).run()
    assert all(v.startswith("ok") for v in told.values()), told
    # the second run brings days, one of them late and one corrected, an empty day, a bad payload and an article seen before
    land.bars([DAYS[45]], ("A.JK",), close=11.5), land.bars(DAYS[50:60]), land.flow(DAYS[40:50]), land.flow([DAYS[50]], "ZZ"), land.feed(2)
    land.put("flow", [{"date": str(DAYS[51]), "payload": "<html>"}])
    (land.root / "landed/feeds/f/again.xml").write_text(RSS.format(1))
    land.put("macro", [{"series": "brent_oil", "driver": "observations", "payload": json.dumps({"observations": [{"date": str(d), "value": "8"} for d in DAYS[:20]]})}])
    told = Refresh(spark, cfg, buckets=4).run()
    assert told["technical"] == "ok, 2 tickers since 2024-02" and told["fundamentals"] == "nothing", told
    third = Refresh(spark, cfg, buckets=4).run()
    assert third["technical"] == third["flow-features"] == third["fundamentals"] == third["macro-observations"] == "nothing"
    # every payload was decoded once
    assert sum(n for name, _, n in seen if name == "bars") == 50 * 2 + 1 + 10 * 2
    assert sum(n for name, _, n in seen if name == "flow") == 40 + 10 + 1 + 1 and sum(n for name, _, n in seen if name == "feeds") == 3
    store = stages.Store(spark, cfg)
    raw = store.raw("raw_prices")
    assert raw.count() == 120 and raw.where("ticker = 'A.JK'").where(F.col("date") == F.lit(DAYS[45])).first().close == 11.5
    want = technical.technical_panel(raw, cfg.universe, cfg.technical)
    assert sorted_rows(store.get("technical")) == sorted_rows(want)
    assert sorted_rows(store.get("flow")) == sorted_rows(flow.flow_features(store.raw("raw_flow").drop("foreign_net"), cfg.flow))
    assert [r.date for r in store.raw("empty_dates").collect()] == [DAYS[50]]
    assert sorted((r.title, r.source, r["query"]) for r in store.raw("articles").collect()) == [("alpha beta gains 1", "paper", "q"), ("alpha beta gains 2", "paper", "q")]
    assert {(r.series, r.driver, r.n) for r in store.raw("macro_observations").groupBy("series", "driver").agg(F.count("*").alias("n")).collect()} == {("brent_oil", "observations", 20)}
    assert [(r.ticker, r.revenue, r.provider) for r in store.raw("raw_fundamentals").collect()] == [("A.JK", 7.0, "statements")]
    for name in ("funda-features", "macro-features", "sentiment", "align"):
        stages.RUN[name](store)
    assert store.get("panel").count() == 120 and store.get("sentimen").count() > 0


def test_failed_batch_is_done_again(spark, world, monkeypatch):
    """A batch that fails between its two tables is repeated from the checkpoint; other sources are not stopped."""
    land, cfg = world
    land.bars(DAYS[:30]), land.flow(DAYS[:5]), land.flow([DAYS[6]], "ZZ")
    plain = KeyedTable.upsert

    def broken(self, *a, **k):
        if self.path.endswith("empty_dates"):
            raise OSError("lost")
        return plain(self, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "upsert", broken)
        told = Refresh(spark, cfg, buckets=2).run()
    assert told["flow"].startswith("failed") and told["bars"].startswith("ok") and told["technical"].startswith("ok")
    job = Refresh(spark, cfg, buckets=2)
    assert job.table("raw_flow").manifest()["version"] == 1 and job.table("empty_dates").read() is None
    assert job.run()["flow"].startswith("ok")
    assert job.table("raw_flow").manifest()["version"] == 1 and job.table("raw_flow").read().count() == 5
    assert [r.date for r in job.table("empty_dates").read().collect()] == [DAYS[6]]
    stages.RUN["refresh"](stages.Store(spark, cfg))
