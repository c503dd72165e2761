"""Decoders of landed payloads, sinks, incremental forms and the stages end to end."""

import datetime as dt
import json
import os

import pytest
from plain import devalue
from pyspark.sql import functions as F

from pitpanel.config import Config, load_config, load_dotenv
from pitpanel.plans import fundamental, landing, ledger, stages
from pitpanel.sources import feeds, readers, sinks
from pitpanel.sources.deadletters import DeadLetters
from pitpanel.sources.keyed import KeyedTable
from pitpanel.streaming import incremental


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_universe(spark, tmp_path):
    p = tmp_path / "t.json"
    p.write_text(json.dumps({"id": [{"ticker": " bbca.jk ", "name": "Bank"}, {"ticker": "", "name": "x"}, {"ticker": "BBCA.JK", "name": "again"}, {"ticker": "tlkm.jk"}]}))
    assert sorted(map(tuple, readers.universe(spark, str(p)).collect())) == [("BBCA.JK", "Bank"), ("TLKM.JK", "")]
    p.write_text("{}")
    with pytest.raises(ValueError):
        readers.universe(spark, str(p))


def test_missing_path_is_an_empty_table(spark, tmp_path):
    df = readers.read(spark, str(tmp_path / "none"), "raw_flow")
    assert df.count() == 0 and df.columns[0] == "date"


def test_statement_decoding(spark):
    flat = [{"financialData": 1}, {"datekey": 2, "revenue": 5, "revenueBank": 6, "epsdil": -1}, [3, 4], "2023-12-31", "TTM", [7, 7], [8, 9], None, 10.0, 11.0]
    payload = json.dumps({"nodes": [None, {"type": "data", "data": [1]}, {"type": "data", "data": flat}]})
    d = readers.financial_arrays(readers.statements(frame(spark, [("A", "Q", payload), ("B", "Q", "<html>")], "ticker string, freq string, payload string")))
    got = readers.statement_rows(d, {"revenue", "eps"}).collect()
    assert [(r.ticker, r.report_period, r.revenue, r.eps) for r in got] == [("A", dt.date(2023, 12, 31), 10.0, None)]


def test_macro_drivers(spark):
    one = lambda p: frame(spark, [("s", p)], "series string, payload string")
    got = readers.observations_api(one('{"observations":[{"date":"2024-01-01","value":"."},{"date":"2024-01-02","value":"3.5"}]}')).collect()
    assert [(r.date, r.value) for r in got] == [(dt.date(2024, 1, 2), 3.5)]
    got = readers.series_docs(one('{"series":{"docs":[{"period_start_day":["2024-02-01"],"value":["7"],"@frequency":"monthly"}]}}')).collect()
    assert [(r.date, r.value) for r in got] == [(dt.date(2024, 2, 29), 7.0)]
    table = {"status": "OK", "vervar": [{"val": "9999"}], "turvar": [{"val": "0"}], "tahun": [{"val": "126", "label": "2026"}], "datacontent": {"999949801261": 5.0, "9999498012613": 60.0}}
    got = readers.dynamic_table(one(json.dumps(table)), "498").collect()
    assert [(r.date, r.value) for r in got] == [(dt.date(2026, 1, 31), 5.0)]
    stat = frame(spark, [("s", 2024, 1, '{"seriesData":[{"x":"a","y":2},{"x":"b","y":null},{"x":"c","y":3.5}]}'), ("s", 2024, 3, '{"seriesData":[{"x":"a","y":2}]}')], "series string, year int, month int, payload string")
    assert [(r.date, r.value) for r in readers.monthly_statistic(stat, "2024-03-15").collect()] == [(dt.date(2024, 1, 31), 5.5)]


def test_flow_rows(spark):
    good = '{"recordsTotal":2,"data":[{"StockCode":" bbca ","ForeignBuy":5,"ForeignSell":2},{"StockCode":"XX","ForeignBuy":1,"ForeignSell":1},{"StockCode":"BBCA","ForeignBuy":"x","ForeignSell":1}]}'
    u = frame(spark, [("BBCA.JK", "")], "ticker string, name string")
    d = frame(spark, [(dt.date(2024, 1, 1), good), (dt.date(2024, 1, 2), None), (dt.date(2024, 1, 3), "[]")], "date date, payload string")
    assert [tuple(r) for r in readers.stock_flow(d, u).collect()] == [(dt.date(2024, 1, 1), "BBCA.JK", 5.0, 2.0, 3.0)]


BAD = {
    "observations": {'{"observations":[{"date":"n/a","value":"1"},{"date":"2024-01-01","value":"."}]}': "no usable entry", '{"observations":7}': "no observations"},
    "series_docs": {'{"series":{"docs":[]}}': "no usable entry", '{"series":{}}': "no series.docs", '{"series":{"docs":[{"period_start_day":["x"],"value":["1"]}]}}': "no usable entry"},
    "dynamic_table": {'{"datacontent":{"1":2},"tahun":[{"val":"1","label":"2024*"}]}': "no usable entry", '{"status":"OK"}': "no datacontent"},
    "monthly_statistic": {'{"seriesData":[{"x":"a","y":"-"}]}': "no usable entry", '{"a":1}': "no seriesData"},
    "flow": {'{"recordsTotal":0}': "no data"},
    "statements": {'{"nodes":[{"type":"skip"}]}': "no usable entry", "{}": "no nodes"},
}


def test_dead_letters(spark, tmp_path):
    letters = DeadLetters(spark, str(tmp_path / "d"), "2024-01-01", limit=30)
    everywhere = {None: "empty", "  ": "empty", "<html>" + "z" * 50: "not JSON", "[1]": "not JSON", '{"a":': "not JSON"}
    for driver, cases in BAD.items():
        want = everywhere | cases
        rows = frame(spark, [("s", p) for p in want], "series string, payload string")
        assert letters.sift(rows, driver, F.col("series")).count() == 0
        got = {(r.reason, r.payload) for r in letters.read().where(F.col("source") == driver).collect()}
        # null and blank payloads are one content each; payloads are cut, their keys are not
        assert got == {(r, (p or None) and p[:30]) for p, r in want.items()}
    n, version = letters.read().count(), letters.table.manifest()["version"]
    letters.sift(frame(spark, [("s", p) for p in BAD["flow"]], "series string, payload string"), "flow", F.col("series"))
    assert letters.read().count() == n and letters.table.manifest()["version"] == version  # a rerun adds nothing
    assert letters.counts()[("flow", "no data")] == 1
    good = frame(spark, [("s", '{"recordsTotal":0,"data":[]}')], "series string, payload string")
    assert letters.sift(good, "flow", F.col("series")).count() == 1


def test_bad_entries_do_not_end_a_run(spark):
    """Every decoder takes what is usable of a payload and leaves the rest."""
    one = lambda p: frame(spark, [("s", p)], "series string, payload string")
    got = readers.observations_api(one('{"observations":[{"date":"n/a","value":"1"},{"date":"2024-01-02","value":"3.5"},{"date":"2024-01-03","value":"NaN"}]}')).collect()
    assert [(r.date, r.value) for r in got] == [(dt.date(2024, 1, 2), 3.5)]
    assert readers.series_docs(one('{"series":{"docs":[]}}')).count() == 0
    assert [r.value for r in readers.series_docs(one('{"series":{"docs":[{"period_start_day":["x","2024-02-01"],"value":["7","8"]}]}}')).collect()] == [8.0]
    table = {"vervar": [{"val": "9"}], "turvar": [{"val": "0"}], "tahun": [{"val": "126", "label": "2026"}, {"val": "127", "label": "2027*"}], "datacontent": {"9498012612": 5.0, "949801271": 6.0, "949801261": "-"}}
    assert [(r.date, r.value) for r in readers.dynamic_table(one(json.dumps(table)), "498").collect()] == [(dt.date(2026, 12, 31), 5.0)]
    stat = frame(spark, [("s", 2024, 13, '{"seriesData":[{"y":2}]}'), ("s", None, 1, '{"seriesData":[{"y":2}]}'), ("s", 2024, 1, '{"seriesData":[{"y":2}]}')], "series string, year int, month int, payload string")
    assert [(r.date, r.value) for r in readers.monthly_statistic(stat, "2024-03-15").collect()] == [(dt.date(2024, 1, 31), 2.0)]
    bars = frame(spark, [("A", "n/a", 1.0), ("A", "2024-01-02 09:00:00", 2.0)], "ticker string, Date string, Close double")
    assert [(r.date, r.close) for r in readers.normalize_bars(bars).collect()] == [(dt.date(2024, 1, 2), 2.0)]


def test_later_rows_win(spark, tmp_path):
    """Of two bars of a date the one that landed later counts, not the greater: within a file, and by file."""
    (tmp_path / "landed/bars").mkdir(parents=True)
    line = lambda d, c: json.dumps({"ticker": "A", "Date": d, "Close": c}) + "\n"
    (tmp_path / "landed/bars/b.json").write_text(line("2024-01-01", 10.0) + line("2024-01-01", 9.0) + line("2024-01-02", 5.0))
    os.utime(tmp_path / "landed/bars/b.json", (1, 1))
    (tmp_path / "landed/bars/a.json").write_text(line("2024-01-02", 4.0))
    got = landing.bars(spark, Config(root=str(tmp_path))).orderBy("date").collect()
    assert [r.close for r in got] == [9.0, 4.0]


def test_pointers_like_devalue(spark):
    """Nested, negative and circular links: the arrays of financialData as the plain form gives them, without Python in the plan."""
    flats = [
        [{"financialData": 1, "self": 0}, {"datekey": 2, "revenue": 5, "cor": 8, "gp": -1, "assets": 9}, [3, 4], "2023-12-31", "2024-03-31", [6, -5], 7.5, None, [7, 6, 99], [10, 6], [6]],
        [{"other": 1}, {"datekey": 2}, []], [{"financialData": -1}], [{"financialData": 1}, {"datekey": 2}, [1, 2, 3], "2024-03-31"], [7],
    ]
    rows = [(str(i), "Q", json.dumps({"nodes": [{"type": "data", "data": f}]})) for i, f in enumerate(flats)] + [("x", "Q", "<html>"), ("y", "Q", None)]
    d = readers.statements(frame(spark, rows, "ticker string, freq string, payload string"))
    assert "Python" not in d._jdf.queryExecution().executedPlan().toString()
    got = {r.ticker: r.financial for r in d.collect()}
    fin = devalue([{"financialData": 1}, *flats[0][1:8], [7, 6], *flats[0][9:]])["financialData"]
    text = lambda x: None if x is None else str(x)
    assert got["0"]["datekey"] == fin["datekey"] and got["0"]["revenue"] == [text(x) for x in fin["revenue"]] and got["0"]["cor"] == ["7.5" if x == 7.5 else None for x in (None, 7.5, None)]
    assert got["0"]["gp"] is None and got["1"] is None and got["2"] is None and got["4"] is None and got["x"] is None and got["y"] is None
    assert got["3"]["datekey"][2] == "2024-03-31"  # a list that links to itself does no harm
    numbers = readers.financial_arrays(d).where("ticker = '0'").first()
    assert numbers.revenue == [7.5, None] and numbers.assets[1] == 7.5


def test_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A &amp;amp; B</title><description>&lt;p&gt;x  y&lt;/p&gt;</description><link> http://l </link><pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate></item><item><title>No date</title></item></channel></rss>")
    got = readers.feed(spark, str(tmp_path / "f.xml"), "s", "en", "u", "2024-05-05 00:00:00").orderBy("published").collect()
    assert [(r.title, r.summary, r.link, r.published) for r in got] == [("A & B", "x y", "http://l", dt.datetime(2024, 1, 1, 10)), ("No date", "", "", dt.datetime(2024, 5, 5))]


ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title>One</title><link rel="self" href="s1"/><link href="h1"/>
<summary>x</summary><updated>2024-01-03T10:00:00Z</updated></entry><entry><title>Two</title><content>c</content><published>2024-01-02T10:00:00+02:00</published></entry></feed>"""
RSS = "<rss><channel><title>t</title><item><title>T{0}</title><description>d</description><link>l{0}</link><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item></channel></rss>"


def test_feed_bodies(spark):
    rdf = "<rdf:RDF xmlns:rdf='r'><channel><title>t</title></channel><item><title>R</title><link>r</link><dc:date>2024-01-05</dc:date></item></rdf:RDF>"
    rows = [("atom", ATOM), ("rss", RSS.format(1)), ("rdf", rdf), ("none", "<rss><channel></channel></rss>"), ("html", "<html><body>x</body></html>"), ("cut", RSS.format(2)[:60]), ("blank", " "), ("null", None), ("text", "no feed")]
    got = feeds.items(frame(spark, rows, "k string, body string"))
    assert {r.k: r.reason for r in got.collect()} == {"atom": None, "rss": None, "rdf": None, "none": None, "html": "not a feed", "cut": "not a feed", "blank": "empty", "null": "empty", "text": "not a feed"}
    out = {(r.k, r.title): (r.summary, r.link, r.published) for r in feeds.articles(got, "2024-05-05").collect()}
    assert out == {
        ("atom", "One"): ("x", "h1", dt.datetime(2024, 1, 3, 10)), ("atom", "Two"): ("c", "", dt.datetime(2024, 1, 2, 8)),
        ("rss", "T1"): ("d", "l1", dt.datetime(2024, 1, 1, 10)), ("rdf", "R"): ("", "r", dt.datetime(2024, 1, 5)),
    }


def test_archive_backfill(spark, tmp_path):
    """From an archive's index and fetched bodies to historical articles: one snapshot a day, failures noted and tried again."""
    def land(name, rows, file):
        (tmp_path / "landed" / name).mkdir(parents=True, exist_ok=True)
        (tmp_path / "landed" / name / file).write_text("".join(json.dumps(r) + "\n" for r in rows))

    settings = {"as_of": "2024-03-20", "sentiment": {"feeds": [{"name": "f", "source": "paper", "lang": "id", "url": "u"}]}}
    (tmp_path / "s.json").write_text(json.dumps(settings))
    store = stages.Store(spark, load_config(str(tmp_path / "s.json"), str(tmp_path)))
    stamps = ["20200101010000", "20200101020000", "20200102010000", "20200103010000", "20200104010000", "20200105010000"]
    land("archive_index", [{"feed_url": "u", "timestamp": t, "statuscode": "404" if t.startswith("20200105") else "200"} for t in stamps], "1.json")
    body = lambda t, b, status=200: {"feed_url": "u", "timestamp": t, "status": status, "body": b}
    land("archive_bodies", [body(stamps[0], RSS.format(1)), body(stamps[1], RSS.format(9)), body(stamps[2], "<html>"), body(stamps[3], "<rss><channel/></rss>"), body(stamps[4], "x", 503)], "1.json")
    stages.RUN["sentiment-backfill"](store)
    ledger = lambda: {r.timestamp: (r.outcome, r.reason, r.n) for r in landing.archive_ledger(spark, store.cfg).read().collect()}
    assert ledger() == {stamps[0]: ("done", None, 1), stamps[2]: ("failed", "not a feed", 0), stamps[3]: ("empty", None, 0), stamps[4]: ("failed", "status 503", 0)}
    past = readers.read(spark, str(tmp_path / "raw/articles_historical"), "articles")
    assert [(r.source, r.title, r.link) for r in past.collect()] == [("paper", "T1", "l1")]
    assert landing.dead_letters(spark, store.cfg).counts() == {("archive", "not a feed"): 1, ("archive", "status 503"): 1}
    stages.RUN["sentiment-backfill"](store)  # nothing new
    assert readers.read(spark, str(tmp_path / "raw/articles_historical"), "articles").count() == 1
    land("archive_bodies", [body(stamps[2], ATOM), body(stamps[4], RSS.format(1))], "2.json")
    stages.RUN["sentiment-backfill"](store)
    past = readers.read(spark, str(tmp_path / "raw/articles_historical"), "articles")
    assert sorted(r.title for r in past.collect()) == ["One", "T1", "Two"]
    assert ledger()[stamps[2]] == ("done", None, 2) and ledger()[stamps[4]] == ("done", None, 1)


def test_backends():
    assert readers.backfill_backend("wayback") == "wayback"
    with pytest.raises(NotImplementedError):
        readers.backfill_backend("gdelt")
    with pytest.raises(ValueError):
        readers.backfill_backend("x")


def test_sinks(spark, tmp_path):
    d = frame(spark, [(2, 0.123456789), (1, None)], "k int, x double")
    sinks.write_csv(d, str(tmp_path / "c"), ["k"])
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "c"), header=True).orderBy("k").collect()] == [("1", None), ("2", "0.123457")]
    assert sinks.as_text(d).dtypes == [("k", "string"), ("x", "string")]
    assert sinks.push_tables({"t": d}, None) == {}
    assert sinks.push_tables({"t": d}, "jdbc:nothing:x") == {"t": "failed"}


def test_dotenv(tmp_path, monkeypatch):
    (tmp_path / ".env.example").write_text("PANEL_A=1\nPANEL_B=2\n# no\n")
    (tmp_path / ".env").write_text("PANEL_B='3'\n")
    monkeypatch.setenv("PANEL_A", "0")
    monkeypatch.setenv("PANEL_B", "0")
    assert load_dotenv(str(tmp_path)) == {"PANEL_A": "1", "PANEL_B": "3"}


def test_upsert_sink_knows_queries(spark, tmp_path):
    """A stream's batches by its query's id: a repeated one changes nothing, one of a new checkpoint counts though its number is 0 again."""
    table = KeyedTable(spark, str(tmp_path / "u"), ["k"], buckets=4)
    schema = "k int, v string"
    for i, (rows, checkpoint) in enumerate([([(1, "a"), (2, "b")], "c1"), ([(2, "c"), (3, "d")], "c1"), ([(4, "e")], "c2")]):
        folder = tmp_path / ("in1" if checkpoint == "c1" else "in2")
        frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(schema).parquet(str(folder))
        q = stream.writeStream.foreachBatch(incremental.upsert_sink(table)).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        q.awaitTermination()
        assert table.manifest()["version"] == i + 1
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]
    assert sorted(table.manifest()["writers"].values()) == [0, 1]
    with pytest.raises(ValueError):
        incremental.upsert_sink(table)(frame(spark, [(1, "z")], schema), 0)


def test_streams(spark, tmp_path):
    rows = [("s", " http://a ", "t", dt.datetime(2024, 1, 1)), ("s", "http://a", "t2", dt.datetime(2024, 1, 1, 1)), ("s", None, "t", dt.datetime(2024, 1, 1))]
    schema = "source string, link string, title string, fetched_at timestamp"
    frame(spark, rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = incremental.new_articles(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("news").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.key for r in spark.table("news").collect()) == ["http://a", "s|t"]


def test_decay_as_state(spark, tmp_path):
    rows = [("A", dt.date(2024, 1, 1), 1.0, 1.0), ("A", dt.date(2024, 1, 4), 0.0, 1.0)]
    schema = "key string, date date, score_sum double, n double"
    frame(spark, rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = incremental.decay_state(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("decay").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {str(r.date): r.sent_decay for r in spark.table("decay").collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-04": pytest.approx(0.5 / 1.5)}


def test_stages_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    put = lambda name, rows, schema: frame(spark, rows, schema).write.parquet(f"{root}/raw/{name}")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(70)]
    put("raw_prices", [(d, t, 10.0 + i, 11.0 + i, 9.0 + i, 10.5 + i, 10.5 + i, 100.0, 0.0, 0.0) for t in ("A.JK", "B.JK") for i, d in enumerate(days)], readers.SCHEMAS["raw_prices"])
    put("stock_metadata", [("A.JK", "PT Alpha Beta Tbk", "Energy", None, None, None)], readers.SCHEMAS["stock_metadata"])
    put("macro_observations", [(d, float(i), d, "brent_oil", "x", "daily", "g") for i, d in enumerate(days)], readers.SCHEMAS["macro_observations"])
    put("articles", [("s", "u", "en", "alpha beta gains", "coal", "l1", dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1), None)], readers.SCHEMAS["articles"])
    rows = fundamental.canonical(frame(spark, [("A.JK", "Q", dt.date(2023, 9, 30), 5.0)], "ticker string, freq string, report_period date, revenue double"))
    rows.write.parquet(f"{root}/raw/raw_fundamentals")
    store = stages.Store(spark, Config(root=root))
    for name in ("technical", "funda-features", "macro-features", "sentiment", "align"):
        stages.RUN[name](store)
    with pytest.raises(RuntimeError):
        stages.RUN["flow"](store)
    panel = store.get("panel")
    assert panel.count() == 140 and panel.select("ticker", "date").distinct().count() == 140
    assert panel.where("funda_release_date > date").count() == 0
    assert panel.where("ticker = 'A.JK' and sector_cmdty_ret is not null").count() > 0
    assert {r.level for r in store.get("sentimen").collect()} == {"stock", "market", "sector"}
    assert store.get("coverage").where(F.col("rows") == 140).count() == 1


def test_stages_from_payloads(spark, tmp_path):
    """Landed payloads to panel: decoders, provider and source chains, quarantine, days and articles added once."""
    root = str(tmp_path)

    def land(name, rows):
        (tmp_path / "landed" / name).mkdir(parents=True, exist_ok=True)
        with open(tmp_path / "landed" / name / "part.json", "a") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(70)]
    (tmp_path / "config").mkdir()
    (tmp_path / "config" / "universe.json").write_text(json.dumps({"id": [{"ticker": "a.jk", "name": "PT Alpha Beta Tbk"}, {"ticker": "B.JK", "name": "Bravo"}]}))
    land("bars", [{"ticker": t, "Date": str(d), "Open": 10.0 + i, "High": 11.0 + i, "Low": 9.0 + i, "Close": 10.5 + i, "Adj Close": 10.5 + i, "Volume": 100.0, "Dividends": 0.0, "Stock Splits": 0.0} for t in ("A.JK", "B.JK") for i, d in enumerate(days)])
    land("bars", [{"ticker": "A.JK", "Date": "2024-03-20", "Close": None}])
    land("metadata", [{"ticker": "A.JK", "long_name": None, "sector": "Energy", "sub_sector": "Coal", "ipo_epoch": 86400}])

    def statement(**fields):
        flat = [{"financialData": 1}, {"datekey": 2, **{k: 4 + i for i, k in enumerate(fields)}}, [3], "2023-09-30"]
        at = len(flat) + len(fields)
        flat += [[at + i] for i in range(len(fields))] + list(fields.values())
        return json.dumps({"nodes": [{"type": "data", "data": flat}]})

    land("statements", [{"ticker": "A.JK", "freq": "Q", "kind": "income", "payload": statement(revenue=5.0)}, {"ticker": "A.JK", "freq": "Q", "kind": "balance", "payload": statement(assets=9.0, equity=4.0)}, {"ticker": "B.JK", "freq": "Q", "kind": "income", "payload": "<html>"}])
    cells = [("Operating Revenue", 7.0), ("Total Assets", 8.0)]
    land("fallback_statements", [{"ticker": t, "freq": "Q", "report_period": "2023-09-30", "label": k, "value": v} for t in ("A.JK", "B.JK") for k, v in cells])
    docs = {"series": {"docs": [{"period_start_day": [str(d) for d in days], "value": [str(100 + i) for i in range(70)], "@frequency": "daily"}]}}
    land("macro", [{"series": "brent_oil", "driver": "observations", "payload": '{"observations":[{"date":"2024-01-01","value":"."}]}'}, {"series": "brent_oil", "driver": "series_docs", "payload": json.dumps(docs)}])
    bad = {d: next(p for p in cases if p) for d, cases in BAD.items()}
    land("macro", [{"series": "brent_oil", "driver": d, "year": 2024, "month": 1, "payload": bad[d]} for d in ("observations", "series_docs", "dynamic_table", "monthly_statistic")])
    land("macro", [{"series": "brent_oil", "driver": "series_docs", "payload": "<html>"}])
    land("statements", [{"ticker": "B.JK", "freq": "Q", "kind": "income", "payload": bad["statements"]}])
    land("flow", [{"date": "2024-02-04", "payload": bad["flow"]}])
    land("macro_closes", [{"series": "gold", "date": str(d), "close": 5.0} for d in days])
    flow_of = lambda code: json.dumps({"recordsTotal": 1, "data": [{"StockCode": code, "ForeignBuy": 5, "ForeignSell": 2}]})
    land("flow", [{"date": "2024-02-01", "payload": flow_of("A")}, {"date": "2024-02-02", "payload": flow_of("ZZ")}, {"date": "2024-02-03", "payload": "<html>"}])
    feeds = tmp_path / "landed" / "feeds" / "f"
    feeds.mkdir(parents=True)
    item = "<item><title>alpha beta {0}</title><description>gains</description><link>l{0}</link></item>"
    (feeds / "1.xml").write_text("<rss><channel>" + item.format(1) + item.format(1) + "</channel></rss>")
    settings = {"as_of": "2024-03-20", "macro": {"series": [
        {"name": "brent_oil", "group": "commodity", "frequency": "monthly", "lag": 1, "sources": [{"driver": "observations"}, {"driver": "dynamic_table", "variable": "498"}, {"driver": "monthly_statistic"}, {"driver": "series_docs", "frequency": "daily", "lag": 2}]},
        {"name": "gold", "frequency": "daily", "sources": [{"driver": "closes"}]}]}, "sentiment": {"feeds": [{"name": "f", "lang": "id", "url": "u"}]}}
    (tmp_path / "settings.json").write_text(json.dumps(settings))
    store = stages.Store(spark, load_config(str(tmp_path / "settings.json"), root))
    for name in stages.ORDER:
        stages.RUN[name](store)
    meta = {r.ticker: (r.name, r.sector, r.ipo_date) for r in store.raw("stock_metadata").collect()}
    assert meta == {"A.JK": ("PT Alpha Beta Tbk", "Energy", dt.date(1970, 1, 2)), "B.JK": ("Bravo", None, days[0])}
    funda = {r.ticker: (r.provider, r.revenue, r.total_assets, r.total_liabilities, r.release_date) for r in store.raw("raw_fundamentals").collect()}
    release = dt.date(2023, 9, 30) + dt.timedelta(days=45)
    assert funda == {"A.JK": ("statements", 5.0, 9.0, 5.0, release), "B.JK": ("fallback", 7.0, 8.0, None, release)}
    obs = {r.series: (r.driver, r.frequency, r.group, r.n, r.lag) for r in store.raw("macro_observations").groupBy("series", "driver", "frequency", "group").agg(F.count("*").alias("n"), F.max(F.datediff("effective_date", "date")).alias("lag")).collect()}
    assert obs == {"brent_oil": ("series_docs", "daily", "commodity", 70, 2), "gold": ("closes", "daily", "other", 70, 0)}
    assert store.get("macro").agg(F.max("date")).first()[0] == dt.date(2024, 3, 20)
    assert [tuple(r) for r in store.raw("raw_flow").collect()] == [(dt.date(2024, 2, 1), "A.JK", 5.0, 2.0, 3.0)]
    assert [r.date for r in store.raw("empty_dates").collect()] == [dt.date(2024, 2, 2)]
    letters = landing.dead_letters(spark, store.cfg)
    counts = letters.counts()
    assert counts[("flow", "not JSON")] == counts[("flow", "no data")] == counts[("series_docs", "not JSON")] == counts[("statements", "no usable entry")] == 1
    assert counts[("dynamic_table", "no usable entry")] == counts[("monthly_statistic", "no usable entry")] == 1 and counts[("observations", "no usable entry")] == 2
    assert store.get("panel").count() == 140 and store.raw("articles").count() == 1
    # a second run adds what is new and nothing else
    land("flow", [{"date": "2024-02-05", "payload": flow_of("B")}])
    (feeds / "2.xml").write_text("<rss><channel>" + item.format(2) + "</channel></rss>")
    for name in ("flow", "news"):
        stages.RUN[name](store)
    assert landing.dead_letters(spark, store.cfg).counts() == counts
    assert store.raw("raw_flow").count() == 2 and store.raw("empty_dates").count() == 1
    assert sorted(r.link for r in store.raw("articles").collect()) == ["l1", "l2"]


def test_settings_are_checked(tmp_path):
    p = tmp_path / "s.json"
    p.write_text('{"technical": {"sma_windows": [5, 10]}}')
    assert load_config(str(p)).technical.sma_windows == (5, 10) and hash(load_config(str(p)))
    p.write_text('{"technical": {"no_such": 1}}')
    with pytest.raises(TypeError):
        load_config(str(p))


def test_snapshots_per_feed(spark):
    rows = [(f, f"2020010{d}{h}0000", code) for f in "ab" for d in range(1, 6) for h, code in (("01", "200"), ("02", "200"), ("00", "404"))]
    index = spark.createDataFrame(rows, "feed_url string, timestamp string, statuscode string")
    got = feeds.wanted(index, spark.createDataFrame([], feeds.LEDGER), per_run=3).collect()
    assert sorted((r.feed_url, r.timestamp) for r in got) == [(f, f"2020010{d}010000") for f in "ab" for d in (1, 2, 3)]
    assert [r.timestamp for r in got] == sorted(r.timestamp for r in got)


def test_run_ledger(spark, tmp_path):
    """A row per stage: what a good one wrote, why a source failed, what was skipped when the spine was missing."""
    root = str(tmp_path)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(70)]
    rows = [(d, "A.JK", 10.0 + i, 11.0 + i, 9.0 + i, 10.5 + i, None, 100.0, 0.0, 0.0) for i, d in enumerate(days)]
    frame(spark, rows, readers.SCHEMAS["raw_prices"]).write.parquet(f"{root}/raw/raw_prices")
    store = stages.Store(spark, Config(root=root, as_of="2024-03-31", csv=True, buckets=2))
    assert stages.run_stages(store, ["technical", "flow", "align"]) == 0
    book = {r.stage: r for r in ledger.Ledger(spark, f"{root}/runs").read().collect()}
    assert {k: (r.outcome, r.reason) for k, r in book.items()} == {"technical": ("ok", None), "flow": ("failed", "no rows of raw_flow were landed"), "align": ("ok", None)}
    wrote = {t.name: t for t in book["technical"].tables}
    assert (wrote["technical"].rows, wrote["technical"].first, wrote["technical"].last) == (70, "2024-01-01", "2024-03-10")
    assert wrote["technical"].nulls["ret_5d"] == 5 and wrote["technical"].nulls["close"] == 0 and wrote["corporate_actions"].rows == 0
    assert store.get("panel").count() == 70 and (tmp_path / "csv" / "panel").exists()
    with pytest.raises(RuntimeError):
        stages.run_stages(stages.Store(spark, Config(root=str(tmp_path / "none"))), ["align", "sentiment-backfill"])
    left = {r.stage: (r.outcome, r.reason) for r in ledger.Ledger(spark, str(tmp_path / "none/runs")).read().collect()}
    assert left == {"align": ("failed", "the technical panel is missing: it is the spine of the alignment"), "sentiment-backfill": ("skipped", "align failed")}


def test_buckets_need_no_exchange(spark, tmp_path):
    """Windows, keep-last and aggregates by ticker read a bucketed table without an exchange, also in a session that does not know it yet."""
    from pitpanel.operators.dedupe import keep_last
    from pitpanel.plans import technical

    path = str(tmp_path / "t")
    d = frame(spark, [(f"T{i % 7}", dt.date(2024, 1, 1) + dt.timedelta(days=i // 7), float(i), 1.0) for i in range(300)], "ticker string, date date, close double, open double")
    want = sorted(map(str, technical.returns(d).collect()))
    sinks.write_bucketed(d, path, "ticker", ["date"], 4)
    spark.sql(f"DROP TABLE {sinks.bucket_table(path)}")
    t = sinks.read_bucketed(spark, path, "ticker", ["date"], 4)
    for plan in (technical.returns(t), keep_last(t, ["ticker", "date"], ["close"]), t.groupBy("ticker").agg(F.max("date"))):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, technical.returns(t).collect())) == want
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 4


def test_yaml_settings(tmp_path):
    pytest.importorskip("yaml")
    p = tmp_path / "s.yaml"
    p.write_text("technical:\n  sma_windows: [5, 10]\nsentiment:\n  feeds:\n    - {name: f, lang: id, url: u, query: q}\n")
    cfg = load_config(str(p))
    assert cfg.technical.sma_windows == (5, 10) and cfg.sentiment.feeds[0].query == "q"
