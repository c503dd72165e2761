"""Operators and plans on hand-made frames: seeds, boundaries, ties, null rules; and every query against its SQL."""

import datetime as dt
import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plain import scan_pandas
from pitpanel.config import Technical, Universe, load_config
from pitpanel.functions import lexicon, scalar, text
from pitpanel.operators import asof, dedupe, scan
from pitpanel.plans import align, fundamental, macro, sentiment, stages, technical

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
D = dt.date(2024, 1, 1)


def day(n):
    return D + dt.timedelta(days=n)


def bars(spark, closes, ticker="A", **more):
    rows = [(ticker, day(i), c, c, c, c, float(more.get("volume", 10))) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_ewm_matches_pandas(spark):
    r = np.random.RandomState(0)
    x = pd.Series(r.randn(700)).cumsum() + 100
    df = spark.createDataFrame([("A", day(i), float(v), None if i == 0 else float(v)) for i, v in enumerate(x)], "k string, date date, x double, g double")
    for how in (scan.scan, scan_pandas):
        got = scan.ewm(df, "k", "date", {"a": ("x", 2 / 13), "b": ("g", 1 / 14)}, how)
        assert np.allclose(column(got, "a"), x.ewm(span=12, adjust=False).mean(), rtol=1e-12)
        b = column(got, "b")
        assert b[0] is None and np.allclose(b[1:], x[1:].ewm(alpha=1 / 14, adjust=False).mean(), rtol=1e-12)


def test_flat_prices(spark):
    d = technical.volume_features(technical.recursive(technical.clean(bars(spark, [100.0] * 16))))
    assert column(d, "rsi_14") == [None] * 14 + [100.0] * 2
    assert column(d, "mfi_14") == [None] * 13 + [100.0] * 3


def test_zero_volume_gives_null(spark):
    d = technical.volume_features(technical.clean(bars(spark, [100.0 + i for i in range(25)], volume=0)))
    assert set(column(d, "volume_ratio")) == set(column(d, "obv_slope_20d")) == {None}


def test_duplicate_date_with_bad_last_close(spark):
    rows = [("A", D, 1.0, 1.0, 1.0, 5.0, 1.0, 0), ("A", D, 1.0, 1.0, 1.0, None, 1.0, 1), ("A", day(1), 1.0, 1.0, 1.0, 7.0, -3.0, 0)]
    df = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double, seen int")
    got = technical.clean(df, ("seen",)).collect()
    assert [(r.date, r.volume) for r in got] == [(day(1), 0.0)]


@pytest.mark.parametrize("adj, want", [([None, 4.0, None], [2.0, 4.0, 6.0]), ([None] * 3, [1.0, 2.0, 3.0]), ([0.5, None, 3.0], [0.5, 1.0, 3.0])])
def test_back_adjust(spark, adj, want):
    df = bars(spark, [1.0, 2.0, 3.0]).withColumn("adj_close", F.element_at(F.array(*(F.lit(a).cast("double") for a in adj)), F.datediff("date", F.lit(D)) + 1))
    assert column(technical.back_adjust(technical.clean(df)), "close") == want


def test_price_tiers(spark):
    u = Universe()
    df = spark.createDataFrame([(199.99,), (200.0,), (5000.0,), (None,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(scalar.tier(F.col("x"), u.tiers)).collect()] == [0.35, 0.25, 0.2, None, None]


def test_cross_section_needs_ten_rows(spark):
    for n in (9, 10):
        df = spark.createDataFrame([(str(i), D, float(i) if i else None) for i in range(n)], "ticker string, date date, ret_20d double")
        z = [r.ret_20d_cs_z for r in technical.cross_section(df, Technical()).collect()]
        assert all(x is None for x in z) if n == 9 else sum(x is not None for x in z) == 9


def test_december_with_three_days(spark):
    df = spark.createDataFrame([("A", dt.date(2023, 12, d)) for d in (1, 4, 5)] + [("A", dt.date(2024, 1, 2))], "ticker string, date date")
    assert column(technical.calendar_features(df), "window_dressing_flag") == [1, 1, 1, 0]


def test_asof_tolerance_and_ties(spark):
    left = spark.createDataFrame([("A", day(400)), ("B", day(401)), ("C", day(5))], "ticker string, date date")
    right = spark.createDataFrame([("A", D, day(-9), 1.0), ("A", D, day(-8), 2.0), ("B", D, day(-9), 3.0), ("C", None, day(-9), 4.0)], "ticker string, release_date date, p date, v double")
    got = asof.asof_backward(left, right, ["ticker"], "date", "release_date", 400, "p", ["v"])
    assert {r.ticker: r.v for r in got.collect()} == {"A": 2.0, "B": None, "C": None}


def test_nearest_year_ago(spark):
    obs = spark.createDataFrame([("s", dt.date(2022, 12, 22), 1.0), ("s", dt.date(2023, 1, 11), 2.0), ("s", dt.date(2024, 1, 1), 4.0), ("s", dt.date(2024, 3, 1), 9.0)], "series string, date date, value double")
    got = {r.date: r.value for r in macro.year_over_year(obs).collect()}
    assert got == {dt.date(2024, 1, 1): 100.0}  # of two equally near, the later; none within 20 days of 2023-03-01


def quarters(spark, ends, freq="Q"):
    rows = [("A", freq, e, float(i + 1)) for i, e in enumerate(ends)]
    return fundamental.canonical(spark.createDataFrame(rows, "ticker string, freq string, report_period date, revenue double"))


def test_trailing_year_tolerates_one_gap(spark):
    ends = [dt.date(2022, 3, 31), dt.date(2022, 6, 30), dt.date(2022, 9, 30), dt.date(2022, 12, 31), dt.date(2023, 3, 31), dt.date(2023, 6, 30)]
    one, two = ends[:2] + ends[3:5], [ends[0], ends[1], ends[4], ends[5]]
    assert column(fundamental.trailing(quarters(spark, one)), "revenue_ttm", "report_period")[-1] == 10.0
    assert column(fundamental.trailing(quarters(spark, two)), "revenue_ttm", "report_period")[-1] is None


def test_quarterly_wins_over_annual(spark):
    rows = [("A", "A", dt.date(2022, 12, 31), "9"), ("A", "Q", dt.date(2022, 12, 31), "1"), ("A", "A", dt.date(2021, 12, 31), "x")]
    got = fundamental.canonical(spark.createDataFrame(rows, "ticker string, freq string, report_period date, revenue string")).orderBy("report_period").collect()
    assert [(r.freq, r.revenue, r.release_date) for r in got] == [("A", None, dt.date(2022, 3, 31)), ("Q", 1.0, dt.date(2023, 2, 14))]


def test_valuation_of_losses(spark):
    df = spark.createDataFrame([(10.0, -1.0, 2.0), (10.0, 2.0, None), (10.0, None, 0.0)], "close double, eps_ttm double, bvps double")
    assert [(r.pe_ttm, r.pbv) for r in align.valuation(df).collect()] == [(None, 5.0), (5.0, None), (None, None)]


def test_polarity(spark):
    lex = lexicon.load_lexicon()
    rows = ["tidak naik", "naik", "nothing here", None, "NO gain; Falls. rally", "inflasi tinggi"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in df.select(text.polarity(F.col("t"), lex["positive"], lex["negative"], lex["negations"])).collect()]
    assert got == [-1.0, 1.0, None, None, pytest.approx(-1 / 3), None]
    assert lexicon.words([False, "A"]) == ["no", "a"]


def test_keywords_are_substrings(spark):
    df = spark.createDataFrame([("a meeting",), ("none",)], "t string")
    assert [r[0] for r in df.select(text.keyword_groups(F.col("t"), lexicon.SECTOR_KEYWORDS)).collect()] == [["Basic Materials"], []]


def test_decay_gap(spark):
    df = spark.createDataFrame([("A", D, 1.0, 1), ("A", day(20), -1.0, 1), ("A", day(22), 0.0, 0)], "ticker string, date date, score_sum double, n long")
    got = {(r.date - D).days: r.sent_decay for r in sentiment.decay(df, ["ticker"]).collect()}
    assert sorted(got) == [*range(15), 20, 21, 22]
    f = 0.5 ** (1 / 3)
    assert got[14] == pytest.approx(1.0) and got[20] == pytest.approx((f**20 - 1) / (f**20 + 1))


def test_day_of_unscored_articles(spark):
    df = spark.createDataFrame([("A", D, None, "live"), ("A", D, None, "backfill")], "ticker string, date date, score double, source_type string")
    r = sentiment.stock_daily(df).first()
    assert (r.score_sum, r.sent_score, r.n, r.news_count, r.sent_source) == (0.0, None, 0, 2, "mixed")


def test_stale_is_null_before_first(spark):
    obs = spark.createDataFrame([("a", D, 1.0), ("b", day(3), 2.0), ("b", day(9), 3.0)], "series string, effective_date date, value double")
    d = macro.series_features(macro.daily_grid(obs), None, {"a": 3, "b": 1})
    got = {(r.series, (r.date - D).days): r.stale for r in d.collect()}
    assert got["b", 2] is None and got["b", 4] == 0 and got["b", 5] == 1 and got["a", 3] == 0 and got["a", 4] == 1


def test_appended_rows_leave_past_features(spark):
    r = np.random.RandomState(2)
    closes = [float(x) for x in 100 + r.randn(90).cumsum()]
    drop = "window_dressing_flag"
    a = technical.technical_panel(bars(spark, closes[:70])).drop(drop).orderBy("date").collect()
    b = technical.technical_panel(bars(spark, closes)).drop(drop).orderBy("date").limit(70).collect()
    for x, y in zip(a, b):
        assert all(p == q or math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-12) for p, q in zip(x[3:], y[3:]) if p is not None or q is not None)


def test_upsert_and_todo(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, dedupe.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert [r.k for r in dedupe.todo(new, old.where("k = 1"), old.where("k = 2"), "k").collect()] == [3]


def test_significant_digits(spark):
    df = spark.createDataFrame([(123456789.0,), (0.000123456789,), (0.0,), (None,), (-1.0000005,)], "x double")
    got = [r[0] for r in df.select(scalar.significant(F.col("x"))).collect()]
    assert got[0] == 123457000.0 and math.isclose(got[1], 0.000123457) and got[2:4] == [0.0, None] and got[4] == -1.0


def test_stage_names():
    assert stages.resolve(["align", "macro"]) == ["macro", "align"]
    assert stages.resolve(["sentiment-backfill", "all"]) == list(stages.ORDER)
    with pytest.raises(ValueError):
        stages.resolve(["nope"])
    assert load_config().get("technical.rsi") == 14 and load_config().get("no.such", 1) == 1
    with pytest.raises(KeyError):
        load_config().require("no.such")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (dt.date, pd.Timestamp)):
        return pd.Timestamp(v).isoformat()
    return float(v) + 0.0 if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(entry._panel.QUERIES))
def test_query_matches_sql(spark, sf, duck, name):
    got = entry._panel.QUERIES[name](spark, sf)
    want = duck.execute(entry._panel.ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda r: tuple(str(x) for x in r)
    a = sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=key)
    b = sorted((tuple(plain(x) for x in r) for r in want[cols].itertuples(index=False)), key=key)
    assert a == b


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_long_names(spark):
    """Names are found whole whatever their length, and not by their first words."""
    names = [("BJBR.JK", "PT Bank Pembangunan Daerah Jawa Barat dan Banten Tbk"), ("BBCA.JK", "Bank Central"), ("X.JK", "abc")]
    ents = sentiment.entities(spark.createDataFrame([(*n, "s") for n in names], "ticker string, name string, sector string"))
    name = {r.ticker: r.name for r in ents.collect()}
    assert len(name["BJBR.JK"].split()) > 4
    texts = [(1, f"Laba {name['BJBR.JK'].upper()}, naik"), (2, " ".join(name["BJBR.JK"].split()[:4]) + " lain"), (3, name["BJBR.JK"]), (4, f"kata {name['BBCA.JK']} x"), (5, ""), (6, "éBBCA BBCAé"), (7, "(BBCA)"), (8, None)]
    for small in (50_000, 0):
        got = sentiment.match_entities(spark.createDataFrame(texts, "doc_id long, text string"), ents, small=small).collect()
        assert sorted(map(tuple, got)) == [(1, "BJBR.JK"), (3, "BJBR.JK"), (4, "BBCA.JK"), (7, "BBCA.JK")]
    assert sentiment.match_entities(spark.createDataFrame(texts, "doc_id long, text string"), ents.where("false")).count() == 0


def test_pages_with_cut_entities_and_odd_blanks_as_the_sql(spark, tmp_path):
    odd = ["a &amp b", "x &lt y &copy=1", "&am", "&amp;lt;b&amp;#39;", "&hellip; &#8217;", "\u2003a\x0bb\u3000", "\x85a\u2028 ", " &nbsp; ", "<p\n>x</p>&middot;", "", None]
    pages = pd.DataFrame({"page_id": range(len(odd)), "html": odd})
    spark.createDataFrame(list(pages.itertuples(index=False, name=None)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.register("pages", pages)
    want = con.execute(entry.oracle_sql()["text_clean_html"]).fetchall()
    assert {tuple(r) for r in entry.queries()["text_clean_html"](spark, str(tmp_path)).collect()} == set(want)


def test_unescape_as_the_standard_library(spark):
    import html

    texts = [
        "a &amp; b &lt;p&gt; &quot;q&quot; &#39;s&#39; &apos;", "&amp;lt; &amp;amp;", "&eacute;&Eacute &copy 2 &copyright &notit; &notin; &NotEqualTilde;",
        "&#233;&#xe9;&#XE9 &#8217; &#128512; &#0; &#1; &#13; &#11; &#150; &#x80; &#129; &#xD800; &#x110000; &#99999999999999999999; &#xFFFFFFFFFFFF; &#65535; &#64976;",
        "& && &; &#; &#x; &nosuch; &nosuch x", "", "no entity", "&nbsp;x&nbsp", "tail &", "&amp", "AT&T &ampx; &lt", "&#38;lt; &fjlig; &#x1F600;",
    ]
    from pitpanel.functions.text import unescape

    got = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", unescape(F.col("t")).alias("u")).collect()
    assert {r.t: r.u for r in got} == {None: None, **{t: html.unescape(t) for t in texts}}


def test_scan_over_runs_of_blocks(spark):
    import numpy as np

    from pitpanel.operators.scan import scan

    x = np.random.RandomState(0).randn(400)
    df = spark.createDataFrame([(k, i, float(v)) for k in "ab" for i, v in enumerate(x[: 400 if k == "a" else 63])], "k string, i int, c double")
    specs = {"slow": ("c", 0.99), "fast": ("c", 0.5)}
    one = {(r.k, r.i): (r.slow, r.fast) for r in scan(df, "k", "i", specs, block=4).collect()}
    two = {(r.k, r.i): (r.slow, r.fast) for r in scan_pandas(df, "k", "i", specs).collect()}
    assert one.keys() == two.keys() and all(np.allclose(one[k], two[k], rtol=1e-12, atol=1e-12) for k in one)
