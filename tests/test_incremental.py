"""Keyed tables and features brought up to date from changed rows, against plain recomputation."""

import datetime as dt
import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.config import Technical, Universe
from pitpanel.operators.dedupe import has_history
from pitpanel.plans import incremental, technical
from pitpanel.sources import folders
from pitpanel.sources.keyed import BUCKET, KeyedTable
from pitpanel.sources.readers import SCHEMAS


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_touches_its_buckets_only(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    base = spark.createDataFrame([(i, f"a{i}") for i in range(400)], "k long, v string")
    assert t.read() is None and t.upsert(base, "q1", 0) == 1
    whole = folders.size(spark, str(tmp_path / "t/data"))
    batch = spark.createDataFrame([(3, "b3"), (1000, "new")], "k long, v string")
    buckets = {r[0] for r in batch.select(t.bucket(8)).collect()}
    assert t.upsert(batch, "q1", 1) == 2
    written = glob.glob(str(tmp_path / "t/data/v00000002/*"))
    assert {int(os.path.basename(p).split("=")[1]) for p in written if os.path.basename(p).startswith(BUCKET)} == buckets
    assert folders.size(spark, str(tmp_path / "t/data/v00000002")) < whole * (len(buckets) + 0.5) / 8
    assert rows_of(t.read()) == sorted([(i, f"a{i}") for i in range(400) if i != 3] + [(3, "b3"), (1000, "new")], key=str)
    assert rows_of(t.read(1)) == rows_of(base)
    assert rows_of(t.changes(1)) == [(1000,), (3,)] and t.changes(2) is None


def test_batches_are_known_by_writer_and_number(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    one = lambda k, v: spark.createDataFrame([(k, v)], "k long, v string")
    t.upsert(one(1, "a"), "first query", 0)
    assert t.upsert(one(9, "again"), "first query", 0) == 1  # the same batch again changes nothing
    t.upsert(one(2, "b"), "second query", 0)  # a new query starts at 0 again
    assert rows_of(t.read()) == [(1, "a"), (2, "b")]
    assert t.upsert(one(2, "b"), "second query", 1) == 3 and not os.path.exists(tmp_path / "t/data/v00000003")  # no change, no bucket


def test_last_of_a_key_and_null_keys(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k", "d"], by=["k"], buckets=4)
    batch = spark.createDataFrame([(1, "x", 10.0, 1), (1, "x", 9.0, 2), (None, None, 1.0, 1), (None, None, 2.0, 0)], "k long, d string, v double, _seq int")
    t.upsert(batch, "w", 0, order=["_seq"])
    assert rows_of(t.read()) == [(1, "x", 9.0), (None, None, 1.0)]
    t.upsert(spark.createDataFrame([(None, None, None, 1)], "k long, d string, v double, _seq int"), "w", 1, order=["_seq"])
    assert rows_of(t.read()) == [(1, "x", 9.0), (None, None, None)]
    assert rows_of(t.of_keys(spark.createDataFrame([(1,)], "k long"))) == [(1, "x", 9.0)]


def test_half_a_batch_is_never_seen(spark, tmp_path, monkeypatch):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    one = lambda k, v: spark.createDataFrame([(k, v)], "k long, v string")
    t.upsert(one(1, "a"), "w", 0)
    put = folders.put_new

    def broken(*a):
        raise OSError("lost")

    monkeypatch.setattr(folders, "put_new", broken)
    with pytest.raises(OSError):
        t.upsert(one(1, "b"), "w", 1)  # its data is written, its manifest is not
    assert rows_of(t.read()) == [(1, "a")]
    monkeypatch.setattr(folders, "put_new", put)
    assert t.upsert(one(1, "b"), "w", 1) == 2 and rows_of(t.read()) == [(1, "b")]
    with pytest.raises(FileExistsError):  # a second writer with the same version fails, it does not overwrite
        folders.put_new(spark, f"{t.path}/manifests/{2:012d}.json", "{}")
    t.upsert(one(5, "c"), "w", 2)
    t.vacuum(keep=1)
    assert rows_of(t.read()) == [(1, "b"), (5, "c")] and t.versions() == [3]


UNIVERSE, TECH = Universe(min_rows=30), Technical(return_windows=(5, 20, 60), high=80)


def bars(seed=7, names=12, days=260):
    r, out = np.random.RandomState(seed), []
    for k in range(names):
        close, day = 100.0 + 10 * k, dt.date(2022, 11, 1)
        for i in range(days if k < names - 1 else 29):
            day += dt.timedelta(days=int(r.choice([1, 1, 1, 3])))
            close = max(1.0, close * (1 + r.randn() * 0.02))
            adj = None if (k == 1 and i < 100) or r.rand() < 0.1 else close * (0.9 if i < 50 else 1.0)
            o = close * (1 + r.randn() * 0.01)
            out.append([day, f"T{k:02d}", o, max(o, close) * 1.01, min(o, close) * 0.99, close, adj, float(r.randint(0, 1000)), 0.0, 0.0])
    return out


def close_to(got, want):
    """Equal rows, doubles up to rounding."""
    assert got.columns == want.columns
    a, b = ({(r.ticker, r.date): r for r in d.collect()} for d in (got, want))
    assert a.keys() == b.keys() and a
    for k in a:
        for n in got.columns:
            x, y = a[k][n], b[k][n]
            assert (x is None) == (y is None) and (x == y or isinstance(x, float) and abs(x - y) <= 1e-7 * max(1.0, abs(x), abs(y))), (k, n, x, y)


def test_technical_recompute(spark, tmp_path):
    everything = bars()
    late = [r for r in everything if r[1] in ("T03", "T04") and r[0] >= max(x[0] for x in everything if x[1] == r[1]) - dt.timedelta(days=3)]
    base = [r for r in everything if r not in late]
    raw = KeyedTable(spark, str(tmp_path / "raw"), ["ticker", "date"], by=["ticker"], buckets=4)
    store, plan = incremental.MonthlyFeatures(spark, str(tmp_path / "f")), incremental.technical_plan(UNIVERSE, TECH)
    current = {(r[1], r[0]): r for r in base}

    def step(rows, number):
        df = spark.createDataFrame([tuple(r) for r in rows], SCHEMAS["raw_prices"])
        raw.upsert(df, "test", number)
        done = store.refresh(raw, plan)
        current.update({(r[1], r[0]): r for r in rows})
        full = spark.createDataFrame([tuple(r) for r in current.values()], SCHEMAS["raw_prices"])
        want = technical.technical_panel(has_history(full, "ticker", UNIVERSE.min_rows), UNIVERSE, TECH)
        got = store.read()
        close_to(got.select(*sorted(got.columns)), want.select(*sorted(want.columns)))
        return done

    def written():
        return {os.path.basename(p): max(os.path.getmtime(f) for f in glob.glob(f"{p}/*")) for p in glob.glob(str(tmp_path / "f/rows/month=*"))}

    assert step(base, 0)["tickers"] == 12
    before = written()
    done = step(late, 1)  # late bars rewrite their months and later ones only
    assert done["tickers"] == 2 and done["since"] == min(r[0] for r in late).strftime("%Y-%m")
    after = written()
    assert {m for m in after if after[m] != before.get(m)} == {m for m in after if m >= f"month={done['since']}"}
    assert len([m for m in after if after[m] == before.get(m)]) > 5
    # a corrected bar in the middle, a first factor where there was none, and a ticker that gets enough rows
    middle = list(next(r for r in everything if r[1] == "T05" and r[0].year == 2023))
    middle[5], middle[6] = middle[5] * 1.03, None
    first_factor = list(next(r for r in everything if r[1] == "T01"))
    first_factor[6] = first_factor[5] * 0.5
    short = list(next(r for r in everything if r[1] == "T11"))
    short[0] -= dt.timedelta(days=2)
    assert step([middle, first_factor, short], 2)["tickers"] == 3
    gone = list(middle)
    gone[5] = -1.0  # the bar goes
    step([gone], 3)
    assert store.refresh(raw, plan) == {"version": 4, "since": None, "tickers": 0}


def test_failed_refresh_is_done_again(spark, tmp_path, monkeypatch):
    raw = KeyedTable(spark, str(tmp_path / "raw"), ["ticker", "date"], by=["ticker"], buckets=2)
    store, plan = incremental.MonthlyFeatures(spark, str(tmp_path / "f")), incremental.flow_plan()
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(150)]
    flows = [(d, t, float(i * 7 % 13), float(i % 5)) for t in ("A", "B") for i, d in enumerate(days)]
    schema = "date date, ticker string, foreign_buy double, foreign_sell double"
    raw.upsert(spark.createDataFrame(flows[:-20], schema), "w", 0)
    store.refresh(raw, plan)
    raw.upsert(spark.createDataFrame(flows[-30:], schema), "w", 1)

    def broken(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(folders, "put_new", broken)
        with pytest.raises(OSError):
            store.refresh(raw, plan)
    assert store.processed() == 1
    assert store.refresh(raw, plan)["since"] == "2024-05"
    from pitpanel.plans.flow import flow_features

    got = store.read()
    close_to(got.select(*sorted(got.columns)), (w := flow_features(spark.createDataFrame(flows, schema))).select(*sorted(w.columns)))
    assert store.read().where(F.col("foreign_net_zscore").isNotNull()).count() > 100
