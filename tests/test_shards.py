"""One long series in many tasks against the same windows in one."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.config import Technical, Universe
from pitpanel.operators import scan, shards
from pitpanel.operators.windows import Series
from pitpanel.plans import technical


def table(df, key="k", order="i"):
    return {(r[key], r[order]): r for r in df.collect()}


@pytest.mark.parametrize("rows", [7, 400])
def test_hot_key(spark, rows):
    """Frames, fills and scans; also with shards shorter than the frames, whose halos come from many neighbours."""
    r = np.random.RandomState(2)
    n = 3000 if rows > 100 else 120
    data = [("hot", i * 3, float(r.randn()), None if i < 40 or r.rand() < 0.3 else float(i)) for i in range(n)]
    data += [("a", i, float(r.randn()), None) for i in range(5)] + [("z", 1, 1.0, None), (None, 4, 2.0, 1.0), (None, 5, 3.0, None)]
    df = spark.createDataFrame(data, "k string, i long, x double, f double")
    s, specs = Series("k", "i"), {"slow": ("x", 0.99), "fast": ("x", 0.5)}
    frames = lambda d: d.withColumn("m", s.mean(F.col("x"), 25)).withColumn("c", s.change(F.col("x"), 30)).withColumn("ahead", F.lead("x", 3).over(s.w))
    want = table(scan.scan(frames(df).withColumn("g", F.coalesce(s.ffill(F.col("f")), s.bfill(F.col("f")))), "k", "i", specs))
    d = shards.split(df, "k", "i", 30, 3, rows)
    assert d.where("not _halo").select("k.shard").where("k.key = 'hot'").distinct().count() >= 8
    d = shards.filled(d, "k", "i", "f", "_b", "_a")
    d = d.withColumn("g", F.coalesce(s.ffill(F.col("f")), "_b", s.bfill(F.col("f")), "_a"))
    got = table(shards.whole(shards.scan(frames(d), "k", "i", specs), "k"))
    assert got.keys() == want.keys() and len(got) == len(data)
    for at in want:
        for name in ("x", "f", "m", "c", "ahead", "g", "slow", "fast"):
            a, b = got[at][name], want[at][name]
            assert (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-9 * max(1, abs(b))), (at, name, a, b)


def test_panel_of_a_hot_ticker(spark):
    r = np.random.RandomState(5)
    rows, day, close = [], dt.date(2015, 1, 1), 100.0
    for i in range(1500):
        day += dt.timedelta(days=int(r.choice([1, 1, 3])))
        close *= float(np.exp(r.randn() * 0.02))
        rows.append(("HOT", day, close * 1.01, close * 1.02, close * 0.98, close, None if i < 600 or r.rand() < 0.5 else close * 0.8, float(r.randint(0, 500))))
    rows += [("B", dt.date(2015, 1, 1) + dt.timedelta(days=i), 1.0, 1.0, 1.0, 1.0 + i % 3, None, 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, adj_close double, volume double")
    u, t = Universe(), Technical(return_windows=(5, 60), high=80)
    clean = technical.clean(df)
    want, got = table(technical.series_features(clean, u, t), "ticker", "date"), technical.sharded_features(clean, u, t, rows=150)
    names = [x for x in technical.series_features(clean, u, t).columns]
    got = table(got, "ticker", "date")
    assert got.keys() == want.keys()
    for at in want:
        for name in names:
            a, b = got[at][name], want[at][name]
            assert (a is None) == (b is None) and (a == b or abs(a - b) <= 1e-7 * max(1, abs(b))), (at, name, a, b)
