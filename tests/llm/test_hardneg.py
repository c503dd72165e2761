"""Operator 13 against plain sorting of all integer products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import hardneg
from pitpanel.llm.queries import ORACLES, QUERIES


def brute(rows, every=50, n_pos=5, n_neg=3):
    seen, fine = set(), []
    for i, v, label in sorted(rows, key=lambda r: (r[0] is None or r[2] is None, r[0] or 0, r[2] or 0)):
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or i in seen:
            continue
        seen.add(i)
        fine.append((i, [math.floor(256 * float(x)) for x in v], label))
    out = set()
    for i, q, label in fine:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, p)), j, other) for j, p, other in fine if j != i and len(p) == len(q))
        for s, j, other in [x for x in scored if x[2] == label][:n_pos]:
            rest = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:n_neg]
            out |= {(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(rest)}
    return out


def made(n=400, dim=12, seed=1):
    r = np.random.RandomState(seed)
    base = r.randn(6, dim)
    rows = []
    for i in range(n):
        v = base[r.randint(6)] + r.randn(dim) * 0.6 if i % 3 else base[0]
        rows.append((int(i * 5), [float(np.float32(x)) for x in v], int(r.randint(4)) if i % 4 else 0))
    rows += [(None, [1.0] * dim, 1), (5000, None, 1), (5050, [], 1), (5100, [None] + [1.0] * (dim - 1), 1), (5150, [float("nan")] * dim, 1),
             (5200, [float("inf")] * dim, 2), (5250, [1.0] * dim, None), (5300, [0.0] * dim, 1), (5301, [1.0, 2.0], 1), (5350, [1.0, 2.0], 1),
             (5351, [1.0, 1.9], 2), (5352, [1.0, 1.0], 2), (5400, [0.5] * dim, 3), (5400, [0.5] * dim, 3), (5400, [0.25] * dim, 4), (-50, [-0.3] * dim, 77)]
    return rows


@pytest.mark.parametrize("run,block", [(100, 40), (1 << 19, 1 << 16)])
def test_hard_negatives(spark, run, block):
    rows = made()
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, label int, run int")
    got = [tuple(r) for r in hardneg.hard_negatives(df, F.col("vec_id") % 50 == 0, run=run, block=block).collect()]
    want = brute(rows)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_wide_components(spark):
    """Components beyond 16 bits: 64-bit floats, then integers; beyond 63 bits an error."""
    for size in (1e3, 3e5):
        rows = [(i, v and [x * size for x in v], label) for i, v, label in made(120, 5, 2) if v and None not in v and i is not None and label is not None and all(map(math.isfinite, v))]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        assert {tuple(r) for r in hardneg.hard_negatives(df, F.col("vec_id") % 50 == 0, run=200).collect()} == brute(rows)
    df = spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1e30, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="beyond 62 bits"):
        hardneg.hard_negatives(df, F.col("vec_id") == 0)


def test_empty_and_lone(spark):
    df = spark.createDataFrame([(50, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert hardneg.hard_negatives(df, F.col("vec_id") % 50 == 0).count() == 0
    assert hardneg.hard_negatives(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_planes_drop_pairs_and_lose_none():
    """No qualifying pair is lost, and exact scores are worked out for few."""
    r = np.random.RandomState(5)
    q = np.floor(r.randn(3000, 64) * 32).astype(np.int64)
    run = hardneg.Run(np.arange(3000), np.zeros(3000, np.int64), q)
    a, all_ = q[:20], q[:20] @ q.T
    floor = np.sort(all_, axis=1)[:, -30]
    rows, at, score = hardneg.survivors(run, a, slice(0, 3000), floor, np.full(20, 1 << 40))
    assert len(rows) == 600 and (all_[rows, at] == score).all() and (score >= floor[rows]).all()
    assert 0 < run.first_cut(a) < run.bits


def test_registered_query(spark, sf):
    import duckdb

    rows = [(i, list(v), (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {tuple(r) for r in QUERIES["op13_hard_negatives"](spark, sf).collect()}
    assert got == brute(rows) and got
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    assert set(con.sql(ORACLES["op13_hard_negatives"]).fetchall()) == got
