"""Decay as state with timers against the batch form, gaps included."""

import datetime as dt

import numpy as np
import pytest

from pitpanel.config import Sentiment
from pitpanel.plans import sentiment
from pitpanel.streaming import decay

D = dt.date(2024, 1, 1)
SCHEMA = "key string, date date, score_sum double, n long"


def run(spark, folder, checkpoint, out):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    q = decay.decay_days(stream, 3.0, 14).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    q.awaitTermination()


@pytest.fixture
def rocks(spark):
    with decay.state_store(spark):
        yield


def test_stream_equals_batch(spark, rocks, tmp_path):
    r = np.random.RandomState(4)
    rows = []
    for k in ("a", "b", "c"):
        day = 0
        while day < 150:
            rows.append((k, D + dt.timedelta(days=day), float(r.randint(-3, 4)), int(r.randint(0, 3))))
            day += int(r.choice([1, 1, 2, 5, 20 if k != "c" else 3, 40 if k == "b" else 1]))
    rows = [(k, d, s if n else 0.0, n) for k, d, s, n in rows]
    rows += [("d", D + dt.timedelta(days=3), 0.0, 0), ("d", D + dt.timedelta(days=5), 2.0, 1), ("e", D, 1.0, 1), ("e", D + dt.timedelta(days=149), -1.0, 1)]
    end = D + dt.timedelta(days=200)
    rows.sort(key=lambda x: x[1])
    # one run brings some days, a second the rest, rows of one day in two parts and out of order within the delay
    folder = tmp_path / "in"
    cut = [x for x in rows if (x[1] - D).days < 60]
    put = lambda part: spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    put(cut[::-1])
    run(spark, folder, tmp_path / "c", tmp_path / "out")
    first = spark.read.schema(decay.OUT).parquet(str(tmp_path / "out")).count()
    assert first > 50
    later = [x for x in rows if (x[1] - D).days >= 60]
    put([(k, d, s / 2, n) for k, d, s, n in later] + [(k, d, s / 2, 0) for k, d, s, n in later])
    put([("end", end + dt.timedelta(days=2), 0.0, 0)])
    run(spark, folder, tmp_path / "c", tmp_path / "out")
    # the batch form ends with a key's last row: one without news on the day that the watermark has reached
    whole = spark.createDataFrame([*rows, *((k, end, 0.0, 0) for k in "abcde")], SCHEMA)
    want = {(r.key, r.date): r.sent_decay for r in sentiment.decay(whole, ["key"], Sentiment()).collect()}
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len({x[:2] for x in got}) and {x[:2] for x in got} == set(want) and len(got) > 200
    for k, d, v in got:
        assert v == pytest.approx(want[k, d], rel=1e-9, abs=1e-12), (k, d)
    gaps = {(k, d) for k, d, v in got} - {x[:2] for x in rows}
    assert len(gaps) > 50


def test_the_state_store_is_asked_for(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        decay.decay_days(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
