"""Decay sums as keyed state with timers: every calendar day of a key comes out once the watermark has passed it, news or none.

State of a key: sums and news counts of the days that are not over yet, by day, and (day of the last row, last scored day, decayed
sum, decayed count). A timer at the end of a day folds it; days without news follow by themselves until `window_days` after the last
scored one. Then the key rests, with three numbers, until news come or what is left of the sums has no weight in a double
(60 half-lives); then it is forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

DAY_MS = 86_400_000
OUT = "key string, date date, sent_decay double"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of the session for keyed state: small changes are kept as logs, and all stores of an executor share one bound on memory.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
}


@contextmanager
def state_store(spark):
    """The settings above, for the queries started within."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Decay(StatefulProcessor):
    def __init__(self, half_life: float, window_days: int):
        self.factor, self.window, self.rest = 0.5 ** (1.0 / half_life), window_days, int(60 * half_life) + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day int", "score_sum double, n double")
        self.sums = handle.getValueState("sums", "last int, scored int, s double, w double")

    def wake(self, day: int) -> None:
        """Come back when a day is over."""
        self.handle.registerTimer((day + 1) * DAY_MS)

    def handleInputRows(self, key, rows: Iterator, timerValues: TimerValues) -> Iterator:
        import pandas as pd

        last = self.sums.get()[0] if self.sums.exists() else None
        for pdf in rows:
            stamps = pd.to_datetime(pdf["ts"])
            days = (stamps - pd.Timestamp(0)).dt.days
            for day, part in pdf.groupby(days):
                day = int(day)
                if last is not None and day <= last:
                    continue  # its row has come out; the watermark lets no such day through
                a, n = float(part["score_sum"].fillna(0.0).sum()), float(part["n"].fillna(0.0).sum())
                if self.days.containsKey((day,)):
                    b, m = self.days.getValue((day,))
                    a, n = a + b, n + m
                else:
                    self.wake(day)
                self.days.updateValue((day,), (a, n))
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator:
        import pandas as pd

        over = timerValues.getCurrentWatermarkInMs() // DAY_MS - 1  # the last day that the watermark has passed
        last, scored, s, w = self.sums.get() if self.sums.exists() else (None, None, 0.0, 0.0)
        waiting = sorted(k[0] for k in self.days.keys())
        out = []
        while True:
            news = next((d for d in waiting if d > (last if last is not None else d - 1)), None)
            quiet = last + 1 if last is not None and scored is not None and last + 1 - scored <= self.window else None
            day = min(d for d in (news, quiet) if d is not None) if news is not None or quiet is not None else None
            if day is None or day > over:
                break
            a, n = self.days.getValue((day,)) if day == news else (0.0, 0.0)
            gap = self.factor ** (day - last) if last is not None else 0.0
            last, s, w = day, s * gap + a, w * gap + n
            scored = day if n > 0 else scored
            if scored is not None and day - scored <= self.window:
                out.append((key[0], pd.Timestamp(day, unit="D").date(), s / w if w > 1e-9 else None))
            if day == news:
                self.days.removeKey((day,))
        if day is not None:
            self.wake(day)
        if last is not None and news is None and over - last > self.rest:
            self.sums.clear()
        elif last is not None:
            self.sums.update((last, scored, s, w))
            if day is None:
                self.wake(last + self.rest)
        if out:
            yield pd.DataFrame(out, columns=["key", "date", "sent_decay"])

    def close(self) -> None:
        pass


def decay_days(daily: DataFrame, half_life: float = 3.0, window_days: int = 14, delay: str = "1 day") -> DataFrame:
    """Stream of (key, date, score_sum, n), in any order within `delay`, several rows of a day adding up -> key, date, sent_decay
    for every day from a key's first scored one to `window_days` after its last, as the watermark passes it.

    The session's state store must be RocksDB, which keyed state with timers needs: see `state_store`.
    """
    spark = daily.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != PROVIDER:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {PROVIDER}")
    d = daily.select(F.col("key").cast("string").alias("key"), F.col("date").cast("timestamp").alias("ts"), F.col("score_sum").cast("double").alias("score_sum"), F.col("n").cast("double").alias("n"))
    d = d.where("ts is not null").withWatermark("ts", delay)
    return d.groupBy("key").transformWithStateInPandas(Decay(half_life, window_days), OUT, "Append", "EventTime")
