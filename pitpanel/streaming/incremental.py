"""Incremental forms: cumulative articles, flow upserts, hourly windows, decay kept as state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.dedupe import article_key
from pitpanel.sources.keyed import KeyedTable


def new_articles(stream: DataFrame, delay: str = "30 days") -> DataFrame:
    """The first arrival of each article within the watermark."""
    d = stream.where(F.length(F.trim("title")) > 0).withColumn("key", article_key(F.col("link"), F.col("source"), F.col("title")))
    return d.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["key"])


def upsert_sink(table: KeyedTable, writer: str | None = None, order: list[str] = ()):
    """foreachBatch function: rows of the batch beat those of the keyed table; a batch that is repeated changes nothing.

    Batches are known by the query's id, which stays with its checkpoint, and their number; so a new query, whose numbers begin
    at 0 again, loses nothing. `writer` takes the id's place where given.
    """
    def run(batch: DataFrame, number: int) -> None:
        who = writer or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if who is None:
            raise ValueError("outside a streaming query the writer must be named")
        KeyedTable(batch.sparkSession, table.path, table.keys, table.by, table.buckets).upsert(batch, who, number, order)

    return run


def hourly(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Tumbling hours by event type, late events dropped after `delay`."""
    w = F.window("ts", "1 hour")
    return events.withWatermark("ts", delay).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("hour"), "event_type", "n", "value")


def decay_state(daily: DataFrame, half_life: float = 3.0) -> DataFrame:
    """Stream of (key, date, score_sum, n), dates ascending per key -> key, date, sent_decay; two numbers of state a key."""
    import pandas as pd

    f = 0.5 ** (1.0 / half_life)

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, s, w = state.get if state.exists else (None, 0.0, 0.0)
        rows = []
        for pdf in batches:
            for day, a, n in pdf.sort_values("date")[["date", "score_sum", "n"]].itertuples(index=False):
                at = pd.Timestamp(day).toordinal()
                gap = f ** (at - last) if last is not None else 0.0
                last, s, w = at, s * gap + a, w * gap + n
                rows.append((key[0], day, s / w if w > 1e-9 else None))
        state.update((last, s, w))
        yield pd.DataFrame(rows, columns=["key", "date", "sent_decay"])

    return daily.groupBy("key").applyInPandasWithState(run, "key string, date date, sent_decay double", "last long, s double, w double", "append", "NoTimeout")
