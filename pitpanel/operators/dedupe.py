"""Keep-first, keep-last, upserts and set difference by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key by the given sort columns, which should order rows fully."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    return keep_first(df, keys, [F.desc_nulls_last(c) if isinstance(c, str) else c for c in order])


def upsert(old: DataFrame, new: DataFrame, keys, order=()) -> DataFrame:
    """Rows of both; where keys meet, new beats old, and later (by `order`) beats earlier among new ones."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return keep_last(both, keys, ["_batch", *order]).drop("_batch")


def todo(wanted: DataFrame, done: DataFrame, empty: DataFrame, key: str) -> DataFrame:
    """Keys wanted that are neither done nor known to be empty."""
    seen = done.select(key).unionByName(empty.select(key)).distinct()
    return wanted.select(key).distinct().join(seen, key, "left_anti")


def article_key(link, source, title):
    """The link if there is one, else source|title."""
    return F.when(F.length(F.trim(link)) > 0, F.trim(link)).otherwise(F.concat_ws("|", source, title))


def has_history(df: DataFrame, by: str, least: int) -> DataFrame:
    """Rows of keys with at least so many rows."""
    enough = df.groupBy(by).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(by)
    return df.join(enough, by, "left_semi")
