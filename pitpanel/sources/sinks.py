"""Sinks: Parquet first, CSV with six significant digits, SQL tables of text."""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.scalar import significant

log = logging.getLogger(__name__)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, sort: list[str] | None = None) -> None:
    """Range-partitioned and sorted by the given columns, overwriting."""
    if sort:
        df = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def write_csv(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """With header, doubles at six significant digits."""
    out = df.select(*(significant(F.col(n)).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes))
    if sort:
        out = out.repartitionByRange(*sort).sortWithinPartitions(*sort)
    out.write.mode("overwrite").option("header", True).csv(path)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{n}`").cast("string").alias(n) for n in df.columns))


def push_tables(tables: dict[str, DataFrame], url: str | None, properties: dict[str, str] | None = None, batch: int = 2000) -> dict[str, str]:
    """Every table over JDBC, dropped and made anew, all columns text; one failing leaves the others. -> name: outcome."""
    if not url:
        log.warning("no address of the SQL sink is set; nothing is pushed")
        return {}
    out = {}
    for name, df in tables.items():
        try:
            as_text(df).write.jdbc(url, name, mode="overwrite", properties={"batchsize": str(batch), **(properties or {})})
            out[name] = "ok"
        except Exception as e:  # each table stands alone
            log.warning("table %s was not pushed: %s", name, e)
            out[name] = "failed"
    return out


def bucket_table(path: str) -> str:
    """The name under which a bucketed folder is known to the catalog."""
    return "panel_" + hashlib.md5(path.encode()).hexdigest()[:16]


def write_bucketed(df: DataFrame, path: str, by: str, sort: list[str], buckets: int) -> DataFrame:
    """One file a bucket of `by`, sorted: windows, aggregates and joins by that key then read it without an exchange. -> read back.

    Rows of one key lie in one bucket, so this is for keys of which none is large by itself.
    """
    spark, name = df.sparkSession, bucket_table(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.repartition(buckets, by).write.mode("overwrite").option("path", path).bucketBy(buckets, by).sortBy(*sort).saveAsTable(name)
    return spark.table(name)


def read_bucketed(spark, path: str, by: str, sort: list[str], buckets: int) -> DataFrame:
    """A folder that write_bucketed wrote, made known to this session's catalog where it is not."""
    name = bucket_table(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        order = ", ".join(f"`{x}`" for x in sort)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{by}`) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
