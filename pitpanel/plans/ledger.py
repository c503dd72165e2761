"""What every run did: a row per stage, with the metrics of the tables it wrote, gathered while they were written."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "run string, at timestamp, stage string, outcome string, reason string, seconds double, "
    "tables array<struct<name:string,rows:bigint,first:string,last:string,nulls:map<string,bigint>>>"
)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and what its next write tells of it: rows, first and last date, missing values by column. No second pass is made."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    dates = [F.min(F.col("date").cast("string")).alias("first"), F.max(F.col("date").cast("string")).alias("last")] if "date" in df.columns else []
    nulls = [F.sum(F.col(f"`{x}`").isNull().cast("long")).alias(f"null:{x}") for x in df.columns]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *dates, *nulls), seen


def told(name: str, seen: Observation) -> tuple:
    """A `tables` entry of a written table."""
    try:
        m = seen.get
    except Py4JJavaError:  # a table that is known to be empty is written without its plan, and so without metrics
        m = {}
    return name, m.get("rows", 0), m.get("first"), m.get("last"), {k.removeprefix("null:"): v or 0 for k, v in m.items() if k.startswith("null:")}


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.run = spark, path, uuid.uuid4().hex

    def add(self, at, stage: str, outcome: str, reason: str | None, seconds: float, tables: list[tuple]) -> None:
        """A row of outcome ok, failed or skipped; `at` is given, as no plan asks the clock."""
        row = [(self.run, at, stage, outcome, reason, seconds, tables)]
        self.spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)
