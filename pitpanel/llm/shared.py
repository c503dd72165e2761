"""What several corpus operators use: tables in the shared folder, checks on sizes."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Regular expression (Java and RE2) of a word and of the white space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: Folder of each local session that names none.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local session (tests) that names none gets one; a cluster must name it."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        there = _LOCAL.get(spark.sparkContext.applicationId) or "file://" + tempfile.mkdtemp(prefix="shared-")
        _LOCAL[spark.sparkContext.applicationId] = there
    return there.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: While a table of an intermediate step is written: the shuffle files of each query go when it ends, not when the driver
#: happens to collect garbage; and the driver, which keeps the plans of its last thousand queries as texts, keeps short ones.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxPlanStringLength": "8192"}


@contextmanager
def writing(spark: SparkSession, more: dict[str, str] | None = None):
    settings = {**WRITING, **(more or {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write(df: DataFrame, path: str, settings: dict[str, str] | None = None, **options) -> DataFrame:
    with writing(df.sparkSession, settings):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, name: str, settings: dict[str, str] | None = None, **options) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends there, and a lost executor loses nothing."""
    return write(df, new_path(df.sparkSession, name), settings, **options)


class Scratch:
    """Tables of one run, dropped by name as soon as the run is through with them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.setdefault(name, []).append(new_path(self.spark, name))
        return write(df, self.paths[name][-1])

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.paths.pop(name, []):
                drop_path(self.spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def let(value, body):
    """body(value) with value evaluated once per row, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def small(df: DataFrame, rows: int) -> bool:
    """Whether a (written) table has at most so many rows; stops counting beyond."""
    return df.limit(rows + 1).count() <= rows


def join_small(left: DataFrame, right: DataFrame, on, how: str, rows: int = 20_000) -> DataFrame:
    """Join with a table that is usually tiny: broadcast while its counted rows stay within the bound, else shuffle."""
    return left.join(F.broadcast(right) if small(right, rows) else right, on, how)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
