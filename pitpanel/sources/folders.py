"""Small files and folders in any store that Spark reaches, by Hadoop paths."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Folder of each local session that names none.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that driver and executors share; only a local session may name none."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        there = _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="panel-"))
    return f"{there.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    p, fs = _at(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def drop(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """A whole small file or none: written beside, then renamed. A file that is there already is an error, never overwritten."""
    p, fs = _at(spark, path)
    aside, _ = _at(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(p) or not fs.rename(aside, p):
        fs.delete(aside, False)
        raise FileExistsError(path)
