"""A table by key in hash buckets, changed batch by batch.

    PATH/data/v00000007/_bucket=12/...      rows of the buckets that version 7 wrote
    PATH/changes/v00000007/...              keys of the rows that version 7 added or changed
    PATH/manifests/000000000007.json        which folder holds each bucket, and the last batch of each writer

A batch rewrites the buckets that its changed rows touch and no others; its manifest, put in place whole, is what makes it count,
so that readers see all of a batch or nothing, and a batch that failed half-way leaves only files that no manifest names. Batches
are known by writer and number: a batch number that this writer has brought already is skipped, the same number of another
writer (a new query, a new checkpoint) is a batch of its own. One writer at a time may commit; of two that collide, one fails.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.operators.dedupe import keep_last
from pitpanel.sources import folders

BUCKET = "_bucket"


class KeyedTable:
    """Rows by unique `keys`, bucketed by the columns `by` (all keys unless given)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], by: list[str] | None = None, buckets: int = 64):
        self.spark, self.path, self.keys, self.by, self.buckets = spark, path.rstrip("/"), keys, by or keys, buckets

    # manifests ------------------------------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in folders.names(self.spark, f"{self.path}/manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """{version, schema, buckets: {bucket: version of its folder}, count, writers: {writer: last batch}}; empty before the first."""
        at = self.versions()[-1:] if version is None else [version]
        if not at:
            return {"version": 0, "schema": None, "buckets": {}, "count": self.buckets, "writers": {}}
        return json.loads(folders.read_text(self.spark, f"{self.path}/manifests/{at[0]:012d}.json"))

    def _folders(self, m: dict, buckets=None) -> list[str]:
        return [f"{self.path}/data/v{v:08d}/{BUCKET}={b}" for b, v in m["buckets"].items() if buckets is None or int(b) in buckets]

    def _rows(self, m: dict, buckets=None) -> DataFrame:
        schema, paths = T.StructType.fromJson(m["schema"]), self._folders(m, buckets)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of the newest (or a given) version; None before the first."""
        m = self.manifest(version)
        return None if m["schema"] is None else self._rows(m)

    def bucket(self, count: int):
        return F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in self.by)), F.lit(count)).cast("int")

    def of_keys(self, wanted: DataFrame) -> DataFrame | None:
        """The rows whose `by` columns are among those of `wanted`, read from their buckets alone."""
        m = self.manifest()
        if m["schema"] is None:
            return None
        wanted = wanted.select(*self.by).distinct()
        touched = {r[0] for r in wanted.select(self.bucket(m["count"])).distinct().collect()}  # at most the number of buckets
        return self._rows(m, touched).join(wanted, self.by, "left_semi")

    # batches --------------------------------------------------------------------------------------------------------
    def upsert(self, batch: DataFrame, writer: str | None = None, number: int = 0, order: list[str] = ()) -> int:
        """Rows of the batch beat those stored; of a key's rows in the batch the last by `order` counts. -> the version then valid.

        Columns whose names begin with `_` are for ordering only and are not stored. Rows equal to the stored ones change nothing: a
        batch without any change is remembered, but writes no bucket. Null keys are keys like others. Batches without a writer
        are not numbered: each is applied.
        """
        m = self.manifest()
        if writer is not None and number <= m["writers"].get(writer, -1):
            return m["version"]
        columns = [f.name for f in T.StructType.fromJson(m["schema"])] if m["schema"] else [c for c in batch.columns if not c.startswith("_")]
        new = keep_last(batch, self.keys, list(order) or [c for c in columns if c not in self.keys] or self.keys)
        new = new.select(*(F.col(f"`{c}`") for c in columns)).withColumn(BUCKET, self.bucket(m["count"])).persist()
        try:
            touched = {r[0] for r in new.select(BUCKET).distinct().collect()}  # at most the number of buckets
            old = self._rows(m, touched) if m["schema"] else self.spark.createDataFrame([], new.drop(BUCKET).schema)
            changed = self._changed(old, new, columns)
            version = m["version"] + 1
            log = f"{self.path}/changes/v{version:08d}"
            changed.select(*self.keys, BUCKET).write.mode("overwrite").parquet(log)
            dirty = {r[0] for r in self.spark.read.schema(changed.select(*self.keys, BUCKET).schema).parquet(log).select(BUCKET).distinct().collect()}
            if dirty:
                keep, put = (d.where(F.col(BUCKET).isin(*dirty)) for d in (old.withColumn(BUCKET, self.bucket(m["count"])), new))
                both = keep.withColumn("_new", F.lit(0)).unionByName(put.withColumn("_new", F.lit(1)))
                rows = keep_last(both, self.keys, ["_new"]).drop("_new").hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.keys)
                rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/v{version:08d}")
            out = {
                "version": version, "schema": m["schema"] or new.drop(BUCKET).schema.jsonValue(), "count": m["count"],
                "buckets": m["buckets"] | {str(b): version for b in sorted(dirty)}, "writers": m["writers"] | ({} if writer is None else {writer: number}),
            }
            folders.put_new(self.spark, f"{self.path}/manifests/{version:012d}.json", json.dumps(out))
            return version
        finally:
            new.unpersist()

    def _changed(self, old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
        """Rows of `new` that `old` lacks or has otherwise."""
        had = old.select(F.lit(True).alias("_had"), *(F.col(f"`{c}`").alias(f"_old_{c}") for c in columns))
        same_key = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_old_{k}`")) for k in self.keys]
        d = new.join(had, same_key, "left")
        same = F.coalesce(F.col("_had"), F.lit(False))
        for c in columns:
            same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_old_{c}`"))
        return d.where(~same).select(*(F.col(f"`{c}`") for c in columns), BUCKET)

    def changes(self, since: int = 0) -> DataFrame | None:
        """Keys of the rows added or changed after a version, once each; None where nothing was."""
        paths = [f"{self.path}/changes/v{v:08d}" for v in range(since + 1, self.manifest()["version"] + 1)]
        paths = [p for p in paths if folders.exists(self.spark, p)]
        if not paths:
            return None
        schema = T.StructType([f for f in T.StructType.fromJson(self.manifest()["schema"]) if f.name in self.keys])
        return self.spark.read.schema(schema).parquet(*paths).select(*self.keys).distinct()

    def vacuum(self, keep: int = 2) -> None:
        """Folders that none of the last `keep` versions names go, and manifests and changes before those versions."""
        versions = self.versions()
        if not versions:
            return
        last = versions[-keep:]
        named = {p for v in last for p in self._folders(self.manifest(v))}
        newest = versions[-1]
        for folder in folders.names(self.spark, f"{self.path}/data"):
            for part in folders.names(self.spark, f"{self.path}/data/{folder}"):
                at = f"{self.path}/data/{folder}/{part}"
                if part.startswith(BUCKET) and at not in named and int(folder[1:]) <= newest:
                    folders.drop(self.spark, at)
        for v in versions[:-keep]:
            folders.drop(self.spark, f"{self.path}/manifests/{v:012d}.json")
            folders.drop(self.spark, f"{self.path}/changes/v{v:08d}")
