"""One long series in many tasks: shards of consecutive rows, each with the rows its frames reach.

Rows are range-partitioned by key and order; the rows of a key in one partition are a shard. A shard gets copies of up to `back` rows
before it and `ahead` rows after it, from as many neighbours as it takes (`_halo` marks them). The key column becomes (key, shard), so
that windows by key run shard by shard, unchanged, and are right on the shard's own rows for all frames within the halo. What has
an endless memory is carried by one row per shard: `scan` runs a scan within each shard and adds what earlier shards leave
behind, by their lengths and last values; `filled` gives each shard the last value before it and the first after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.operators import scan as plain
from pitpanel.sources import folders

c = F.col


def split(df: DataFrame, by: str, order: str, back: int, ahead: int = 0, rows: int = 1_000_000) -> DataFrame:
    """df with `by` as a struct (key, shard) and `_halo`; `order` is unique within a key and not NULL. About `rows` rows a shard."""
    spark = df.sparkSession
    path = folders.shared_folder(spark, "shards")
    n = max(1, -(-df.count() // rows))
    dealt = df.repartitionByRange(n, by, order).withColumn("_shard", F.spark_partition_id().cast("long"))
    dealt.write.parquet(path)
    d = spark.read.schema(dealt.schema).parquet(path)
    sizes = d.groupBy(c(by).alias("_k"), "_shard").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("_k").orderBy("_shard")
    sizes = sizes.withColumn("_end", F.sum("_n").over(w)).withColumn("_start", c("_end") - c("_n")).withColumn("_last", F.max("_shard").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    many = sizes.where("_last <> _shard or _start > 0")  # only keys in several shards have neighbours
    a, b = many.select("_k", "_shard", "_start", "_end"), many.select(c("_k").alias("_to_key"), c("_shard").alias("_to"), c("_start").alias("_to_start"), c("_end").alias("_to_end"))
    # shards whose rows another one's frames reach: how many of the last rows, or of the first
    gaps = a.join(b, c("_k").eqNullSafe(c("_to_key"))).where("_shard <> _to")
    before = F.when(c("_shard") < c("_to"), F.lit(back) - (c("_to_start") - c("_end")))
    after = F.when(c("_shard") > c("_to"), F.lit(ahead) - (c("_start") - c("_to_end")))
    gaps = gaps.select("_k", "_shard", "_to", F.coalesce(before, F.lit(0)).alias("_tail"), F.coalesce(after, F.lit(0)).alias("_head")).where("_tail > 0 or _head > 0")
    mine = Window.partitionBy(by, "_shard")
    near = d.withColumn("_f", F.row_number().over(mine.orderBy(order))).withColumn("_r", F.count("*").over(mine) - c("_f") + 1)
    near = near.where((c("_r") <= back) | (c("_f") <= ahead)).withColumnRenamed("_shard", "_from")
    gaps = gaps.select(c("_k").alias("_gap_key"), c("_shard").alias("_gap_from"), "_to", "_tail", "_head")
    halo = near.join(gaps, c(by).eqNullSafe(c("_gap_key")) & (c("_from") == c("_gap_from"))).where("_r <= _tail or _f <= _head")
    halo = halo.select(*(c(f"`{x}`") for x in df.columns), c("_to").alias("_shard"), F.lit(True).alias("_halo"))
    both = d.withColumn("_halo", F.lit(False)).unionByName(halo)
    return both.withColumn(by, F.struct(c(by).alias("key"), c("_shard").alias("shard"))).drop("_shard")


def whole(d: DataFrame, by: str) -> DataFrame:
    """The shards' own rows under their own key."""
    return d.where("not _halo").withColumn(by, c(f"{by}.key")).drop("_halo")


def _ends(d: DataFrame, by: str, order: str, values: dict) -> DataFrame:
    """Per shard its number of own rows and aggregates of them."""
    own = d.where("not _halo")
    return own.groupBy(c(f"{by}.key").alias("_k"), c(f"{by}.shard").alias("_shard")).agg(F.count("*").alias("_n"), *(v.alias(n) for n, v in values.items()))


def scan(df: DataFrame, by, order: str, specs: dict[str, tuple[str, float]]) -> DataFrame:
    """scan.scan over shards: the same columns on the shards' own rows, NULL on halo rows."""
    by = by if isinstance(by, str) else by[0]
    zero = {f"_z_{x}": F.when(c("_halo"), F.lit(0.0)).otherwise(c(x)) for x, _ in specs.values()}
    d = df.withColumns(zero)
    d = plain.scan(d, by, order, {n: (f"_z_{x}", b) for n, (x, b) in specs.items()}, skip="_halo").drop(*zero)
    ends = _ends(d, by, order, {f"_e_{n}": F.max_by(n, order) for n in specs})
    earlier = Window.partitionBy("_k").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    fields = F.struct("_n", *(f"_e_{n}" for n in specs))
    ends = ends.withColumn("_before", F.collect_list(fields).over(earlier))  # a few numbers for each earlier shard of the key

    def start(n: str, b: float):
        return F.aggregate("_before", F.lit(0.0), lambda a, e: a * F.pow(F.lit(b), e["_n"]) + e[f"_e_{n}"]).alias(f"_y_{n}")

    starts = ends.select(F.struct(c("_k").alias("key"), c("_shard").alias("shard")).alias(by), *(start(n, b) for n, (_, b) in specs.items()))
    at = F.sum(F.when(c("_halo"), 0).otherwise(1)).over(Window.partitionBy(by).orderBy(order))
    d = d.withColumn("_at", at).join(starts, by, "left")
    return d.withColumns({n: F.when(~c("_halo"), c(n) + F.pow(F.lit(b), c("_at")) * c(f"_y_{n}")) for n, (_, b) in specs.items()}).drop("_at", *(f"_y_{n}" for n in specs))


def filled(d: DataFrame, by: str, order: str, value: str, before: str, after: str) -> DataFrame:
    """d with the last value that is set before each shard, and the first after it."""
    usable = F.when(c(value).isNotNull(), c(order))
    ends = _ends(d, by, order, {"_a": F.min_by(value, usable), "_z": F.max_by(value, usable)})
    w = Window.partitionBy("_k").orderBy("_shard")
    ends = ends.withColumn(before, F.last("_z", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    ends = ends.withColumn(after, F.first("_a", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    return d.join(ends.select(F.struct(c("_k").alias("key"), c("_shard").alias("shard")).alias(by), before, after), by, "left")
