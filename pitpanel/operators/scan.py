"""Affine scans y_t = b y_(t-1) + c_t per key (exponential means, decay sums), several at once.

Rows are numbered per key and cut into blocks of 128, blocks into runs of 128 blocks. Within a block, y is b^k times a running
sum of c_j b^-j; the ends of earlier blocks of the run come in through a window that gathers one value per block, the ends of
earlier runs through one that gathers a value per run, so that a row folds 128 values and one for each 16384 rows before it.
Only windows over one partitioning are used, no join and no Python. Factors
below block^-th root of the least double (half-lives under an eighth of a row) are outside its range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 128


def scan(df: DataFrame, by, order, specs: dict[str, tuple[str, float]], block: int = BLOCK, skip: str | None = None) -> DataFrame:
    """specs: new column -> (column of c, factor b). A missing c counts as 0. Adds the columns to df.

    Rows for which the column `skip` holds must come first or last within a key; they take no step.
    """
    by = [by] if isinstance(by, str) else list(by)
    whole = Window.partitionBy(*by).orderBy(order)
    steps = F.row_number().over(whole) if skip is None else F.sum(F.when(F.col(skip), 0).otherwise(1)).over(whole)
    d = df.withColumn("_scan_n", steps - 1)
    d = d.withColumn("_scan_b", F.floor(F.col("_scan_n") / block).cast("int")).withColumn("_scan_k", (F.col("_scan_n") % block + 1).cast("double"))
    inside = Window.partitionBy(*by, "_scan_b").orderBy("_scan_n").rowsBetween(Window.unboundedPreceding, 0)
    for name, (c, b) in specs.items():
        own = F.sum(F.coalesce(F.col(c), F.lit(0.0)) * F.pow(F.lit(b), -F.col("_scan_k"))).over(inside) * F.pow(F.lit(b), F.col("_scan_k"))
        d = d.withColumn(f"_s_{name}", own)
    run = block * block
    d = d.withColumn("_scan_r", F.floor(F.col("_scan_n") / run).cast("int"))

    def gathered(at, window):
        """The values of the rows marked by `at` before this one."""
        ends = F.when(at, F.struct(*(F.col(f"_s_{name}").alias(name) for name in specs)))
        return F.collect_list(ends).over(window.orderBy("_scan_n").rowsBetween(Window.unboundedPreceding, -1))

    def carried(name: str, b: float, length: int, k):
        """The rows' own value and what the gathered ends, each `length` rows behind the last, leave of themselves k rows on."""
        before = F.aggregate("_scan_ends", F.lit(0.0), lambda a, e: a * F.lit(b**length) + e[name])
        return F.col(f"_s_{name}") + before * F.pow(F.lit(b), k)

    d = d.withColumn("_scan_ends", gathered(F.col("_scan_k") == block, Window.partitionBy(*by, "_scan_r")))
    d = d.withColumns({f"_s_{name}": carried(name, b, block, F.col("_scan_k")) for name, (_, b) in specs.items()})
    d = d.withColumn("_scan_ends", gathered(F.col("_scan_n") % run == run - 1, Window.partitionBy(*by)))
    d = d.withColumns({name: carried(name, b, run, (F.col("_scan_n") % run + 1).cast("double")) for name, (_, b) in specs.items()})
    return d.drop("_scan_n", "_scan_b", "_scan_r", "_scan_k", "_scan_ends", *(f"_s_{name}" for name in specs))


def ewm(df: DataFrame, by, order, specs: dict[str, tuple[str, float]], scan_=scan, known: tuple[str, str] | None = None) -> DataFrame:
    """specs: new column -> (value column, alpha): y_0 = x_0, y_t = (1 - a) y_(t-1) + a x_t, from the first value on.

    Values may be missing at the start of a key only; there the result is NULL. `known` names two columns: where the first, an
    `order` value, is set, the means at that place are the fields of the second (a struct by new column), and rows before it
    leave no trace; so a series can be taken up in its middle.
    """
    by = [by] if isinstance(by, str) else list(by)
    past = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = df
    for name, (x, a) in specs.items():
        seed = F.count(F.col(x)).over(past) == 1
        own = F.when(seed, F.col(x)).otherwise(F.col(x) * a)
        if known:
            at, place = F.col(known[0]), F.col(order)
            own = F.when(place < at, F.lit(0.0)).when((place == at) & F.col(known[1])[name].isNotNull(), F.col(known[1])[name]).otherwise(own)
        d = d.withColumn(f"_c_{name}", own)
    d = scan_(d, by, order, {name: (f"_c_{name}", 1 - a) for name, (_, a) in specs.items()})
    for name, (x, _) in specs.items():
        d = d.withColumn(name, F.when(F.col(x).isNotNull(), F.col(name)))
    return d.drop(*(f"_c_{name}" for name in specs))
