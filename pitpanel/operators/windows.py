"""Window operators over one ordered series per key. All share one partitioning, so Catalyst sorts once."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from pitpanel.functions.scalar import div


class Series:
    """Windows over `by`, ordered by `order`; `at` is the order column of range conditions."""

    def __init__(self, by, order):
        self.by, self.order = [by] if isinstance(by, str) else list(by), [order] if isinstance(order, str) else list(order)

    @property
    def w(self):
        return Window.partitionBy(*self.by).orderBy(*self.order)

    def rows(self, n: int):
        return self.w.rowsBetween(-(n - 1), 0)

    @property
    def past(self):
        return self.w.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def future(self):
        return self.w.rowsBetween(0, Window.unboundedFollowing)

    def number(self) -> Column:
        return F.row_number().over(self.w)

    def lag(self, x: Column, n: int = 1) -> Column:
        return F.lag(x, n).over(self.w)

    def change(self, x: Column, n: int = 1) -> Column:
        return div(x, self.lag(x, n)) - 1

    def rolling(self, agg, x: Column, n: int, least: int | None = None) -> Column:
        """agg over the last n rows, NULL with fewer than `least` (default n) values."""
        return F.when(F.count(x).over(self.rows(n)) >= (n if least is None else least), agg(x).over(self.rows(n)))

    def mean(self, x, n, least=None) -> Column:
        return self.rolling(F.avg, x, n, least)

    def std(self, x, n, least=None) -> Column:
        return self.rolling(F.stddev_samp, x, n, least)

    def median(self, x, n, least=None) -> Column:
        return self.rolling(lambda c: F.percentile(c, 0.5), x, n, least)

    def zscore(self, x, n, least) -> Column:
        return div(x - self.mean(x, n, least), self.std(x, n, least))

    def slope(self, x: Column, n: int, number: Column) -> Column:
        """Least squares slope on the row number over exactly n values."""
        return F.when(F.count(x).over(self.rows(n)) == n, F.regr_slope(x, number).over(self.rows(n)))

    def ffill(self, x: Column) -> Column:
        return F.last(x, ignorenulls=True).over(self.past)

    def bfill(self, x: Column) -> Column:
        return F.first(x, ignorenulls=True).over(self.future)


def across(x: Column, by: str, least: int) -> Column:
    """z-score among the rows with the same `by`, NULL in groups of fewer than `least` rows (not values)."""
    w = Window.partitionBy(by)
    return F.when(F.count(F.lit(1)).over(w) >= least, div(x - F.avg(x).over(w), F.stddev_samp(x).over(w)))
