"""Fundamental features: statements made canonical, trailing sums, growth, ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.config import Fundamental
from pitpanel.functions.scalar import div
from pitpanel.operators.dedupe import keep_first

c = F.col
FLOWS = ("revenue", "net_income", "eps")
FIELDS = (
    "revenue", "cogs", "gross_profit", "operating_profit", "pretax_income", "net_income", "eps", "shares_out", "total_assets",
    "total_equity", "total_liabilities", "current_assets", "current_liabilities", "cash_equivalents", "total_debt",
)


def merge_statements(income: DataFrame, balance: DataFrame, keys=("ticker", "freq", "report_period")) -> DataFrame:
    """Income and balance rows of a period side by side; either may be missing."""
    extra = [x for x in balance.columns if x not in keys and x in income.columns]
    return income.join(balance.drop(*extra), list(keys), "full_outer")


def first_provider(rows: DataFrame, chain) -> DataFrame:
    """Rows of the first provider of the chain that has any for the ticker."""
    rank = F.coalesce(*(F.when(c("provider") == p, i) for i, p in enumerate(chain)), F.lit(len(chain)))
    w = Window.partitionBy("ticker")
    return rows.withColumn("_p", rank).withColumn("_m", F.min("_p").over(w)).where("_p = _m").drop("_p", "_m")


def canonical(rows: DataFrame, f: Fundamental = Fundamental()) -> DataFrame:
    """Every field present and numeric, one row per ticker and period (quarterly wins), release date by reporting lag."""
    for x in FIELDS:
        rows = rows.withColumn(x, c(x).try_cast("double") if x in rows.columns else F.lit(None).cast("double"))
    rows = keep_first(rows.where("report_period is not null"), ["ticker", "report_period"], [F.desc("freq")])
    lag = F.when(c("freq") == "Q", f.lag_quarterly).otherwise(f.lag_annual)
    rows = rows.withColumn("release_date", F.date_add("report_period", lag)).withColumn("release_date_estimated", F.lit(1))
    return rows.withColumn("total_liabilities", F.coalesce("total_liabilities", c("total_assets") - c("total_equity")))


def trailing(rows: DataFrame, f: Fundamental = Fundamental()) -> DataFrame:
    """Trailing sums over quarters that span about a year (annual rows pass), returns on average capital, growth."""
    w = Window.partitionBy("ticker", "freq").orderBy("report_period")
    n = f.ttm_quarters
    frame, quarterly = w.rowsBetween(-(n - 1), 0), c("freq") == "Q"
    span = F.datediff("report_period", F.lag("report_period", n - 1).over(w))
    d = rows
    for x in FLOWS:
        total = F.when((F.count(x).over(frame) == n) & span.between(*f.ttm_span), F.sum(x).over(frame))
        d = d.withColumn(f"{x}_ttm", F.when(quarterly, total).otherwise(c(x)))
    for name, base in (("roa", "total_assets"), ("roe", "total_equity")):
        mean = F.coalesce((c(base) + F.lag(base).over(w)) / 2.0, c(base))
        d = d.withColumn(name, div(c("net_income_ttm"), mean))
    for x in FLOWS:
        prev = F.when(quarterly, F.lag(x, f.yoy_quarters).over(w)).otherwise(F.lag(x, 1).over(w))
        d = d.withColumn(f"{x}_yoy", div(c(x) - prev, F.abs(prev)))
        last = F.lag(x, 1).over(w)
        d = d.withColumn(f"{x}_qoq", F.when(quarterly, div(c(x) - last, F.abs(last))))
    return d


def ratios(rows: DataFrame) -> DataFrame:
    gross = F.coalesce(c("gross_profit"), c("revenue") - c("cogs"))
    pairs = {
        "gross_margin": (gross, c("revenue")), "operating_margin": (c("operating_profit"), c("revenue")), "net_margin": (c("net_income"), c("revenue")),
        "current_ratio": (c("current_assets"), c("current_liabilities")), "debt_to_equity": (c("total_debt"), c("total_equity")),
        "debt_to_assets": (c("total_debt"), c("total_assets")), "cash_to_assets": (c("cash_equivalents"), c("total_assets")),
        "equity_ratio": (c("total_equity"), c("total_assets")), "bvps": (c("total_equity"), c("shares_out")),
    }
    return rows.withColumns({k: div(a, b) for k, (a, b) in pairs.items()})


def fundamental_features(rows: DataFrame, f: Fundamental = Fundamental()) -> DataFrame:
    return ratios(trailing(canonical(rows, f), f))
