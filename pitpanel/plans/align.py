"""Panel assembly by point-in-time joins, and its coverage report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.config import Fundamental, Macro
from pitpanel.operators.asof import asof_backward

c = F.col
# Columns of the coverage report's groups.
COVERAGE = {
    "technical": ("ret_5d", "ret_20d", "ret_60d", "ret_250d", "macd_hist_pct", "rsi_14", "mfi_14", "obv_slope_20d", "atr_ratio_14", "realized_vol_20d", "bollinger_pctb"),
    "fundamental": ("gross_margin", "operating_margin", "net_margin", "current_ratio", "debt_to_equity", "roa", "roe", "revenue_yoy", "net_income_yoy", "eps_yoy", "pe_ttm", "pbv"),
}


def join_metadata(spine: DataFrame, meta: DataFrame) -> DataFrame:
    return spine.join(meta.select("ticker", *(x for x in ("sector", "sub_sector", "ipo_date") if x in meta.columns)), "ticker", "left")


def join_fundamentals(spine: DataFrame, funda: DataFrame, f: Fundamental = Fundamental()) -> DataFrame:
    """The newest report released by each date, none older than max_staleness days, and the valuation by it."""
    keep = [x for x in f.columns if x in funda.columns]
    right = funda.select("ticker", "release_date", c("report_period").alias("funda_report_period"), c("release_date").alias("funda_release_date"), *keep)
    d = asof_backward(spine, right, ["ticker"], "date", "release_date", f.max_staleness, "funda_report_period", ["funda_report_period", "funda_release_date", *keep])
    return valuation(d)


def valuation(d: DataFrame) -> DataFrame:
    price = c("raw_close") if "raw_close" in d.columns else c("close")
    for name, per in (("pe_ttm", "eps_ttm"), ("pbv", "bvps")):
        if per in d.columns:
            d = d.withColumn(name, F.when(c(per) > 0, price / c(per)))
    return d


def join_if(spine: DataFrame, right: DataFrame | None, keys: list[str]) -> DataFrame:
    """Left join, or the spine itself where the table or a key is missing. Catalyst broadcasts by size."""
    if right is None or any(k not in spine.columns for k in keys):
        return spine
    return spine.join(right, keys, "left")


def panel(spine: DataFrame, meta=None, funda=None, macro=None, sector=None, flow=None, f: Fundamental = Fundamental()) -> DataFrame:
    if spine is None:
        raise RuntimeError("the technical panel is missing: it is the spine of the alignment")
    d = join_metadata(spine, meta) if meta is not None else spine
    d = join_fundamentals(d, funda, f) if funda is not None else d
    return join_if(join_if(join_if(d, macro, ["date"]), sector, ["date", "sector"]), flow, ["date", "ticker"])


def coverage(d: DataFrame, m: Macro = Macro()) -> DataFrame:
    """Per year: rows, and per feature group the mean share of values present, in percent."""
    groups = {
        "technical": [x for x in COVERAGE["technical"] if x in d.columns], "cross_sectional": [x for x in d.columns if x.endswith("_cs_z")],
        "fundamental": [x for x in COVERAGE["fundamental"] if x in d.columns], "macro": [x for x in m.coverage if x in d.columns],
    }
    def share(cols):
        total = F.count(c(cols[0])).cast("double")
        for x in cols[1:]:
            total = total + F.count(c(x))
        return F.round(total / (F.count("*") * len(cols)) * 100.0, 1)
    return d.groupBy(F.year("date").alias("year")).agg(F.count("*").alias("rows"), *(share(v).alias(k) for k, v in groups.items() if v))
