"""Per-stock flow features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.config import Flow
from pitpanel.operators.windows import Series

S = Series("ticker", "date")


def flow_features(raw: DataFrame, f: Flow = Flow(), start: str | None = None) -> DataFrame:
    """(date, ticker, foreign_buy, foreign_sell) -> net, its rolling z-score and sum, per ticker."""
    d = raw.where(F.col("date") >= F.lit(start).cast("date")) if start else raw
    d = d.withColumn("foreign_net", F.col("foreign_buy") - F.col("foreign_sell"))
    net = F.col("foreign_net")
    return d.select(
        "date", "ticker", "foreign_buy", "foreign_sell", "foreign_net",
        S.zscore(net, f.z_window, max(f.z_window // 2, 5)).alias("foreign_net_zscore"),
        S.rolling(F.sum, net, f.sum_window).alias("foreign_net_5d_sum"),
    )
