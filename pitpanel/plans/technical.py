"""Technical panel: cleaned, back-adjusted bars, universe flags, indicators, calendar and cross-section features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.config import Technical, Universe
from pitpanel.functions.scalar import div, finite, flag, not_below, tier
from pitpanel.operators import shards
from pitpanel.operators.dedupe import keep_last
from pitpanel.operators.scan import ewm, scan
from pitpanel.operators.windows import Series, across

S = Series("ticker", "date")
c = F.col


def clean(raw: DataFrame, ties=("close",)) -> DataFrame:
    """One row per ticker and date (the last by `ties`), then only positive closes; raw_close, turnover and volume set."""
    d = keep_last(raw, ["ticker", "date"], list(ties)).where("close is not null and close > 0")
    d = d.withColumn("volume", F.greatest(F.coalesce("volume", F.lit(0.0)), F.lit(0.0)))
    return d.withColumn("raw_close", c("close")).withColumn("turnover_idr", c("close") * c("volume"))


def back_adjust(d: DataFrame) -> DataFrame:
    """Prices times adj_close / close, carried forward, then backward, 1 where there is none; high and low repaired."""
    if "adj_close" in d.columns:
        d = d.withColumn("_f", finite(div(c("adj_close"), c("close"))))
        d = shards.filled(d, "ticker", "date", "_f", "_f_before", "_f_after") if "_halo" in d.columns else d
        ends = ([c("_f_before")], [c("_f_after")]) if "_halo" in d.columns else ([], [])
        d = d.withColumn("_f", F.coalesce(S.ffill(c("_f")), *ends[0], S.bfill(c("_f")), *ends[1], F.lit(1.0))).drop("_f_before", "_f_after")
    else:
        d = d.withColumn("_f", F.lit(1.0))
    for x in ("open", "high", "low", "close"):
        d = d.withColumn(x, c(x) * c("_f"))
    return d.withColumn("high", F.greatest("high", "open", "close")).withColumn("low", F.least("low", "open", "close")).drop("_f")


def universe_flags(d: DataFrame, u: Universe = Universe()) -> DataFrame:
    median = S.median(c("turnover_idr"), u.turnover_window, u.turnover_window // 2)
    prev = S.lag(c("raw_close"))
    ret, limit = div(c("raw_close"), prev) - 1, tier(prev, u.tiers) * u.tolerance
    return d.withColumn("is_liquid", flag(median >= u.min_median_turnover)).withColumn("ara_flag", flag(ret >= limit)).withColumn("arb_flag", flag(ret <= -limit))


def returns(d: DataFrame, t: Technical = Technical()) -> DataFrame:
    for n in t.return_windows:
        d = d.withColumn(f"ret_{n}d", S.change(c("close"), n))
    for n in t.sma_windows:
        d = d.withColumn(f"price_sma{n}_ratio", div(c("close"), S.mean(c("close"), n)))
    return d.withColumn("gap_open", div(c("open"), S.lag(c("close"))) - 1)


#: The exponential means that a series is taken up with.
STATES = ("_fast", "_slow", "_ag", "_al", "_atr", "_sig")


def recursive(d: DataFrame, t: Technical = Technical(), states: bool = False) -> DataFrame:
    """MACD histogram, RSI and ATR: five exponential means in one scan, the signal line in a second.

    With `states` the means stay as columns, and where `_known_at` is set, they start from `_known` at that date.
    """
    fast, slow, signal = t.macd
    known = ("_known_at", "_known") if states else None
    way = shards.scan if "_halo" in d.columns else scan
    delta, prev = c("close") - S.lag(c("close")), S.lag(c("close"))
    d = d.withColumn("_gain", not_below(delta)).withColumn("_loss", not_below(-delta))
    d = d.withColumn("_tr", F.greatest(c("high") - c("low"), F.abs(c("high") - prev), F.abs(c("low") - prev)))
    d = ewm(d, "ticker", "date", {
        "_fast": ("close", 2 / (fast + 1)), "_slow": ("close", 2 / (slow + 1)),
        "_ag": ("_gain", 1 / t.rsi), "_al": ("_loss", 1 / t.rsi), "_atr": ("_tr", 1 / t.atr),
    }, way, known)
    # a shard's halo rows have no means of their own, but are rows before its own all the same
    d = ewm(d.withColumn("_macd", F.coalesce(c("_fast") - c("_slow"), F.lit(0.0))), "ticker", "date", {"_sig": ("_macd", 2 / (signal + 1))}, way, known)
    enough = lambda x, n: F.count(c(x)).over(S.past) >= n
    rsi = F.when(c("_al") > 0, 100.0 - 100.0 / (1.0 + div(c("_ag"), c("_al")))).otherwise(100.0)
    d = d.withColumn("macd_hist", c("_macd") - c("_sig")).withColumn("macd_hist_pct", div(c("_macd") - c("_sig"), c("close")))
    d = d.withColumn("rsi_14", F.when(enough("_gain", t.rsi), rsi)).withColumn("atr_ratio_14", F.when(enough("_tr", t.atr), div(c("_atr"), c("close"))))
    return d.drop("_gain", "_loss", "_tr", "_macd", *(() if states else STATES))


def volume_features(d: DataFrame, t: Technical = Technical()) -> DataFrame:
    sma = S.mean(c("volume"), t.volume_sma, t.volume_sma // 2)
    d = d.withColumn("_sma", sma).withColumn("_n", S.number().cast("double"))
    d = d.withColumn("_dir", F.coalesce(F.signum(c("close") - S.lag(c("close"))), F.lit(0.0)) * c("volume"))
    d = d.withColumn("_obv", F.sum("_dir").over(S.past))
    d = d.withColumn("volume_ratio", div(c("volume"), c("_sma"))).withColumn("obv_slope_20d", div(S.slope(c("_obv"), t.obv_slope, c("_n")), c("_sma")))
    d = d.withColumn("_tp", (c("high") + c("low") + c("close")) / 3.0)
    d = d.withColumn("_up", c("_tp") - S.lag(c("_tp"))).withColumn("_mf", c("_tp") * c("volume"))
    pos, neg = (S.rolling(F.sum, F.when(cond, c("_mf")).otherwise(0.0), t.mfi) for cond in (c("_up") > 0, c("_up") < 0))
    d = d.withColumn("_pos", pos).withColumn("_neg", neg)
    mfi = F.when(c("_pos").isNotNull(), F.when(c("_neg") > 0, 100.0 - 100.0 / (1.0 + div(c("_pos"), c("_neg")))).otherwise(100.0))
    return d.withColumn("mfi_14", mfi).drop("_sma", "_n", "_obv", "_dir", "_tp", "_up", "_mf", "_pos", "_neg")


def range_vol(d: DataFrame, t: Technical = Technical()) -> DataFrame:
    d = d.withColumn("_lr", F.ln(div(c("close"), S.lag(c("close")))))
    d = d.withColumn("dist_52w_high", div(c("close"), S.rolling(F.max, c("high"), t.high, t.high // 4)) - 1)
    lo, hi = S.rolling(F.min, c("low"), t.close_pos), S.rolling(F.max, c("high"), t.close_pos)
    d = d.withColumn("close_pos_20d", div(c("close") - lo, hi - lo))
    d = d.withColumn("realized_vol_20d", S.std(c("_lr"), t.realized_vol) * math.sqrt(252.0))
    short, long = t.vol_ratio
    d = d.withColumn("vol_ratio_5_60", div(S.std(c("_lr"), short), S.std(c("_lr"), long)))
    n, k = t.bollinger
    mid, band = S.mean(c("close"), n), S.std(c("close"), n) * k
    return d.withColumn("bollinger_pctb", div(c("close") - (mid - band), 2.0 * band)).drop("_lr")


def calendar_features(d: DataFrame, t: Technical = Technical()) -> DataFrame:
    inside = F.month("date") == t.dressing_month
    w = Window.partitionBy("ticker", F.year("date"), inside).orderBy(F.desc("date"))
    d = d.withColumn("day_of_week", F.weekday("date"))
    return d.withColumn("window_dressing_flag", flag(inside & (F.row_number().over(w) <= t.dressing_days)))


def cross_section(d: DataFrame, t: Technical = Technical()) -> DataFrame:
    for x in t.cross_section:
        if x in d.columns:
            d = d.withColumn(f"{x}_cs_z", across(c(x), "date", t.min_names))
    return d


def technical_panel(raw: DataFrame, u: Universe = Universe(), t: Technical = Technical(), ties=("close",)) -> DataFrame:
    """Raw bars -> the technical panel. One exchange by ticker for all series windows, one by date for the cross-section."""
    return cross_section(series_features(clean(raw, ties), u, t), t).drop("adj_close", "dividends", "stock_splits", "n")


def series_features(cleaned: DataFrame, u: Universe = Universe(), t: Technical = Technical(), states: bool = False) -> DataFrame:
    """All features of one ticker's own bars."""
    d = universe_flags(back_adjust(cleaned), u)
    return calendar_features(range_vol(volume_features(recursive(returns(d, t), t, states), t), t), t)


def sharded_features(cleaned: DataFrame, u: Universe = Universe(), t: Technical = Technical(), rows: int = 1_000_000) -> DataFrame:
    """The same where one ticker's bars may be too many for a task: in shards of about `rows` bars."""
    d = shards.split(cleaned, "ticker", "date", look_back(u, t), t.dressing_days, rows)
    return shards.whole(series_features(d, u, t), "ticker")


def look_back(u: Universe = Universe(), t: Technical = Technical()) -> int:
    """How many earlier rows of its ticker the finite frames of a row reach; exponential means reach all and are kept as states."""
    frames = (*t.sma_windows, u.turnover_window, t.mfi + 1, t.obv_slope + 1, t.volume_sma, t.realized_vol + 1, *(n + 1 for n in t.vol_ratio), t.bollinger[0], t.high, t.close_pos, t.rsi + 1, t.atr + 1)
    return max(*t.return_windows, *(n - 1 for n in frames))


def corporate_actions(raw: DataFrame) -> DataFrame:
    """Dividends above 0 and splits other than 0, one row each."""
    two = F.explode(F.array(
        F.struct(F.lit("dividend").alias("action"), F.when(c("dividends") > 0, c("dividends")).alias("value")),
        F.struct(F.lit("stock_split").alias("action"), F.when(c("stock_splits") != 0, c("stock_splits")).alias("value")),
    )).alias("e")
    return raw.select("ticker", "date", two).select("ticker", "date", "e.action", "e.value").where("value is not null")
