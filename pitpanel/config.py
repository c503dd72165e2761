"""Settings of every plan, with their default values; frozen, so that a plan is a pure function of tables and settings."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field
from pathlib import Path

# Defaults of windows, tiers, lags, thresholds and word lists.


@dataclass(frozen=True)
class Universe:
    turnover_window: int = 20
    min_median_turnover: float = 1e9
    tiers: tuple = ((0.0, 200.0, 0.35), (200.0, 5000.0, 0.25), (5000.0, 1e12, 0.20))
    tolerance: float = 0.95
    min_rows: int = 60


@dataclass(frozen=True)
class Technical:
    return_windows: tuple = (5, 20, 60, 250)
    sma_windows: tuple = (20, 60)
    macd: tuple = (12, 26, 9)
    rsi: int = 14
    mfi: int = 14
    atr: int = 14
    obv_slope: int = 20
    volume_sma: int = 20
    realized_vol: int = 20
    vol_ratio: tuple = (5, 60)
    bollinger: tuple = (20, 2.0)
    high: int = 252
    close_pos: int = 20
    min_names: int = 10
    cross_section: tuple = ("ret_20d", "ret_60d", "volume_ratio", "realized_vol_20d")
    dressing_month: int = 12
    dressing_days: int = 5


@dataclass(frozen=True)
class Fundamental:
    lag_quarterly: int = 45
    lag_annual: int = 90
    ttm_quarters: int = 4
    yoy_quarters: int = 4
    ttm_span: tuple = (250, 420)
    max_staleness: int = 400
    chain: tuple = ("statements", "fallback")
    fallback_map: tuple = (
        ("revenue", ("Total Revenue", "Operating Revenue")), ("cogs", ("Cost Of Revenue",)), ("gross_profit", ("Gross Profit",)),
        ("operating_profit", ("Operating Income",)), ("pretax_income", ("Pretax Income",)),
        ("net_income", ("Net Income Common Stockholders", "Net Income")), ("eps", ("Diluted EPS", "Basic EPS")),
        ("shares_out", ("Diluted Average Shares", "Basic Average Shares")), ("total_assets", ("Total Assets",)),
        ("total_equity", ("Stockholders Equity", "Common Stock Equity")), ("total_liabilities", ("Total Liabilities Net Minority Interest",)),
        ("current_assets", ("Current Assets",)), ("current_liabilities", ("Current Liabilities",)),
        ("cash_equivalents", ("Cash And Cash Equivalents",)), ("total_debt", ("Total Debt",)),
    )
    columns: tuple = (
        "gross_margin", "operating_margin", "net_margin", "current_ratio", "debt_to_equity", "debt_to_assets",
        "cash_to_assets", "equity_ratio", "roa", "roe", "revenue_yoy", "net_income_yoy", "eps_yoy", "revenue_qoq",
        "net_income_qoq", "eps_qoq", "revenue_ttm", "net_income_ttm", "eps_ttm", "bvps",
    )
    field_map: tuple = (
        ("revenue", ("revenue", "revenueBank")), ("cogs", ("cor",)), ("gross_profit", ("gp",)), ("operating_profit", ("opinc",)),
        ("pretax_income", ("pretax", "ebtBank")), ("net_income", ("netinccmn", "netinc")), ("eps", ("epsdil", "epsBasic")),
        ("shares_out", ("sharesDiluted", "sharesBasic")), ("total_assets", ("assets",)), ("total_equity", ("equity", "totalCommonEquity")),
        ("total_liabilities", ("liabilities", "liabilitiesBank")), ("current_assets", ("totalCurrentAssets", "currentAssets")),
        ("current_liabilities", ("totalCurrentLiabilities", "currentLiabilities")), ("cash_equivalents", ("cashneq",)), ("total_debt", ("debt",)),
    )


@dataclass(frozen=True)
class Source:
    """One source of a series; None and blanks take what the series says."""

    driver: str = ""
    transform: str | None = None
    lag: int | None = None
    frequency: str = ""
    variable: str = ""


@dataclass(frozen=True)
class MacroSeries:
    name: str = ""
    group: str = "other"
    frequency: str = "unknown"
    transform: str = "none"
    lag: int = 0
    sources: tuple[Source, ...] = ()


@dataclass(frozen=True)
class Feed:
    """A feed, or a search of one: `query` is what was searched for, `source` the name its articles bear (the feed's own unless given)."""

    name: str = ""
    lang: str = ""
    url: str = ""
    source: str = ""
    query: str | None = None


@dataclass(frozen=True)
class Macro:
    series: tuple[MacroSeries, ...] = ()
    change_windows: tuple = (5, 20)
    z_window: int = 252
    yoy_tolerance: int = 20
    sector_window: int = 20
    staleness: tuple = (("id_trade_balance", 60), ("coal_newcastle", 10))
    sector_map: tuple = (
        ("Energy", ("brent_oil", "coal_newcastle")), ("Basic Materials", ("nickel", "gold", "copper", "tin", "cpo")),
        ("Consumer Defensive", ("cpo", "rubber")), ("Industrials", ("brent_oil", "copper")), ("Utilities", ("brent_oil", "coal_newcastle")),
    )
    coverage: tuple = (
        "bi_rate", "id_cpi_yoy", "usd_idr", "id_fx_reserves", "fed_funds_rate", "us_cpi_yoy", "us_10y_yield", "dxy", "vix",
        "us_manufacturing_activity", "cpo", "nickel", "brent_oil", "gold", "copper", "tin", "rubber",
    )


@dataclass(frozen=True)
class Flow:
    start_date: str = "2020-01-02"
    z_window: int = 60
    sum_window: int = 5


@dataclass(frozen=True)
class Sentiment:
    half_life: float = 3.0
    window_days: int = 14
    stopwords: tuple = ("pt", "tbk", "persero", "indonesia", "tbk.")
    min_name: int = 4
    feeds: tuple[Feed, ...] = ()


@dataclass(frozen=True)
class Config:
    universe: Universe = field(default_factory=Universe)
    technical: Technical = field(default_factory=Technical)
    fundamental: Fundamental = field(default_factory=Fundamental)
    macro: Macro = field(default_factory=Macro)
    flow: Flow = field(default_factory=Flow)
    sentiment: Sentiment = field(default_factory=Sentiment)
    root: str = "."
    use_cache: bool = False
    buckets: int = 0  # feature tables by ticker lie in so many buckets; 0: in ranges of ticker and date
    csv: bool = False  # the last tables also as CSV
    as_of: str = ""  # the day of the run, yyyy-MM-dd; blank: calendars end with the data

    def get(self, dotted: str, default=None):
        at = self
        for part in dotted.split("."):
            if not hasattr(at, part):
                return default
            at = getattr(at, part)
        return at

    def require(self, dotted: str):
        out = self.get(dotted)
        if out is None:
            raise KeyError(f"setting {dotted} is missing")
        return out

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def made(default, given):
    """Given values in the shape of the defaults: lists become tuples, objects settings; unknown names are errors."""
    if isinstance(given, list):
        return tuple(made(None, x) for x in given)
    if isinstance(given, dict) and dataclasses.is_dataclass(default):
        kinds = {"series": MacroSeries, "sources": Source, "feeds": Feed}
        parts = {k: tuple(made(kinds[k](), x) for x in v) if k in kinds else made(getattr(default, k, None), v) for k, v in given.items()}
        return dataclasses.replace(default, **parts)
    return given


def read_settings(path: str):
    """The value of a JSON file, or of a YAML file where that library is there."""
    text = Path(path).read_text()
    if not path.endswith((".yaml", ".yml")):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ValueError(f"{path}: no YAML library is installed; use JSON") from e
    return yaml.safe_load(text) or {}


def load_config(path: str | None = None, root: str = ".") -> Config:
    """Defaults, overridden by a JSON or YAML file of the same nesting."""
    return made(Config(root=root), read_settings(path)) if path else Config(root=root)


def load_dotenv(root: str) -> dict[str, str]:
    """KEY=VALUE lines of .env.example, then of .env (which wins), put into the environment; empty values are not."""
    found: dict[str, str] = {}
    for name in (".env.example", ".env"):
        p = Path(root) / name
        if p.exists():
            for line in p.read_text().splitlines():
                key, eq, value = line.strip().partition("=")
                if eq and key and not key.startswith("#"):
                    found[key.strip()] = value.strip().strip("'\"")
    found = {k: v for k, v in found.items() if v}
    os.environ.update(found)
    return found
