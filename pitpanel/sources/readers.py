"""Readers of landed files: fixed schemas, tolerant of missing paths, entries that cannot be read left out. Transport is not here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.config import Fundamental
from pitpanel.operators.dedupe import keep_last

c = F.col
# Schemas of the raw tables.
SCHEMAS = {
    "raw_prices": "date date, ticker string, open double, high double, low double, close double, adj_close double, volume double, dividends double, stock_splits double",
    "stock_metadata": "ticker string, name string, sector string, sub_sector string, ipo_date date, first_data_date date",
    "corporate_actions": "ticker string, date date, action string, value double",
    "raw_fundamentals": "ticker string, report_period date, fiscal_year string, fiscal_quarter string, freq string, provider string, revenue double, cogs double, gross_profit double, operating_profit double, pretax_income double, net_income double, eps double, shares_out double, total_assets double, total_equity double, total_liabilities double, current_assets double, current_liabilities double, cash_equivalents double, total_debt double, release_date date, release_date_estimated int",
    "macro_observations": "date date, value double, effective_date date, series string, driver string, frequency string, group string",
    "raw_flow": "date date, ticker string, foreign_buy double, foreign_sell double, foreign_net double",
    "empty_dates": "date date",
    "articles": "source string, feed_url string, lang string, title string, summary string, link string, published timestamp, fetched_at timestamp, query string",
}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A raw table by its schema; an empty one where the path is missing."""
    schema = SCHEMAS[table]
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def cached(spark: SparkSession, path: str, table: str, use_cache: bool) -> DataFrame | None:
    """The stage's output of an earlier run if it may be reused and is there, else None."""
    return read(spark, path, table) if use_cache and exists(spark, path) else None


def day(text):
    """The date of a date, timestamp or their text; NULL for anything else."""
    return F.coalesce(F.try_to_date(text.cast("string")), F.try_to_timestamp(text.cast("string")).cast("date"))


def carried(landed: DataFrame, *more: str) -> list[str]:
    """Columns that decoders hand on: those named, and the place at which a row landed, where it is known."""
    return [*more, *(["_seq"] if "_seq" in landed.columns else [])]


def with_file(landed: DataFrame) -> DataFrame:
    """Rows read from files, with `_seq`: the time, file and block they came from."""
    m = c("_metadata")
    place = F.struct(m["file_modification_time"].alias("time"), m["file_path"].alias("file"), m["file_block_start"].alias("block"))
    return landed.select(*landed.columns, place.alias("_seq"))


def with_row(landed: DataFrame) -> DataFrame:
    """The same with the row's place within its block, so that later rows follow earlier ones; a stream gets it batch by batch."""
    return landed.withColumn("_seq", F.struct("_seq.time", "_seq.file", "_seq.block", F.monotonically_increasing_id().alias("row")))


def with_place(landed: DataFrame) -> DataFrame:
    return with_row(with_file(landed))


def universe(spark: SparkSession, path: str) -> DataFrame:
    """JSON {country: [{ticker, name}]} -> ticker, name: trimmed, upper case, blank ones dropped, the first of each stays."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<struct<ticker:string,name:string>>>").alias("m"))
    rows = raw.select(F.posexplode(F.map_values("m")).alias("i", "l")).select("i", F.posexplode("l").alias("j", "e"))
    rows = rows.select("i", "j", F.upper(F.trim("e.ticker")).alias("ticker"), F.coalesce("e.name", F.lit("")).alias("name")).where("ticker <> ''")
    first = rows.groupBy("ticker").agg(F.min(F.struct("i", "j", "name")).alias("f"))
    if first.isEmpty():
        raise ValueError(f"no tickers in {path}")
    return first.select("ticker", "f.name")


def normalize_bars(frame: DataFrame, ticker: str | None = None) -> DataFrame:
    """Provider columns to canonical names, midnight dates, the last of each date, rows without close dropped."""
    names = {"Date": "date", "Datetime": "date", "Open": "open", "High": "high", "Low": "low", "Close": "close", "Adj Close": "adj_close", "Volume": "volume", "Dividends": "dividends", "Stock Splits": "stock_splits"}
    d = frame.withColumnsRenamed({a: b for a, b in names.items() if a in frame.columns}).withColumn("date", day(c("date")))
    if ticker:
        d = d.withColumn("ticker", F.lit(ticker))
    order = [x for x in ("_seq", "fetched") if x in d.columns] or ["close"]
    return keep_last(d.where("date is not null"), ["ticker", "date"], order).where("close is not null")


def metadata(fetched: DataFrame, tickers: DataFrame, first_dates: DataFrame) -> DataFrame:
    """(ticker, long_name, sector, sub_sector, ipo_epoch) joined to the universe, names and dates filled in."""
    d = tickers.join(fetched, "ticker", "left").join(first_dates.select("ticker", "first_data_date"), "ticker", "left_outer")
    return d.select("ticker", F.coalesce("long_name", "name").alias("name"), "sector", "sub_sector", F.coalesce(F.to_date(F.timestamp_seconds("ipo_epoch")), c("first_data_date")).alias("ipo_date"), "first_data_date")


def candidate(names, available: set[str]):
    """Whole-array choice: the first candidate array that holds any value."""
    out = F.lit(None).cast("array<double>")
    for n in reversed([n for n in names if n in available]):
        out = F.when(F.exists(c(n), lambda x: x.isNotNull()), c(n)).otherwise(out)
    return out


def statement_rows(columns: DataFrame, fields, f: Fundamental = Fundamental()) -> DataFrame:
    """One row per payload (ticker, freq, datekey[], field arrays) -> one per report period; pseudo periods go."""
    have = set(columns.columns)
    arrays = {k: candidate(cands, have) for k, cands in f.field_map if k in fields}
    keep = carried(columns, "ticker", "freq")
    rows = columns.select(*keep, F.arrays_zip(c("datekey").alias("d"), *(F.coalesce(a, F.transform("datekey", lambda _: F.lit(None).cast("double"))).alias(k) for k, a in arrays.items())).alias("z"))
    rows = rows.select(*keep, F.inline("z"))
    return rows.withColumn("report_period", F.try_to_date("d")).where("report_period is not null").drop("d")


def statements(landed: DataFrame) -> DataFrame:
    """(ticker, freq, payload) -> ticker, freq, financial: the arrays of the last data node's financialData as texts, by name
    (NULL if there is none).

    A node's data is a flat array in which objects and arrays hold the places of their values; negative places and places
    beyond the array stand for what is missing. The way from the root (place 0) over financialData and its arrays to their values has a fixed
    length, so it is looked up step by step; links that run in a circle elsewhere do no harm.
    """
    nodes = F.from_json("payload", "nodes array<struct<type:string,data:array<string>>>")["nodes"]
    flat = F.try_element_at(F.filter(nodes, lambda n: n["type"].eqNullSafe("data")), F.lit(-1))["data"]
    keep = carried(landed, "ticker", "freq")
    d = landed.select(*keep, flat.alias("flat"))
    at = lambda i: F.when(i >= 0, F.get(c("flat"), i))
    places = lambda text: F.from_json(text, "map<string,int>")
    d = d.select(*keep, "flat", places(at(F.try_element_at(places(F.get("flat", F.lit(0))), F.lit("financialData")))).alias("fields"))
    values = lambda text: F.transform(F.from_json(text, "array<int>"), at)
    arrays = F.transform_values("fields", lambda _, i: values(at(i)))
    return d.select(*keep, F.when(c("fields").isNotNull(), arrays).alias("financial"))


def financial_arrays(decoded: DataFrame, f: Fundamental = Fundamental()) -> DataFrame:
    """financial (arrays of texts by name) -> datekey[] and every candidate array, of numbers."""
    names = sorted({x for _, cands in f.field_map for x in cands})
    array = lambda n: F.try_element_at("financial", F.lit(n))
    keep = carried(decoded, "ticker", "freq")
    return decoded.where("financial is not null").select(*keep, array("datekey").alias("datekey"), *(F.transform(array(n), lambda x: number(x)).alias(n) for n in names))


def fallback_statement(rows: DataFrame, mapping: dict[str, tuple[str, ...]]) -> DataFrame:
    """(ticker, freq, report_period, label, value), a row per cell of a table -> canonical columns.

    Of a cell that landed twice the later counts. Of the labels of a column the first that the table of the ticker and frequency
    has any value for is taken, whole.
    """
    from pitpanel.functions.scalar import first_usable

    keys = ["ticker", "freq", "report_period"]
    last = F.max_by("value", "_seq") if "_seq" in rows.columns else F.max("value")
    wide = rows.where("value is not null").groupBy(*keys).pivot("label", [x for v in mapping.values() for x in v]).agg(last)
    return wide.select(*keys, *(first_usable(wide, v, ["ticker", "freq"]).alias(k) for k, v in mapping.items()))


def observations_api(landed: DataFrame) -> DataFrame:
    """(series, payload) {observations: [{date, value}]} -> series, date, value; '.' and blanks are missing, entries without a date go."""
    keep = carried(landed, "series")
    o = landed.select(*keep, F.explode(F.from_json("payload", "observations array<struct<date:string,value:string>>")["observations"]).alias("o"))
    o = o.select(*keep, F.try_to_date("o.date").alias("date"), number(c("o.value")).alias("value"))
    return o.where("date is not null and value is not null")


def number(text):
    """The finite number a text stands for, else NULL."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def series_docs(landed: DataFrame) -> DataFrame:
    """(series, payload) {series: {docs: [{period_start_day, value, @frequency}]}} -> rows; monthly stamps move to month end."""
    keep = carried(landed, "series")
    schema = "series struct<docs:array<struct<period_start_day:array<string>,value:array<string>,`@frequency`:string>>>"
    d = landed.select(*keep, F.get(F.from_json("payload", schema)["series"]["docs"], F.lit(0)).alias("d"))
    z = d.select(*keep, c("d.`@frequency`").alias("f"), F.explode(F.arrays_zip(c("d.period_start_day").alias("p"), c("d.value").alias("v"))).alias("z"))
    at = F.try_to_date("z.p")
    z = z.select(*keep, F.when(c("f") == "monthly", F.last_day(at)).otherwise(at).alias("date"), number(c("z.v")).alias("value"))
    return z.where("date is not null and value is not null")


def month_end(year, month):
    """The last day of a month given as numbers or their text; NULL where there is no such month."""
    y, m = year.try_cast("int"), month.try_cast("int")
    return F.when(y.between(1, 9999) & m.between(1, 12), F.last_day(F.make_date(F.when(y.between(1, 9999), y), F.when(m.between(1, 12), m), F.lit(1))))


def dynamic_table(landed: DataFrame, variable) -> DataFrame:
    """(series, payload) with datacontent keyed vervar+var+turvar+year+month -> monthly values; the annual month 13 is skipped.

    `variable` is the id of the variable, a text or a column. Years whose label is no number go.
    """
    keep = carried(landed, "series")
    schema = "status string, vervar array<struct<val:string>>, turvar array<struct<val:string>>, tahun array<struct<val:string,label:string>>, datacontent map<string,string>"
    p = landed.select(*keep, (F.lit(variable) if isinstance(variable, str) else variable).alias("_v"), F.from_json("payload", schema).alias("p"))
    p = p.select(*keep, "_v", "p.datacontent", F.explode("p.vervar.val").alias("ver"), c("p.turvar.val").alias("turs"), c("p.tahun").alias("years"))
    p = p.withColumn("tur", F.explode("turs")).withColumn("y", F.explode("years")).withColumn("m", F.explode(F.sequence(F.lit(1), F.lit(12))))
    key = F.concat("ver", "_v", "tur", "y.val", c("m").cast("string"))
    p = p.select(*keep, month_end(c("y.label"), c("m")).alias("date"), number(F.try_element_at("datacontent", key)).alias("value"))
    return p.where("date is not null and value is not null")


def monthly_statistic(landed: DataFrame, as_of: str) -> DataFrame:
    """(series, year, month, payload) {seriesData: [{x, y}]} -> month's sum of numbers; the month of `as_of` is skipped.

    Of a month that landed twice the later payload counts.
    """
    keep = carried(landed, "series")
    landed = landed.withColumn("date", month_end(c("year"), c("month"))).where("date is not null")
    if "_seq" in landed.columns:
        landed = keep_last(landed, ["series", "date"], ["_seq"])
    d = landed.select(*keep, "date", F.explode(F.from_json("payload", "seriesData array<struct<x:string,y:string>>")["seriesData"]).alias("e"))
    d = d.withColumn("y", number(c("e.y"))).where("y is not null").where(c("date") <= F.last_day(F.add_months(F.lit(as_of).cast("date"), -1)))
    return d.groupBy(*keep, "date").agg(F.sum("y").alias("value"))


def statistic_filter(year, month):
    """The query parameter of the monthly statistic: base64 of a compact JSON object."""
    return F.base64(F.to_json(F.struct(year.cast("string").alias("year"), month.cast("string").alias("month"), F.lit("0").alias("quarter"), F.lit("monthly").alias("type"))).cast("binary"))


def stock_flow(landed: DataFrame, universe_: DataFrame) -> DataFrame:
    """(date, payload) {data: [{StockCode, ForeignBuy, ForeignSell}]} -> raw_flow rows of the universe; non-numbers go."""
    keep = carried(landed, "date")
    d = landed.select(*keep, F.explode(F.from_json("payload", "recordsTotal string, data array<struct<StockCode:string,ForeignBuy:string,ForeignSell:string>>")["data"]).alias("e"))
    d = d.select(*keep, F.concat(F.upper(F.trim("e.StockCode")), F.lit(".JK")).alias("ticker"), number(c("e.ForeignBuy")).alias("foreign_buy"), number(c("e.ForeignSell")).alias("foreign_sell"))
    d = d.where("foreign_buy is not null and foreign_sell is not null").join(universe_.select("ticker"), "ticker", "left_semi")
    return d.select(*keep, "ticker", "foreign_buy", "foreign_sell", (c("foreign_buy") - c("foreign_sell")).alias("foreign_net"))


def feed(spark: SparkSession, path: str, source: str, lang: str, feed_url: str, as_of: str, query: str | None = None) -> DataFrame:
    """Landed feed files (RSS or Atom) -> articles; an undated one gets `as_of`, never the clock."""
    from pitpanel.sources import feeds

    bodies = spark.read.text(path, wholetext=True).select(F.lit(source).alias("source"), F.lit(feed_url).alias("feed_url"), F.lit(lang).alias("lang"), F.lit(query).cast("string").alias("query"), c("value").alias("body"))
    d = feeds.articles(feeds.items(bodies), as_of).withColumn("fetched_at", F.lit(as_of).cast("timestamp"))
    return d.select("source", "feed_url", "lang", "title", "summary", "link", "published", "fetched_at", "query")


def backfill_backend(name: str) -> str:
    if name == "gdelt":
        raise NotImplementedError("this archive has no usable Indonesian headlines")
    if name != "wayback":
        raise ValueError(f"unknown backend {name}")
    return name
