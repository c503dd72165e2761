"""Article sentiment: dedupe, scores, entities, sectors, daily aggregates, exponential decay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.config import Sentiment
from pitpanel.functions.text import article_text, keyword_groups, normal_name, polarity
from pitpanel.operators.asof import calendar
from pitpanel.operators.dedupe import article_key, keep_first
from pitpanel.operators.scan import scan
from pitpanel.operators.windows import Series
from pitpanel.sources import folders

c = F.col


def dedupe_articles(rows: DataFrame) -> DataFrame:
    """Titled articles, one per link (else source and title); the first fetched stays."""
    d = rows.where(F.length(F.trim("title")) > 0).withColumn("_key", article_key(c("link"), c("source"), c("title")))
    return keep_first(d, ["_key"], ["fetched_at", "published", "title", "summary"]).drop("_key")


def union_articles(live: DataFrame, backfill: DataFrame) -> DataFrame:
    return live.withColumn("source_type", F.lit("live")).unionByName(backfill.withColumn("source_type", F.lit("backfill")), allowMissingColumns=True)


def score_articles(rows: DataFrame, lexicon: dict) -> DataFrame:
    """Adds text, date and score."""
    d = rows.withColumn("text", article_text(c("title"), c("summary"))).withColumn("date", F.to_date("published"))
    return d.withColumn("score", polarity(c("text"), lexicon["positive"], lexicon["negative"], lexicon["negations"]))


def entities(universe: DataFrame, s: Sentiment = Sentiment()) -> DataFrame:
    """(ticker, name, sector) -> ticker, sector, code, name (normal form, NULL if too short)."""
    name = normal_name(c("name"), s.stopwords)
    return universe.select("ticker", "sector", F.substring_index("ticker", ".", 1).alias("code"), F.when(F.length(F.replace(name, F.lit(" "), F.lit(""))) >= s.min_name, name).alias("name"))


def match_entities(rows: DataFrame, ents: DataFrame, key: str = "doc_id", small: int = 50_000) -> DataFrame:
    """(key, ticker) once per article and company that it names: its code as a word of the text (case counts), or its name,
    of any length, as words of the text's normal form. A word borders on what is no letter, digit or underscore.

    A text meets the names whose longest word it holds, by an equality join; then the whole name is looked for. Up to `small`
    names (counted when the plan is made) are broadcast; of more, the pairs met are joined back to the texts."""
    codes = rows.select(key, F.explode(F.array_distinct(F.split("text", r"[^\p{L}\p{N}_]+"))).alias("code")).where("code <> ''")
    by_code = codes.join(ents.where("code <> ''").select("ticker", "code"), "code").select(key, "ticker")
    longest = F.array_max(F.transform(F.split("name", " "), lambda w: F.struct(F.length(w), w.alias("word"))))["word"]
    named = ents.where("name is not null").select("ticker", "name", longest.alias("word"))
    norm = rows.select(key, normal_name(c("text")).alias("norm"))
    words = norm.select(key, "norm", F.explode(F.array_distinct(F.split("norm", " "))).alias("word"))
    if named.limit(small + 1).count() <= small:
        met = words.join(F.broadcast(named), "word")
    else:
        pairs = words.select(key, "word").join(named, "word").select(c(key).alias("_key"), "ticker", "name")
        met = norm.join(pairs, c(key).eqNullSafe(c("_key")))
    padded = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    by_name = met.where(F.contains(padded(c("norm")), padded(c("name")))).select(key, "ticker")
    return by_code.unionByName(by_name).distinct()


def match_sectors(rows: DataFrame, groups: dict, key: str = "doc_id") -> DataFrame:
    return rows.select(key, F.explode(keyword_groups(c("text"), groups)).alias("sector"))


def all_sectors(keyword_hits: DataFrame, ticker_hits: DataFrame, ents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sectors by keyword and those of matched companies, once per article."""
    more = ticker_hits.join(ents.select("ticker", "sector"), "ticker").where("sector is not null").select(key, "sector")
    return keyword_hits.select(key, "sector").unionByName(more).distinct()


def facts(rows: DataFrame, ents: DataFrame, groups: dict, key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scored articles -> (key, date, score, source_type), (key, ticker), (key, sector), written to the shared folder.

    What all three levels need of the articles is worked out once: texts are read for scores and keywords, and again for
    names, and no more after that.
    """
    spark, work = rows.sparkSession, folders.shared_folder(rows.sparkSession, "articles")

    def kept(d: DataFrame, name: str) -> DataFrame:
        d.write.parquet(f"{work}/{name}")
        return spark.read.schema(d.schema).parquet(f"{work}/{name}")

    own = kept(rows.select(key, "date", "score", "source_type", keyword_groups(c("text"), groups).alias("sectors")), "scores")
    hits = kept(match_entities(rows.select(key, "text"), ents, key), "hits")
    sectors = all_sectors(own.select(key, F.explode("sectors").alias("sector")), hits, ents, key)
    return own.drop("sectors"), hits, sectors


def stock_daily(hits: DataFrame) -> DataFrame:
    """(ticker, date, score, source_type) -> score_sum, sent_score, n (scored), news_count (all), sent_source."""
    source = F.when(F.count_distinct("source_type") > 1, "mixed").when(F.min("source_type") == "backfill", "lexicon_backfill").otherwise("lexicon_live")
    return hits.groupBy("ticker", "date").agg(
        F.coalesce(F.sum("score"), F.lit(0.0)).alias("score_sum"), F.avg("score").alias("sent_score"),
        F.count("score").alias("n"), F.count("*").alias("news_count"), source.alias("sent_source"),
    )


def scored_daily(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sum, count and mean of scored rows by key and date; rows without key go."""
    d = rows.where("score is not null").dropna(subset=by)
    return d.groupBy(*by, "date").agg(F.sum("score").alias("score_sum"), F.count("*").alias("n")).withColumn("sent_score", c("score_sum") / c("n"))


def decay(daily: DataFrame, by: list[str], s: Sentiment = Sentiment()) -> DataFrame:
    """(by, date, score_sum, n) -> every day from first to last, sent_decay; days over window_days after the last scored one go."""
    days = calendar(daily, F.min("date"), F.max("date"), by)
    d = days.join(daily.select(*by, "date", c("score_sum").cast("double"), c("n").cast("double")), [*by, "date"], "left")
    f = 0.5 ** (1.0 / s.half_life)
    d = scan(d, by, "date", {"_s": ("score_sum", f), "_w": ("n", f)})
    last = Series(by, "date").ffill(F.when(c("n") > 0, c("date")))
    d = d.withColumn("_last", last).where(F.datediff("date", "_last") <= s.window_days)
    return d.select(*by, "date", F.when(c("_w") > 1e-9, c("_s") / c("_w")).alias("sent_decay"))


def stock_sentiment(daily: DataFrame, s: Sentiment = Sentiment()) -> DataFrame:
    d = decay(daily, ["ticker"], s).join(daily.select("ticker", "date", "sent_score", "news_count", "sent_source"), ["ticker", "date"], "left")
    return d.select("date", "ticker", "sent_score", "sent_decay", F.coalesce("news_count", F.lit(0)).alias("news_count"), "sent_source")


def market_sentiment(scored: DataFrame, s: Sentiment = Sentiment()) -> DataFrame:
    daily = scored_daily(scored.withColumn("_k", F.lit("all")), ["_k"])
    d = decay(daily, ["_k"], s).join(daily, ["_k", "date"], "left")
    return d.select("date", c("sent_score").alias("market_sent"), c("sent_decay").alias("market_sent_decay"), F.coalesce("n", F.lit(0)).alias("market_news_count"))


def sector_sentiment(rows: DataFrame, s: Sentiment = Sentiment()) -> DataFrame:
    return decay(scored_daily(rows, ["sector"]), ["sector"], s).select("date", "sector", c("sent_decay").alias("sector_sent"))


def sentiment_union(stock: DataFrame, market: DataFrame, sector: DataFrame) -> DataFrame:
    """date, level, entity, sent_score, sent_decay, news_count over the three levels."""
    none = lambda t: F.lit(None).cast(t)
    a = stock.select("date", F.lit("stock").alias("level"), c("ticker").cast("string").alias("entity"), "sent_score", "sent_decay", c("news_count").cast("long"))
    b = market.select("date", F.lit("market").alias("level"), F.lit("MARKET").alias("entity"), c("market_sent").alias("sent_score"), c("market_sent_decay").alias("sent_decay"), c("market_news_count").cast("long").alias("news_count"))
    d = sector.select("date", F.lit("sector").alias("level"), c("sector").alias("entity"), none("double").alias("sent_score"), c("sector_sent").alias("sent_decay"), none("long").alias("news_count"))
    return a.unionByName(b).unionByName(d)
