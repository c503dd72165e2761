"""Feed bodies held as column values: RSS and Atom to articles, with a reason for each body that gives none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.text import clean_html

c = F.col
_ITEM = "struct<title:string,link:string,description:string,summary:string,pubDate:string,updated:string,`dc:date`:string>"
_ENTRY = "struct<title:string,link:array<struct<_href:string,_rel:string,_VALUE:string>>,summary:string,content:string,published:string,updated:string>"
#: Of RSS the items lie in a channel, or beside it (RSS 1.0); of Atom the entries lie in the root.
BODY = f"channel struct<item:array<{_ITEM}>>, item array<{_ITEM}>, entry array<{_ENTRY}>, _bad string"
PATTERNS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yy HH:mm:ss Z", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd")


def moment(text: Column) -> Column:
    """The time of a feed's date in any of the usual forms, else NULL."""
    plain = F.trim(F.regexp_replace(text, r"^\s*\w+,\s*", ""))
    return F.coalesce(*(F.try_to_timestamp(plain, F.lit(p)) for p in PATTERNS))


def items(bodies: DataFrame) -> DataFrame:
    """(body, ...) -> the other columns, reason, items: array of title, summary, link, published (NULL where undated).

    reason is NULL for a feed, also one without items, else `empty` or `not a feed`.
    """
    keep = [x for x in bodies.columns if x != "body"]
    parsed = F.from_xml("body", BODY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    d = bodies.select(*keep, "body", F.when(F.trim(F.coalesce("body", F.lit(""))) != "", parsed).alias("x"))

    def rss(i):
        return F.struct(i["title"].alias("title"), F.coalesce(i["summary"], i["description"]).alias("summary"), i["link"].alias("link"), F.coalesce(moment(i["pubDate"]), moment(i["updated"]), moment(i["dc:date"])).alias("published"))

    def atom(e):
        way = F.filter(e["link"], lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
        first = F.get(F.when(F.size(way) > 0, way).otherwise(e["link"]), F.lit(0))
        return F.struct(e["title"].alias("title"), F.coalesce(e["summary"], e["content"]).alias("summary"), F.coalesce(first["_href"], first["_VALUE"]).alias("link"), F.coalesce(moment(e["published"]), moment(e["updated"])).alias("published"))

    none = F.array().cast("array<struct<title:string,summary:string,link:string,published:timestamp>>")
    many = F.concat(*(F.coalesce(F.transform(x, f), none) for x, f in ((c("x.channel.item"), rss), (c("x.item"), rss), (c("x.entry"), atom))))
    empty = F.trim(F.coalesce("body", F.lit(""))) == ""
    # an empty feed has a root of the right name, or a channel
    root = F.col("body").rlike(r"(?s)^\s*(<\?[^>]*>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<(\w+:)?(rss|RDF|feed)\b")
    reason = F.when(empty, "empty").when(c("x._bad").isNotNull() | c("x").isNull() | ~root, "not a feed")
    return d.select(*keep, reason.alias("reason"), F.when(reason.isNull(), many).otherwise(none).alias("items"))


def articles(decoded: DataFrame, as_of: str | None = None) -> DataFrame:
    """Decoded bodies (source, feed_url, lang, items[, query]) -> articles; an undated one gets `as_of`, if given; untitled ones go."""
    keep = [x for x in decoded.columns if x not in ("items", "reason")]
    d = decoded.select(*keep, F.explode("items").alias("i"))
    when = c("i.published") if as_of is None else F.coalesce(c("i.published"), F.lit(as_of).cast("timestamp"))
    d = d.select(*keep, clean_html(c("i.title")).alias("title"), clean_html(c("i.summary")).alias("summary"), F.trim(F.coalesce("i.link", F.lit(""))).alias("link"), when.alias("published"))
    return d.where(F.length(F.trim("title")) > 0)


# archive of snapshots -----------------------------------------------------------------------------------------------
LEDGER = "feed_url string, timestamp string, outcome string, reason string, n int"
DONE = ("done", "empty")


def wanted(index: DataFrame, ledger: DataFrame, per_run: int = 5000) -> DataFrame:
    """(feed_url, timestamp, statuscode) of an archive's index -> feed_url, timestamp of the snapshots to decode: the first good one
    of each feed and day, less those the ledger calls done or empty, oldest first and at most `per_run` of a feed."""
    good = index.where("statuscode = '200'").groupBy("feed_url", F.substring("timestamp", 1, 8).alias("day")).agg(F.min("timestamp").alias("timestamp"))
    left = good.join(ledger.where(c("outcome").isin(*DONE)).select("feed_url", "timestamp"), ["feed_url", "timestamp"], "left_anti")
    w = Window.partitionBy("feed_url").orderBy("timestamp")
    return left.withColumn("_n", F.row_number().over(w)).where(c("_n") <= per_run).select("feed_url", "timestamp").orderBy("timestamp")


def outcomes(todo: DataFrame, bodies: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshots to decode and landed bodies (feed_url, timestamp, status, body[, _seq]) -> (decoded bodies, ledger rows).

    names: feed_url, source, lang of the feeds. A body with a status other than 200, none at all or no feed fails, with its
    reason, and is tried again when a newer body lands; a snapshot without a body stays to be fetched and gets no ledger row.
    """
    from pitpanel.operators.dedupe import keep_last

    order = [x for x in ("_seq",) if x in bodies.columns] or ["status", "body"]
    last = keep_last(bodies, ["feed_url", "timestamp"], order).join(todo, ["feed_url", "timestamp"], "left_semi").join(names, "feed_url")
    refused = F.coalesce(c("status"), F.lit(200)) != 200
    d = items(last.select("feed_url", "timestamp", "source", "lang", F.when(refused, F.concat(F.lit("status "), c("status").cast("string"))).alias("_refused"), "body"))
    d = d.withColumn("reason", F.coalesce("_refused", "reason")).drop("_refused")
    d = d.withColumn("items", F.when(c("reason").isNull(), c("items")).otherwise(F.slice("items", 1, 0)))
    n = F.size("items")
    outcome = F.when(c("reason").isNotNull(), "failed").when(n == 0, "empty").otherwise("done")
    return d, d.select("feed_url", "timestamp", outcome.alias("outcome"), "reason", n.cast("int").alias("n"))
