"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The mix is a number of blocks of `BLOCK` words. They go to the sources by highest quotients target / (2k + 1), which gives each
source an integer quota, near its target to a block; a source's quota goes to its shards in the same way, by their words. A shard
holds its documents in a seeded order as one stream of words, cut into blocks of that length, of which only the last may be
shorter; so many whole blocks are chosen in a seeded order, all of them once before any is taken twice, the short one last. What a
source's quota lacks or exceeds of its target, a block or so, its first shards with room add or leave out: the last block chosen
there is cut. So sources smaller than a block meet their target, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.shared import SPACE, WORD, Scratch, join_small, let

#: Words of a block, and of a source's shard (on average).
BLOCK, SHARD_WORDS = 256, 1 << 20
WEIGHTS = (3, 1, 2)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> source, source_size, target.

    Sources in code-point order, null last, take the weights in turn and share `share` times all words; no target is over
    `most` times its source's words, the excess goes to the others by weight until none is above. All of it in one row per
    source: with sources by rising cap/weight, the level at which the rest is shared is where the caps met so far fit.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w.cast("double")).withColumn("cap", F.col("source_size") * most)
    total = Window.partitionBy()
    s = s.withColumn("all", F.sum("source_size").over(total) * F.lit(float(share))).withColumn("ratio", F.col("cap") / F.col("w"))
    rise = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest = rise.rowsBetween(Window.unboundedPreceding, -1), rise.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    s = s.withColumn("level", F.when(level <= F.col("ratio"), level))
    level = F.max("level").over(total)
    return s.select("source", "source_size", F.least("cap", F.coalesce(F.col("w") * level, F.col("cap"))).alias("target"))


def seats(units: DataFrame, by: list[str]) -> DataFrame:
    """(by, unit, share, cap, all) -> with `quota`, the Sainte-Lague seats of each unit: of a group's `all` seats by share / (2k + 1).

    Equal quotients go to the smaller unit; no unit has more than `cap`. Of a group with n units and Q seats, a unit's are near
    q = Q * share / all shares: those below q - w are its own, and the places to q + w compete, so that few rows are made.
    """
    of = Window.partitionBy(*by)
    s = units.withColumn("q", F.col("share") * F.col("all") / F.greatest(F.sum("share").over(of), F.lit(1e-300)))
    s = s.withColumn("w", F.ceil(F.col("q") * F.count("*").over(of) / F.greatest("all", F.lit(1))) + 2)
    s = s.withColumn("base", F.least(F.greatest(F.floor("q") - F.col("w"), F.lit(0)), "cap")).withColumn("top", F.least(F.floor("q") + F.col("w"), "cap"))
    s = s.withColumn("open", F.col("all") - F.sum("base").over(of))
    offers = s.where("top > base").withColumn("k", F.explode(F.sequence("base", F.col("top") - 1)))
    rank = of.orderBy(F.desc(F.col("share") / (2 * F.col("k") + 1)), F.asc_nulls_last("unit"), "k")
    won = offers.withColumn("rank", F.row_number().over(rank)).where("rank <= open").groupBy(*by, "unit").agg(F.count("*").alias("won"))
    on = F.lit(True)
    for x in (*by, "unit"):
        on = on & F.col(f"s.{x}").eqNullSafe(F.col(f"o.{x}"))
    return s.alias("s").join(won.alias("o"), on, "left").select(*(f"s.{x}" for x in units.columns), (F.col("s.base") + F.coalesce("o.won", F.lit(0))).cast("long").alias("quota"))


def plan(docs: DataFrame, seed: int = 7, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """docs(doc_id, text, source) -> one row per row: doc_id, source, h (hash of the text), size, source_size, target, taken, at, block, copies, cut_at, cut_words.

    The row lies at words [at, at + size) of its stream; `copies` holds how often the mix takes each block of `block` words
    that it touches (null without words), and block number `cut_at` of the stream once more as far as its first `cut_words` words.
    Null texts have size 0, a null source is a source of its own, repeated rows are
    rows of their own, other columns are ignored, an empty table gives an empty table. Texts are not shuffled.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.cut(docs.select("doc_id", "source", F.xxhash64("text").alias("h"), n_words(F.col("text")).alias("size")), "sizes")
    by_source = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    by_source = by_source.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / F.lit(SHARD_WORDS)), F.lit(1)))
    by_source = scratch.cut(by_source.withColumn("whole", F.round("target").cast("long")), "targets")
    total = F.round(F.sum("whole").over(Window.partitionBy()) / F.lit(BLOCK)).cast("long")
    # a source may take each word `most` times, and half a block is added or left out in the end
    cap = F.ceil(F.col("source_size") * F.lit(float(most)) / F.lit(BLOCK)).cast("long")
    units = by_source.select(F.lit(0).alias("g"), F.col("source").alias("unit"), F.col("target").alias("share"), cap.alias("cap"), total.alias("all"))
    of_source = seats(units, ["g"]).select(F.col("unit").alias("source"), "quota")
    by_source = by_source.alias("s").join(of_source.alias("q"), F.col("s.source").eqNullSafe(F.col("q.source"))).select("s.*", "quota")
    by_source = scratch.cut(by_source, "source_quotas")

    rows = join_small(rows, by_source.drop("quota").withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "inner", 10_000).drop("_source")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("shards")).cast("int"))
    stream = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size", "h")
    rows = rows.withColumn("at", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = scratch.cut(rows.select("doc_id", "source", "h", "size", "source_size", "target", "shard", "at"), "streams")
    s = scratch.cut(chosen(rows.where("size > 0").groupBy("source", "shard").agg(F.sum("size").alias("words")), by_source, seed, most), "stream_quotas")

    out = join_small(rows, s.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "blocks", "once", "last", "cut_at", "cut_words"), (F.col("shard") == F.col("_shard")) & F.col("source").eqNullSafe(F.col("_source")), "left", 100_000)
    block = F.lit(BLOCK).cast("long")
    first, last = F.expr(f"cast(at div {BLOCK} as int)"), F.expr(f"cast((at + size - 1) div {BLOCK} as int)")
    touched = F.when(F.col("size") > 0, F.transform(F.sequence(first, last), lambda j: F.col("once") + F.coalesce((j < F.col("blocks") - 1) & (_place(seed, j) <= F.col("last")), F.lit(False)).cast("int")))
    out = out.withColumn("copies", touched)
    overlap = lambda a, b: F.greatest(F.least(b, F.col("at") + F.col("size")) - F.greatest(a, F.col("at")), F.lit(0).cast("long"))
    held = F.transform("copies", lambda x, i: x * overlap((first + i) * block, (first + i + 1) * block))
    more = F.when(F.col("cut_at").isNotNull(), overlap(F.col("cut_at") * block, F.col("cut_at") * block + F.col("cut_words"))).otherwise(F.lit(0))
    taken = F.when(F.col("size") > 0, F.aggregate(held, F.lit(0).cast("long"), lambda a, x: a + x) + more).otherwise(F.lit(0).cast("long"))
    return out.select("doc_id", "source", "h", "size", "source_size", "target", taken.alias("taken"), "at", block.alias("block"), "copies", "cut_at", "cut_words")


def _place(seed: int, j: Column) -> Column:
    """A block's place in the seeded order of its stream."""
    return F.struct(F.xxhash64(F.lit(seed + 2), "source", "shard", j).alias("h"), j.alias("j"))


def chosen(streams: DataFrame, by_source: DataFrame, seed: int, most: float) -> DataFrame:
    """(source, shard, words) and the sources' quotas -> which blocks each stream takes: all `once` times, the whole ones up to
    place `last` once more, and of block `cut_at` the first `cut_words` words."""
    s = streams.alias("t").join(by_source.alias("q"), F.col("t.source").eqNullSafe(F.col("q.source"))).select("t.*", "q.whole", F.col("q.quota").alias("all"))
    cap = F.ceil(F.col("words") * F.lit(float(most)) / F.lit(BLOCK)).cast("long")
    got = seats(s.select("source", F.col("shard").alias("unit"), F.col("words").cast("double").alias("share"), cap.alias("cap"), "all", "words", "whole"), ["source"])
    # what whole blocks lack of the source's words, or exceed, the first streams that have room add or leave out
    of = Window.partitionBy("source")
    got = got.withColumn("most", F.floor(F.col("words") * F.lit(float(most))).cast("long")).withColumn("own", F.least(F.col("quota") * BLOCK, "most"))
    got = got.withColumn("lack", F.col("whole") - F.sum("own").over(of)).withColumn("room", F.when(F.col("lack") > 0, F.col("most") - F.col("own")).otherwise(F.col("own")))
    left = F.greatest(F.abs("lack") - (F.sum("room").over(of.orderBy("unit").rowsBetween(Window.unboundedPreceding, 0)) - F.col("room")), F.lit(0))
    budget = (F.col("own") + F.signum("lack").cast("long") * F.least(left, F.col("room"))).cast("long")
    d = got.select("source", F.col("unit").alias("shard"), "words", budget.alias("budget")).withColumn("blocks", F.expr(f"cast((words + {BLOCK - 1}) div {BLOCK} as int)"))
    d = d.withColumn("once", F.expr("cast(budget div words as int)")).withColumn("rest", F.col("budget") % F.col("words"))
    d = d.withColumn("k", F.expr(f"cast(rest div {BLOCK} as int)")).withColumn("cut_words", F.col("rest") % BLOCK)
    ids = F.when(F.col("blocks") > 1, F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(F.col("blocks") - 2, F.lit(0))), lambda j: _place(seed, j))))
    found = let(ids, lambda x: F.struct(F.get(x, F.col("k") - 1).alias("last"), F.coalesce(F.get(x, F.col("k"))["j"], F.col("blocks") - 1).alias("next")))
    d = d.withColumn("found", found)
    return d.select("source", "shard", "blocks", "once", F.when(F.col("k") > 0, F.col("found.last")).alias("last"), F.when(F.col("cut_words") > 0, F.col("found.next")).alias("cut_at"), "cut_words")


def mixed(docs: DataFrame, seed: int = 7, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: docs' columns, a row for each copy of a document, its text the words whose blocks that copy takes.

    A text that is taken whole stays as it is; rows of which nothing is taken go. Columns may have any names.
    """
    chosen = Scratch(docs.sparkSession).cut(plan(docs, seed, weights, share, most).where("taken > 0"), "mix_plan").alias("c")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text", F.xxhash64("text").alias("h"))
    on = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.h") == F.col("c.h"))
    if chosen.groupBy("doc_id", "source", "h").count().where("count > 1").limit(1).count():  # repeated rows: one to one
        rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "source", "h").orderBy("h")))
        chosen = chosen.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "source", "h").orderBy("at"))).alias("c")
        on = on & (F.col("d.n") == F.col("c.n"))
    met = rows.alias("d").join(chosen, on).select("d.row", "d.text", "c.at", "c.block", "c.copies", "c.cut_at", "c.cut_words", "c.size")
    reach = lambda x: F.when(F.col("cut_at").isNotNull(), x)
    met = met.withColumn("cut", reach(F.greatest(F.col("cut_at") * F.col("block"), "at"))).withColumn("cut_end", reach(F.least(F.col("cut_at") * F.col("block") + F.col("cut_words"), F.col("at") + F.col("size"))))
    more = F.when(F.col("cut_end") > F.col("cut"), F.get("copies", (F.col("cut_at") - F.floor(F.col("at") / F.col("block"))).cast("int")) + 1)
    once = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.array_max("copies"), more))))
    words = F.regexp_extract_all("text", F.lit(f"(?:{SPACE})?{WORD}"), F.lit(0))
    place = lambda i: (F.floor((F.col("at") + i) / F.col("block")) - F.floor(F.col("at") / F.col("block"))).cast("int")
    inside = lambda i: (F.col("at") + i >= F.col("cut")) & (F.col("at") + i < F.col("cut_end"))
    part = F.ltrim(F.array_join(F.filter(words, lambda w, i: F.get("copies", place(i)) + F.coalesce(inside(i), F.lit(False)).cast("int") >= F.col("copy")), ""))
    text = F.when(F.array_min("copies") >= F.col("copy"), F.col("text")).otherwise(part)
    return once.select(*(text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
