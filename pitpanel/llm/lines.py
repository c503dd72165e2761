"""Line dedup by an exact set-similarity join, with Spark expressions only.

A line is the set of its words. Words are hashes led by 7 bits of how frequent the word is at most (the count of its hash
bucket over the corpus, on a logarithmic scale), so that sorting puts rare words first. Lines with equal sets are one row;
two different sets of Jaccard similarity at least t share a word among their first n - ceil(t n) + 1 words (prefix filter),
have similar sizes (length filter), enough words left behind that one (positional filter), and parity sketches of 64 bits
(128 or 256 in larger sets) that differ in no more bits than the sets may differ in words; what passes is verified on the
words themselves. A line goes if an earlier line (by doc_id, then place) has an equal or similar set, whether or not that
one stays itself.

Groups of near copies are met first: each set meets, for some of its rare words, the word's first set and the sets just
before its own. Only sets for which that finds no earlier match meet all earlier sets, so that no group is joined with itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.shared import WORD, Scratch, let

#: Hash buckets of words whose counts order them; their number never changes.
BUCKETS = 1 << 18
#: Words of 64 bits in the bitmap that tells which lines take part in candidate pairs; its size never changes.
BITMAP = 1 << 16
#: Words by which a set meets near copies first, and how many sets before its own.
FIRST, BACK = 4, 4
#: Runs of words in which all earlier sets are met, one after the other, so that only one run's postings are on disk at once.
RUNS = 4
#: Largest sets whose sketch has one and two words of 64 bits; larger ones have four. With few bits a word, sketches cannot tell
#: sets somewhat below t from those above it: the nearest set is then often a wrong one, and a group of such sets passes in pairs.
SIZES = (24, 48)
SKETCH = ("s0", "s1", "s2", "s3")


def units(line: Column) -> Column:
    """A line cut at blanks, after other white space has become blanks where there is any: its words and empty strings."""
    other = "\t\x0b\x0c\r"
    odd = F.contains(line, F.lit(other[0]))
    for c in other[1:]:
        odd = odd | F.contains(line, F.lit(c))
    return F.split(F.when(odd, F.translate(line, other, " " * len(other))).otherwise(line), " ", -1)


def words(line: Column) -> Column:
    return F.array_remove(units(line), "")


def rarity(docs: DataFrame) -> Column:
    """Of each hash bucket, 4 log2 of how many words of the corpus fall into it, at most 127: a constant array of fixed size.

    The table passes through the driver: 2^18 small numbers, whatever the corpus.
    """
    of = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).select(F.explode(units(F.col("line"))).alias("w")).where("w <> ''")
    of = of.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("i")).agg(F.count("*").alias("n"))
    out = ["0"] * BUCKETS
    for i, v in of.select("i", F.least(F.lit(127), F.floor(F.log2(F.col("n").cast("double")) * 4)).cast("int")).toPandas().itertuples(index=False):
        out[i] = str(v)
    return F.split(F.lit(",".join(out)), ",").cast("array<bigint>")


def hashes(line: Column) -> Column:
    """Hashes of a line's different words, in any order."""
    return F.array_except(F.transform(units(line), lambda w: F.xxhash64(w)), F.array(F.xxhash64(F.lit(""))))


def by_rarity(hashed: Column, ranks: Column) -> Column:
    rank = lambda h: F.coalesce(F.get(ranks, h.bitwiseAND(F.lit(BUCKETS - 1))), F.lit(0))  # noqa: E731  never null: sorts as plain longs
    return F.sort_array(F.transform(hashed, lambda h: F.call_function("shiftleft", rank(h), F.lit(56)).bitwiseOR(F.shiftrightunsigned(h, 8))))


def split_lines(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), pos, line of every line with a word."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.split("text", "\n", -1).alias("parts"))
    return rows.select("doc_id", "h", F.posexplode("parts").alias("pos", "line")).where(F.col("line").rlike(WORD))


def sketch(name: str) -> list[Column]:
    """Parities of the words of a set by the last 6 bits of their hashes: 64 of them; in larger sets as many of each half or
    quarter of the words, by the bits before those. Those unused are 0."""
    n, none, (one, two) = F.size(name), F.lit(0).cast("long"), SIZES

    def of(mask: int = 0, bits: int = 0) -> Column:
        part = F.filter(name, lambda x: x.bitwiseAND(F.lit(mask).cast("long")) == bits) if mask else F.col(name)
        return F.aggregate(part, none, lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))))

    return [
        F.when(n <= one, of()).when(n <= two, of(128, 0)).otherwise(of(192, 0)).alias("s0"),
        F.when(n <= one, none).when(n <= two, of(128, 128)).otherwise(of(192, 64)).alias("s1"),
        F.when(n <= two, none).otherwise(of(192, 128)).alias("s2"),
        F.when(n <= two, none).otherwise(of(192, 192)).alias("s3"),
    ]


def line_sets(lines: DataFrame, ranks: Column, num: int, den: int) -> DataFrame:
    """Different word sets: id, in the order of `at` (first occurrence: doc_id, h, pos), e (hash of that line), n, sketch, prefix."""
    n = F.size("set")
    prefix = F.slice("set", F.lit(1), n - F.expr(f"(size(set) * {num} + {den - 1}) div {den}").cast("int") + 1)
    at = F.struct("doc_id", "h", "pos", F.xxhash64("line").alias("e")).alias("at")
    rows = lines.select(at, by_rarity(hashes(F.col("line")), ranks).alias("set"))
    rows = rows.select(
        F.xxhash64("set").alias("k1"), F.xxhash64(F.lit(1), "set").alias("k2"), "at", n.alias("n"), *sketch("set"),
        F.transform(prefix, lambda x: F.hash(x)).alias("prefix"),
    )
    rows = rows.groupBy("k1", "k2").agg(F.min("at").alias("at"), *(F.first(c).alias(c) for c in ("n", *SKETCH, "prefix")))
    rows = rows.drop("k1", "k2").repartitionByRange("at").sortWithinPartitions("at")
    return rows.withColumn("id", F.monotonically_increasing_id())


def apart(a: str, b: str) -> str:
    """Bits in which the sketches differ, at the coarser of their sizes: at most the words in which the sets differ."""
    one, two = SIZES
    # quarters 0 and 1 make the lower half; a set of two words has its halves in s0 and s1
    half = lambda x, i: f"if({x}.n > {two}, {x}.s{2 * i} ^ {x}.s{2 * i + 1}, {x}.s{i})"
    whole = "bit_count(" + " ^ ".join(f"{x}.{s}" for x in (a, b) for s in SKETCH) + ")"
    halves = " + ".join(f"bit_count({half(a, i)} ^ {half(b, i)})" for i in (0, 1))
    quarters = " + ".join(f"bit_count({a}.{s} ^ {b}.{s})" for s in SKETCH)
    return f"(case when least({a}.n, {b}.n) <= {one} then {whole} when least({a}.n, {b}.n) <= {two} then {halves} else {quarters} end)"


def may_match(a: str, b: str, num: int, den: int) -> str:
    """Length, positional and sketch filters, and that different sets share fewer words than the larger has."""
    least = f"(({a}.n + {b}.n) * {num} + {num + den - 1}) div {num + den}"
    return (
        f"{a}.n * {den} >= {b}.n * {num} and {b}.n * {den} >= {a}.n * {num} and least({a}.n - {a}.p, {b}.n - {b}.p) >= {least} "
        f"and {least} < greatest({a}.n, {b}.n) and {apart(a, b)} <= {a}.n + {b}.n - 2 * ({least})"
    )


def postings(sets: DataFrame, num: int, den: int, prefix, *more: str) -> DataFrame:
    """A row per set and prefix word (by 32-bit hash: a collision costs a comparison): id, key, n, p (place), sketch."""
    rows = sets.where(f"n * {2 * num} + {num} <= n * {num + den}")  # smaller sets resemble equal ones only
    return rows.select("id", "n", *SKETCH, *more, F.posexplode(prefix).alias("p", "key"))


def first_pairs(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of each set and FIRST words of its prefix, the nearest of the sets that may match among the word's first and those just
    before. The words are those of least hash, so that near copies choose the same ones whatever rare words each has of its own."""
    rows = postings(sets, num, den, F.slice(F.sort_array("prefix"), 1, FIRST)).withColumn("p", F.lit(0))
    w = Window.partitionBy("key").orderBy("id")
    own = F.struct("id", "n", "p", *SKETCH)
    met = F.array(F.first(own).over(w), *(F.lag(own, k).over(w) for k in range(1, BACK + 1)))
    rows = rows.select(own.alias("a"), met.alias("met")).select("a", F.explode("met").alias("b")).where("b.id < a.id")
    # one match is enough, the nearest is tried; a set for which that fails meets all earlier sets afterwards
    near = F.min_by("b.id", F.struct(F.expr(apart("a", "b")), -F.col("b.id")))
    return rows.where(may_match("a", "b", num, den)).groupBy(F.col("a.id").alias("x")).agg(near.alias("y"))


def other_pairs(scratch: Scratch, sets: DataFrame, later: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that may match, of sets not yet known to be later ones with all earlier sets: of a run of words at a time, where
    both sides read one exchange."""
    held, rows = bitmap(scratch, later, "id"), sets.drop("at")
    some = rows.where(held("id")).join(later.withColumn("late", F.lit(1)), "id", "left").withColumn("late", F.coalesce("late", F.lit(0)))
    rows = scratch.cut(rows.where(~held("id")).withColumn("late", F.lit(0)).unionByName(some), "open_sets")  # read by both sides
    every = postings(rows, num, den, F.col("prefix"), "late")
    found = []
    for run in range(RUNS):
        rows = every.where(F.pmod("key", F.lit(RUNS)) == run)
        # a condition on one side alone would be pushed below its exchange, and a column that one side lacks would be pruned
        # there: the other side then could not reuse it
        met = rows.alias("a").join(rows.alias("b"), F.col("a.key") == F.col("b.key")).where("a.late + (b.late & 0) < 1 and b.id < a.id")
        met = met.where(may_match("a", "b", num, den)).select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
        found.append(scratch.cut(met, "run_pairs"))
    return reduce(DataFrame.union, found).distinct()


def bitmap(scratch: Scratch, keys: DataFrame, name: str):
    """A test of columns of longs that all of the `keys` pass, and most others do not while the keys are fewer than the bits.

    It leaves rows out before a join and decides nothing. Its size is fixed; it reaches the tasks as a scalar subquery.
    """
    def place(k: str) -> tuple[Column, Column]:
        x = F.xxhash64(F.lit(7), k)
        return x.bitwiseAND(F.lit(BITMAP - 1)), F.shiftrightunsigned(x, 20).bitwiseAND(F.lit(63)).cast("int")

    word, bit = place(name)
    marks = keys.groupBy(word.alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("m"))
    all_ = keys.sparkSession.range(BITMAP).withColumnRenamed("id", "i").join(marks, "i", "left")
    listed = F.array_sort(F.collect_list(F.struct("i", F.coalesce("m", F.lit(0)).alias("m"))))
    marks = scratch.cut(all_.groupBy().agg(F.transform(listed, lambda x: x["m"]).alias("marks")), "marks").scalar()

    def test(k: str) -> Column:
        word, bit = place(k)
        return F.call_function("shiftrightunsigned", F.get(marks, word.cast("int")), bit).bitwiseAND(F.lit(1)) == 1

    return test


def later_sets(scratch: Scratch, pairs: DataFrame, sets: DataFrame, lines: DataFrame, num: int, den: int) -> DataFrame:
    """Of the candidate pairs (x, y), x behind y, those x that are similar to y, by the words of the lines themselves.

    The lines of the sets in pairs come from the texts; bitmaps leave most other sets and lines out before the joins.
    """
    met = scratch.cut(pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "met_ids")
    met = sets.where(bitmap(scratch, met, "id")("id")).join(met, "id").select("id", "at.doc_id", "at.h", "at.pos", "at.e")
    met = scratch.cut(met, "met_sets")
    wanted = met.select("id", F.col("doc_id").alias("d"), "h", "pos")
    # the first test goes below the splitting of texts into lines
    held = lines.where(bitmap(scratch, met, "h")("h")).withColumn("e", F.xxhash64("line")).where(bitmap(scratch, met, "e")("e"))
    held = held.join(wanted, ["h", "pos"]).where(F.col("doc_id").eqNullSafe(F.col("d"))).groupBy("id").agg(F.first("line").alias("line"))
    held = scratch.cut(held.withColumn("n", F.size(F.array_distinct(words(F.col("line"))))), "met_lines")
    one = lambda s: held.select(F.col("id").alias(s), F.col("line").alias(f"line_{s}"), F.col("n").alias(f"n_{s}"))
    common = F.size(F.array_intersect(words(F.col("line_x")), words(F.col("line_y"))))
    # common / (n_x + n_y - common) >= num / den
    alike = pairs.join(one("x"), "x").join(one("y"), "y").where(common.cast("long") * (den + num) >= (F.col("n_x").cast("long") + F.col("n_y")) * num)
    out = scratch.cut(alike.select(F.col("x").alias("id")).distinct(), "later")
    scratch.drop("met_ids", "met_sets", "met_lines", "marks")
    return out


def dedup_lines(docs: DataFrame, num: int = 8, den: int = 10) -> DataFrame:
    """docs(doc_id, text, ...) -> its columns with the text's remaining lines, n_lines and n_removed (long); t = num / den.

    Lines without a word never go. A null text stays null (no lines); a null doc_id comes first in the order; rows equal in
    doc_id and text are one document and get one result; other columns pass unchanged, whatever their names, but for
    n_lines and n_removed, which the new ones replace. An empty table gives no rows. Words are told apart by 56-bit hashes
    where sets are found equal, by themselves where they are found similar.
    """
    scratch = Scratch(docs.sparkSession)
    src = docs.select("doc_id", "text").where("text is not null")
    lines = split_lines(src)
    sets = scratch.cut(line_sets(lines, rarity(src), num, den), "sets")
    pairs = scratch.cut(first_pairs(sets, num, den), "line_pairs")
    later = later_sets(scratch, pairs, sets, lines, num, den)
    scratch.drop("line_pairs")
    pairs = scratch.cut(other_pairs(scratch, sets, later, num, den), "line_pairs")
    scratch.drop("open_sets", "run_pairs")
    later = later.union(later_sets(scratch, pairs, sets, lines, num, den))
    kept = sets.join(later, "id", "left_anti").select("at.doc_id", "at.h", "at.pos").groupBy("doc_id", "h").agg(F.collect_list("pos").alias("kept"))
    kept = scratch.cut(kept, "kept_lines")
    scratch.drop("line_pairs", "later", "sets", "marks")

    given = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.xxhash64("text").alias("h"))
    # a hash table of places by document, so that texts are dealt out but not sorted
    out = given.alias("d").join(kept.alias("k").hint("shuffle_hash"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.h") == F.col("k.h")), "left")
    out = out.select("d.row", "d.text", F.coalesce("k.kept", F.array().cast("array<int>")).alias("kept"))

    def rest(parts: Column) -> Column:
        gone = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("kept"))
        stay = F.filter(gone, lambda i: ~F.get(parts, i).rlike(WORD))
        order = F.sort_array(F.concat(F.col("kept"), stay))
        left = F.when(F.size("kept") == F.size(parts), parts).otherwise(F.transform(order, lambda i: F.get(parts, i)))
        return F.struct(left.alias("lines"), F.size(parts).alias("n"))

    out = out.withColumn("rest", let(F.split("text", "\n", -1), rest))
    new = {
        "text": F.array_join("rest.lines", "\n"), "n_lines": F.coalesce(F.col("rest.n"), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.col("rest.n") - F.size("rest.lines"), F.lit(0)).cast("long"),
    }
    same = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*(new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in [*same, "n_lines", "n_removed"]))
