"""Spelling variants of words without pairs: wildcard groups and deletions meet by key, and only counts and the best travel on.

A word of L code points has L wildcard keys (prefix, `*`, suffix). Words with a common key differ by one replaced code point and
share that key alone, so the sizes of a word's groups, less itself, add up to the number of its near words by replacement; the
best of them is the group's first word, or its second for the first itself. A group holds no more words than the alphabet has
letters. A word's different deletions meet the vocabulary by equality: each deletion row learns of the word that equals it, and
that word learns how many deletions equal it and the best of their words (at most an alphabet for each place). Words of more
than `LONG` code points, whose keys would take the square of their length, have keys of 127-bit hashes of prefixes and suffixes
instead and travel as numbers in code-point order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.shared import Scratch, drop_path, new_path, write

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Regular expression (Java and RE2) of a letter.
LETTER = r"[A-Za-z\x{C0}-\x{FF}]"
LEAST_LENGTH, LEAST_COUNT, TIMES, LONG = 6, 5, 5, 256
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1B873593


def lowered(run: Column) -> Column:
    """A-Z lowered and nothing else, of a run of letters."""
    return F.when(run.rlike(r"[\x{C0}-\x{DE}]"), F.translate(run, UPPER, LOWER)).otherwise(F.lower(run))


def runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, text) -> doc_id, run: maximal runs of at least so many letters, lowered, repeats included."""
    found = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTER}{{{least},}}"), F.lit(0)))
    return docs.select("doc_id", found.alias("run")).select("doc_id", lowered(F.col("run")).alias("run"))


def typos(found: DataFrame, every: int = 199) -> DataFrame:
    """(doc_id, run) -> word: the run, or, where `every` divides the crc32 of `<doc_id>:<run>`, the run without one letter."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    d = found.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return d.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST_COUNT, length: int = LEAST_LENGTH) -> DataFrame:
    """word -> word, n, of words with at least so many code points and occurrences."""
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _hashed(long: int):
    """mapInPandas function: (word, id, n) of words of at least `long` code points -> key, w, n, kind with hashed keys.

    Kind 0: a wildcard key, 1: a deletion, 2: the word itself. A word of exactly `long` has the last alone; the rest it has as text.
    """
    def keys(word: str):
        ahead, powers = [0], [1]
        for ch in word:
            ahead.append((ahead[-1] * BASE + ord(ch)) % PRIME)
            powers.append(powers[-1] * BASE % PRIME)
        size = len(word)
        yield f"{size}={ahead[-1]:x}", 2
        for i, ch in enumerate(word) if size > long else ():
            tail = (ahead[-1] - ahead[i + 1] * powers[size - i - 1]) % PRIME
            yield f"{size}:{i}:{ahead[i]:x}:{tail:x}", 0
            if i + 1 == size or ch != word[i + 1]:
                yield f"{size - 1}={(ahead[i] * powers[size - i - 1] + tail) % PRIME:x}", 1

    def run(batches):
        from itertools import batched

        import pandas as pd

        rows = ((key, number, n, kind) for pdf in batches for word, number, n in pdf[["word", "id", "n"]].itertuples(index=False) for key, kind in keys(word))
        for part in batched(rows, 100_000):
            yield pd.DataFrame(part, columns=["key", "w", "n", "kind"])

    return run


def _texts(words: DataFrame, long: int) -> DataFrame:
    """(word, n) of words of at most `long` code points -> key, w, n, kind, as above with keys of text."""
    w = F.col("word")
    at = words.where(F.length("word") <= long).select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    before, after = F.substring(w, F.lit(1), F.col("i") - 1), F.substring(w, F.col("i") + 1, F.length(w))
    last = (F.col("i") == F.length(w)) | (F.substring(w, F.col("i"), F.lit(1)) != F.substring(w, F.col("i") + 1, F.lit(1)))
    wild = at.select(F.concat(before, F.lit("*"), after).alias("key"), w.alias("w"), "n", F.lit(0).alias("kind"))
    less = at.where(last).select(F.concat(before, after).alias("key"), w.alias("w"), "n", F.lit(1).alias("kind"))
    own = words.where(F.length("word") < long).select(w.alias("key"), w.alias("w"), "n", F.lit(2).alias("kind"))
    return wild.unionByName(less).unionByName(own)


def _counted(keys: DataFrame) -> DataFrame:
    """(key, w, n, kind) -> w, near, best: for every row with near words under its key their number and (-n, w) of the best."""
    me, group = F.struct((-F.col("n")).alias("less"), F.col("w")), Window.partitionBy("key")
    # both kinds of keys share one exchange: none of one kind equals one of the other
    d = keys.repartition("key")
    order = group.orderBy(F.desc("n"), "w")
    wild = d.where("kind = 0").select("w", (F.count("*").over(group) - 1).alias("near"), F.coalesce(F.when(F.row_number().over(order) > 1, F.first(me).over(order)), F.lead(me).over(order)).alias("best"))
    own, less = F.col("kind") == 2, F.col("kind") == 1
    meet = d.where("kind > 0").select(
        "w", F.when(own, F.count(F.when(less, 1)).over(group)).otherwise(F.count(F.when(own, 1)).over(group)).alias("near"),
        F.when(own, F.min(F.when(less, me)).over(group)).otherwise(F.min(F.when(own, me)).over(group)).alias("best"),
    )
    return wild.unionByName(meet).where("near > 0")


def near_words(words: DataFrame, scratch: Scratch, long: int = LONG) -> DataFrame:
    """(word, n), written -> word, n_near, best, best_n, for words that have near words."""
    found = _counted(_texts(words, long))
    longer = words.where(F.length("word") >= long)
    if not longer.isEmpty():
        ordered = longer.repartitionByRange("word").sortWithinPartitions("word")
        ids = scratch.cut(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "long_words")
        by_id = _counted(ids.mapInPandas(_hashed(long), "key string, w long, n long, kind int"))
        name = ids.select(F.col("id").alias("w"), "word")
        best = ids.select(F.col("id").alias("best_id"), F.col("word").alias("w"))
        by_id = by_id.join(name, "w").select("word", "near", F.col("best.less").alias("less"), F.col("best.w").alias("best_id")).join(best, "best_id")
        found = found.unionByName(by_id.select(F.col("word").alias("w"), "near", F.struct("less", "w").alias("best")))
    r = found.groupBy(F.col("w").alias("word")).agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return r.select("word", "n_near", F.col("best.w").alias("best"), (-F.col("best.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> word, root: forms followed to the last, by doubling the steps; counts rise along a chain, so it is short."""
    spark, path = forms.sparkSession, new_path(forms.sparkSession, "roots")
    now = write(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), path)
    while not now.where("moved").isEmpty():
        nxt = new_path(spark, "roots")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        now = write(now.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), nxt)
        drop_path(spark, path)
        path = nxt
    return now.select("word", "root")


def variants(docs: DataFrame, every: int = 199, least: int = LEAST_COUNT, length: int = LEAST_LENGTH, times: int = TIMES, long: int = LONG) -> DataFrame:
    """(doc_id, text) -> word, form, root, n, n_near, form_n, a row per word of the vocabulary.

    A word's form is its near word (one code point inserted, deleted or replaced) of largest n, of equal ones the smallest in
    code-point order, if it has at least `times` the word's n; its root the end of its chain of forms, or itself. Null and
    empty texts have no words; a null doc_id counts as empty in the hash; repeated rows count each; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    words = scratch.cut(vocabulary(typos(runs(docs, length), every), least, length), "words")
    near = scratch.cut(near_words(words, scratch, long), "near_words")
    scratch.drop("long_words")
    d = words.join(near, "word", "left")
    has = F.col("best_n") >= times * F.col("n")
    d = scratch.cut(d.select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_n")).alias("form_n")), "forms")
    scratch.drop("words", "near_words")
    ends = roots(d.where("form is not null").select("word", "form"))
    return d.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
