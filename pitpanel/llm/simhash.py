"""SimHash fingerprints and their links by anchor-point covering.

The first 62 of 64 bits are two blocks of 31. Two fingerprints at 3 or fewer differing bits differ by at most one bit in
one of the blocks. The anchors of a block are the words of the perfect Hamming code of length 31 (a covering code of
radius 1, 2^26 anchors). In each block a fingerprint has its one home anchor at distance 0 or 1, and is replicated to
every anchor within covering radius + 1 = 2 (one, or 16); so each link is met at the home anchor of its smaller end.
Fingerprints that are equal are one row; links are between different fingerprints only.

Three bits find texts that are all but equal. With `alike`, a second search finds pairs by the Jaccard similarity of their
sets of shingles: each text has BANDS keys over ROWS minima of permuted shingle hashes, of which a pair of similarity 0.8
shares one with probability 1 - (1 - 0.8^4)^20 = 0.99997; pairs that share a key are verified on the whole sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.components import components
from pitpanel.llm.shared import cut

#: Bits where the i-th binary digit of the 1-based position is set: the parity checks of the Hamming code of length 31.
CHECKS = [sum(1 << (p - 1) for p in range(1, 32) if p >> i & 1) for i in range(5)]
BLOCK = (1 << 31) - 1
#: Keys of a text in the second search, and minima in each.
BANDS, ROWS = 20, 4


def _shingles(words: list[bytes], width: int):
    if len(words) < width:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(width))))


def _band_keys(x):
    """The keys of a set of shingle hashes (an array of them, not empty)."""
    import numpy as np
    from xxhash import xxh64_intdigest

    r = np.random.RandomState(42)
    odd, plus = r.randint(0, 1 << 62, (2, BANDS * ROWS, 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for i in range(0, len(x), 1024):
        y = x[i : i + 1024] * odd + plus
        y ^= y >> np.uint64(32)
        low = np.minimum(low, (y * np.uint64(0x9E3779B97F4A7C15)).min(axis=1))
    return np.array([xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(low.reshape(BANDS, ROWS))], np.uint64)


def _lists(pa, np, values: list):
    at = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)))


def _whole_sets(width: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        for batch in batches:
            sets = [np.unique(np.fromiter((xxh64_intdigest(s, 42) for s in _shingles(t.as_py().encode().lower().split(), width)), np.uint64)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("k"), _lists(pa, np, sets)], ["k", "v"])

    return run


def _fingerprints(width: int, chunk: int, keyed: bool = False):
    def run(batches):
        from array import array

        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        def bits(hashes: list[int]):
            return np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")

        for batch in batches:
            n = batch.num_rows
            ones, total = np.zeros((n, 64), np.int64), np.zeros(n, np.int64)
            held, of = [], []
            sets, keys = [], []

            def flush():
                if held:
                    b = bits(held)
                    starts = np.flatnonzero(np.r_[True, np.diff(of) != 0])
                    rows = np.array(of)[starts]
                    np.add.at(ones, rows, np.add.reduceat(b, starts, axis=0, dtype=np.int64))
                    np.add.at(total, rows, np.diff(np.r_[starts, len(of)]))
                    held.clear()
                    of.clear()

            for i, text in enumerate(batch.column("text")):
                raw = text.as_py()
                mine = array("Q")
                for s in _shingles(raw.encode().lower().split(), width) if raw else ():  # bytes: only A-Z, only ASCII white space
                    held.append(xxh64_intdigest(s, 42))
                    of.append(i)
                    if keyed:
                        mine.append(held[-1])
                    if len(held) >= chunk:
                        flush()
                if keyed:
                    x = np.unique(np.array(mine, np.uint64))
                    sets.append(xxh64_intdigest(x.tobytes(), 7))
                    keys.append(_band_keys(x) if len(x) else x)
            flush()
            fp = np.packbits(ones * 2 > total[:, None], axis=1, bitorder="little").view("<i8").ravel()
            cols = {"doc_id": batch.column("doc_id"), "fp": pa.array(fp, pa.int64())}
            if keyed:
                cols |= {"h": batch.column("h"), "k": pa.array(np.array(sets, np.uint64).view(np.int64)), "keys": _lists(pa, np, keys)}
            yield pa.RecordBatch.from_pydict(cols)

    return run


def fingerprints(docs: DataFrame, width: int = 3, chunk: int = 1 << 17) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp long). A text without words (or null) has fingerprint 0; other columns are ignored."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInArrow(_fingerprints(width, chunk), "doc_id long, fp long")


def keyed_fingerprints(docs: DataFrame, width: int, chunk: int = 1 << 17) -> DataFrame:
    """fingerprints with h (hash of the text), k (hash of its set of shingles) and its keys for the second search."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    return src.mapInArrow(_fingerprints(width, chunk, True), "doc_id long, fp long, h long, k long, keys array<long>")


def _syndrome(x: Column) -> Column:
    s = F.lit(0).cast("long")
    for i, mask in enumerate(CHECKS):
        s = s + (F.bit_count(x.bitwiseAND(F.lit(mask))) % 2).cast("long") * (1 << i)
    return s


def links(fps: DataFrame, most: int = 3) -> DataFrame:
    """(fp) distinct -> (a, b), a < b: all pairs at 1 to `most` (at most 3) differing bits."""
    blocks = fps.select("fp", F.explode(F.array(*(
        F.struct(F.lit(k).alias("k"), F.shiftrightunsigned("fp", 31 * k).bitwiseAND(F.lit(BLOCK)).alias("x")) for k in (0, 1)
    ))).alias("p")).select("fp", "p.k", "p.x", _syndrome(F.col("p.x")).alias("s"))

    def flip(p: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (p - 1).cast("int"))

    home = F.when(F.col("s") == 0, F.col("x")).otherwise(F.col("x").bitwiseXOR(flip(F.col("s"))))
    near = F.transform(
        F.filter(F.sequence(F.lit(1).cast("long"), F.lit(31).cast("long")), lambda p: p < p.bitwiseXOR(F.col("s"))),
        lambda p: F.col("x").bitwiseXOR(flip(p)).bitwiseXOR(flip(p.bitwiseXOR(F.col("s")))),
    )
    key = F.col("anchor") * 2 + F.col("k")
    homes = blocks.select("k", home.alias("anchor"), F.col("fp").alias("a")).select(key.alias("at"), "a")
    # positions p and p^s, each from 1 to 31: p^s is 0 for p = s, which 'p < p^s' leaves out
    others = blocks.select("k", F.explode(
        F.when(F.col("s") == 0, F.array("x")).otherwise(F.concat(F.array(home), near))
    ).alias("anchor"), F.col("fp").alias("b")).select(key.alias("at"), "b")
    return homes.join(others, "at").where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)
    ).select("a", "b").distinct()


def alike_links(docs: DataFrame, own: DataFrame, first: DataFrame, width: int, alike: tuple[int, int]) -> DataFrame:
    """(a, b): `first`, links of fingerprints, and more, so that all texts with Jaccard similarity of shingles of at least
    alike[0] / alike[1] are connected. Equal sets are one row. Each set meets the least one of each of its keys; then, where
    a key still holds sets of several components, those meet in blocks."""
    num, den = alike
    sets = own.where(F.size("keys") > 0).groupBy("k").agg(F.min("h").alias("h"), F.min("fp").alias("fp"), F.collect_set("fp").alias("fps"), F.first("keys").alias("keys"))
    sets = cut(sets, "shingle_sets")
    same = sets.where(F.size("fps") > 1).select(F.col("fp").alias("a"), F.explode("fps").alias("b"))
    rows = sets.select("k", "fp", "h", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("k", "fp")).alias("least")).where("n > 1").drop("n")
    rows = cut(rows.join(shared, "key"), "shared_keys")
    texts = docs.where("text is not null").select("text", F.xxhash64("text").alias("h")).join(rows.select("h", "k").distinct(), "h").select("k", "text")
    whole = cut(texts.mapInArrow(_whole_sets(width), "k long, v array<long>").groupBy("k").agg(F.first("v").alias("v")), "whole_sets")

    def verified(pairs: DataFrame) -> DataFrame:
        one = lambda s: whole.select(F.col("k").alias(s), F.col("v").alias(f"v{s}"))
        n, m, common = F.size("vx"), F.size("vy"), F.size(F.array_intersect("vx", "vy"))
        found = pairs.distinct().join(one("x"), "x").join(one("y"), "y").where((n * den >= m * num) & (m * den >= n * num))
        return found.where(common * den >= (n + m - common) * num).select("a", "b")

    pairs = rows.where("k <> least.k").select(F.col("least.k").alias("x"), F.col("k").alias("y"), F.col("least.fp").alias("a"), F.col("fp").alias("b"))
    links_ = cut(first.union(same).union(verified(pairs)), "alike_links")
    labels = components(links_)
    now = rows.join(labels, rows.fp == labels.node, "left").select("key", "k", "fp", F.coalesce("label", "fp").alias("label"))
    mixed = now.groupBy("key").agg((F.min("label") < F.max("label")).alias("mixed")).where("mixed").select("key")
    now = cut(now.join(mixed, "key").where("fp is not null"), "mixed_keys")
    return links_.union(meet(now, whole, alike))


#: Sets and elements of a block of a key's sets.
SETS, ELEMENTS = 512, 1 << 18


def meet(rows: DataFrame, whole: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """(key, k, fp, label) and the sets (k, v) -> (a, b): links that connect, within each key, all sets of different labels
    that are as alike as asked for.

    A key's sets are dealt to blocks of bounded size; a task holds two blocks and counts common elements as matrix products, so a
    set travels once for every block of its key, not once for every other set, and a task gives no more links than it has labels.
    """
    d = rows.join(whole, "k")
    sizes = d.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / SETS), F.ceil(F.sum(F.size("v")) / ELEMENTS)).cast("int").alias("blocks"))
    d = d.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("k", "key"), F.col("blocks")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    d = d.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), (F.col("block") > F.col("other")).alias("second"), "k", "fp", "label", "v")
    return d.groupBy("key", "one", "two").applyInPandas(_met(*alike), "a long, b long")


def common(x: list, y: list):
    """How many elements each set of x has in common with each of y."""
    import numpy as np

    sizes = [len(v) for v in (*x, *y)]
    place = np.unique(np.concatenate([*x, *y]), return_inverse=True)[1]
    row, wide = np.repeat(np.arange(len(sizes)), sizes), 4096
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    out = np.zeros((len(x), len(y)), np.int64)
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, wide):
        part = slice(*np.searchsorted(place, [at, at + wide]))
        m = np.zeros((len(sizes), wide), np.float32)
        m[row[part], place[part] - at] = 1
        out += (m[: len(x)] @ m[len(x) :].T).astype(np.int64)
    return out


def _met(num: int, den: int):
    def run(pdf):
        import numpy as np
        import pandas as pd

        same = pdf["one"].iat[0] == pdf["two"].iat[0]
        x, y = (pdf, pdf) if same else (pdf[~pdf["second"]], pdf[pdf["second"]])
        found = []
        if len(x) and len(y) and pdf["label"].nunique() > 1:
            n, m = (np.array([len(v) for v in d["v"]], np.int64) for d in (x, y))
            both = common(list(x["v"]), list(y["v"]))
            ok = (both * den >= (n[:, None] + m[None, :] - both) * num) & (x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None, :])
            group = {label: label for label in pdf["label"]}

            def root(label):
                while group[label] != label:
                    group[label] = label = group[group[label]]
                return label

            for i, j in zip(*np.nonzero(ok)):  # of the links between two groups of labels one is enough
                p, q = root(x["label"].iat[i]), root(y["label"].iat[j])
                if p != q:
                    group[max(p, q)] = min(p, q)
                    found.append((x["fp"].iat[i], y["fp"].iat[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, width: int = 3, most: int = 3, alike: tuple[int, int] | None = None) -> DataFrame:
    """(doc_id, text) -> doc_id, fp long, component_id: the smallest doc_id reachable by links of fingerprints.

    One row per input row. Null texts count as empty; rows with a null doc_id join their group but never name it (a group
    of null ids only has component_id null). Repeated rows and equal texts share a fingerprint and so a group. With `alike`,
    texts whose sets of shingles have a Jaccard similarity of alike[0] / alike[1] or more are linked as well.
    """
    own = cut(keyed_fingerprints(docs, width) if alike else fingerprints(docs, width), "fingerprints")
    groups = cut(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp_groups")
    found = links(groups.select("fp"), most)
    labels = components(alike_links(docs, own, found, width, alike) if alike else found)
    of = groups.join(labels, groups.fp == labels.node, "left").select("fp", F.coalesce("label", "fp").alias("label"), "least")
    names = of.groupBy("label").agg(F.min("least").alias("component_id"))
    named = of.join(names, "label").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3, most: int = 3, alike: tuple[int, int] | None = None) -> DataFrame:
    """The rows of docs whose doc_id names their group, one row each (of rows with the same doc_id, any one; null ids stay).

    Columns may have any names.
    """
    found = near_duplicates(docs, width, most, alike)
    ids = cut(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("copies")), "kept_ids")
    rows = docs.select(F.struct("*").alias("row"), "doc_id")
    kept = rows.join(ids, "doc_id")
    out = kept.where("copies = 1").select("row").unionByName(rows.where("doc_id is null").select("row"))
    if ids.where("copies > 1").limit(1).count():
        out = out.unionByName(kept.where("copies > 1").dropDuplicates(["doc_id"]).select("row"))
    return out.select("row.*")
