"""Each corpus operator against a brute-force version, with nulls, empty and long texts, ties, repeats and extra columns."""

import collections
import hashlib
import math
import re
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from pitpanel.llm import binary_ids, chat, covertree, lines, mixing, packing, quality, secrets, simhash, warc
from pitpanel.llm.queries import QUERIES
from pitpanel.llm.shared import new_path, tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n int, label int, id long, pos int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """Rows (doc_id, text[, lang, source]) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *("en", "a")[len(r) - 2 :], 1, 2, 3, 4) for r in rows], DOC)


def table(spark, sf, name):
    return [r.asDict(recursive=True) for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]


def union(n, pairs):
    at = {x: x for x in n}

    def find(x):
        while at[x] != x:
            at[x] = at[at[x]]
            x = at[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return {x: find(x) for x in n}


# 1 ------------------------------------------------------------------------------------------------------------------
def brute_vectors(rows):
    good = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = np.array(v, float)
            good[i] = v / np.linalg.norm(v)
    ids = list(good)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9]
    links = collections.Counter(x for p in pairs for x in p)
    comp = union([i for i, _ in rows], pairs)
    return {i: (links[i], comp[i], comp[i] == i) for i, _ in rows}


@pytest.mark.parametrize("block", [7, 4096])
def test_vectors(spark, block):
    r = np.random.RandomState(1)
    base = r.randn(12, 8)
    v = [*r.randn(40, 8), *(base[r.randint(0, 12, 60)] + r.randn(60, 8) * 0.25), *[base[0]] * 5, base[0] * 3]
    rows = [(i * 7 % 1000 + 1, [float(np.float32(y)) for y in x]) for i, x in enumerate(v)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [None] + [1.0] * 7), (2004, [float("nan")] * 8), (2005, [float("inf")] * 8), (2006, [1.0, 2.0]), (2007, [2.0, 4.0])]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id long, embedding array<float>, times int")
    got = {x[0]: (x[1], x[2], x[3]) for x in covertree.near_vectors(df, block=block).collect()}
    assert got == brute_vectors(rows)
    assert covertree.near_vectors(df.where("false")).count() == 0


@pytest.mark.parametrize("spread", [0.0, 0.02, 0.06, 0.12, 1.0])
@pytest.mark.parametrize("cosine", [0.9, 0.5, 0.99])
def test_walk_of_two_trees(spread, cosine):
    """Ranges of both trees hold the pairs over the threshold and no others, for groups from tight to none."""
    r = np.random.RandomState(3)
    base = r.randn(5, 16)

    def tree(n):
        v = covertree._unit(base[r.randint(0, 5, n)] * (spread < 1) + r.randn(n, 16) * spread + [1e-9] * 16)
        order, levels = covertree.build(v)
        place = np.empty(n, int)
        place[order] = np.arange(n)
        return v[order], [(f, e, radius, place[c]) for f, e, radius, c in levels]

    (x, tx), (y, ty) = tree(300), tree(211)
    for a, b, ta, tb, same in ((x, y, tx, ty, False), (x, x, tx, tx, True)):
        got = np.zeros((len(a), len(b)), int)
        for ranges in covertree.dual(a, b, ta, tb, cosine, same, rows=64, many=500):
            for f, e, g, h in zip(*ranges):
                got[f:e, g:h] += np.triu(np.ones((e - f, h - g), int), 1) if same and f == g else 1
        want = a @ b.T >= cosine
        assert (got == (np.triu(want, 1) if same else want)).all()


def test_wide_nodes_are_not_walked_pair_by_pair(monkeypatch):
    """A node wider than the threshold, which parts little, costs rows of a matrix product and no lists of pairs."""
    r = np.random.RandomState(4)
    v = r.randn(900, 64)
    v[1:120:2] = 0.8 * v[0:120:2] + 0.6 * v[1:120:2]
    v[200:204] = v[199] + 0.05 * r.randn(4, 64)
    v = covertree._unit(v)
    order, levels = covertree.build(v)
    place = np.empty(len(v), int)
    place[order] = np.arange(len(v))
    v, levels = v[order], [(f, e, radius, place[c]) for f, e, radius, c in levels]
    assert sum(((e - f > 1) & (radius > 0.5)).sum() for f, e, radius, _ in levels[1:2]) > 20
    one_by_one, plain = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: (one_by_one.append(len(a)), plain(how, a, b))[1])
    for same in (False, True):
        one_by_one.clear()
        got = np.zeros((len(v), len(v)), int)
        for ranges in covertree.dual(v, v, levels, levels, 0.9, same):
            for f, e, g, h in zip(*ranges):
                got[f:e, g:h] += np.triu(np.ones((e - f, h - g), int), 1) if same and f == g else 1
        want = v @ v.T >= 0.9
        assert (got == (np.triu(want, 1) if same else want)).all()
        assert same or sum(one_by_one) < 20 * len(v)


def test_pairs_of_blocks_copy_no_trees(spark, monkeypatch):
    """No row with a tree is made for each other block (such rows of one tree were held together) and none is shuffled."""
    r = np.random.RandomState(6)
    rows = [(i, [float(np.float32(y)) for y in x]) for i, x in enumerate(r.randn(60, 3))] + [(100 + i, [float(y) for y in x]) for i, x in enumerate(r.randn(30, 2))]
    plans, plain = {}, covertree.cut
    monkeypatch.setattr(covertree, "cut", lambda df, name, *a, **k: (plans.update({name: df._jdf.queryExecution().executedPlan().toString()}), plain(df, name, *a, **k))[1])
    got = {x[0]: (x[1], x[2], x[3]) for x in covertree.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=7).collect()}
    assert got == brute_vectors(rows)
    assert "tree" in plans["vector_links"] and "Generate" not in plans["vector_links"] and "Exchange" not in plans["vector_links"]


def test_blocks_of_wide_vectors_are_smaller(spark, monkeypatch):
    r = np.random.RandomState(7)
    rows = [(i, [float(np.float32(y)) for y in x]) for i, x in enumerate(np.r_[r.randn(30, 40), r.randn(40) + 0.3 * r.randn(30, 40)])]
    monkeypatch.setattr(covertree, "WIDE", 400)
    points, plain = [], covertree.cut
    monkeypatch.setattr(covertree, "cut", lambda df, name, *a, **k: (t := plain(df, name, *a, **k), points.extend([t.count()] * (name == "trees")))[0])
    got = {x[0]: (x[1], x[2], x[3]) for x in covertree.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == brute_vectors(rows) and points[0] > 3


@pytest.mark.parametrize("same", [False, True])
def test_pair_of_blocks_of_wide_near_copies_is_small(same):
    """What a walk looks up at once does not grow with the width of the vectors or with the links."""
    import tracemalloc

    import pandas as pd

    r = np.random.RandomState(8)
    v = (r.randn(500) + 0.33 * r.randn(5000, 500)).astype(np.float32)
    trees = [covertree._tree(pd.DataFrame({"dim": 500, "block": k, "id": np.arange(2500) * 2 + k, "times": 1, "v": list(v[k::2])}))["tree"][0] for k in (0, 1)]
    tracemalloc.start()
    ids, n, to = covertree._meet(trees[0], None if same else trees[1], 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    u = covertree._unit(v)
    near = u @ u.T >= 0.9
    want = near[::2, ::2].sum(1) - 1 if same else np.where(np.arange(5000) % 2 == 0, near[:, 1::2].sum(1), near[:, ::2].sum(1))
    want = dict(zip(np.arange(0, 5000, 2) if same else np.arange(5000), want))
    assert dict(zip(ids.tolist(), n.tolist())) == {int(i): int(x) for i, x in want.items() if x}
    assert len(ids) > 2000 and len(set(to.tolist())) == 1
    assert peak < 130e6  # 365 MB and 569 MB when lists of pairs were as long for wide vectors as for narrow ones


def test_walk_leaves_nothing_behind():
    """The arrays of a pair of blocks go with it, not when cycles happen to be collected."""
    import gc
    import weakref

    v = covertree._unit(np.random.RandomState(9).randn(50, 8))
    order, levels = covertree.build(v)
    place = np.empty(50, int)
    place[order] = np.arange(50)
    v = v[order]
    kept, levels = weakref.ref(v), [(f, e, radius, place[c]) for f, e, radius, c in levels]
    gc.disable()
    try:
        for _ in covertree.dual(v, v, levels, levels, 0.9, True):
            pass
        del v
        assert kept() is None
    finally:
        gc.enable()


def test_merged_links():
    r = np.random.RandomState(10)
    found = []
    for _ in range(8):
        ids = np.unique(r.randint(0, 300, 40))
        found.append((ids, r.randint(1, 9, len(ids)), np.minimum(ids, r.choice(ids, len(ids)))))
    want = collections.Counter()
    for ids, n, _ in found:
        want.update(dict(zip(ids.tolist(), n.tolist())))
    at = union(sorted(want), [(a, b) for ids, _, to in found for a, b in zip(ids.tolist(), to.tolist())])
    for parts in (found, [covertree._merged(found[:5]), *found[5:]]):
        nodes, n, to = covertree._merged(parts)
        assert dict(zip(nodes.tolist(), n.tolist())) == want and dict(zip(nodes.tolist(), to.tolist())) == at


def test_steps_keep_short_plan_texts(spark):
    """The driver keeps the plans of its last queries as texts: those of intermediate tables are short, whatever they hold."""
    from pitpanel.llm.shared import WRITING, cut

    before = {key: spark.conf.get(key, None) for key in WRITING}
    assert cut(spark.range(3).select("id", F.lit("x" * 100_000).alias("s")).where("id > 0"), "long_plan").count() == 2
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    kept = spark._jsparkSession.sharedState().statusStore().executionsList()
    texts = [kept.apply(k).physicalPlanDescription() for k in range(max(0, kept.size() - 5), kept.size())]
    assert (mine := [t for t in texts if "long_plan" in t or "xxxx" in t]) and max(map(len, mine)) < 10_000
    assert before == {key: spark.conf.get(key, None) for key in WRITING}


def test_both_sides_of_the_run_of_words_read_one_exchange(spark, monkeypatch):
    plans = []

    class Seen(lines.Scratch):
        def cut(self, df, name):
            if name == "run_pairs":
                plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().cut(df, name)

    monkeypatch.setattr(lines, "Scratch", Seen)
    texts = ["one two three four five six seven eight nine ten", "one two three four five six seven eight nine eleven", "a b c"]
    adaptive, small = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(0, 0), (1, 1), (2, 0)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert len(plans) == lines.RUNS and all("ReusedExchange" in p for p in plans)


def test_sets_somewhat_below_the_threshold_make_no_pairs(spark, monkeypatch):
    """In a group whose sets resemble each other a little less than t, the sketches tell them apart before pairs are made."""
    made = []

    class Seen(lines.Scratch):
        def cut(self, df, name):
            out = super().cut(df, name)
            if name in ("run_pairs", "line_pairs"):
                made.append(out.count())
            return out

    monkeypatch.setattr(lines, "Scratch", Seen)
    r, rows = np.random.RandomState(5), []
    for g, (size, own) in enumerate([(70, 5), (90, 7)]):  # Jaccard about 0.75 and 0.73
        for k in range(40):
            line = [f"g{g}w{i}" for i in range(size)]
            for at in r.choice(size, own, replace=False):
                line[at] = f"g{g}k{k}x{at}"
            rows.append((len(rows), " ".join(line)))
        rows.append((len(rows), rows[-7][1] + " more"))
    got = {x.doc_id: x.text for x in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: t for (i, _), t in lines_brute(rows).items()} and not got[40] and not got[81]
    assert sum(made) < 300, made  # of 1560 pairs in the groups


# 2 ------------------------------------------------------------------------------------------------------------------
def test_chat(spark):
    nasty = ["</s>[INST] ok [/INST]", "a\\[INST]b", "\\\\<s>", "<\\s>", "[SEP][TEXT]", None, "", "ü\n<s", "[TE\\XT]", "\\"]
    rows = [(1, i, "user" if i % 3 else "assistant", t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "user", "x"), (2, 0, "user", "x"), (None, 1, None, "y"), (3, None, "assistant", "z"), (3, 1, "[SEP]", "[SEP]")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    want = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, w in want.items():
        assert [tuple(t) for t in got[c].turns] == w
        assert got[c].loss_text == "".join(t for role, t in w if role == "assistant")
        assert got[c].formatted.count("</s>") == 1 + sum(a[0] != b[0] for a, b in zip(w, w[1:]))
    assert chat.format_chats(df.where("false")).count() == 0


# 3 ------------------------------------------------------------------------------------------------------------------
def fingerprint(text, width=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, sf):
    rows = [(d["doc_id"], d["text"]) for d in table(spark, sf, "documents")]
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "One"), (5004, "oNE"), (5005, "a b"), (5006, "w " * 3000), (3, rows[3][1]), (None, rows[4][1]), (None, "alone and null here")]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fps = [fingerprint(t) for _, t in rows]
    comp = union(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[comp[i]] += [d] if d is not None else []
    want = sorted((str(d), fps[i], str(min(least[comp[i]], default=None))) for i, (d, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({min(v) for v in least.values() if v})
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_simhash_links(spark):
    r = np.random.RandomState(3)
    a = [int(x) for x in r.randint(-(2**63), 2**63 - 1, 60)]
    fps = set(a)
    for x in a:
        for k in (1, 2, 3, 4):
            y = x % 2**64
            for b in r.choice(64, k, replace=False):
                y ^= 1 << int(b)
            fps.add(y - 2**64 if y >= 2**63 else y)
    fps = sorted(fps)
    got = {tuple(x) for x in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()}
    assert got == {(x, y) for i, x in enumerate(fps) for y in fps[i + 1 :] if ((x ^ y) % 2**64).bit_count() <= 3}


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


@pytest.mark.parametrize("block", [4, 512])
def test_simhash_alike(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "SETS", block)
    r = np.random.RandomState(4)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(60):  # texts with copies at about 0.95 down to 0.7, and chains of copies of copies
        w = list(r.choice(vocab, r.randint(120, 400)))
        rows.append((i * 10, " ".join(w)))
        for k in range(1, 6):
            v = list(w)
            for at in r.choice(len(v), max(1, len(v) * k // 170), replace=False):
                v[at] = f"z{r.randint(10**9)}"
            rows.append((i * 10 + k, " ".join(v)))
            w = v if i % 3 == 0 else w
    rows += [(5000, None), (5001, ""), (5002, "One two"), (5003, "oNE  two"), (5004, "a b c d e f"), (5005, "b c d e f g"), (5006, "w " * 3000), (3, rows[3][1]), (None, rows[4][1]), (None, "alone and null here"), (0, rows[60][1])]
    assert len({i for i, _ in rows}) == len(rows) - 3
    got = simhash.near_duplicates(docs(spark, rows), 5, alike=(8, 10)).collect()
    fps, sets = [fingerprint(t, 5) for _, t in rows], [shingles(t) for _, t in rows]
    alike = lambda a, b: 10 * len(a & b) >= 8 * len(a | b) > 0
    bits = lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)]
    assert sum(alike(sets[i], sets[j]) and not bits(i, j) for i, j in pairs) > 100
    comp = union(range(len(rows)), [(i, j) for i, j in pairs if bits(i, j) or alike(sets[i], sets[j])])
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[comp[i]] += [d] if d is not None else []
    assert sorted((str(x.doc_id), x.fp % 2**64, str(x.component_id)) for x in got) == sorted((str(d), fps[i], str(min(least[comp[i]], default=None))) for i, (d, _) in enumerate(rows))
    kept = simhash.keep_one(docs(spark, rows), 5, alike=(8, 10)).collect()
    assert {x.doc_id for x in kept if x.doc_id is not None} == {min(v) for v in least.values() if v}
    assert simhash.near_duplicates(docs(spark, []), 5, alike=(8, 10)).count() == 0


def test_common_elements():
    r = np.random.RandomState(1)
    x, y = ([np.unique(r.randint(0, 9000, k)) for k in sizes] for sizes in ((5, 800, 3000), (1, 700, 2500, 4000)))
    assert simhash.common(x, y).tolist() == [[len(set(a) & set(b)) for b in y] for a in x]


# 4 ------------------------------------------------------------------------------------------------------------------
def pages_brute(rows, least=100):
    first = {}
    for i, h in rows:
        b = (h or "").encode()
        if len(b) >= least and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, h in rows:
        b = (h or "").encode()
        f = first.get(b) if len(b) >= least and i is not None else None
        again = f is not None and f != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def test_warc(spark):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    long = "<p>ü" * 40
    rows = [(1, "x" + inner + inner + "y"), (2, long), (3, long), (4, None), (5, ""), (6, "\r\n\r\n" + inner), (7, "ends\r\n"), (8, "\r\n\r\n" * 30 + inner), (9, long), (None, long), (10, "z" * 99), (11, "z" * 99), (12, inner[:30]), (3, long), (13, "q" * 3000 + inner)]
    # one page_id with two payloads, each revisited; a payload that looks like an HTTP message
    rows += [(20, "A" * 150), (20, "B" * 300), (21, "A" * 150), (22, "B" * 300), (23, "HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + "C" * 100), (24, "r" * 6_000 + inner)]
    df = spark.createDataFrame([(i, f"http://h/{i}\r\nX: y", h, 1) for i, h in rows], "page_id long, url string, html string, first int")
    for parts, size in ((1, "128m"), (2, "900b"), (3, "700b"), (2, "200b")):
        use = rows if size != "200b" else [r for r in rows if r[0] != 24]
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            folder = new_path(spark, "w")
            d = df if use is rows else df.where("page_id is null or page_id <> 24")
            warc.write_warc(d.coalesce(parts) if parts == 1 else d.repartition(parts), folder)
            got = sorted((tuple(r) for r in warc.read_pages(spark, folder).collect()), key=str)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == pages_brute(use), size
    assert warc.read_pages(spark, new_empty(spark, df, folder)).count() == 0


def new_empty(spark, df, folder):
    warc.write_warc(df.where("false"), folder + "-none")
    return folder + "-none"


def test_warc_versions_and_broken_chains(spark, tmp_path):
    """Records of any version 1.x; a wrong length, one that is missing and a cut end are told, and the records behind are read."""
    def record(i, body, version="1.0", length=None, end="\r\n\r\n"):
        head = f"WARC/{version}\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\n"
        return head + ("" if length == "none" else f"Content-Length: {len(body) if length is None else length}\r\n") + "\r\n" + body + end

    def read(name, text, size="128m"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(text.encode())
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = warc.read_warc(spark, f"file://{tmp_path / name}").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        return sorted((r.at, r.id[10:-1] if r.id else None, r.bytes, r.broken) for r in got)

    inner = record("x", "in")
    for k, size in enumerate(("128m", "300b", "90b")):
        plain = [(i, f"body {i} " * 9 + (inner if i == 2 else "")) for i in range(6)]
        got = read(f"v{k}", "".join(record(i, b, f"1.{i % 3}") for i, b in plain), size)
        assert [x[1:] for x in got] == [(str(i), len(b), None) for i, b in plain]
        got = read(f"w{k}", record(1, "abc") + record(2, "def", length=7) + record(3, "ghi"), size)
        assert [x[1:] for x in got] == [("1", 3, None), ("2", None, "wrong length"), ("3", 3, None)]
        text = record(1, "abc") + record(2, "def", length=1) + record(3, "gh", length="none") + record(4, "ijk" * 50, "1.1") + record(5, "l", length=3) + record(6, "m") + record(7, "n" * 20, length=50, end="")
        got = read(f"b{k}", text, size)
        assert [x[1:] for x in got if x[1]] == [("1", 3, None), ("2", None, "wrong length"), ("4", 150, None), ("5", None, "wrong length"), ("6", 1, None), ("7", None, "cut short")]
    assert [x[1:] for x in read("last", record(1, "abc") + record(2, "abc", end=""))] == [("1", 3, None), ("2", 3, None)]
    assert [x[3] for x in read("none", "no archive")] == ["no length"]


def test_warc_gzip(spark, tmp_path):
    """Archives of gzip members, a member per record, read as plain ones do."""
    import gzip

    rows = [(i, f"{i} " * (60 + i)) for i in range(20)] + [(50, "0 " * 60)]
    folder = new_path(spark, "w")
    warc.write_warc(spark.createDataFrame([(i, "http://h", h) for i, h in rows], "page_id long, url string, html string").coalesce(1), folder)
    plain = b"".join(p.read_bytes() for p in sorted(Path(folder.removeprefix("file://")).glob("part-*")))
    records = [x for x in re.split(rb"(?=WARC/1\.0\r\n)", plain) if x]
    assert len(records) == len(rows)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    got = sorted((tuple(r) for r in warc.read_pages(spark, f"file://{tmp_path}").collect()), key=str)
    assert got == pages_brute(rows)


# 5 ------------------------------------------------------------------------------------------------------------------
def measures(text):
    t = text or ""
    w = WORDS.findall(t)
    ls = [x for x in t.split("\n") if WORDS.search(x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(tri)
    hit = {i + k for i, x in enumerate(tri) if n[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls), len(ls) - len(set(ls)), len(hit)


def test_measures(spark, sf):
    rows = [(d["doc_id"], d["text"]) for d in table(spark, sf, "documents")] + [(900, None), (901, ""), (902, "a b c " * 4000), (903, "a a a a"), (904, "x\n\nx\n \n\x0bx"), (905, "a b"), (906, "p q r s p q r")]
    got = quality.measures(docs(spark, rows).withColumn("_w", F.lit(1)).drop("_w")).collect()
    assert {r.doc_id: tuple(r)[-6:] for r in got} == {i: measures(t) for i, t in rows}


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_quality_rules(spark, sf):
    labels = spark.createDataFrame([(1, 0, 7), (1, 1, 7), (None, 1, 7), (2, None, 7), (77777, 1, 7)], "doc_id long, quality int, lang int")
    real = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    risk = 0.06
    got = {r.doc_id: r for r in quality.apply_rules(d, real.unionByName(labels.select("doc_id", "quality")), risk=risk).collect()}
    pdf = pd.DataFrame([(i, *measures(t), g) for i, t, g in d.collect()], columns=["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "lang"])
    pdf["base"] = (pdf.n_words < 50) | (100 * pdf.n_repeat_words > 50 * pdf.n_words)
    lab = pd.concat([real.toPandas(), labels.toPandas()[["doc_id", "quality"]]]).dropna().groupby("doc_id", as_index=False).quality.min()
    known = pdf[~pdf.base].merge(lab, on="doc_id")
    value = lambda f, r: np.where(f[quality.RULES[r][1]] > 0, 100.0 * f[quality.RULES[r][0]] / f[quality.RULES[r][1]].clip(lower=1), 0.0)
    tests = {}
    for s, g in known.groupby("lang"):
        for r in quality.RULES:
            for c in quality.RULES[r][2]:
                good, over = g.quality == 1, value(g, r) > c
                tests[s, r, c] = (int(good.sum()), int((good & over).sum()), int((~good & over).sum()))
    cut, best = {}, {}
    for (s, r, c), (n, k, b) in tests.items():
        if b > k and k < risk / 3 * n and tail(k, n, risk / 3) <= 0.05 / len(tests) and (b - k, c) > best.get((s, r), (0, 0)):
            cut[s, r], best[s, r] = c, (b - k, c)
    assert cut  # some rule is admissible
    bad = pdf.base.to_numpy().copy()
    for r in quality.RULES:
        bad |= value(pdf, r) > pdf.lang.map(lambda s: cut.get((s, r), math.inf)).to_numpy()
    assert {i: g.kept for i, g in got.items()} == dict(zip(pdf.doc_id, (~bad).tolist()))
    clean = set(lab[lab.quality == 1].doc_id) & set(pdf[~pdf.base].doc_id)
    assert sum(not got[i].kept for i in clean) <= risk * len(clean)


def test_quality_sql(spark):
    """The registered query and its SQL where cutoffs are in force: over the largest small tables."""
    import duckdb

    from pitpanel.llm.oracles import ORACLES

    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    want = con.sql(ORACLES["op5_quality_rules"]).df().set_index("doc_id").sort_index()
    got = QUERIES["op5_quality_rules"](spark, sf).toPandas().set_index("doc_id").sort_index()
    assert (got.kept == want.kept).all() and (~got.kept & ~got.base_failed).sum() > 0


def test_quality_edges(spark):
    rows = [(1, None), (2, ""), (3, "w%d " * 60 % tuple(range(60))), (3, "other"), (None, "x " * 80)]
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = sorted((str(r.doc_id), r.base_failed, r.kept) for r in quality.apply_rules(docs(spark, rows), none).collect())
    assert got == sorted([("1", True, False), ("2", True, False), ("3", False, True), ("3", True, False), ("None", True, False)])
    kept = quality.keep_good(docs(spark, rows), none).collect()
    assert [(r.doc_id, r.label) for r in kept] == [(3, 2)]
    assert quality.apply_rules(docs(spark, []), none).count() == 0


# 6 ------------------------------------------------------------------------------------------------------------------
def spans_brute(text):
    out = []
    for k, (kind, (p, g, least)) in enumerate(secrets.RULES.items()):
        for m in re.finditer(p, text or "", re.ASCII):
            if len(m.group(g) or "") >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_secrets(spark, sf):
    odd = ["token=token:abcdefgh", 'é PassWord = "hunter22" x', "AKIA" + "B" * 15, "AKIA" + "B" * 16 + "AKIA" + "0" * 30, "0123456789abcdef01234567", "𝒳𝒳 api-key:'aaaaaa'", "secret=abc secret=abcdef", None, "", "ghp_" + "a" * 36, "passwd==x=====", "apikey: 0123456789abcdef0123456789 " * 500]
    rows = [(d["doc_id"], d["text"]) for d in table(spark, sf, "documents")] + [(1000 + i, t) for i, t in enumerate(odd)] + [(None, odd[0]), (5, odd[1]), (5, odd[1])]
    ledger = new_path(spark, "ledger")
    got = secrets.scan_history(docs(spark, rows), ledger).collect()
    want = sorted((str(i), spans_brute(t)) for i, t in rows)
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in got) == want
    # a second run scans nothing, a new version of one rule scans that rule only, and both find the same
    size = spark.read.parquet(ledger).count()
    again = secrets.scan_history(docs(spark, rows + [(9999, "AKIA" + "C" * 20)]), ledger).collect()
    assert spark.read.parquet(ledger).count() == size + 1
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in again if r.doc_id != 9999) == want
    rules = secrets.RULES | {"access": (r"AKIA[A-Z0-9]+", 0, 30)}
    assert secrets.rule_keys(rules)["hex"] == secrets.rule_keys()["hex"] != secrets.rule_keys(rules)["access"]
    third = {str(r.doc_id): r.spans for r in secrets.scan_history(docs(spark, [(7, odd[3])]), ledger, rules).collect()}
    assert [s.kind for s in third["7"]] == [1, 2] or [s.kind for s in third["7"]] == [1]
    assert secrets.scan_history(docs(spark, [])).count() == 0


def test_secrets_widened(spark):
    """A version of a rule that covers more finds it, also in texts that the older version has seen."""
    rows = [(1, "x 0123456789abcdef y"), (2, "AKIA" + "B" * 12), (3, "ghx_" + "z" * 36), (4, "credential=hunter22"), (5, "a 0123456789abcdef01234567")]
    ledger = new_path(spark, "ledger")
    first = {r.doc_id: len(r.spans) for r in secrets.scan_history(docs(spark, rows), ledger).collect()}
    assert first == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1}
    rules = secrets.RULES | {"hex": (r"[0-9a-f]+", 0, 16), "access": (r"AKIA[A-Z0-9]+", 0, 16), "github": (r"gh[pousrx]_[A-Za-z0-9]+", 0, 40), "assign": (r"((?i:credential))(=)(.+)", 3, 6)}
    kinds = list(rules)
    got = {r.doc_id: {kinds[s.kind] for s in r.spans} for r in secrets.scan_history(docs(spark, rows), ledger, rules).collect()}
    assert got == {1: {"hex"}, 2: {"access"}, 3: {"github"}, 4: {"assign"}, 5: {"hex"}}


def test_secrets_long_and_reordered(spark):
    """Very long texts for every rule; kinds follow the rules' order at reading; many null ids meet few blobs."""
    bad = ["-----BEGIN " + "A " * 200_000 + "PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY-----" * 5000, "token=" + "a" * 10**6, "AKIA" + "B" * 10**6, "0123456789abcdef" * 60_000, "ghp_" + "z" * 10**6, "xoxb-" + "1-" * 500_000, "eyJ" + "a" * 400_000 + ".eyJ" + "b" * 400_000 + "." + "c" * 400_000, "password" * 100_000]
    # every rule's beginning, over and over
    bad += [x * (10**6 // len(x)) for x in ("eyJ", "eyJa.", "eyJa.eyJb ", "ghp_", "xoxb-", "-----BEGIN ", "-----BEGIN A ", "password ", "token=", "api_key ='", "AKIA", "AKIA-")]
    rows = list(enumerate(bad)) + [(None, f"secret: abcdef{i % 3}") for i in range(3_000)]
    ledger = new_path(spark, "ledger")
    d = docs(spark, rows)
    want = sorted((str(i), spans_brute(t)) for i, t in rows)
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in secrets.scan_history(d, ledger).collect()) == want
    other = {"new": (r"abcdef[0-9]", 0, 7)} | dict(reversed(secrets.RULES.items()))
    old = list(secrets.RULES)
    for r in secrets.scan_history(docs(spark, [*rows[:9], rows[-1]]), ledger, other).collect():
        mine = sorted((s.start, list(other)[s.kind], s.end) for s in r.spans if list(other)[s.kind] != "new")
        assert mine == sorted((a, old[k], b) for a, k, b in spans_brute(bad[r.doc_id] if r.doc_id is not None else rows[-1][1]))
        assert r.doc_id is not None or "new" in {list(other)[s.kind] for s in r.spans}


# 7, 10 --------------------------------------------------------------------------------------------------------------
def ids_of(path, text, end=2):
    from tokenizers import Tokenizer

    t = ids_of.__dict__.setdefault(path, Tokenizer.from_file(path))
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = [None, "", " ", "a  b\n\n c ", "x\ty z", "“q” é ß ² <|endoftext|> t", "日本 語", "long" * 3000, "w " * 9000, "it's \x1c q\x0b", "Don't  \n I'll"]


def test_binary_ids(spark, sf):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = [(d["doc_id"] - 50, d["text"]) for d in table(spark, sf, "documents")] + [(-(2**62) + i, t) for i, t in enumerate(ODD)] + [(2**62, "top"), (3, "again"), (None, "n"), (None, "m")]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in binary_ids.read_ids(binary_ids.write_ids(docs(spark, rows), path), docs=50).collect())
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = ids_of(path, t)
        want.append((at, i, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    assert binary_ids.read_ids(binary_ids.write_ids(docs(spark, []), path)).count() == 0


def test_elias_fano():
    r = np.random.RandomState(0)
    for n, top in ((0, 1), (1, 0), (1, 10**12), (1500, 3), (5000, 10**7), (700, 2**62)):
        v = np.sort(r.randint(0, top + 1, n)).astype(np.uint64)
        head, blob = binary_ids.EliasFano.build(v).blob()
        e = binary_ids.EliasFano.load(head, blob)
        for a, b in ((0, n), (n // 3, n // 2), (n - 1, n), (n, n)):
            if 0 <= a:
                assert e.select(a, b).tolist() == v[a:b].tolist()
        assert all(e.select(i) == v[i] for i in range(0, n, 97))
        if n:
            bits = max(1, int(v[-1]) // n).bit_length() + 3
            assert len(blob) <= n * bits / 8 + n * 4 / binary_ids.SAMPLE + 64


def test_packing(spark, sf):
    path = tokenizer_path("word_bpe_49k.json")
    rows = [(d["doc_id"], d["text"]) for d in table(spark, sf, "documents")] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "n"), (7777, "rep " * 10), (7777, "rep " * 10)]
    src = docs(spark, rows).coalesce(2)
    got = packing.pack(src, path, shard_docs=60).collect()
    seqs = collections.defaultdict(list)
    parts = collections.defaultdict(list)
    for p in got:
        assert len(p.ids) == 4 * p.length and p.length > 0
        seqs[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id].append((p.start, p.ids, p.doc_tokens))
    pad = 0
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 4096
        pad += 0 if at & (at - 1) == 0 else 4096 - at
    assert pad == 0
    for i, t in rows:
        ids = ids_of(path, t)
        if i not in (7777,):
            assert b"".join(b for _, b, _ in sorted(parts[i])) == np.array(ids, "<u4").tobytes()
            assert {n for _, _, n in parts[i]} == {len(ids)}
    assert sum(p.length for p in got) == sum(len(ids_of(path, t)) for _, t in rows)
    again = packing.pack(src, path, shard_docs=60).collect()
    assert again == got
    assert packing.pack(docs(spark, []), path).count() == 0


def test_bm25_neighbours():
    a, b = list(range(10, 40)), list(range(100, 130))
    d = [np.array(x, "<u4") for x in (a, b, a[:25] + [1], b[5:] + [2], [5])]
    s = packing.Index(d).scores(0)
    assert s[2] > 0 and s[1] == s[3] == s[4] == 0
    assert list(packing.order_of(d, 60))[:2] == [0, 2]
    assert sorted(packing.order_of(d, 60)) == [0, 1, 2, 3, 4]


# 8 ------------------------------------------------------------------------------------------------------------------
def fill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        t = {s: 2.0 * sizes[s] if s in capped else rest * w[s] / sum(w[x] for x in free) for s in names}
        over = [s for s in free if t[s] > 2 * sizes[s]]
        if not over:
            return t
        capped |= set(over)


def test_mixing(spark, sf):
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"]) for d in table(spark, sf, "documents")]
    rows += [(900, None, "en", "src1"), (901, "", "en", None), (902, "a b " * 900, "en", None), (903, "é q", "en", "zz"), (3, rows[3][1], "en", rows[3][3]), (None, "n u l l " * 50, "en", "src2")]
    got = mixing.plan(docs(spark, rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.plan(docs(spark, rows)).collect())) and len(got) == len(rows)
    size, taken = collections.Counter(), collections.Counter()
    for i, t, _, s in rows:
        size[s] += len(WORDS.findall(t or ""))
    want = fill(size)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= max(2, 0.02 * want[s])
    out = mixing.mixed(docs(spark, rows)).collect()
    words = collections.Counter()
    for r in out:
        words[r.source] += len(WORDS.findall(r.text))
    assert words == +taken
    assert mixing.plan(docs(spark, [])).count() == 0


def test_mixing_small_source(spark, monkeypatch):
    """A small source of short texts beside large ones, over many shards, meets its target as the others do."""
    big = [(i, "w " * 200_000, "en", f"big{i % 2}") for i in range(30)]
    rows = big + [(1000 + i, "a b c d " * 5, "en", "small") for i in range(100)] + [(3000, "one text of some words", "en", "tiny")]
    for shard_words in (mixing.SHARD_WORDS, 1 << 12):
        monkeypatch.setattr(mixing, "SHARD_WORDS", shard_words)
        use = rows if shard_words > 1 << 12 else [(i, t[:4000], *r) for i, t, *r in rows] + [(5000 + i, "e f " * (i % 90), "en", "mid") for i in range(900)]
        size, taken = collections.Counter(), collections.Counter()
        for _, t, _, s in use:
            size[s] += len(t.split())
        for r in mixing.plan(docs(spark, use)).collect():
            taken[r.source] += r.taken
        want = fill(size)
        assert all(abs(taken[s] - want[s]) <= max(2, 0.02 * want[s]) for s in size), (taken, want)


def highest_quotients(units, total):
    """{unit: (share, cap)} -> seats of each, one by one."""
    offers = sorted((-share / (2 * k + 1), u, k) for u, (share, cap) in units.items() for k in range(min(cap, total)))
    return collections.Counter(u for _, u, _ in offers[:total])


def test_mixing_seats(spark):
    r = np.random.RandomState(6)
    rows, want = [], {}
    for g, (n, top, total) in enumerate([(1, 900, 7), (40, 3000, 900), (60, 40, 33), (25, 20000, 5000), (30, 300, 0)]):
        units = {f"u{i:02d}": (float(x), int(2 * x / top * total / n) + 3) for i, x in enumerate([*r.randint(1, top, n), top * 9])}
        total = min(total, sum(c for _, c in units.values()))
        for u, k in highest_quotients(units, total).items():
            want[g, u] = k
        rows += [(g, u, share, cap, total) for u, (share, cap) in units.items()]
    free = [x for x in rows if x[0] != 0]
    df = spark.createDataFrame([(g, u, s, 10**6 if g != 0 else c, t) for g, u, s, c, t in rows], "g int, unit string, share double, cap long, all long")
    got = {(x.g, x.unit): x.quota for x in mixing.seats(df, ["g"]).collect()}
    for g in {x[0] for x in free}:
        units = {u: (s, 10**6) for h, u, s, _, _ in rows if h == g}
        total = next(t for h, *_, t in rows if h == g)
        seats = highest_quotients(units, total)
        assert {u: got[g, u] for u in units} == {u: seats[u] for u in units}


def test_mixing_blocks(spark, monkeypatch):
    """Sources get blocks by highest quotients, their shards by theirs, and blocks are whole but for a stream's end and one cut."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", 1 << 13)
    r = np.random.RandomState(8)
    rows = [(i, " ".join(f"w{j}" for j in range(r.randint(1, 900))), "en", f"s{i % 4}") for i in range(300)] + [(900, "only a few words", "en", "tiny")]
    got = mixing.plan(docs(spark, rows)).collect()
    size = collections.Counter()
    for x in got:
        size[x.source] += x.size
    target = fill(size)
    total = round(sum(round(t) for t in target.values()) / mixing.BLOCK)
    seats = highest_quotients({s: (target[s], -(-2 * size[s] // mixing.BLOCK)) for s in size}, total)
    by_source = spark.createDataFrame([(s, size[s], target[s]) for s in size], "source string, source_size long, target double")
    cap = F.ceil(F.col("source_size") * 2.0 / mixing.BLOCK).cast("long")
    units = by_source.select(F.lit(0).alias("g"), F.col("source").alias("unit"), F.col("target").alias("share"), cap.alias("cap"), F.lit(total).cast("long").alias("all"))
    assert {x.unit: x.quota for x in mixing.seats(units, ["g"]).collect()} == {s: seats[s] for s in size}
    taken, cuts = collections.Counter(), collections.defaultdict(set)
    for x in got:
        taken[x.source] += x.taken
        assert x.block == mixing.BLOCK and x.taken <= 2 * x.size
        if x.cut_at is not None:
            cuts[x.source].add((x.cut_at, x.cut_words))
    # a quota is met to a block, the target to the few words that the ends of streams and their limits leave
    assert all(abs(taken[s] - target[s]) <= 1 for s in size), (taken, target)
    assert all(abs(target[s] - seats[s] * mixing.BLOCK) <= mixing.BLOCK for s in size)


# 9 ------------------------------------------------------------------------------------------------------------------
def lines_brute(rows):
    """Rows (doc_id, text) distinct -> doc_id, text: remaining text."""
    order = sorted(((i is not None, i or 0, t, k) for i, t in rows if t is not None for k in range(len(t.split("\n")))), key=lambda x: x[:2])
    seen, gone, done = [], set(), set()
    for _, i, t, k in order:
        s = frozenset(WORDS.findall(t.split("\n")[k]))
        if not s or (i, t, k) in done:
            continue
        done.add((i, t, k))
        if any(10 * len(s & x) >= 8 * len(s | x) for x in seen):
            gone.add((i, t, k))
        seen.append(s)
    return {(i, t): None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i or 0, t, k) not in gone) for i, t in rows}


def test_lines(spark, sf):
    r = np.random.RandomState(5)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(d["doc_id"], d["text"]) for d in table(spark, sf, "documents")]
    long = " ".join(f"v{i}" for i in range(60))
    rows += [(1000 + i, "\n".join(" ".join(r.choice(vocab, r.randint(1, 14))) for _ in range(6))) for i in range(60)]
    rows += [(2000, long + "\nown line here"), (2001, "x\n" + long + " more"), (2002, long.replace("v1 ", "u1 ")), (2003, None), (2004, ""), (2005, "\n \n"), (2006, "a\ta b\x0bc\r"), (2007, "a b c"), (None, "a b c"), (None, "only null here"), (2008, "t\nt\nt"), (2009, "k " * 5000)]
    df = docs(spark, rows + [(2009, "k " * 5000)])
    got = lines.dedup_lines(df).collect()
    want = lines_brute(rows)
    by = {i: t for i, t in rows if i is not None}
    for x in got:
        if x.doc_id is not None:
            assert x.text == want[x.doc_id, by[x.doc_id]], x.doc_id
            assert x.label == 2 and x.n_removed == len((by[x.doc_id] or "").split("\n")) * (x.text is not None) - (len(x.text.split("\n")) if x.text else 0) or x.text == ""
    assert len(got) == len(rows) + 1
    assert sorted(x.text for x in got if x.doc_id is None) == sorted(t for (i, _), t in want.items() if i is None)
    assert lines.dedup_lines(docs(spark, [])).count() == 0


def test_lines_near(spark):
    """Groups of near copies of short, long and very long lines, in any order of doc_id; columns with the names used inside."""
    r = np.random.RandomState(8)
    rows = []
    for g, (n, size) in enumerate([(40, 12), (25, 30), (25, 50), (20, 70), (15, 150), (10, 220), (8, 700)]):
        base = [f"g{g}w{i}" for i in range(size)]
        for k in range(n):
            line = list(base)
            for at in r.choice(size, max(1, int(size * r.uniform(0, 0.16))), replace=False):
                line[at] = f"x{r.randint(10**9)}"
            rows.append((int(r.randint(10**6)), " ".join(line) + f"\nown {g} {k} line of this text"))
    assert len({i for i, _ in rows}) == len(rows)
    names = "doc_id long, text string, h long, _h string, kept int, _kept int, pos int, line string, id long, n_lines string, k int, d int, row int, rest int"
    df = spark.createDataFrame([(i, t, 1, "a", 2, 3, 4, "b", 5, "c", 6, 7, 8, 9) for i, t in rows], names)
    got = lines.dedup_lines(df)
    assert got.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    got, want = got.collect(), lines_brute(rows)
    assert {(x.doc_id): x.text for x in got} == {i: t for (i, _), t in want.items()}
    assert sum(x.n_removed for x in got) > 50 and all((x.h, x._h, x.kept, x._kept, x.pos, x.line, x.id, x.k, x.d, x.row, x.rest) == (1, "a", 2, 3, 4, "b", 5, 6, 7, 8, 9) for x in got)


def test_clashing_names(spark, sf):
    """The filters of the pipeline take columns of any name and give them back."""
    d = spark.read.parquet(f"{sf}/documents.parquet").limit(80)
    names = ["at", "copies", "copy", "block", "h", "_h", "_n", "_m", "_i", "_k", "_id", "n", "row", "size", "target", "taken", "n_words", "_t", "_w", "stratum", "rule", "quality", "fp", "label", "component_id", "word", "kept", "shard"]
    d = d.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))
    lab = spark.read.parquet(f"{sf}/labels.parquet").withColumn("h", F.lit(1))
    for out in (quality.keep_good(d, lab), lines.dedup_lines(d).drop("n_lines", "n_removed"), simhash.keep_one(d), mixing.mixed(d)):
        assert out.columns == d.columns
        rows = out.collect()
        assert rows and all(tuple(r)[-len(names):] == tuple(range(len(names))) for r in rows)
    plain = d.select("doc_id", "text", "source")
    assert sorted(map(str, mixing.mixed(d).select(plain.columns).collect())) == sorted(map(str, mixing.mixed(plain).collect()))


# pipeline -----------------------------------------------------------------------------------------------------------
def test_pipeline(spark, sf):
    import corpus_pipeline as c

    d = spark.read.parquet(f"{sf}/documents.parquet")
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    at = {}
    cols = d.columns
    for name, stage in c.STAGES:
        path = new_path(spark, "t")
        stage(spark, d, sf).write.parquet(path)
        at[name], d = (d, spark.read.parquet(path)), spark.read.parquet(path)
        if name != "packing":
            assert d.columns == cols
    before, after = at["quality rules"]
    verdict = {r.doc_id: r.kept for r in quality.apply_rules(before.select("doc_id", "text", "lang"), lab).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, k in verdict.items() if k}
    before, after = at["line dedup"]
    want = lines_brute([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id: r.text for r in after.collect()} == {i: t for (i, o), t in want.items() if WORDS.search(t) or t == o}
    before, after = at["simhash near-dedup"]
    fps = {r.doc_id: fingerprint(r.text, 5) for r in before.collect()}
    ids = list(fps)
    comp = union(ids, [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 3])
    assert {r.doc_id for r in after.collect()} == set(comp.values())
    before, after = at["mixing"]
    size = collections.Counter()
    for r in before.collect():
        size[r.source] += len(WORDS.findall(r.text))
    got, goal = collections.Counter(), fill(size)
    for r in after.collect():
        got[r.source] += len(WORDS.findall(r.text))
    assert all(abs(got[s] - goal[s]) <= max(2, 0.02 * goal[s]) for s in size)
    before, after = at["packing"]
    path = tokenizer_path("word_bpe_49k.json")
    assert after.agg(F.sum("length")).first()[0] == sum(len(ids_of(path, r.text)) for r in before.collect())


def test_names():
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES] == list(range(1, 14))
