"""Operator 11 against a comparison of all words with each other."""

import collections
import re
import zlib

import numpy as np
import pytest

from pitpanel.llm import spelling
from pitpanel.llm.queries import ORACLES, QUERIES

LOW = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(rows, every=199, least=5, length=6, times=5):
    count = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= length:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= least}
    by = collections.defaultdict(list)
    for w in count:
        by[len(w)].append(w)
    found = {}
    for w, n in count.items():
        others = [v for k in (-1, 0, 1) for v in by[len(w) + k] if near(w, v)]
        best = min(others, key=lambda v: (-count[v], v), default=None)
        found[w] = (best if best and count[best] >= times * n else None, n, len(others))
    out = {}
    for w, (form, n, k) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        out[w] = (form, root, n, k, count[form] if form else None)
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    got = [tuple(r) for r in spelling.variants(df, **options).collect()]
    assert len({r[0] for r in got}) == len(got)
    want = brute(rows, **{k: v for k, v in options.items() if k != "long"})
    assert {r[0]: r[1:] for r in got} == want
    return want


def made(seed, n=60, size=8):
    r = np.random.RandomState(seed)
    letters = list("abcàéÿzßA")
    base = ["".join(r.choice(letters, size)) for _ in range(6)]
    words = []
    for _ in range(n * 40):
        w = list(base[r.randint(6)])
        for _ in range(r.randint(0, 3)):
            k, i = r.randint(3), r.randint(len(w))
            w[i : i + (k != 2)] = [r.choice(letters)] if k else []
        words.append("".join(w))
    return [(i if i % 9 else None, " ".join(words[i::n])) for i in range(n)]


@pytest.mark.parametrize("long", [256, 8, 7])
def test_variants(spark, long):
    """Also where words of eight or more letters go the way of long ones, and where the boundary lies between near words."""
    rows = made(3) + [(1, None), (2, ""), (3, "12 34 !"), (3, "short abc"), (3, "short abc")]
    want = check(spark, rows, least=2, times=2, every=13, long=long)
    assert sum(1 for w in want.values() if w[0]) > 20 and any(w[1] != w[0] for w in want.values() if w[0])


def test_ties_chains_and_runs(spark):
    rows = [(1, "abcdef " * 200 + "abcdeg " * 200 + "abcdex " * 9 + "abcdexx " * 1 + "Abcdéx " * 5)]
    rows += [(2, "aaaaaa " * 700 + "aaaaaaa " * 100 + "aaaaaaaa " * 10 + "ABCDEFG " * 7 + "abc×def " * 6 + "naïveté's " * 30)]
    want = check(spark, rows, every=10**9)
    assert want["aaaaaaaa"][:2] == ("aaaaaaa", "aaaaaa") and want["abcdex"][0] == "abcdef"


def test_long_words(spark):
    """A run of letters of 20,000 code points and its variants: no square of its length."""
    w = "".join(np.random.RandomState(1).choice(list("abcdefgh"), 20_000))
    rows = [(i, " ".join([w, w[:500] + "z" + w[501:], w[:9] + w[10:], w + "q", w[:256], w[:255], w[:257]][: 7 if i < 5 else 1])) for i in range(30)]
    want = check(spark, rows, every=10**9)
    assert len(want) == 7 and want[w][2:4] == (30, 3)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(df).count() == 0


def test_registered_query(spark, sf):
    import duckdb

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_spelling_variants"](spark, sf).collect()}
    assert got == brute(rows) and any(r[0] for r in got.values())
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    assert {r[0]: r[1:] for r in con.sql("select word, form, root, n, n_near, form_n from (" + ORACLES["op11_spelling_variants"] + ")").fetchall()} == got
