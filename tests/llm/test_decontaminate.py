"""Operator 12 against a brute-force search over word lists."""

import hashlib
import re

import pytest

from pitpanel.llm import decontaminate
from pitpanel.llm.queries import ORACLES, QUERIES

LOW = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def words(text):
    return re.findall(decontaminate.WORD, (text or "").translate(LOW))


def brute(doc, items, width=10):
    """(n_words, hit word numbers, item ids)"""
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        q = words(text)
        n = min(width, len(q))
        wanted = {tuple(q[i : i + n]) for i in range(len(q) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in wanted:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), hit, found


ITEMS = [
    (1, "Which of these, the FIRST second third fourth fifth sixth seventh eighth ninth?"),
    (2, "one two  three"), (2, "an answer of two rows that share one id, long enough for a window or two"),
    (3, None), (4, ""), (5, "?!"), (None, "no id here"), (10, "Éa été ½ £5 naïve"), (11, "a a a a a a a a a a a a"), (12, "nul\x00byte"),
]
TEXTS = [
    None, "", "  \n", "One-two three", "one two", "three one two three one two three.", "x" * 50, "no ID here and one_two_three",
    "of these the first; SECOND third fourth fifth sixth seventh eighth and more", "these the first second third fourth fifth sixth seventh eighth ninth tenth",
    "ÉA ÉTÉ", "Éa été ½ £5 naïve", "éa été ½ £5 naïve", "a " * 9, "a " * 10, "a " * 5000 + "b", "nul\x00byte", "日本語 one two three 日本語",
    "begin " + "an answer of two rows that share one id long enough" * 2 + " end", "word " * 200_000 + "one two three",
]


@pytest.mark.parametrize("per_scan", [4, 100_000])
def test_scan(spark, per_scan):
    rows = [(i // 2 if i % 5 else None, t, 7, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, item string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id int")
    got = decontaminate.scan(docs, bench, cleaned=True, per_scan=per_scan).collect()
    out = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, tuple(r.items)) for r in got)
    want = []
    for i, t, *_ in rows:
        n, hit, found = brute(t, ITEMS)
        want.append((i if i is not None else -1, n, len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    assert out == sorted(want)
    # offsets are those of the original text; what is left of it holds none of the hit words
    for r in got:
        source = [t for t in TEXTS if len(words(t)) == r.n_words and (r.text is None) == (t is None) and brute(t, ITEMS)[2] - {None} == {int(x) for x in r.items}]
        assert any("".join(t[a:b] for a, b in zip([0, *(s.end for s in r.spans)], [*(s.start for s in r.spans), len(t)])) == r.text for t in source if t is not None) or r.text is None
        assert any(sum(len(words(t[s.start : s.end])) for s in r.spans) == r.n_hit for t in source if t is not None) or r.text is None
    assert got[0].item == "x"


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    r = decontaminate.scan(docs, bench).first()
    assert (r.n_words, r.n_hit, r["items"], r.spans) == (3, 0, [], [])
    assert decontaminate.scan(docs.where("false"), bench).count() == 0


def test_questions_and_answers_are_windowed_apart(spark):
    docs = spark.createDataFrame([(1, "what is it it is this"), (2, "it is this"), (3, "is it it")], "doc_id long, text string")
    bench = spark.createDataFrame([("q", "what is it", "it is this")], "item_id string, question string, answer string")
    got = {r.doc_id: (r.n_hit, [(s.start, s.end) for s in r.spans]) for r in decontaminate.scan(docs, bench, ("question", "answer")).collect()}
    assert got == {1: (6, [(0, 21)]), 2: (3, [(0, 10)]), 3: (0, [])}


def test_registered_query(spark, sf):
    import duckdb

    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_decontamination"](spark, sf).collect()}
    for d, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        n, hit, found = brute(text, items)
        listed = ",".join(sorted(map(str, found)))
        assert got[d] == (n, len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))
    assert any(x[4] for x in got.values())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    assert {r[0]: r[1:] for r in con.sql(ORACLES["op12_decontamination"]).fetchall()} == got
