"""Registered queries by name over whole small tables, against brute force or an exact round trip."""

import collections
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F
from test_ops import WORDS, fill, fingerprint, lines_brute, table, union

from pitpanel.llm.queries import ORACLES, QUERIES
from pitpanel.llm.shared import tokenizer_path


def ids_of(text, name, end=2):
    from tokenizers import Tokenizer

    tok = ids_of.made.setdefault(name, Tokenizer.from_file(tokenizer_path(name)))
    return [*tok.encode(text or "", add_special_tokens=False).ids, end]


ids_of.made = {}


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_op3(spark, sf):
    rows = [(d["doc_id"], d["text"]) for d in table(spark, sf, "documents")]
    fps = {i: fingerprint(t) for i, t in rows}
    comp = union(list(fps), [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, sf).collect()}
    assert got == {i: (f"{fps[i]:016x}", comp[i]) for i in fps}


def test_op7(spark, sf):
    start, want = 0, {}
    for i, t in sorted((d["doc_id"], d["text"]) for d in table(spark, sf, "documents")):
        ids = ids_of(t, "byte_bpe_50k.json")
        want[i] = (start, len(ids), crc(ids))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op7_binary_ids"](spark, sf).collect()} == want


def test_op8(spark, sf):
    rows = table(spark, sf, "documents")
    sizes = {d["doc_id"]: len(WORDS.findall(d["text"] or "")) for d in rows}
    source, total, taken = {d["doc_id"]: d["source"] for d in rows}, collections.Counter(), collections.Counter()
    for i, n in sizes.items():
        total[source[i]] += n
    want, got = fill(total), QUERIES["op8_mixing"](spark, sf).collect()
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (sizes[r.doc_id], total[s]) and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_op9(spark, sf):
    rows = sorted({(d["doc_id"], d["text"]) for d in table(spark, sf, "documents")})
    want = {i: text for (i, _), text in lines_brute(rows).items()}
    assert {r.doc_id: r.text for r in QUERIES["op9_line_dedup"](spark, sf).collect()} == want


def test_op10(spark, sf):
    """Each id lies in one piece, pieces lie gapless in sequences of at most 4096, and all but those of a power of two are full."""
    want = {d["doc_id"]: ids_of(d["text"], "word_bpe_49k.json") for d in table(spark, sf, "documents")}
    of, seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in QUERIES["op10_packing"](spark, sf).collect():
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(ids) > 0 and r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == crc(ids)
        of[r.doc_id].append((r.start, r.length))
        seq[r.sequence_id].append((r.offset, r.length))
    for i, ids in want.items():
        at = 0
        for start, n in sorted(of[i]):
            assert start == at
            at += n
        assert at == len(ids)
    for pieces in seq.values():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
        assert at <= 4096 and at & (at - 1) == 0 or at == 4096


@pytest.mark.parametrize("name", ["op1_covertree", "op2_chat_formatting", "op4_warc", "op6_secret_scans"])
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    d = QUERIES[name](spark, sf)
    want = con.sql(f"select {', '.join(d.columns)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in d.select(*(F.col(c) for c in d.columns)).collect()))) == sorted(map(str, want))
