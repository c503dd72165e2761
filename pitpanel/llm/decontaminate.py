"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test questions and answers reads each text once.

A text's words are taken after A-Z are lowered; a window is `WINDOW` consecutive words of an item, or all of an item that has
fewer. The automaton runs over word numbers, so that its size is that of the windows in words, and every occurrence of any
window is found in one walk. Documents are neither shuffled nor joined. Windows travel to the tasks in broadcasts of at most
`PER_SCAN` windows and `BYTES` bytes (counted first, dealt by hash); a test set beyond that is scanned in several passes, each
adding its hits to those of the last.
"""

from __future__ import annotations

from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.shared import Scratch

WINDOW, PER_SCAN, BYTES = 10, 100_000, 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Regular expression (Java and RE2) of a word of a lowered text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same over UTF-8 bytes: each byte lowered, or a blank where it is in no word. All bytes beyond ASCII are in words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPANS = "array<struct<start:bigint,end:bigint>>"


def windows(items: DataFrame, columns: tuple[str, ...] = ("text",), width: int = WINDOW) -> DataFrame:
    """(item_id, text columns) -> different (item string, window: words joined by blanks), each column windowed by itself."""
    parts = F.explode(F.array(*(F.regexp_extract_all(F.translate(c, UPPER, LOWER), F.lit(WORD), F.lit(0)) for c in columns)))
    w = items.select(F.col("item_id").cast("string").alias("item"), parts.alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1)))
    return w.select("item", "w", starts.alias("i")).select("item", F.array_join(F.slice("w", F.col("i"), width), " ").alias("window")).distinct()


class Machine:
    """The automaton of (item, window) rows; `ranges` gives the hit word ranges of a folded text and the items hit."""

    def __init__(self, rows):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        of: dict[tuple[int, ...], set] = {}
        for item, window in rows:
            key = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window.encode().split(b" "))
            of.setdefault(key, set()).add(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for n, (key, items) in enumerate(of.items()):
            self.machine.add_word(key, (n, len(key), items))
        if of:
            self.machine.make_automaton()
        self.empty = not of

    def ranges(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word ranges (first, end), ascending and apart, inside any occurrence; items, None for items without id."""
        if self.empty or not words:
            return [], set()
        reach, seen, items = {}, set(), set()
        for at, (n, length, of) in self.machine.iter(tuple(map(self.numbers.get, words, repeat(0)))):
            reach[at] = max(length, reach.get(at, 0))
            if n not in seen:
                seen.add(n)
                items |= of
        return joined((at - length + 1, at + 1) for at, length in reach.items()), items


def joined(ranges) -> list[tuple[int, int]]:
    """The union of ranges, as ranges that neither meet nor touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def offsets(raw: bytes, folded: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as byte offsets of the original text, from the start of their first word to the end of their last."""
    import re

    wanted = {k for a, b in ranges for k in (a, b - 1)}
    at = {k: m.span() for k, m in enumerate(re.finditer(rb"[^ ]+", folded)) if k in wanted}
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def points(raw: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Byte offsets as offsets in code points."""
    out, byte, point = [], 0, 0
    for a, b in spans:
        start = point + len(raw[byte:a].decode())
        byte, point = b, start + len(raw[a:b].decode())
        out.append({"start": start, "end": point})
    return out


def _pass(sent, last: bool, cleaned: bool):
    """mapInArrow function: adds the hits of one automaton to `ranges` and `items`; the last one turns ranges into the results."""
    def run(batches):
        import pyarrow as pa

        machine = None
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            machine = machine or Machine(sent.value)
            texts, rows = batch.column("_text"), {"_words": [], "_ranges": [], "_items": [], "_spans": [], "_clean": []}
            before = zip(batch.column("_ranges").to_pylist(), batch.column("_items").to_pylist())
            for text, (ranges, items) in zip(texts.cast(pa.binary()), before):
                raw = text.as_py() or b""
                folded = raw.translate(FOLD)
                words = folded.split()
                found, more = machine.ranges(words)
                ranges = joined([*found, *((r["start"], r["end"]) for r in ranges)])
                rows["_words"].append(len(words))
                rows["_ranges"].append([{"start": a, "end": b} for a, b in ranges])
                rows["_items"].append(sorted({*items, *(x for x in more if x is not None)}))
                if last:
                    spans = offsets(raw, folded, ranges) if ranges else []
                    rows["_spans"].append(points(raw, spans))
                    if cleaned:
                        cuts = [0, *(x for s in spans for x in s), len(raw)]
                        rows["_clean"].append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2])).decode() if text.is_valid else None)
            kinds = {"_words": pa.int64(), "_ranges": pair, "_items": pa.list_(pa.string()), "_spans": pair, "_clean": pa.string()}
            own = [n for n in kinds if rows[n] or not batch.num_rows]
            own = [n for n in own if n in ("_words", "_ranges", "_items") or last and (n == "_spans" or cleaned)]
            kept = [n for n in batch.schema.names if n not in kinds and (n != "_text" or not last)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *(pa.array(rows[n], kinds[n]) for n in own)], [*kept, *own])

    return run


def scan(docs: DataFrame, benchmark: DataFrame, columns: tuple[str, ...] = ("text",), width: int = WINDOW, cleaned: bool = False, per_scan: int = PER_SCAN) -> DataFrame:
    """docs (with text) -> its columns but text, and n_words, n_hit, items (sorted strings), spans (code points of the original
    text, end exclusive, neighbouring hit words in one span); with `cleaned` also text without those spans.

    A row per input row, repeated ids included. Null and empty texts have no words and no hits (a cleaned null stays null);
    items without words hit nothing; rows of one item_id are one item, and an item without id hits words but is not listed.
    Other columns pass through, save those named like the results, which these replace. An empty test set hits nothing.
    """
    spark = docs.sparkSession
    results = ["n_words", "n_hit", "items", "spans", "text"]
    kept = [c for c in docs.columns if c not in results]
    d = docs.select(*(F.col(f"`{c}`") for c in kept), F.col("text").cast("string").alias("_text"), F.expr(f"cast(array() as {SPANS})").alias("_ranges"), F.expr("cast(array() as array<string>)").alias("_items"))
    scratch = Scratch(spark)
    rows = scratch.cut(windows(benchmark, columns, width), "benchmark_windows")
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    scans = max(1, -(-n // per_scan), -(-size // BYTES))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name in kept)
    for k in range(scans):
        last = k == scans - 1
        own = rows.where(F.pmod(F.xxhash64("item", "window"), F.lit(scans)) == k)
        sent = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])  # at most about per_scan windows
        schema = [head, "" if last else "_text string", f"_words bigint, _ranges {SPANS}, _items array<string>", f"_spans {SPANS}" if last else "", "_clean string" if last and cleaned else ""]
        d = d.mapInArrow(_pass(sent, last, cleaned), ", ".join(filter(None, schema)))
        if not last:
            d = scratch.cut(d, "benchmark_hits")
    scratch.drop("benchmark_windows")
    hit = F.aggregate("_ranges", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return d.select(*(F.col(f"`{c}`") for c in kept), F.col("_words").alias("n_words"), hit.alias("n_hit"), F.col("_items").alias("items"), F.col("_spans").alias("spans"), *([F.col("_clean").alias("text")] if cleaned else []))
