"""WARC archives: written by Spark's text writer, read back by verifying the chain of record borders.

Reading: archives are split at `\\r\\n\\r\\nWARC/1.`, so any task's block of any file yields segments that start at a
magic string of any version 1.x, in a payload or not. Each task emits, for every segment, the candidate link from its offset to that of its
successor (by Content-Length), and where the chain leaves the block. Pointer jumping over those exits, from the start of
each file, finds the block entries that are reached; in a block, a candidate is kept if the chain from the entry passes
it, which pre-order numbers of the forest of successors tell. Magic inside payloads is never reached. A link counts only if it
ends at a candidate or at the end of the file; where one does not, its record is told as broken and the chain goes on at the next
candidate whose own link counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.llm.shared import Scratch, cut, drop_path, join_small, new_path, write

CRLF2 = "\r\n\r\n"
MAGIC = "WARC/1.0\r\n"
#: What all versions begin with, and where archives are split.
STEM = "WARC/1."
BREAK = CRLF2 + STEM


def write_warc(pages: DataFrame, path: str, least_bytes: int = 100, date: str = "2024-01-01T00:00:00Z") -> None:
    """pages(page_id, url, html) -> WARC files in the folder `path`, a record per row.

    Of the rows with equal payloads of at least `least_bytes` bytes, that with the smallest page_id is a response and the
    others revisit it; all other rows are responses. A null html is an empty payload; a null page_id is written without
    number, is always a response, and never referred to; repeated rows (same page_id and payload) are of the same type.
    Only digests are shuffled, texts are not, unless the list of revisits is large.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    sums = cut(p.select("page_id", F.sha2("html", 256).alias("digest"), F.octet_length("html").alias("n")), "digests")
    firsts = sums.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("c")).where("c > 1")
    revisits = cut(sums.join(firsts.drop("c"), "digest").where("page_id > first and n >= %d" % least_bytes).select("page_id", "first", F.col("digest").alias("_d")).distinct(), "revisits")
    p = join_small(p.withColumn("_d", F.sha2("html", 256)), revisits, ["page_id", "_d"], "left")
    ref = F.col("first").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(k + ": "), v, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.octet_length("html").cast("string")), F.lit("\r\n"))
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20]", "")
    size = F.octet_length(http) + F.when(ref, F.lit(0)).otherwise(F.octet_length("html"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(ref, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "_d")),
        F.when(ref, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", name(F.col("first")))
        )).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", size.cast("string")),
        F.lit("\r\n"), http, F.when(ref, F.lit("")).otherwise(F.col("html")),
    )
    p.select(record.alias("value")).write.option("lineSep", CRLF2).text(path)


SCAN = "file string, block long, idx int, start long, next long, exit long, tin int, tout int, whole boolean, type string, id string, refers string, bytes long, digest string, consumed long, root long"


def _parse(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n"))
    return {k.strip().lower().decode("latin-1"): v.strip().decode("latin-1") for k, _, v in pairs}


def _facts(head: dict[str, str], block: bytes) -> tuple[int, str]:
    """Bytes and digest of a record's payload: the block, without the HTTP head where Content-Type names HTTP. A revisit has
    no payload of its own but the digest of the one that it stands for."""
    from hashlib import sha256

    if head.get("content-type", "").partition(";")[0].strip().lower() == "application/http":
        block = block.partition(b"\r\n\r\n")[2]
    if head.get("warc-type") == "revisit":
        return len(block), head.get("warc-payload-digest", "").rpartition(":")[2]
    return len(block), sha256(block).hexdigest()


def _blocks(batches):
    """(file, block, idx, offset of the text in the block, text) of every segment, in order."""
    last, idx, at = None, 0, 0
    for batch in batches:
        for file, block, value in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value")):
            if (file, block) != last:
                last, idx, at = (file, block), 0, 0
            text = value.as_py()
            yield file, block, idx, at, text
            idx, at = idx + 1, at + len(text) + len(BREAK)


def _chain(rows: list[list]) -> None:
    """Fill exit, tin, tout and root of the rows (of one block, by offset), whose start and next are known."""
    by, n = {r[3]: i for i, r in enumerate(rows) if r[4] is not None}, len(rows)
    size, free, roots = [1] * n, [0] * n, 0
    up = [by.get(r[4]) for r in rows]
    for i in range(n):  # a successor lies behind: children come first
        if up[i] is not None:
            size[up[i]] += size[i]
    for i in reversed(range(n)):
        r = rows[i]
        if up[i] is None:
            r[5], r[6], r[15], roots = r[4], roots, r[3], roots + size[i]
        else:
            r[5], r[6], r[15] = rows[up[i]][5], free[up[i]], rows[up[i]][15]
            free[up[i]] += size[i]
        r[7], free[i] = r[6] + size[i], r[6] + 1


def _scan(batches):
    import pyarrow as pa
    from itertools import groupby

    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in SCAN.split(", ")]
    for (file, block), segments in groupby(_blocks(batches), key=lambda s: s[:2]):
        rows, total = [], 0
        for _, _, idx, at, text in segments:
            total, start, skip = at + len(text) + len(BREAK), at - len(STEM), 0
            row = [file, block, idx, start, None, None, 0, 0, False, None, None, None, 0, None, 0, 0]
            if block == 0 and idx == 0:  # the file's first record holds its own magic
                row[3], skip = 0, len(STEM)
            head, found, body = text[skip:].partition(b"\r\n\r\n")
            if found and (not skip or text.startswith(STEM.encode())) and head.partition(b"\r\n")[0].isdigit():
                h = _parse(head)
                if h.get("content-length", "").isdigit():
                    n = int(h["content-length"])
                    row[4] = at + skip + len(head) + 4 + n + 4
                    row[8] = len(body) >= n
                    row[9:12] = h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to")
                    if row[8]:
                        row[12:14] = _facts(h, body[:n])
                    else:
                        row[12] = n
            rows.append(row)
        _chain(rows)
        for r in rows:
            r[14] = total
        for i in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + 4096]), types)], names)


def _texts(batches):
    import pyarrow as pa

    for file, block, idx, _, text in _blocks(batches):
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((file, block, idx, text), (pa.string(), pa.int64(), pa.int32(), pa.binary()))], ["file", "block", "idx", "text"])


def _joined(spark: SparkSession, lines: DataFrame, cands: DataFrame, reached: DataFrame) -> DataFrame:
    """The facts of reached records that hold magic strings or go on in other blocks: their segments are put together."""
    broken = reached.where("not whole").select("file", F.col("at").alias("abs"), F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("idx"), F.struct("at", "to").alias("of"))
    rows = cands.select("file", "abs", "block", "idx", F.lit(None).cast(broken.schema["of"].dataType).alias("of")).unionByName(broken)
    before = Window.partitionBy("file").orderBy("abs", F.col("block").asc_nulls_first())  # a broken record, then its segments
    rows = rows.withColumn("of", F.last("of", ignorenulls=True).over(before)).where("block is not null and abs < of.to")
    parts = cut(rows.select("file", "block", "idx", "abs", "of.at"), "parts")
    texts = join_small(lines.mapInArrow(_texts, "file string, block long, idx int, text binary"), parts, ["file", "block", "idx"], "inner")

    def put(key, pdf):
        import pandas as pd

        text = BREAK.encode().join(pdf.sort_values("abs")["text"])
        text = text[len(STEM):] if key[1] == 0 and text.startswith(STEM.encode()) else text
        head, _, body = text.partition(b"\r\n\r\n")
        h = _parse(head)
        n = int(h["content-length"])
        size, digest = _facts(h, body[:n])
        return pd.DataFrame({"file": [key[0]], "at": [key[1]], "bytes2": [size], "digest2": [digest], "held": [len(body) >= n]})

    return texts.groupBy("file", "at").applyInPandas(put, "file string, at long, bytes2 long, digest2 string, held boolean")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The archives in a folder -> a row per record reached: file, at, type, id, refers, bytes, digest (of the payload), broken.

    Files may have any size, blocks any border, records any version 1.x. A record that is `cut short` by the end of its file, has
    `no length` or a `wrong length` (it ends where neither a record nor the file does) says so in `broken` and has neither bytes
    nor digest; the next candidate with a sound link is taken for the next record. A file that does not begin with a record is told as one with
    no length. An empty folder gives no rows.
    """
    scratch = Scratch(spark)
    lines = spark.read.option("lineSep", BREAK).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )
    raw = scratch.cut(lines.mapInArrow(_scan, SCAN), "candidates")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = raw.where("idx = 0").select("file", "block", "consumed").withColumn("base", F.coalesce(F.sum("consumed").over(before), F.lit(0)))
    blocks = blocks.withColumn("end", F.sum("consumed").over(Window.partitionBy("file")) - len(BREAK))
    cands = raw.drop("consumed").join(blocks.drop("consumed"), ["file", "block"]).withColumn("abs", F.col("base") + F.col("start")).withColumn("to", F.col("base") + F.col("next"))
    cands = cands.withColumn("out", F.col("base") + F.col("exit")).withColumn("root", F.col("base") + F.col("root"))
    # where a block's chain leads, and whether that is a border: a candidate's start, or the end of the file, with or without its empty lines
    starts = cands.select("file", F.col("abs").alias("out"), F.lit(True).alias("_start"))
    ends = lambda c: F.coalesce(F.col(c).between(F.col("end"), F.col("end") + 4), F.lit(False))
    led = cands.select("file", "abs", "out", "root", "to", "end").join(starts, ["file", "out"], "left")
    led = scratch.cut(led.withColumn("sound", F.coalesce("_start", F.lit(False)) | ends("out")).drop("_start"), "exits")
    jumps, lost = led.where("sound").select("file", "abs", "out"), led.where("not sound")
    if not lost.isEmpty():
        # a broken record is the root of its block's chain; the next candidate behind it whose own link counts goes on, or else
        # the next that has a length at all, to be told as broken itself
        ahead = Window.partitionBy("file").orderBy("abs").rowsBetween(1, Window.unboundedFollowing)
        counts = (F.col("abs") != F.col("root")) | F.col("sound")
        first = lambda x: F.first(F.when(x, F.col("abs")), ignorenulls=True).over(ahead)
        on = led.withColumn("on", F.coalesce(first(counts), first(F.col("to").isNotNull()))).where("abs = root and not sound").select("file", "root", "on")
        jumps = jumps.unionByName(lost.join(on, ["file", "root"]).where("on is not null").select("file", "abs", F.col("on").alias("out")))
    # pointer jumping: after k rounds `seen` holds the entries within 2^k - 1 jumps of a file's start, `jumps` leads 2^k on
    jumps = cut(jumps, "jumps")
    seen, n, old = scratch.cut(cands.where("abs = 0").select("file", "abs"), "entries"), -1, []
    while (now := seen.count()) > n:
        n = now
        ahead = seen.join(jumps, ["file", "abs"]).select("file", F.col("out").alias("abs"))
        a, b = new_path(spark, "entries"), new_path(spark, "jumps")
        more = write(seen.unionByName(ahead).distinct(), a)
        far = jumps.select("file", F.col("out").alias("_m"), "abs").join(jumps.select("file", F.col("abs").alias("_m"), "out"), ["file", "_m"]).select("file", "abs", "out")
        seen, jumps = more, write(far, b)
        for x in old:
            drop_path(spark, x)
        old = [a, b]
    entries = cands.join(seen, ["file", "abs"], "left_semi").select("file", "block", F.col("tin").alias("entry"))
    found = cands.join(entries, ["file", "block"]).where("tin <= entry and entry < tout")
    # within a block links end at candidates; only a root can be broken
    sound = led.where("abs = root").select("file", "abs", "sound")
    found = found.join(sound, ["file", "abs"], "left").withColumn("sound", F.coalesce("sound", F.lit(True)))
    broken = F.when(F.col("next").isNull(), "no length").when(~F.col("sound") & (F.col("to") > F.col("end")), "cut short").when(~F.col("sound"), "wrong length")
    reached = scratch.cut(found.select("file", F.col("abs").alias("at"), "to", "whole", "type", "id", "refers", "bytes", "digest", broken.alias("broken")), "reached")
    fine = lambda c: F.when(F.col("broken").isNull(), F.col(c)).alias(c)
    columns = ["file", "at", "type", "id", "refers"]
    if reached.where("not whole and broken is null").isEmpty():
        return reached.select(*columns, fine("bytes"), fine("digest"), "broken")
    more = scratch.cut(_joined(spark, lines, cands, reached.where("broken is null")), "joined")
    out = reached.join(more, ["file", "at"], "left")
    out = out.withColumn("broken", F.when(F.col("broken").isNull() & ~F.col("whole") & ~F.coalesce("held", F.lit(False)), "cut short").otherwise(F.col("broken")))
    out = out.withColumn("bytes", F.when(F.col("whole"), F.col("bytes")).otherwise(F.col("bytes2"))).withColumn("digest", F.when(F.col("whole"), F.col("digest")).otherwise(F.col("digest2")))
    return out.select(*columns, fine("bytes"), fine("digest"), "broken")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Archives as write_warc makes them -> page_id, payload_bytes, payload_digest, record_type, refers_to; revisits resolved.

    A revisit stands for the response with the page_id it refers to and the payload digest it names.
    """
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
    r = read_warc(spark, path).where("broken is null").select(
        number("id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), number("refers").alias("refers_to")
    )
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = r.where("record_type = 'response'").groupBy(F.col("page_id").alias("_p"), F.col("payload_digest").alias("_d")).agg(F.first("payload_bytes").alias("_n"))
    on = (F.col("refers_to") == F.col("_p")) & (F.col("payload_digest") == F.col("_d"))
    again = r.where("record_type = 'revisit'").join(first, on, "left").withColumn("payload_bytes", F.col("_n"))
    return r.where("record_type = 'response'").select(cols).unionByName(again.select(cols))
