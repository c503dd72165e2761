"""Token ids in flat files with Elias-Fano coded document boundaries.

A shard file: magic, all ids (little-endian unsigned, 16 bits where the vocabulary allows it, else 32), the boundaries and the document ids as Elias-Fano blocks, a
JSON footer, its length. Of n non-decreasing values below u, an Elias-Fano block keeps l = log2(u/n) low bits each and the
high parts in unary, about 2 + l bits a value; every 512th one bit's place is kept in 32 bits, from which select starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.shared import cut, new_path

MAGIC, SAMPLE = b"EFIDS001", 512


class EliasFano:
    """n values, non-decreasing, none negative; select(i) and select(i, j) give the i-th, or those from i to j - 1."""

    def __init__(self, n: int, low_bits: int, low, high, samples):
        self.n, self.l, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values) -> EliasFano:
        import numpy as np

        v = np.asarray(values, np.uint64)
        n = len(v)
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) // 8 + 1) if n else 0, np.uint8)
        np.bitwise_or.at(high, places >> 3, (1 << (places & 7)).astype(np.uint8))
        return cls(n, low_bits, low, high, places[::SAMPLE].astype("<u4"))

    def blob(self) -> tuple[dict, bytes]:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return {"n": self.n, "l": self.l, "sizes": [len(p) for p in parts]}, b"".join(parts)

    @classmethod
    def load(cls, head: dict, data: bytes) -> EliasFano:
        import numpy as np

        a, b, _ = head["sizes"]
        return cls(head["n"], head["l"], np.frombuffer(data[:a], np.uint8), np.frombuffer(data[a : a + b], np.uint8), np.frombuffer(data[a + b :], "<u4"))

    def select(self, i: int, j: int | None = None):
        import numpy as np

        one, j = j is None, i + 1 if j is None else j
        if j <= i:
            return np.zeros(0, np.uint64)
        first, end = int(self.samples[i // SAMPLE]) >> 3, -(-j // SAMPLE)
        last = (int(self.samples[end]) >> 3) + 1 if end < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first:last], bitorder="little")) + 8 * first
        # ones before the sampled place may share its byte
        ones = ones[np.searchsorted(ones, int(self.samples[i // SAMPLE])) :][i % SAMPLE :][: j - i]
        out = (ones - np.arange(i, j)).astype(np.uint64) << np.uint64(self.l)
        if self.l:
            a, b = i * self.l, j * self.l
            bits = np.unpackbits(self.low[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 :][: b - a].reshape(-1, self.l)
            out |= (bits.astype(np.uint64) << np.arange(self.l, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out[0] if one else out


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write(folder: str, tokenizer: str, end_id: int, width: int):
    def run(batches):
        import json
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from pitpanel.llm.tokens import encoder

        enc, end = encoder(tokenizer, width), end_id.to_bytes(width, "little")
        shard, out, path = TaskContext.get().partitionId(), None, ""
        lengths, ids, nulls = [], [], 0
        for batch in batches:
            if out is None and batch.num_rows:  # an attempt writes a file of its own; only the manifest makes it count
                path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"
                store, place = _open(folder)
                store.create_dir(place, recursive=True)
                out = store.open_output_stream(f"{place}/{path.rpartition('/')[2]}")
                out.write(MAGIC)
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                data = enc.encode(text.as_py() or "") + end
                out.write(data)
                lengths.append(len(data) // width)
                if doc is None:
                    nulls += 1
                else:
                    ids.append(doc)
        if out is None:
            return
        ends = np.cumsum(np.array(lengths, np.uint64))
        base = ids[0] if ids else 0
        heads = []
        for v in (ends, (np.array(ids, np.int64).view(np.uint64) - np.array([base], np.int64).view(np.uint64))):
            head, data = EliasFano.build(v).blob()
            out.write(data)
            heads.append(head)
        foot = json.dumps({"boundaries": heads[0], "doc_ids": heads[1], "base": base, "null_ids": nulls, "width": width}).encode()
        out.write(foot)
        out.write(len(foot).to_bytes(4, "little"))
        out.close()
        row = [[shard], [path], [len(lengths)], [int(ends[-1])]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["shard", "path", "n_docs", "n_ids"])

    return run


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """(doc_id, text) -> manifest (shard, path, n_docs, n_ids, start); shards and their rows ascend by doc_id, nulls first.

    Every row becomes a document, repeated ids included (then ordered by text); null texts are empty; other columns are
    ignored; an empty table gives an empty manifest. A file counts only if the (written) manifest names it, so that files
    of lost or repeated attempts are never read.
    """
    from pitpanel.llm.tokens import width_of

    spark = docs.sparkSession
    folder = folder or new_path(spark, "ids")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    d = d.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    shards = cut(d.mapInArrow(_write(folder, tokenizer, end_id, width_of(tokenizer, end_id)), "shard int, path string, n_docs long, n_ids long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard file
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def _read(docs: int, request: int = 1 << 22):
    def run(batches):
        import json
        import zlib

        import numpy as np
        import pyarrow as pa

        names = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()}
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store, place = _open(path)
                with store.open_input_file(place) as f:
                    size = f.size()
                    n = int.from_bytes(f.read_at(4, size - 4), "little")
                    foot = json.loads(f.read_at(n, size - 4 - n))
                    a, b = sum(foot["boundaries"]["sizes"]), sum(foot["doc_ids"]["sizes"])
                    tail = size - 4 - n - a - b
                    ends = EliasFano.load(foot["boundaries"], f.read_at(a, tail))
                    ids = EliasFano.load(foot["doc_ids"], f.read_at(b, tail + a))
                    nulls, base, width, at = foot["null_ids"], foot["base"], foot["width"], 0
                    for i in range(0, ends.n, docs):
                        j = min(ends.n, i + docs)
                        to = ends.select(i, j).tolist()
                        own = [None] * max(0, min(j, nulls) - i) + [base + x for x in ids.select(max(0, i - nulls), max(0, j - nulls)).tolist()]
                        rows, k, to_ = [], 0, np.array(to)
                        while k < len(to):  # a run of documents by one request, of `request` bytes or the next document's
                            last = max(k + 1, int(np.searchsorted(to_, at + request // width, "right")))
                            data = np.frombuffer(f.read_at(width * (to[last - 1] - at), len(MAGIC) + width * at), f"<u{width}")
                            base_at = at
                            for doc, e in zip(own[k:last], to[k:last]):
                                rows.append((doc, start + at, e - at, zlib.crc32(data[at - base_at : e - base_at].astype("<u4"))))
                                at = e
                            k = last
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), names.values())], list(names))

    return run


def read_ids(manifest: DataFrame, docs: int = 4096) -> DataFrame:
    """manifest -> per document, from the files: doc_id, start, n_tokens, ids_crc32. One shard is one task's work."""
    parts = manifest.sparkSession.sparkContext.defaultParallelism * 4  # a number, so that small rows are not put into one task
    files = manifest.select("path", "start").repartition(parts, "path")
    return files.mapInArrow(_read(docs), "doc_id long, start long, n_tokens long, ids_crc32 long")
