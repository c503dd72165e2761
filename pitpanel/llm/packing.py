"""Packing by lexical retrieval: in shards of bounded size, BM25 finds unused neighbours that fill a seed's window.

A shard is a run of documents of one task's input (their texts are not shuffled), with an inverted index of its own over
token ids. The first unused document opens a window of 4096 tokens, its neighbours follow by score; one that is too long is
cut and its rest opens the next window. What remains of the last window of a task is cut into powers of two, so that no
sequence needs padding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 4096


class Index:
    """BM25 over the documents of one shard: scores(i) of all documents for the terms of document i."""

    def __init__(self, docs: list, k1: float = 1.2, b: float = 0.75):
        import numpy as np

        lengths = np.array([len(d) for d in docs])
        n = len(docs)
        keys, tf = np.unique((np.concatenate(docs).astype(np.int64) << 32) | np.repeat(np.arange(n), lengths), return_counts=True)
        terms, self.doc = keys >> 32, keys & 0xFFFFFFFF
        ids, first, df = np.unique(terms, return_index=True, return_counts=True)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        self.weight = np.repeat(idf, df) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[self.doc] / max(1.0, lengths.mean())))
        self.first, self.df, self.n = first, df, n
        term = np.repeat(np.arange(len(ids)), df)
        order = np.argsort(self.doc, kind="stable")
        self.terms_of = np.split(term[order], np.cumsum(np.bincount(self.doc, minlength=n))[:-1])

    def scores(self, i: int):
        import numpy as np

        terms = self.terms_of[i]
        df = self.df[terms]
        at = np.repeat(self.first[terms] - np.r_[0, np.cumsum(df)[:-1]], df) + np.arange(int(df.sum()))
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def order_of(docs: list, window: int = WINDOW):
    """The documents of a shard, window by window: each seed, then its unused neighbours until the window is full."""
    import numpy as np

    index, used, at = Index(docs), np.zeros(len(docs), bool), 0
    filled = 0
    for seed in range(len(docs)):
        if used[seed]:
            continue
        used[seed] = True
        yield seed
        filled = (filled + len(docs[seed])) % window
        if used.all():
            return
        score = np.where(used, -1.0, index.scores(seed))
        for near in np.argsort(-score, kind="stable"):
            if score[near] <= 0:
                break
            used[near] = True
            yield int(near)
            filled += len(docs[near])
            if filled >= window:  # its rest opens the next window
                filled %= window
                break


def _pack(tokenizer: str, end_id: int, window: int, shard_tokens: int, shard_docs: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from pitpanel.llm.tokens import encoder

        enc, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        at, rows, docs, total = TaskContext.get().partitionId() << 40, [], [], 0
        names = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
        open_, filled = [], 0  # the window that is being filled: (doc_id, start, ids, doc_tokens)

        def close(limit: int):
            nonlocal open_, filled, at
            offset, rest = 0, []
            for doc, start, ids, n in open_:
                take = min(len(ids), limit - offset)
                if take:
                    rows.append((doc, start, take, ids[:take].tobytes(), n, at, offset))
                    offset += take
                if take < len(ids):
                    rest.append((doc, start + take, ids[take:], n))
            open_, filled, at = rest, filled - limit, at + 1

        def pack():
            nonlocal filled
            for i in order_of([ids for _, ids in docs], window):
                doc, ids = docs[i]
                open_.append((doc, 0, ids, len(ids)))
                filled += len(ids)
                while filled >= window:
                    close(window)
            docs.clear()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), names.values())], list(names))
            rows.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.frombuffer(enc.encode(text.as_py() or "") + end, "<u4")
                docs.append((doc, ids))
                total += len(ids)
                if total >= shard_tokens or len(docs) >= shard_docs:
                    pack()
                    total = 0
                    if rows:
                        yield out()
        if docs:
            pack()
        while filled:
            close(1 << (filled.bit_length() - 1))
        if rows:
            yield out()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, shard_tokens: int = 1 << 20, shard_docs: int = 2048) -> DataFrame:
    """(doc_id, text) -> a row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Every row is a document, repeated ones too; null texts are empty (their end id only); a null doc_id stays null; other
    columns are ignored; an empty table gives no rows. Memory is bounded by a shard and the longest text.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInArrow(
        _pack(tokenizer, end_id, window, shard_tokens, shard_docs),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
