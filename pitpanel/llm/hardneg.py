"""Hard-negative mining by bit-sliced integer products.

Vectors become integers and lie in runs of about `RUN` components, sorted by label, packed as one row a run; anchors lie in
blocks of their own. A block of anchors meets a run in one task. There the run's components are bit planes: the products of the
planes from the most significant down to a first cut are summed (planes whose rest is wider than the spread of scores cannot drop
anything, so they are taken in one product); from then on a pair's score is known up to an interval, which every further plane
halves. Pairs whose interval cannot reach the task's best scores so far, or the anchor's windows, are dropped; the others get
the next plane. What is left after the last plane has its exact score. Products are exact: 32-bit floats, 64-bit floats or
integers, by the bound of the sums at hand.

Two rounds: the best rows of an anchor's own label (its positives), in runs that hold that label only; then, for every
positive, the best rows of other labels within its window of scores. Of each round only the few best of an anchor and a run
travel, packed by block, and are merged as they stream by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.shared import Scratch, join_small

RUN, BLOCK, TILE, PAIRS = 1 << 19, 1 << 16, 2048, 1 << 16
NONE = -(1 << 62)  # the score of no row; its id is LAST
LAST = (1 << 63) - 1
PACK = "run int, dim int, lo bigint, hi bigint, ids binary, labels binary, q binary"
#: What streams through the tasks: a run or block (kind 0), then what meets it or is merged into it (kind 1).
STREAM = ("run", "block", "dim", "kind", "ids", "labels", "q", "found", "scores")
BEST = "block int, dim int, found binary, scores binary"
BLOCKS = "block int, dim int, ids binary, labels binary, q binary, found binary, scores binary"
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _pack(batches):
    """Rows of a partition, sorted by length and label -> a row per length: components floor(256 x) as 64-bit integers."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    run, of = TaskContext.get().partitionId(), {}
    for b in batches:
        v = b.column("v")
        sizes = np.diff(np.asarray(v.offsets))
        flat = np.asarray(v.flatten(), np.float64) * 256
        if len(flat) and np.abs(flat).max() >= 2.0**62:
            raise OverflowError("components beyond 62 bits")
        flat, at = np.floor(flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])
        ids, labels = np.asarray(b.column("vec_id"), np.int64), np.asarray(b.column("label"), np.int64)
        for dim in np.unique(sizes):
            mine = np.flatnonzero(sizes == dim)
            rows = flat.reshape(-1, dim) if len(mine) == len(sizes) else np.stack([flat[at[i] : at[i + 1]] for i in mine])
            of.setdefault(int(dim), []).append((ids[mine], labels[mine], rows))
    for dim, parts in of.items():
        ids, labels, q = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((ids, labels))
        ids, labels, q = ids[order], labels[order], q[order]
        row = [run, dim, int(labels[0]), int(labels[-1]), ids.tobytes(), labels.tobytes(), q.astype(narrow(q)).tobytes()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["run", "dim", "lo", "hi", "ids", "labels", "q"])


def narrow(q):
    import numpy as np

    return np.int16 if not q.size or np.abs(q).max() < 1 << 15 else np.int64


def wide(data: bytes, rows: int, dim: int):
    """The components of a packed block as 64-bit integers."""
    import numpy as np

    return np.frombuffer(data, np.int16 if len(data) == 2 * rows * dim else np.int64).reshape(rows, dim).astype(np.int64)


class Run:
    """The candidates of a task, and exact products with their bit planes."""

    def __init__(self, ids, labels, q):
        import numpy as np

        self.ids, self.labels, self.least = ids, labels, int(q.min())
        self.u = q - self.least
        self.bits = int(self.u.max()).bit_length()
        self.rms = float(np.sqrt((q.astype(np.float64) ** 2).mean()))

    def kind(self, a):
        """The type in which sums of products with `a` are exact."""
        import numpy as np

        top = (1 << self.bits) * int(np.abs(a).sum(axis=1).max()) if len(a) else 0
        top = max(top, abs(self.least) * int(np.abs(a).sum(axis=1).max()) if len(a) else 0) * 2
        if top >= 1 << 62:
            raise OverflowError("scores beyond 62 bits")
        return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64

    def first_cut(self, a) -> int:
        """How many planes are left when the rest first is no wider than the spread of scores."""
        import numpy as np

        width = float(np.abs(a).sum(axis=1).mean())
        spread = self.rms * float(np.sqrt((a.astype(np.float64) ** 2).sum(axis=1).mean()))
        k = self.bits
        while k > 0 and ((1 << k) - 1) * width > spread:
            k -= 1
        return k


def survivors(run: Run, a, cols: slice, floor, ceiling, allowed=None, keep: int = 0):
    """Pairs (row of a, column, score) of the columns with floor <= score <= ceiling by row of a, and maybe more, found plane by plane.

    `allowed` masks pairs. With `keep`, a row's floor also rises to its keep-th best lower bound.
    """
    import numpy as np

    kind, u, k = run.kind(a), run.u[cols], run.first_cut(a)
    x = a.astype(kind)
    up, down = np.maximum(a, 0).sum(axis=1), np.minimum(a, 0).sum(axis=1)
    base = run.least * a.sum(axis=1)
    score = x @ ((u >> k) << k).astype(kind).T + base.astype(kind)[:, None]
    floor = floor.copy()
    if keep and score.shape[1] >= keep and allowed is None:
        floor = np.maximum(floor, (np.partition(score, -keep, axis=1)[:, -keep]).astype(np.int64) + ((1 << k) - 1) * down)
    rest = (1 << k) - 1
    ok = (score >= (floor - rest * up).astype(kind)[:, None]) & (score <= (ceiling - rest * down).astype(kind)[:, None])
    if allowed is not None:
        ok &= allowed
    rows, at = np.nonzero(ok)
    known = score[rows, at].astype(np.int64)
    while k > 0 and len(rows):
        k -= 1
        plane = ((u >> k) & 1).astype(kind)
        for i in range(0, len(rows), PAIRS):
            part = slice(i, i + PAIRS)
            known[part] += np.einsum("ij,ij->i", x[rows[part]], plane[at[part]]).astype(np.int64) << k
        rest = (1 << k) - 1
        ok = (known + rest * up[rows] >= floor[rows]) & (known + rest * down[rows] <= ceiling[rows])
        rows, at, known = rows[ok], at[ok], known[ok]
    return rows, at + cols.start, known


def best(keys, ids, scores, n: int, most: int):
    """The first `most` of each key (0 to n - 1) by score, then id -> arrays (n, most) of ids and scores, filled up with none."""
    import numpy as np

    out, top = np.full((n, most), LAST, np.int64), np.full((n, most), NONE, np.int64)
    order = np.lexsort((ids, -scores, keys))
    keys, ids, scores = keys[order], ids[order], scores[order]
    rank = np.arange(len(keys)) - np.searchsorted(keys, keys)
    ok = (rank < most) & (scores > NONE)
    out[keys[ok], rank[ok]], top[keys[ok], rank[ok]] = ids[ok], scores[ok]
    return out, top


def merge(found, top, keys, ids, scores):
    """The tables of `best` with more rows merged in."""
    import numpy as np

    n, most = found.shape
    had = np.repeat(np.arange(n), most)
    return best(np.concatenate([had, keys]), np.concatenate([found.ravel(), ids]), np.concatenate([top.ravel(), scores]), n, most)


def positives(run: Run, ids, labels, q, most: int):
    """The best `most` other rows of the run with each anchor's label."""
    import numpy as np

    found, top = np.full((len(ids), most), LAST, np.int64), np.full((len(ids), most), NONE, np.int64)
    for label in np.intersect1d(labels, run.labels):
        mine = np.flatnonzero(labels == label)
        first, end = np.searchsorted(run.labels, label), np.searchsorted(run.labels, label, "right")
        f, t = found[mine], top[mine]
        for i in range(first, end, TILE):
            # one more than asked for, since the anchor itself may be among them
            rows, at, score = survivors(run, q[mine], slice(i, min(end, i + TILE)), t[:, -1], np.full(len(mine), -NONE), keep=most + 1)
            other = run.ids[at] != ids[mine][rows]
            f, t = merge(f, t, rows[other], run.ids[at][other], score[other])
        found[mine], top[mine] = f, t
    return found, top


def negatives(run: Run, labels, q, scores, most: int, low: int, high: int):
    """The best `most` rows of other labels for each anchor and positive with low% to high% of the positive's score."""
    import numpy as np

    n, k = scores.shape
    there = scores > NONE
    lo = np.where(there, -((-low * np.where(there, scores, 0)) // 100), -NONE)
    hi = np.where(there, high * np.where(there, scores, 0) // 100, NONE)
    lo, hi = np.where(lo > hi, -NONE, lo), np.where(lo > hi, NONE, hi)
    found, top = np.full((n * k, most), LAST, np.int64), np.full((n * k, most), NONE, np.int64)
    use = np.flatnonzero((lo <= hi).any(axis=1))
    for i in range(0, len(run.ids), TILE) if len(use) else ():
        cols = slice(i, min(len(run.ids), i + TILE))
        floor = np.maximum(lo, top[:, -1].reshape(n, k))[use].min(axis=1)
        rows, at, score = survivors(run, q[use], cols, floor, hi[use].max(axis=1), labels[use][:, None] != run.labels[cols][None, :])
        rows = use[rows]
        for j in range(k):
            ok = (score >= lo[rows, j]) & (score <= hi[rows, j])
            mine = slice(j, n * k, k)
            found[mine], top[mine] = merge(found[mine], top[mine], rows[ok], run.ids[at][ok], score[ok])
    return found.reshape(n, k * most), top.reshape(n, k * most)


def _unpacked(row: dict):
    """ids, labels and components of a packed row."""
    import numpy as np

    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), wide(row["q"], len(ids), row["dim"])


def _table(data: bytes, rows: int):
    import numpy as np

    return np.frombuffer(data, np.int64).reshape(rows, -1)


def _batch(rows: list[list], schema: str):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[t]) for x, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _meet(step):
    """mapInArrow function over a run, then the blocks of anchors that meet it: a row of BEST for each block."""
    def go(batches):
        run = None
        for row in (r for b in batches for r in b.to_pylist()):
            if row["kind"] == 0:
                run = Run(*_unpacked(row))
            else:
                found, scores = step(run, row)
                yield _batch([[row["block"], row["dim"], found.tobytes(), scores.tobytes()]], BEST)

    return go


def _merged(most: int, groups: int, result):
    """mapInArrow function over a block of anchors, then what its runs found: result(block row, found, scores) at its end.

    Of each anchor and group (positive), `most` rows are kept; memory holds one block and one row of finds.
    """
    def go(batches):
        import numpy as np

        block = found = scores = None
        for row in (r for b in batches for r in b.to_pylist()):
            if row["kind"] == 0:
                if block is not None:
                    yield from result(block, found, scores)
                block, n = row, len(row["ids"]) // 8 * groups
                found, scores = np.full((n, most), LAST, np.int64), np.full((n, most), NONE, np.int64)
            else:
                more = np.frombuffer(row["found"], np.int64), np.frombuffer(row["scores"], np.int64)
                found, scores = merge(found, scores, np.repeat(np.arange(len(found)), most), *more)
        if block is not None:
            yield from result(block, found, scores)

    return go


def _with_positives(block, found, scores):
    yield _batch([[*(block[n] for n in ("block", "dim", "ids", "labels", "q")), found.tobytes(), scores.tobytes()]], BLOCKS)


def _rows(k: int):
    def result(block, found, scores):
        import numpy as np

        ids = np.frombuffer(block["ids"], np.int64)
        positive, positive_score = _table(block["found"], len(ids)).ravel(), _table(block["scores"], len(ids)).ravel()
        at, rank = np.nonzero(scores > NONE)
        if len(at):
            cols = ids[at // k], positive[at], rank + 1, found[at, rank], positive_score[at], scores[at, rank]
            yield _batch(list(zip(*(c.tolist() for c in cols))), RESULT)

    return result


def _stream(first: DataFrame, then: DataFrame, by: str, parts: int) -> DataFrame:
    """Rows of both by run or block, each partition sorted so that `first` comes before what belongs to it."""
    def shaped(d: DataFrame, kind: int) -> DataFrame:
        own = {"kind": F.lit(kind)} | {n: F.col(n) for n in STREAM if n in d.columns}
        return d.select(*(own.get(n, F.lit(None).cast("int" if n in ("run", "block") else "binary")).alias(n) for n in STREAM))

    both = shaped(first, 0).unionByName(shaped(then, 1))
    return both.repartitionById(max(1, parts), F.col(by)).sortWithinPartitions(by, "dim", "kind")


def hard_negatives(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, run: int = RUN, block: int = BLOCK) -> DataFrame:
    """(vec_id, embedding array<float|double>, label integer) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows for which `anchors` holds are anchors. Rows with a null id or label, a null or empty vector, or a null or non-finite
    component take no part; of rows with one vec_id the first by label and vector does. Vectors of different lengths do not
    meet. Equal scores are told by the smaller vec_id. Scores are 64-bit integers; where components are so large that one
    could overflow, the run ends with an OverflowError. Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
    fine = fine & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    d = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    first = F.row_number().over(Window.partitionBy("vec_id").orderBy("label", "v"))
    d = scratch.cut(d.where(F.coalesce(fine, F.lit(False))).withColumn("n", first).where("n = 1").drop("n").withColumn("dim", F.size("v")), "vectors")
    whole, own = d.agg(F.coalesce(F.sum("dim"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("anchor"), F.col("dim"))), F.lit(0))).first()

    def packed(rows: DataFrame, components: int, size: int, name: str) -> tuple[DataFrame, int]:
        n = max(1, -(-components // size))
        dealt = rows.repartitionByRange(n, "dim", "label", F.xxhash64("vec_id")).sortWithinPartitions("dim")
        out = scratch.cut(dealt.select("vec_id", "label", "v").mapInArrow(_pack, PACK), name)
        return out, 1 + (out.agg(F.max("run")).first()[0] or 0)

    runs, n_runs = packed(d, whole, run, "runs")
    blocks, n_blocks = packed(d.where("anchor"), own, block, "anchors")
    blocks = blocks.withColumnRenamed("run", "block")
    places = runs.select("run", "dim", F.col("lo").alias("run_lo"), F.col("hi").alias("run_hi"))

    met = join_small(blocks, places, "dim", "inner", 1_000_000).where("run_lo <= hi and lo <= run_hi")  # a row of a few numbers for each run
    found = _stream(runs, met, "run", n_runs).mapInArrow(_meet(_positives(n_positives)), BEST)
    found = scratch.cut(found, "best_positives")
    chosen = _stream(blocks, found, "block", n_blocks).mapInArrow(_merged(n_positives, 1, _with_positives), BLOCKS)
    chosen = scratch.cut(chosen, "chosen_positives")

    met = join_small(chosen, places, "dim", "inner", 1_000_000).where("run_lo <= run_hi")
    found = _stream(runs, met, "run", n_runs).mapInArrow(_meet(_negatives(n_positives, n_negatives, low, high)), BEST)
    found = scratch.cut(found, "best_negatives")
    out = _stream(chosen, found, "block", n_blocks).mapInArrow(_merged(n_negatives, n_positives, _rows(n_positives)), RESULT)
    out = scratch.cut(out, "hard_negatives")
    scratch.drop("vectors", "runs", "anchors", "best_positives", "chosen_positives", "best_negatives")
    return out


def _positives(most: int):
    return lambda run, row: positives(run, *_unpacked(row), most)


def _negatives(k: int, most: int, low: int, high: int):
    def step(run, row):
        ids, labels, q = _unpacked(row)
        return negatives(run, labels, q, _table(row["scores"], len(ids)), most, low, high)

    return step
