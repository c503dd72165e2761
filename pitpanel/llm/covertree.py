"""Near-duplicate vectors: exact pairs over a cosine threshold by dual traversal of cover trees.

Vectors that are equal are one point. Points (unit vectors; cosine >= c means distance <= sqrt(2 - 2c)) are dealt into
blocks of bounded size; each block is a cover tree: nested levels of centres whose covering radii halve (2, 1, 1/2, ...),
each node with the true radius of what it covers. For every pair of blocks, both trees are walked together from the top: a
pair of nodes is dropped if the distance of its centres exceeds both radii and the threshold, and linked whole if that
distance and both radii stay within the threshold; what is left at the points is decided by the cosine itself. Nodes wider
than the threshold part little, so their children meet in matrix products and not pair by pair. The trees are written once;
a task reads two partitions of them, of bounded size, and walks their pairs one after the other. So nothing is shuffled for
the pairs, memory is bounded, whatever the number of blocks, the width of the vectors or the links, and no task sees a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.components import components
from pitpanel.llm.shared import cut

BLOCK, LEAST_RADIUS, SLACK = 4096, 1 / 16, 1e-7
#: Components of the vectors of a block, and of those that a step of the walk looks up, at most.
WIDE, STEP = 1 << 21, 1 << 20
#: While pairs of blocks are walked: bytes of trees in each of a task's two partitions, and pairs handed to Python at once.
PAIRING = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.files.openCostInBytes": "256k", "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}


def _cover(points, left, radius: float, owner, rows: int = 256) -> None:
    """Greedy cover of the points `left` (the first stays a centre) by balls around some of them; sets their owners."""
    import numpy as np

    while len(left):
        head = left[:rows]
        near = points[head] @ points[left].T >= 1 - radius * radius / 2
        free = np.ones(len(left), bool)
        for r in range(len(head)):
            if free[r]:
                own = near[r] & free
                own[r] = True
                owner[left[own]] = head[r]
                free[own] = False
        left = left[free]


def build(points):
    """Unit vectors -> (order, levels): levels of (first point, end, radius, centre) of nodes over the points in that order.

    The children of a node lie side by side; the last level has a node per point.
    """
    import numpy as np

    n = len(points)
    owner = np.zeros(n, np.int64)  # of each point, the centre that covers it at this level
    chain, radius = [owner], 1.0
    while len(np.unique(owner)) < n and radius >= LEAST_RADIUS:
        new = owner.copy()
        by = np.argsort(owner, kind="stable")
        for group in np.split(by, np.flatnonzero(np.diff(owner[by])) + 1):
            if len(group) > 1:
                centre = owner[group[0]]  # stays one: levels are nested
                _cover(points, np.r_[centre, group[group != centre]], radius, new)
        owner = new
        chain.append(owner)
        radius /= 2
    if len(np.unique(owner)) < n:
        chain.append(np.arange(n))
    order = np.lexsort(chain[::-1])
    levels = []
    for own in chain:
        own = own[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        gap = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", points[order], points[own])))
        levels.append((first, np.r_[first[1:], n], np.maximum.reduceat(gap, first), own[first]))
    return order, levels


def dual(x, y, tx, ty, cosine: float, same: bool = False, rows: int = 128, many: int = 1 << 16):
    """Walks both trees; yields arrays (first, end, first, end): each point of the first range links with each of the second.

    A pair of nodes is dropped if its centres lie further apart than both radii and the threshold, and taken whole if they
    lie so near that the radii cannot part any two of its points. With `same`, x and y are one tree: pairs come once, and a
    range with itself stands for the pairs of different points in it. Products are looked through in single precision, less
    the greatest error they can have; what they leave open is decided in double precision.
    """
    import numpy as np

    far, err = np.sqrt(2 - 2 * cosine), (x.shape[1] + 4) * 2.0**-23
    xs = x.astype(np.float32)
    ys = xs if same else y.astype(np.float32)
    level = lambda t, k: t[min(k, len(t) - 1)]

    def least(gap):
        """The product of two unit vectors so far apart."""
        return 1 - np.minimum(gap, 2) ** 2 / 2

    def settle(k: int, a, b, product):
        """Pairs of nodes of level k with the products of their centres: taken, dropped or gone down with."""
        (fx, ex, rx, _), (fy, ey, ry, _) = level(tx, k), level(ty, k)
        one = (ex[a] - fx[a] == 1) & (ey[b] - fy[b] == 1)
        if same:
            keep = ~(one & (a == b))
            a, b, product, one = a[keep], b[keep], product[keep], one[keep]
        room = far - SLACK - rx[a] - ry[b]
        whole = np.where(one, product >= cosine, (room >= 0) & (product >= least(np.maximum(room, 0))))
        if whole.any():
            yield fx[a[whole]], ex[a[whole]], fy[b[whole]], ey[b[whole]]
        open_ = ~whole & ~one & (product >= least(rx[a] + ry[b] + far + SLACK))
        if open_.any():
            yield from walk(k, a[open_], b[open_])

    def walk(k: int, a, b):
        """Open pairs of nodes of level k: the pairs of their children."""
        ax, zx, ay, zy = *ends(tx, k, a), *ends(ty, k, b)
        size = (zx - ax) * (zy - ay)
        for n in np.flatnonzero(size > many):
            yield from table(k + 1, np.arange(ax[n], zx[n]), np.arange(ay[n], zy[n]))
        few = np.flatnonzero(size <= many)
        cx, cy = level(tx, k + 1)[3], level(ty, k + 1)[3]
        run = np.cumsum(size[few]) // many
        for part in np.split(few, np.flatnonzero(np.diff(run)) + 1) if len(few) else ():
            of = np.repeat(part, size[part])  # the pair whose children these are
            at = np.arange(len(of)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
            i, j = ax[of] + at // (zy - ay)[of], ay[of] + at % (zy - ay)[of]
            if same:
                i, j = i[i <= j], j[i <= j]
            yield from settle(k + 1, i, j, np.einsum("ij,ij->i", x[cx[i]], y[cy[j]]))

    def ends(t, k: int, a):
        """Of nodes of level k, the first and the end of their children in level k + 1."""
        (first, end, *_), (below, *_) = level(t, k), level(t, k + 1)
        return np.searchsorted(below, first[a]), np.searchsorted(below, end[a])

    def children(t, k: int, a):
        first, end = ends(t, k, a)
        n = end - first
        return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)

    def table(k: int, a, b):
        """All pairs of two lists of nodes of level k, as matrix products.

        Nodes wider than the threshold are never taken whole and part little; where they leave many pairs open, their
        children meet as a table of their own instead of pair by pair.
        """
        (fx, ex, rx, _), (fy, ey, ry, _) = level(tx, k), level(ty, k)
        wide, other = (rx[a] > far) & (ex[a] - fx[a] > 1), (ry[b] > far) & (ey[b] - fy[b] > 1)
        yield from chunks(k, a[~wide], b[~other], False)
        yield from chunks(k, a[wide], b, True)
        yield from chunks(k, a[~wide], b[other], True)

    def chunks(k: int, a, b, wide: bool):
        (fx, ex, rx, cx), (fy, ey, ry, cy) = level(tx, k), level(ty, k)
        if not len(b):
            return
        right, q = ys[cy[b]].T, np.flatnonzero(ey[b] - fy[b] > 1)
        for s in range(0, len(a), rows):
            i = a[s : s + rows]
            near = xs[cx[i]] @ right
            open_ = near >= np.float32(least(far + SLACK) - err)  # right for single points; nodes of more have radii
            p = np.flatnonzero(ex[i] - fx[i] > 1)
            open_[p] = near[p] >= least(rx[i[p]][:, None] + ry[b][None] + far + SLACK) - err
            open_[:, q] = near[:, q] >= least(rx[i][:, None] + ry[b[q]][None] + far + SLACK) - err
            if same:
                open_ &= i[:, None] <= b[None]
            if wide and np.count_nonzero(open_) > open_.size // 8:
                yield from table(k + 1, children(tx, k, i[open_.any(axis=1)]), children(ty, k, b[open_.any(axis=0)]))
                continue
            p, h = np.divmod(np.flatnonzero(open_), len(b))
            exact = x[cx[i]] @ y[cy[b]].T if len(p) > open_.size // 8 else None
            for c in range(0, len(p), many):
                g, j = p[c : c + many], h[c : c + many]
                product = np.einsum("ij,ij->i", x[cx[i[g]]], y[cy[b[j]]]) if exact is None else exact[g, j]
                yield from settle(k, i[g], b[j], product)

    top = [len(level(t, 0)[0]) for t in (tx, ty)]
    try:
        yield from table(0, np.arange(top[0]), np.arange(top[1]))
    finally:
        del x, y, xs, ys, tx, ty  # the functions above refer to each other, and so would keep these until a collection of cycles


def _forest(a, b):
    """Links -> for every point met, the least point it reaches by them."""
    import numpy as np

    nodes, both = np.unique(np.r_[a, b], return_inverse=True)
    u, v = both[: len(a)], both[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, u, label[v])
        np.minimum.at(least, v, label[u])
        least = least[least]
        if (least == label).all():
            return nodes, nodes[label]
        label = least


def _unit(vectors):
    import numpy as np

    v = np.asarray(vectors, np.float64)
    with np.errstate(all="ignore"):
        v = v / np.abs(v).max(axis=1, keepdims=True)  # neither under- nor overflow in the squares
        return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _tree(pdf):
    import pickle

    import numpy as np
    import pandas as pd

    v = _unit(np.stack(pdf["v"].to_numpy()))
    order, levels = build(v)
    held = {"id": pdf["id"].to_numpy()[order], "times": pdf["times"].to_numpy()[order]}
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    held["levels"] = [(f, e, r, place[c]) for f, e, r, c in levels]
    kind = np.float32 if all(getattr(x, "dtype", None) == np.float32 for x in pdf["v"]) else np.float64
    held["v"] = np.stack(pdf["v"].to_numpy()).astype(kind)[order]
    return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "block": [pdf["block"].iloc[0]], "tree": [pickle.dumps(held)]})


def _meet(one: bytes, other: bytes | None, cosine: float):
    """Two trees, or one with itself -> ids of the points that link, rows that each links to, the point it reaches."""
    import pickle

    import numpy as np

    x, same = pickle.loads(one), other is None
    y = x if same else pickle.loads(other)
    vx = _unit(x.pop("v"))
    vy = vx if same else _unit(y.pop("v"))
    n = len(vx)
    times, label = np.r_[x["times"], [] if same else y["times"]].astype(np.int64), None
    before = np.r_[0, np.cumsum(times)]
    # steps at the ends of ranges: rows linked to, ranges linked with themselves, neighbours that a range holds together
    gain, alone, chain = np.zeros((3, len(times) + 1), np.int64)
    held, size = [], 0

    def forest():
        nonlocal label, held, size
        a, b = (np.concatenate(z) for z in zip(*held))
        if label is not None:
            at = np.flatnonzero(label != np.arange(len(label)))
            a, b = np.r_[a, at], np.r_[b, label[at]]
        nodes, least = _forest(a, b)
        label = np.arange(len(times))
        label[nodes] = least
        held, size = [], 0

    def step(steps, first, end, by):
        np.add.at(steps, first, by)
        np.add.at(steps, end, -by)

    for fa, ea, fb, eb in dual(vx, vy, x["levels"], y["levels"], cosine, same, many=min(1 << 16, -(-STEP // vx.shape[1]))):
        fb, eb = (fb, eb) if same else (fb + n, eb + n)
        step(gain, fa, ea, before[eb] - before[fb])
        two, own = fa != fb, fa == fb
        step(gain, fb[two], eb[two], (before[ea] - before[fa])[two])
        step(alone, fa[own], ea[own], np.ones(own.sum(), np.int64))
        for f, e in ((fa, ea), (fb, eb)):
            step(chain, f, e - 1, np.ones(len(f), np.int64))
        new = two if label is None else two & (label[fa] != label[fb])
        held.append((fa[new], fb[new]))
        size += new.sum()
        if size > 1 << 18:
            forest()
    count = (np.cumsum(gain) - np.cumsum(alone) * np.r_[times, 0])[:-1]
    at = np.flatnonzero(np.cumsum(chain)[:-1])
    held.append((at, at + 1))
    forest()
    met = np.flatnonzero(count)
    ids = x["id"] if same else np.r_[x["id"], y["id"]]
    return ids[met], count[met], ids[label[met]]


def _merged(found):
    """Several results of _meet as one: a row per point."""
    import numpy as np

    ids, n, to = (np.concatenate(z) for z in zip(*found))
    nodes, least = _forest(ids, to)
    total = np.zeros(len(nodes), np.int64)
    np.add.at(total, np.searchsorted(nodes, ids), n)
    return nodes, total, least


def _pairs(cosine: float):
    def run(batches):
        import pandas as pd

        found, size, most = [], 0, 1 << 18
        for pdf in batches:
            for one, other in zip(pdf["tree"], pdf["other"]):
                found.append(_meet(one, other, cosine))
                size += len(found[-1][0])
                if size > most:
                    found = [_merged(found)]
                    size = len(found[0][0])
                    most = 2 * size + (1 << 18)
        if found:
            ids, n, to = _merged(found)
            for s in range(0, len(ids), 1 << 16):
                yield pd.DataFrame({"id": ids[s : s + (1 << 16)], "n": n[s : s + (1 << 16)], "to": to[s : s + (1 << 16)]})

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9, block: int = BLOCK) -> DataFrame:
    """(vec_id, embedding array<float|double>) -> vec_id, n_links, component_id, kept.

    A row per input row. Null and empty vectors, vectors of zeros and those with null, NaN or infinite components link with
    nothing; vectors of different lengths do not link. Repeated rows are vectors of their own (linked by their equal
    vectors); a null vec_id is linked but names no component, and its `kept` is null. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    fine = F.coalesce(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    # equal vectors are one point; its id is a number given when the points are written
    key = F.sha2(F.to_json(F.struct("v")), 256)
    rows = cut(rows.select("vec_id", fine.alias("fine"), F.when(fine, key).alias("key"), F.when(fine, F.col("v")).alias("v")), "vectors")
    points = rows.where("fine").groupBy("key").agg(F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count("*").alias("times"))
    points = cut(points.select(F.monotonically_increasing_id().alias("id"), "key", "least", "times", F.size("v").alias("dim"), "v"), "points")
    # a row per vector length; blocks of wide vectors hold fewer points
    sizes = {r["dim"]: -(-r["n"] // max(1, min(block, WIDE // r["dim"]))) for r in points.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    blocks = F.create_map(*(F.lit(x) for kv in sizes.items() for x in kv)) if sizes else F.create_map(F.lit(0), F.lit(1))
    # block by hash within the number that the count asks for
    own = points.select("id", "times", "dim", "v", F.pmod(F.xxhash64("key"), F.element_at(blocks, F.col("dim"))).cast("int").alias("block"))
    widest = max((min(block * dim, max(WIDE, dim)) for dim in sizes), default=1)
    trees = cut(own.groupBy("dim", "block").applyInPandas(_tree, "dim int, block int, tree binary"), "trees", maxRecordsPerFile=max(1, WIDE // widest))
    # every task reads two partitions of the trees: a tree is not shuffled, nor copied for each other block
    other = trees.select(F.col("dim").alias("dim_b"), F.col("block").alias("b"), F.col("tree").alias("tree_b"))
    pairs = trees.hint("shuffle_replicate_nl").join(other, (F.col("dim") == F.col("dim_b")) & (F.col("block") <= F.col("b")))
    pairs = pairs.select("tree", F.when(F.col("block") < F.col("b"), F.col("tree_b")).alias("other"))
    found = cut(pairs.mapInPandas(_pairs(cosine), "id long, n long, to long"), "vector_links", PAIRING)
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    named = points.join(labels, points.id == labels.node, "left").select("id", "key", "least", "times", F.coalesce("label", "id").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").join(links, "id", "left").select("key", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id")
    linked = rows.where("fine").select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
