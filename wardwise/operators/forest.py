"""Feature importances and scores of a random forest whose cost grows with the rows, however deep its trees.

Equal binned rows are one weighted row; a tree draws it as often as a Poisson number of that mean says, by a hash of
the row, so results do not depend on the partitioning. Nodes with many rows are split level by level: a pass gives
the histograms of all of them in all trees. The rows below them, a bounded number a node, are then shuffled to their
node once, and a task finishes its subtree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.session import materialize

BINS = 32
#: Drawn rows of a node whose subtree one task grows.
NODE_ROWS = 65_536
#: Nodes of a level that are split at a time.
NODES = 4096
#: Shares of a class travel as whole numbers of this part, so that their sums do not depend on the order.
SHARES = 1 << 40


def forest_importances(rows: DataFrame, trees: int = 100, depth: int = 30, seed: int = K.SEED,
                       node_rows: int = NODE_ROWS) -> np.ndarray:
    """Importance per place of ``x`` for rows (x array<double>, label int from 0): the Gini gain of the splits by the
    rows of their node, one in all per tree, then over all trees. Each node looks at the rounded up square root of
    the number of features; branches with one prediction are cut back."""
    spark = rows.sparkSession
    binned, edges, classes, tops = _upper(rows, trees, depth, seed, node_rows)
    k = len(edges)
    if any(t.open for t in tops):
        sent = spark.sparkContext.broadcast((seed, k, classes, [t.packed(t.open) for t in tops]))
        width = 4 * spark.sparkContext.defaultParallelism
        done = (binned.mapInArrow(_dealt(sent), "tree int, node int, data binary").repartition(width, "tree", "node")
                .groupBy("tree", "node").applyInPandas(_subtree(sent, depth), "tree int, node int, pred int, gains array<double>"))
        for r in done.collect():  # a row per subtree
            tops[r.tree].below(r)
        sent.unpersist()
    one = np.array([t.importance(k) for t in tops])
    whole = one.sum(axis=1, keepdims=True)
    mean = np.divide(one, whole, out=np.zeros_like(one), where=whole > 0).sum(axis=0)
    return mean / mean.sum() if mean.sum() > 0 else mean


def _upper(rows: DataFrame, trees: int, depth: int, seed: int, node_rows: int, leaf: int = 1):
    """(binned rows, edges, number of classes, the upper nodes of every tree), all nodes of over node_rows rows split."""
    spark = rows.sparkSession
    k, classes = _shape(rows)
    edges = _edges(rows, k)
    binned = materialize(rows.mapInArrow(_bin(edges), "bins binary, label int").groupBy("bins", "label").agg(
        F.count(F.lit(1)).alias("w")).withColumn("h", F.xxhash64(F.lit(seed), "bins", "label")), "binned")
    tops = [_Top() for _ in range(trees)]
    total = binned.agg(F.sum("w")).first()[0]
    for top in tops:
        top.big = [0] if total > node_rows else []
        top.open = [] if top.big else [0]
    for level in range(depth):
        if not any(t.big for t in tops):
            break
        sent = spark.sparkContext.broadcast((seed, k, classes, [t.packed(t.big) for t in tops]))
        best = (binned.mapInArrow(_histograms(sent), "tree int, node int, sums binary").groupBy("tree", "node")
                .applyInPandas(_best(sent, leaf), "tree int, node int, feature int, cut int, gain double, left binary, right binary"))
        found = best.collect()  # a row per node of over node_rows rows and tree
        sent.unpersist()
        for t in tops:
            t.big = []
        for r in sorted(found, key=lambda r: (r.tree, r.node)):
            tops[r.tree].split(r, level + 1 < depth, node_rows)
    return binned, edges, classes, tops


def forest_scores(rows: DataFrame, held: DataFrame, trees: int = 100, depth: int = 30, leaf: int = 1, seed: int = K.SEED,
                  node_rows: int = NODE_ROWS) -> DataFrame:
    """Rows (label, n, probability): of how many rows of ``held`` (x, label) the mean share of class 1 over the leaves of
    a forest on ``rows`` is how much. Leaves have ``leaf`` drawn rows or more; equal binned rows of a label are one.

    The trees are never together: the held rows go to the nodes that tasks finish, with the rows that these grow from.
    """
    spark = rows.sparkSession
    binned, edges, classes, tops = _upper(rows, trees, depth, seed, node_rows, leaf)
    asked = materialize(held.mapInArrow(_bin(edges), "bins binary, label int").groupBy("bins", "label").agg(
        F.count(F.lit(1)).alias("n")), "asked")
    cells = asked.select("bins").distinct()
    sent = spark.sparkContext.broadcast((seed, len(edges), classes, [t.packed(t.open) for t in tops]))
    both = binned.select("bins", "label", "w", "h").union(cells.select(
        "bins", F.lit(-1).alias("label"), F.lit(1).cast("long").alias("w"), F.lit(0).cast("long").alias("h")))
    width = 4 * spark.sparkContext.defaultParallelism
    found = (both.mapInArrow(_dealt(sent), "tree int, node int, data binary").repartition(width, "tree", "node")
             .groupBy("tree", "node").applyInPandas(_subtree_shares(sent, depth, leaf), "bins binary, share long"))
    if any(t.closed().size for t in tops):
        found = found.union(cells.mapInArrow(_upper_shares(sent), "bins binary, share long"))
    share = found.groupBy("bins").agg((F.sum("share") / (trees * float(SHARES))).alias("probability"))
    return asked.join(share, "bins").select("label", "n", "probability")


def _shape(rows: DataFrame) -> tuple[int, int]:
    found = rows.agg(F.max(F.size("x")).alias("k"), (F.max("label") + 1).alias("classes")).first()
    if found.k is None:
        raise ValueError("a forest needs rows")
    return found.k, found.classes


def _edges(rows: DataFrame, k: int) -> list[np.ndarray]:
    """Cuts of every feature: between its values if they are few, else at quantiles of a sketch."""
    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0)] * k
        for batch in batches:
            x = _matrix(batch.column("x"), k)
            seen = [s if s.size > BINS else np.unique(np.concatenate([s, c]))[:BINS + 1] for s, c in zip(seen, x.T)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), [s.size for s in seen]), pa.int32()),
                                          pa.array(np.concatenate(seen))], ["feature", "value"])

    # at most BINS + 1 values a task and feature
    values = {r.feature: np.sort(r.found) for r in rows.mapInArrow(few, "feature int, value double").groupBy("feature").agg(
        F.collect_set("value").alias("found")).collect()}
    many = [i for i in range(k) if values[i].size > BINS]
    at: list[Column] = [F.percentile_approx(F.col("x")[i], [n / BINS for n in range(1, BINS)], 10_000) for i in many]
    cuts = dict(zip(many, rows.agg(*[c.alias(f"q{i}") for i, c in zip(many, at)]).first())) if many else {}
    return [np.unique(cuts[i]) if i in cuts else (values[i][:-1] + values[i][1:]) / 2 for i in range(k)]


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), k)


def _bin(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), len(edges))
            bins = np.column_stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), batch.column("label")], ["bins", "label"])

    return run


def _poisson(u: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Poisson numbers of the given means by the inverse of their distribution."""
    out = np.zeros(u.size, np.int64)
    for m in np.unique(mean):
        n = np.arange(int(m + 12 * np.sqrt(m) + 20))
        chance = np.exp(-m + n * np.log(m) - np.concatenate([[0.0], np.log(n[1:]).cumsum()]))
        mine = mean == m
        out[mine] = np.searchsorted(chance.cumsum(), u[mine], side="right")
    return out


def _drawn(h: np.ndarray, w: np.ndarray, tree: int) -> np.ndarray:
    """How often the tree draws each row."""
    z = h.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return _poisson(((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53), w)


def _looks(seed: int, tree: int, node: int, level: int, nodes: int, k: int) -> np.ndarray:
    """The features each of the nodes may split on."""
    some = int(np.ceil(np.sqrt(k)))
    return np.argpartition(np.random.default_rng([seed, tree, node, level]).random((nodes, k)), some - 1, axis=1)[:, :some]


class _Top:
    """The upper nodes of a tree: big ones are split next, open ones are left to a task, the others are done."""

    def __init__(self):
        self.feature, self.cut, self.left, self.gain, self.pred, self.sub = [-1], [0], [0], [0.0], [-1], [None]
        self.share = [0.0]
        self.big: list[int] = []
        self.open: list[int] = []
        self.depth = [0]

    def packed(self, asked: list[int]):
        return (np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(asked, int), np.array(self.depth),
                np.array(self.share))

    def closed(self) -> np.ndarray:
        """The leaves that no task goes on with."""
        return np.setdiff1d(np.flatnonzero(np.array(self.feature) < 0), self.open)

    def split(self, r, more: bool, node_rows: int) -> None:
        self.share[r.node] = float(_share(np.frombuffer(r.left) + np.frombuffer(r.right)))
        if r.feature < 0:
            return
        first = len(self.feature)
        self.feature[r.node], self.cut[r.node], self.left[r.node], self.gain[r.node] = r.feature, r.cut, first, r.gain
        for n, data in enumerate((r.left, r.right)):
            counts = np.frombuffer(data)
            for field, v in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.gain, 0.0), (self.pred, int(counts.argmax())),
                             (self.sub, None), (self.share, float(_share(counts))), (self.depth, self.depth[r.node] + 1)):
                field.append(v)
            if more and np.count_nonzero(counts) > 1:
                (self.big if counts.sum() > node_rows else self.open).append(first + n)

    def below(self, r) -> None:
        self.pred[r.node], self.sub[r.node] = r.pred, np.array(r.gains)

    def importance(self, k: int) -> np.ndarray:
        feature, pred = np.array(self.feature), np.array(self.pred)
        closed = (feature < 0) & np.array([s is None or not s.any() for s in self.sub])
        feature = _pruned(feature, np.array(self.left), pred, closed)
        out = np.bincount(feature[feature >= 0], np.array(self.gain)[feature >= 0], k)
        return out + sum((s for s in self.sub if s is not None), np.zeros(k))


def _share(counts: np.ndarray) -> np.ndarray:
    """The share of class 1 in counts by class; none where nothing is counted."""
    return (counts[1] if len(counts) > 1 else 0.0 * counts[0]) / np.maximum(counts.sum(axis=0), 1)


def _pruned(feature: np.ndarray, left: np.ndarray, pred: np.ndarray, closed: np.ndarray) -> np.ndarray:
    """The features with -1 at nodes below which all leaves have one prediction; closed are the leaves."""
    feature = feature.copy()
    while True:
        gone = (feature >= 0) & closed[left] & closed[np.minimum(left + 1, left.size - 1)]
        gone &= pred[left] == pred[np.minimum(left + 1, left.size - 1)]
        if not gone.any():
            return feature
        feature[gone], closed[gone], pred[gone] = -1, True, pred[left[gone]]


def _walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    at = np.zeros(len(bins), int)
    while (inner := feature[at] >= 0).any():
        at = np.where(inner, left[at] + (bins[np.arange(len(bins)), np.maximum(feature[at], 0)] > cut[at]), at)
    return at


def _reached(batch: pa.RecordBatch, k: int, tops: list):
    """(tree, node, bins, label, weight) of the drawn rows in the nodes asked for, in order of nodes."""
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, k)
    label, w, h = (batch.column(c).to_numpy() for c in ("label", "w", "h"))
    for tree, (feature, cut, left, asked, *_) in enumerate(tops):
        if not asked.size:
            continue
        # rows without a label are not drawn but asked for
        weight = np.where(label < 0, 1, _drawn(h, w, tree))
        at = _walk(bins, feature, cut, left)
        rows = np.flatnonzero((weight > 0) & np.isin(at, asked))
        rows = rows[np.argsort(at[rows], kind="stable")]
        yield tree, at[rows], bins[rows], label[rows], weight[rows]


def _counts(slot, nodes: int, picked, label, weight, classes: int) -> np.ndarray:
    """Weights by (class, node, place among the looked at features, bin)."""
    some = picked.shape[1]
    flat = ((label[:, None] * nodes + slot[:, None]) * some + np.arange(some)) * BINS + picked
    return np.bincount(flat.ravel(), np.repeat(weight.astype(float), some), classes * nodes * some * BINS).reshape(classes, nodes, some, BINS)


def _splits(counts: np.ndarray, leaf: int = 1):
    """(gain, place, bin, left counts, right counts) of the best split of every node."""
    left = counts.cumsum(axis=3)
    every = left[:, :, :1, -1:]
    right = every - left
    score = lambda c: (c * c).sum(axis=0) / c.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(left) + score(right) - score(every)
    gain = np.where((left.sum(axis=0) >= max(leaf, 1)) & (right.sum(axis=0) >= max(leaf, 1)), gain, -np.inf)
    nodes = np.arange(gain.shape[0])
    flat = gain.reshape(len(nodes), -1)
    best = flat.argmax(axis=1)
    place, cut = best // BINS, best % BINS
    return flat[nodes, best], place, cut, left[:, nodes, place, cut], right[:, nodes, place, cut]


def _least(weight: np.ndarray) -> np.ndarray:
    """Gains up to here are rounding."""
    return 1e-9 * np.maximum(weight, 1.0)


def _histograms(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, k, classes, tops = sent.value
        looks = {t: np.concatenate([_looks(seed, t, n, 0, 1, k) for n in top[3]]) for t, top in enumerate(tops) if top[3].size}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for tree, node, bins, label, weight in _reached(batch, k, tops):
                slot = np.searchsorted(tops[tree][3], node)
                picked = np.take_along_axis(bins, looks[tree][slot], axis=1)
                one = _counts(slot, len(looks[tree]), picked, label, weight, classes)
                sums[tree] = sums[tree] + one if tree in sums else one
        for tree, one in sums.items():
            asked = tops[tree][3]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(asked.size, tree), pa.int32()), pa.array(asked, pa.int32()),
                pa.array([one[:, i].tobytes() for i in range(asked.size)], pa.binary())], ["tree", "node", "sums"])

    return run


def _best(sent, leaf: int = 1):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        seed, k, classes, _ = sent.value
        tree, node = int(part["tree"].iloc[0]), int(part["node"].iloc[0])
        looks = _looks(seed, tree, node, 0, 1, k)
        counts = sum(np.frombuffer(s) for s in part["sums"]).reshape(classes, 1, looks.shape[1], BINS)
        gain, place, cut, left, right = (v[..., 0] for v in _splits(counts, leaf))
        feature = int(looks[0, place]) if gain > _least(counts[:, :, 0].sum()) else -1
        return pd.DataFrame({"tree": [tree], "node": [node], "feature": [feature], "cut": [int(cut)], "gain": [float(gain)],
                             "left": [left.tobytes()], "right": [right.tobytes()]})

    return run


def _dealt(sent):
    """The drawn rows of a batch packed per tree and node: bins, label, weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, k, _, tops = sent.value
        for batch in batches:
            for tree, node, bins, label, weight in _reached(batch, k, tops):
                ids, first = np.unique(node, return_index=True)
                packed = np.column_stack([bins, label.astype("<i4")[:, None].view(np.uint8), weight.astype("<i8")[:, None].view(np.uint8)])
                data = [p.tobytes() for p in np.split(packed, first[1:])] if ids.size else []
                yield pa.RecordBatch.from_arrays([pa.array(np.full(ids.size, tree), pa.int32()), pa.array(ids, pa.int32()),
                                                  pa.array(data, pa.binary())], ["tree", "node", "data"])

    return run


def _unpacked(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, label, weight) of packed rows, in an order of their own: the same tree whatever the order of arrival."""
    rows = rows[np.lexsort(rows.T)]
    return rows[:, :k], rows[:, k:k + 4].copy().view("<i4").ravel(), rows[:, k + 4:].copy().view("<i8").ravel()


def _subtree(sent, depth: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        seed, k, classes, tops = sent.value
        tree, node = int(part["tree"].iloc[0]), int(part["node"].iloc[0])
        rows = np.frombuffer(b"".join(part["data"]), np.uint8).reshape(-1, k + 12)
        pred, gains = grow_subtree(*_unpacked(rows, k), classes, depth - int(tops[tree][4][node]),
                                   lambda level, nodes: _looks(seed, tree, node, 1 + level, nodes, k))
        return pd.DataFrame({"tree": [tree], "node": [node], "pred": [pred], "gains": [gains.tolist()]})

    return run


def _subtree_shares(sent, depth: int, leaf: int):
    """The held rows of a node with the share of class 1 in their leaves of the subtree."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        seed, k, classes, tops = sent.value
        tree, node = int(part["tree"].iloc[0]), int(part["node"].iloc[0])
        rows = np.frombuffer(b"".join(part["data"]), np.uint8).reshape(-1, k + 12)
        known = rows[:, k:k + 4].copy().view("<i4").ravel() >= 0
        held = rows[~known, :k]
        if not len(held):
            return pd.DataFrame({"bins": np.array([], object), "share": np.array([], np.int64)})
        feature, cut, left, _, _, share = _grown(*_unpacked(rows[known], k), classes, depth - int(tops[tree][4][node]),
                                                 lambda level, nodes: _looks(seed, tree, node, 1 + level, nodes, k), leaf)
        return pd.DataFrame({"bins": [b.tobytes() for b in held],
                             "share": np.round(share[_walk(held, feature, cut, left)] * SHARES).astype(np.int64)})

    return run


def _upper_shares(sent):
    """Per held row the sum of its shares over the trees in which it ends at an upper leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, k, _, tops = sent.value
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, k)
            total = np.zeros(len(bins), np.int64)
            for feature, cut, left, asked, _, share in tops:
                at = _walk(bins, feature, cut, left)
                total += np.where(np.isin(at, asked), 0, np.round(share[at] * SHARES).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("bins"), pa.array(total)], ["bins", "share"])

    return run


def grow_subtree(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, depth: int, looks) -> tuple[int, np.ndarray]:
    """(prediction, gains per feature) of a tree grown level by level; the gains are zero where nothing is left to split."""
    feature, _, _, gains, pred, _ = _grown(bins, label, weight, classes, depth, looks)
    return int(pred[0]), np.bincount(feature[feature >= 0], gains[feature >= 0], bins.shape[1])


def _grown(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, depth: int, looks, leaf: int = 1):
    """(feature or -1 at a leaf, cut, left, gain, prediction, share of class 1) of the nodes of a tree, cut back."""
    every = np.bincount(label, weight, classes)
    feature, left, gains, pred = [np.full(1, -1)], [np.zeros(1, int)], [np.zeros(1)], [np.array([every.argmax()])]
    cuts, share = [np.zeros(1, int)], [np.array([_share(every)])]
    rows, slot, ids, size = np.arange(len(bins)), np.zeros(len(bins), int), np.zeros(1, int), 1
    for level in range(depth):
        m = ids.size
        if not m:
            break
        chosen, found = looks(level, m), []
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        for lo in range(0, m, NODES):
            hi = min(lo + NODES, m)
            a, b = np.searchsorted(slot, [lo, hi])
            mine, at = rows[a:b], slot[a:b]
            picked = bins[mine[:, None], chosen[at]]
            counts = _counts(at - lo, hi - lo, picked, label[mine], weight[mine], classes)
            gain, place, cut, l_sum, r_sum = _splits(counts, leaf)
            split = gain > _least(counts[:, :, 0].sum(axis=(0, 2)))
            found.append((gain, chosen[np.arange(lo, hi), place], cut, l_sum, r_sum, split))
        gain, f, cut, l_sum, r_sum, split = (np.concatenate(v, axis=-1) for v in zip(*found))
        at = np.flatnonzero(split)
        kids = 2 * at.size
        whole = np.concatenate(feature), np.concatenate(cuts), np.concatenate(left), np.concatenate(gains)
        for array, new in zip(whole, (f[at], cut[at], size + 2 * np.arange(at.size), gain[at])):
            array[ids[at]] = new
        sums = np.stack([l_sum[:, at], r_sum[:, at]], axis=2).reshape(classes, kids)
        feature, cuts = [whole[0], np.full(kids, -1)], [whole[1], np.zeros(kids, int)]
        left, gains = [whole[2], np.zeros(kids, int)], [whole[3], np.zeros(kids)]
        pred.append(sums.argmax(axis=0))
        share.append(_share(sums))
        number = np.full(m, -1)
        number[at] = np.arange(at.size)
        kept = number[slot] >= 0
        rows, slot = rows[kept], slot[kept]
        child = 2 * number[slot] + (bins[rows, f[slot]] > cut[slot])
        mixed = np.count_nonzero(sums, axis=0) > 1
        place = np.cumsum(mixed) - 1
        ids, size = size + np.flatnonzero(mixed), size + kids
        rows, slot = rows[mixed[child]], place[child[mixed[child]]]
    feature, cuts, left, gains, pred, share = (np.concatenate(v) for v in (feature, cuts, left, gains, pred, share))
    return _pruned(feature, left, pred, feature < 0), cuts, left, gains, pred, share
