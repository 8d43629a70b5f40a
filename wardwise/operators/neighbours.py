"""Exact neighbour work on blocks: SMOTE balancing and density noise.

Equal points are first merged into one weighted point. Points are then ordered along a space-filling
key and cut into blocks of at most ``block_rows``. Two blocks are compared only if their bounding
boxes are within the search radius; which ones may be is found by an equi-join on coarse grid cells.
Key and grid use quantiles as edges, so that outliers do not push all points into one cell.
A task sees two blocks at a time and returns counts or the nearest k, never the pairs.
"""

from __future__ import annotations

import gc
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.functions.hashing import HASH_BITS, seeded_hash, seeded_unit
from wardwise.operators.ordered import running_sums
from wardwise.operators.prepare import HASH_SHIFTS
from wardwise.operators.profile import union_all
from wardwise.session import materialize

BLOCK_ROWS = 2048
#: Pairs of blocks per block that are compared at a time: each shuffles one copy of both blocks.
ROUND_PAIRS = 8
_KEY_DIMS, _KEY_BITS = 6, 5
_GRID_DIMS, _GRID = 2, 64


def _distinct_points(df: DataFrame, features: list[str], key: str) -> DataFrame:
    """(pid, w, x): one row per distinct point with its number of rows and its smallest key."""
    # adding zero turns -0.0 into 0.0
    x = F.array(*[C.col(f).cast("double") + F.lit(0.0) for f in features])
    return df.groupBy(x.alias("x")).agg(F.min(key).alias("pid"), F.count("*").alias("w"))


def _cell(value: Column, edges: list[float]) -> Column:
    """Number of edges at or below the value, as a binary CASE."""
    def half(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(edges[mid]), half(lo, mid)).otherwise(half(mid + 1, hi))
    return half(0, len(edges)).cast("bigint")


def _edges(points: DataFrame, dims: int) -> list[tuple[int, list[float], list[float]]]:
    """(dimension, key edges, grid edges) of the widest dimensions; sketches are enough for edges."""
    at = lambda i: F.col("x")[i]
    spread = points.agg(*[F.var_pop(at(i)).alias(f"d{i}") for i in range(dims)]).first()
    wide = sorted(range(dims), key=lambda i: -(spread[i] or 0.0))[:_KEY_DIMS]
    steps = [n / _GRID for n in range(1, _GRID)]
    cuts = points.agg(*[F.percentile_approx(at(i), steps, 1000).alias(f"d{i}") for i in wide]).first()
    out = []
    for n, i in enumerate(wide):
        fine = cuts[n] or []
        out.append((i, sorted(set(fine[_GRID // (1 << _KEY_BITS) - 1::_GRID >> _KEY_BITS])),
                    sorted(set(fine))))
    return out


def _blocked(points: DataFrame, dims: int, block_rows: int) -> tuple[DataFrame, list[tuple]]:
    """Points with their block, written once, and the edges of the widest dimensions."""
    points = materialize(points, "points")
    edges = _edges(points, dims)
    places = [_cell(F.col("x")[i], coarse) for i, coarse, _ in edges]
    key: Column = F.lit(0).cast("bigint")
    for bit in range(_KEY_BITS - 1, -1, -1):
        for p in places:
            key = F.shiftleft(key, 1) + F.shiftright(p, bit).bitwiseAND(F.lit(1))
    # Twenty hash bits below the key spread the points of one cell over many ranking blocks.
    low = F.shiftright(seeded_hash(0, F.col("pid")), HASH_BITS - 20)
    keyed = points.withColumn("_o", F.shiftleft(key, 20) + low)
    ranked = running_sums(keyed, [], [F.col("_o"), F.col("pid")], F.col("_o"),
                          {"_r": F.lit(1)}, shifts=(10, 30))
    out = ranked.select("pid", "w", "x", F.floor((F.col("_r") - 1) / block_rows).alias("block"))
    return materialize(out, "blocks"), edges


def _boxes(blocks: DataFrame, dims: int) -> DataFrame:
    return blocks.groupBy("block").agg(
        F.array(*[F.min(F.col("x")[i]) for i in range(dims)]).alias("lo"),
        F.array(*[F.max(F.col("x")[i]) for i in range(dims)]).alias("hi"),
        F.sum("w").alias("weight"))


def _block_pairs(boxes: DataFrame, edges: list[tuple]) -> DataFrame:
    """(a, b): blocks b that may hold a point within the ``radius`` of a point of block a."""
    grid = [(i, fine) for i, _, fine in edges[:_GRID_DIMS]]

    def cells(df, grow):
        for n, (i, fine) in enumerate(grid):
            df = df.withColumn(f"c{n}", F.explode(F.sequence(
                _cell(F.col("lo")[i] - grow, fine), _cell(F.col("hi")[i] + grow, fine))))
        return df

    on = [f"c{n}" for n in range(len(grid))]
    left = cells(boxes, F.col("radius")).select(
        F.col("block").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), "radius", *on)
    right = cells(boxes, F.lit(0.0)).select(
        F.col("block").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), *on)
    gap = F.aggregate(
        F.arrays_zip("alo", "ahi", "blo", "bhi"), F.lit(0.0),
        lambda acc, s: acc + F.pow(F.greatest(F.lit(0.0), s["alo"] - s["bhi"],
                                              s["blo"] - s["ahi"]), F.lit(2.0)))
    # The margin covers rounding of the summed squares; it only ever adds a pair.
    near = gap <= F.col("radius") * F.col("radius") * (1 + 1e-9)
    return left.join(right, on).filter(near).select("a", "b").distinct()


def _side(points: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """The points of one side of every pair. New aliases keep the two sides apart."""
    renamed = points.select(*[F.col(c).alias(c) for c in points.columns if c != "block"],
                            F.col("block").alias(side))
    return renamed.join(pairs.select(F.col("a").alias("a"), F.col("b").alias("b")), side)


def _compare(queries: DataFrame, candidates: DataFrame, pairs: DataFrame, kernel,
             schema: str) -> DataFrame:
    """Run ``kernel(query rows, candidate rows)`` for every pair of blocks. The rows are few bytes for their
    work, so the number of partitions follows the pairs, not the bytes."""
    n, width = pairs.count(), 4 * pairs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(n, max(width, n // 32)))
    left, right = (_side(rows, pairs, side).repartition(parts, "a", "b")
                   for rows, side in ((queries, "a"), (candidates, "b")))
    return (left.groupBy("a", "b").cogroup(right.groupBy("a", "b"))
            .applyInPandas(kernel, schema))


def _squares(q: np.ndarray, c: np.ndarray, rows: int = 256):
    """(first row, squared distances by the expanded square, their greatest error) of a few query rows at a time;
    infinite where a coordinate is missing."""
    with np.errstate(invalid="ignore"):
        centre = np.nan_to_num(c[0], posinf=0.0, neginf=0.0)
        q, c = q - centre, c - centre
        c2 = np.einsum("ij,ij->i", c, c)
        whole, most = np.isfinite(c2).all(), c2.max(where=np.isfinite(c2), initial=0.0)
        for at in range(0, len(q), rows):
            some = q[at:at + rows]
            q2 = np.einsum("ij,ij->i", some, some)
            rough = some @ (-2 * c.T)
            rough += q2[:, None]
            rough += c2
            if not (whole and np.isfinite(q2).all()):
                rough = np.where(np.isfinite(rough), rough, np.inf)
            yield at, rough, 1e-12 * (q2 + most)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows side by side."""
    diff = (q - c)[:, None, :]
    return np.einsum("ijk,ijk->ij", diff, diff)[:, 0]


def _reaching(q: np.ndarray, r2: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Places of the rows q that have the box of c within the square root of r2; a missing coordinate counts as within."""
    gap = np.zeros(len(q))
    for x, y in zip(q.T, c.T):
        with np.errstate(invalid="ignore"):
            away = np.maximum(0.0, np.maximum(np.fmin.reduce(y) - x, x - np.fmax.reduce(y)))
        gap += np.nan_to_num(away, nan=0.0, posinf=0.0) ** 2
    return np.flatnonzero(~(gap > r2 * (1 + 1e-9)))


def _nearest_kernel(k: int):
    """The k nearest points of every point; with ``r2``, the square of a distance within which it has k of them, only
    those no further."""
    def kernel(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"pid": [], "nid": [], "w": [], "d2": []}).astype(
            {"pid": "int64", "nid": "int64", "w": "int64", "d2": "float64"})
        if not len(left) or not len(right):
            return none
        q, c = np.stack(left["x"]), np.stack(right["x"])
        pid, nid, w = (left["pid"].to_numpy(), right["pid"].to_numpy(), right["w"].to_numpy())
        r2 = left["r2"].to_numpy() if "r2" in left else np.full(len(q), np.inf)
        near = _reaching(q, r2, c)
        q, pid, r2 = q[near], pid[near], r2[near]
        itself = np.isin(pid, nid[w == 1])
        last, parts = min(k, len(c)) - 1, [none]
        for at, rough, error in _squares(q, c):
            to = at + len(rough)
            if (mine := at + np.flatnonzero(itself[at:to])).size:
                rough[np.ix_(mine - at, w == 1)] += np.where(pid[mine, None] == nid[w == 1], np.inf, 0.0)
            # all that may be among the k nearest, by exact distance, then id
            bound = r2[at:to]
            if np.isinf(bound).any():
                bound = np.minimum(bound, np.partition(rough, last, axis=1)[:, last])
            i, j = np.nonzero(rough <= np.minimum(bound + 2 * error, np.finfo(float).max)[:, None])
            d2 = _exact(q[at + i], c[j])
            order = np.lexsort((nid[j], d2, i))
            i, j, d2 = i[order], j[order], d2[order]
            best = (np.arange(i.size) - np.searchsorted(i, i) < k) & (d2 <= r2[at + i])
            i, j, d2 = i[best], j[best], d2[best]
            parts.append(pd.DataFrame({"pid": pid[at + i], "nid": nid[j], "w": np.where(pid[at + i] == nid[j], w[j] - 1, w[j]), "d2": d2}))
        return pd.concat(parts)
    return kernel


def nearest(df: DataFrame, features: list[str], key: str, k: int,
            block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Blocked distinct points, and (pid, place, nid, w): their k nearest points, self included
    through its other copies. Ties go to the smaller id."""
    dims = len(features)
    blocks, edges = _blocked(_distinct_points(df, features, key), dims, block_rows)
    schema = "pid BIGINT, nid BIGINT, w BIGINT, d2 DOUBLE"
    kernel = _nearest_kernel(k)
    # The k-th distance inside the own block bounds the search radius of the block.
    own = blocks.select("block").distinct().select(F.col("block").alias("a"), F.col("block").alias("b"))
    place = Window.partitionBy("pid").orderBy("d2", "nid")
    inside = _compare(blocks, blocks, own, kernel, schema).groupBy("pid").agg(
        F.when(F.count("*") >= k, F.max("d2")).otherwise(float("inf")).alias("r2"))
    asking = materialize(blocks.join(inside, "pid", "left").select(
        "pid", "w", "x", F.coalesce("r2", F.lit(float("inf"))).alias("r2"), "block"), "asking")
    radius = asking.groupBy("block").agg(F.sqrt(F.max("r2")).alias("radius"))
    pairs = _block_pairs(_boxes(blocks, dims).join(radius, "block"), edges)
    found = _compare(asking, blocks, materialize(pairs, "pairs"), kernel, schema)
    # top-k rank: cut per map task before the shuffle
    best = found.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k)
    return blocks, best.select("pid", "place", "nid", "w")


def smote(df: DataFrame, features: list[str], label: str, key: str, k: int = 5,
          seed: int = K.SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows plus synthetic rows that bring every class to the size of the largest.

    Returns (key, copy, label, features...); copy 0 is the original. A synthetic row lies between
    a row and one of its k nearest rows of the same class. Which neighbour, and where between, is a
    hash of the key, the copy and the seed, so a retried task makes the same row again.
    """
    base = df.select(F.col(key), F.lit(0).alias("copy"), F.col(label),
                     *[C.col(f).cast("double").alias(f) for f in features])
    sizes = {r[label]: r["n"] for r in  # one row per class
             df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    top = max(sizes.values(), default=0)
    out = base
    for value, n in sorted(sizes.items(), key=lambda kv: str(kv[0])):
        if n == top:
            continue
        if n < 2:
            raise ValueError(f"class {value!r} has one row, which has no neighbour to balance it with")
        rows = df.filter(F.col(label) == value)
        out = out.unionByName(_synthetic(rows, features, label, key, k, seed, n, top - n, block_rows))
    return out


def _synthetic(rows: DataFrame, features, label, key, k, seed, n, wanted, block_rows) -> DataFrame:
    k = min(k, n - 1)
    blocks, found = nearest(rows, features, key, k, block_rows)
    points = blocks.select(F.col("pid").alias("nid"), F.col("x").alias("nx"))
    # The coordinates of the neighbours of a point, every copy of a neighbour counted: k per point.
    lists = (found.join(points, "nid").groupBy("pid").agg(F.array_sort(F.collect_list(
        F.struct("place", "nx", "w"))).alias("l"))
        .select("pid", F.slice(F.flatten(F.transform(
            "l", lambda s: F.array_repeat(s["nx"], F.least(s["w"], F.lit(k)).cast("int")))),
            1, k).alias("near")))
    known = blocks.select("pid", "x").join(lists, "pid").select("x", "near")
    x = F.array(*[C.col(f).cast("double") + F.lit(0.0) for f in features])
    each, extra = divmod(wanted, n)
    hashed = rows.select(F.col(key), F.col(label), x.alias("x"),
                         seeded_hash(seed, F.col(key)).alias("_h"))
    ranked = running_sums(hashed, [], [F.col("_h"), F.col(key)], F.col("_h"), {"_r": F.lit(1)},
                          shifts=HASH_SHIFTS)
    copies = F.lit(each) + F.when(F.col("_r") <= extra, 1).otherwise(0)
    made = (ranked.withColumn("copies", copies).filter("copies > 0").join(known, "x")
            .select(key, label, "x", "near", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
            .withColumn("_j", (seeded_hash(seed + 1, F.col(key), F.col("copy")) % k).cast("int"))
            .withColumn("gap", seeded_unit(seed + 2, F.col(key), F.col("copy")))
            .withColumn("nx", F.col("near")[F.col("_j")]).drop("near"))
    return made.select(
        key, F.col("copy").cast("int").alias("copy"), label,
        *[(F.col("x")[i] + F.col("gap") * (F.col("nx")[i] - F.col("x")[i])).alias(f)
          for i, f in enumerate(features)])


def _count_kernel(eps: float):
    def kernel(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"pid": [], "n": []}).astype("int64")
        q, c, w = np.stack(left["x"]), np.stack(right["x"]), right["w"].to_numpy()
        counts = np.zeros(len(q), np.int64)
        # only rows near the other side's box can be within eps of one of its rows
        near = _reaching(q, np.full(len(q), eps * eps), c)
        if near.size:
            q = q[near]
            mine = _reaching(c, np.full(len(c), eps * eps), q)
            c, w = c[mine], w[mine]
        if near.size and len(c):
            found = []
            for at, rough, error in _squares(q, c):
                inside = rough <= eps * eps
                i, j = np.nonzero(np.abs(rough - eps * eps) <= error[:, None])
                inside[i, j] = _exact(q[at + i], c[j]) <= eps * eps
                found.append(inside @ w)
            counts[near] = np.concatenate(found)
        return pd.DataFrame({"pid": left["pid"].to_numpy(), "n": counts})
    return kernel


def _counted(queries: DataFrame, candidates: DataFrame, pairs: DataFrame, blocks: int, eps: float,
             round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """(pid, n): rows of the candidates within eps of every query. Pairs are compared in rounds of about ``round_pairs`` times
    the number of blocks, so that the shuffle on disk follows the rows, not the pairs; only counts stay of a round."""
    rounds = math.ceil(pairs.count() / (round_pairs * max(blocks, 1)))
    out = []
    for r in range(max(rounds, 1)):
        some = pairs.filter(F.pmod(F.xxhash64("a"), F.lit(rounds)) == r) if rounds > 1 else pairs
        found = _compare(queries, candidates, some, _count_kernel(eps), "pid BIGINT, n BIGINT").groupBy("pid").agg(
            F.sum("n").alias("n"))
        out.append(materialize(found, "counted") if rounds > 1 else found)
        if rounds > 1:
            # Spark deletes the shuffle files of a plan that nothing refers to any more
            del some, found
            gc.collect()
            pairs.sparkSession.sparkContext._jvm.System.gc()
    return union_all(out)


def density_noise(df: DataFrame, features: list[str], key: str, eps: float = 0.5,
                  min_samples: int = 10, block_rows: int = BLOCK_ROWS, round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """Rows with their point, and whether it is a core point or noise: (key, core, noise).

    Core: at least ``min_samples`` rows, itself included, within ``eps``. Noise: not core and no
    core point within ``eps``.
    """
    dims = len(features)
    blocks, edges = _blocked(_distinct_points(df, features, key), dims, block_rows)
    boxes = materialize(_boxes(blocks, dims).withColumn("radius", F.lit(float(eps))), "boxes")
    pairs = materialize(_block_pairs(boxes, edges), "pairs")
    # A block no wider than eps across that holds enough rows is core as a whole; in dense regions
    # most blocks are, and nothing there needs comparing.
    across = F.aggregate(F.arrays_zip("lo", "hi"), F.lit(0.0),
                         lambda acc, s: acc + F.pow(s["hi"] - s["lo"], F.lit(2.0)))
    dense = boxes.filter((across <= eps * eps * (1 - 1e-9)) & (F.col("weight") >= min_samples)) \
        .select("block")
    open_blocks = blocks.join(dense, "block", "left_anti")
    n_blocks = boxes.count()
    counted = _counted(open_blocks, blocks, pairs, n_blocks, eps, round_pairs)
    core = materialize(
        counted
        .select("pid", (F.col("n") >= min_samples).alias("core"))
        .unionByName(blocks.join(dense, "block", "left_semi")
                     .select("pid", F.lit(True).alias("core"))), "core")
    # Second round: only core points count, as one each, and only other points ask.
    flagged = blocks.join(core, "pid")
    queries = flagged.filter("NOT core").select("pid", "w", "x", "block")
    targets = flagged.filter("core").select("pid", F.lit(1).cast("bigint").alias("w"), "x", "block")
    reached = _counted(queries, targets, pairs, n_blocks, eps, round_pairs).filter("n > 0").select("pid")
    noise = (queries.select("pid").join(reached, "pid", "left_anti")
             .withColumn("noise", F.lit(True)))
    verdict = (flagged.select("x", "pid", "core").join(noise, "pid", "left")
               .select("x", "core", F.coalesce("noise", F.lit(False)).alias("noise")))
    x = F.array(*[C.col(f).cast("double") + F.lit(0.0) for f in features])
    return df.select(F.col(key), x.alias("x")).join(verdict, "x").select(key, "core", "noise")


def noise_count(df: DataFrame, features: list[str], key: str, eps: float = 0.5,
                min_samples: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return density_noise(df, features, key, eps, min_samples, block_rows).agg(
        F.count("*").alias("rows"), F.count_if("core").alias("core_rows"),
        F.count_if("noise").alias("noise_rows"))
