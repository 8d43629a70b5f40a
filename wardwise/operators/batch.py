"""Many model fits at once: one table of rows for all of them, few jobs, one metric job.

Logistic models of all feature lists, parts and strengths share one pass per Newton step over all rows: a task
returns a small weighted Gram matrix per model. Trees see their features in bins: the rows of a part that fall into the same
bins of a feature list are one weighted cell, and each tree model is grown from all cells of its part in a task, which scores
the held cells tree by tree and keeps no tree. What one fit contains is not fitted again: a forest's first trees, cut at any
depth, are the smaller and shallower forests, and the first rounds of a boosted model are the model of fewer rounds. Draws
are hashes of the cell and sums are of whole numbers, so results depend neither on the order of the rows nor on the tasks. The
metrics of all models come from one grouped rank sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.functions.hashing import seeded_hash
from wardwise.operators.evaluate import evaluate_split
from wardwise.operators.profile import union_all
from wardwise.session import materialize

#: Cells that a step of a tree fit takes at a time.
FIT_ROWS = 1 << 18
BINS = 32
MOST_DEPTH = 30
#: Gradients and shares are whole numbers of these parts, so that their sums do not depend on the order.
PARTS, SHARES = float(1 << 24), float(1 << 40)


PARAMETERS = {
    "LogisticRegression": {"C", "penalty", "max_iter"},
    "RandomForest": {"n_estimators", "max_depth", "min_samples_leaf"},
    "GradientBoosting": {"n_estimators", "max_depth", "min_samples_leaf", "learning_rate",
                         "subsample", "colsample_bytree"},
}


@dataclass(frozen=True)
class Fit:
    """One asked model: which part's rows it is fitted on, and the sides it is scored on."""

    model: str
    features: tuple[str, ...]
    params: tuple[tuple[str, object], ...] = ()
    part: int = 0
    sides: tuple[str, ...] = ("val",)

    @classmethod
    def of(cls, model: str, features: list[str], params: dict | None = None, part: int = 0, sides=("val",)) -> Fit:
        if model not in PARAMETERS or set(params or {}) - PARAMETERS[model]:
            raise ValueError(f"unknown model or parameter: {model!r} {sorted(params or {})}")
        return cls(model, tuple(features), tuple(sorted((params or {}).items())), part, tuple(sides))


@dataclass
class Part:
    """Rows to fit on, and the rows of every side to score."""

    fit: DataFrame
    sides: dict[str, DataFrame] = field(default_factory=dict)


class Batch:
    """Parts written as one table (part, side, label, x, draw); `features` is the order of x."""

    def __init__(self, parts: list[Part], features: list[str], label: str = "label", key: str | None = "encounter_id",
                 fit_rows: int = FIT_ROWS, seed: int = K.SEED):
        self.features, self.fit_rows, self.seed = list(features), fit_rows, seed
        self.spark = parts[0].fit.sparkSession
        x = F.array(*[C.col(f).cast("double") for f in features])

        def rows(df: DataFrame, part: int, side: str) -> DataFrame:
            keys = [F.col(c) for c in (key, "copy") if c in df.columns]
            draw = seeded_hash(seed, *keys) if keys else F.xxhash64(x)
            return df.select(F.lit(part).alias("part"), F.lit(side).alias("side"), F.col(label).cast("int").alias("label"),
                             x.alias("x"), draw.alias("draw"))

        stacked = [rows(p.fit, i, "fit") for i, p in enumerate(parts)]
        stacked += [rows(df, i, side) for i, p in enumerate(parts) for side, df in p.sides.items()]
        # fits and scores are dear for their bytes: the rows of every part and side go to all tasks
        width = 4 * self.spark.sparkContext.defaultParallelism
        self.rows = materialize(union_all(stacked).repartition(width, "draw"), "batch")

    def metrics(self, fits: list[Fit]) -> dict[tuple[Fit, str], dict]:
        """Metrics of every fit and side: accuracy, precision, recall, f1, auc, and n_iter of logistic fits."""
        fits = list(dict.fromkeys(fits))
        table, linear = self._scores(fits)
        found = evaluate_split(table, ["config", "side"], weight="n").collect()  # a row per configuration and side
        out = {}
        for r in found:
            f = fits[r.config]
            out[f, r.side] = {k: r[k] for k in ("accuracy", "precision", "recall", "f1", "auc")} | (
                {"n_iter": linear[f][1]} if f in linear else {})
        return out

    def scores(self, fits: list[Fit]) -> DataFrame:
        """(config, side, label, prediction, probability) of every row, config being the fit's place in the list."""
        return self._scores(fits)[0].withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n")

    def _scores(self, fits: list[Fit]) -> tuple[DataFrame, dict]:
        """The scores, n saying for how many rows, and the logistic fits."""
        linear = self.logistic([f for f in fits if f.model == "LogisticRegression"])
        plans = _staged([f for f in fits if f.model != "LogisticRegression"])
        scored = []
        if linear:
            scored.append(self._scored([(fits.index(f), f, w) for f, (w, _) in linear.items()]))
        if plans:
            scored.append(self._grown(fits, plans))
        return materialize(union_all(scored), "scored"), linear

    def _columns(self, fit: Fit) -> np.ndarray:
        return np.array([self.features.index(f) for f in fit.features])

    # --- logistic models ----------------------------------------------------------------------

    def logistic(self, fits: list[Fit], tolerance: float = 1e-10) -> dict[Fit, tuple[np.ndarray, int]]:
        """(weights, the last the intercept; steps) of every fit: the mean log loss and 1 / (C n) times the penalty
        are least. One pass over the rows per step for all models that still move."""
        if not fits:
            return {}
        counts = {r.part: r["count"] for r in self.rows.where("side = 'fit'").groupBy("part").count().collect()}
        state = {f: _Newton(len(f.features), dict(f.params), counts[f.part]) for f in fits}
        fit_rows = self.rows.where("side = 'fit'").select("part", "label", "x")
        while moving := [f for f in fits if not state[f].done]:
            asked: dict[int, list] = {}
            for i, f in enumerate(moving):
                asked.setdefault(f.part, []).append((i, self._columns(f), state[f].weights))
            sent = self.spark.sparkContext.broadcast(asked)
            # (p + 1)(p + 2) + 1 numbers a model
            sums = fit_rows.mapInArrow(_gram(sent), "model int, place int, value double").groupBy("model", "place").agg(
                F.sum("value").alias("value")).toArrow()
            sent.unpersist()
            got: dict[int, np.ndarray] = {i: np.zeros((len(f.features) + 2) ** 2) for i, f in enumerate(moving)}
            for m, p, v in zip(*(sums[c].to_pylist() for c in ("model", "place", "value"))):
                got[m][p] = v
            for i, f in enumerate(moving):
                state[f].step(got[i], tolerance)
        return {f: (state[f].best, state[f].steps) for f in fits}

    # --- trees --------------------------------------------------------------------------------

    def edges(self, parts: list[int]) -> dict[int, list[np.ndarray]]:
        """Cuts of every feature by the rows a part fits on: between its values if they are few, else at quantiles of a
        sketch."""
        k, mine = len(self.features), self.rows.where((F.col("side") == "fit") & F.col("part").isin(parts))
        # at most BINS + 1 values a task, part and feature
        few = mine.select("part", "x").mapInArrow(_few(k), "part int, feature int, value double").groupBy("part", "feature").agg(
            F.collect_set("value").alias("found")).collect()
        values = {(r.part, r.feature): np.sort(r.found) for r in few}
        many = [(p, f) for (p, f), v in values.items() if v.size > BINS]
        x = {(p, f): F.when((F.col("part") == p) & ~F.isnan(F.col("x")[f]), F.col("x")[f]) for p, f in many}
        rows = mine.agg(*[F.count(c).alias(f"{p}_{f}") for (p, f), c in x.items()]).first() if many else {}
        # the place (n - 1) i / BINS from zero, rounded down; a sketch answers for the middle of a place
        at = {(p, f): [((rows[f"{p}_{f}"] - 1) * i // BINS + 0.5) / rows[f"{p}_{f}"] for i in range(1, BINS)] for p, f in many}
        cuts = mine.agg(*[F.percentile_approx(c, at[key], 10_000).alias("{}_{}".format(*key)) for key, c in x.items()]).first() if many else {}

        def cut(p: int, f: int) -> np.ndarray:
            v = values.get((p, f), np.zeros(0))
            return np.unique(cuts[f"{p}_{f}"]) if v.size > BINS else (v[:-1] + v[1:]) / 2

        return {p: [cut(p, f) for f in range(k)] for p in parts}

    def _grown(self, fits: list[Fit], plans: list[tuple[Fit, list]]) -> DataFrame:
        """(config, side, label, prediction, probability, n) of the held cells, by models grown in tasks of their own. A
        forest's trees go to several tasks if there are fewer plans than tasks."""
        spark = self.spark
        units = list(dict.fromkeys((f.part, f.features) for f, _ in plans))
        sides = sorted({s for _, members in plans for f in members for s in f.sides})
        columns = [(part, np.array([self.features.index(f) for f in features])) for part, features in units]
        sent = spark.sparkContext.broadcast((self.edges(sorted({p for p, _ in units})), columns, sides))
        cells = materialize(self.rows.mapInArrow(_cells(sent), "unit int, side int, bins binary, label int").groupBy("unit", "side", "bins").agg(
            F.count_if(F.col("label") == 0).alias("w0"), F.count_if(F.col("label") == 1).alias("w1")), "cells")
        pieces = max(1, spark.sparkContext.defaultParallelism // len(plans))
        place, jobs = {f: i for i, f in enumerate(fits)}, []
        for fit, members in plans:
            asked, trees = [(place[f], dict(f.params), [sides.index(s) for s in f.sides]) for f in members], _trees(fit)
            cuts = np.linspace(0, trees, (min(pieces, trees) if fit.model == "RandomForest" else 1) + 1).astype(int)
            jobs += [(units.index((fit.part, fit.features)), fit.model, dict(fit.params), int(lo), int(hi), asked) for lo, hi in zip(cuts, cuts[1:])]
        # dear fits first, so that tasks end together
        jobs.sort(key=lambda j: -(j[4] - j[3]) * (_depth(Fit.of(j[1], [], j[2]))) * len(units[j[0]][1]))
        work = spark.sparkContext.broadcast(([(j, len(units[j[0]][1])) for j in jobs], self.seed, self.fit_rows))
        asked = (cells.mapInArrow(_dealt(work), "job int, data binary").repartitionById(len(jobs), F.col("job"))
                 .mapInArrow(_grow(work, pieces > 1), "config int, side int, cell binary, w0 long, w1 long, trees int, total double"))
        if pieces > 1:
            asked = asked.groupBy("config", "side", "cell", "w0", "w1", "trees").agg(F.sum("total").alias("total"))
        name = F.array(*map(F.lit, sides))
        held = asked.select("config", name[F.col("side")].alias("side"), (F.col("total") / F.col("trees")).alias("probability"), F.explode(F.array(
            F.struct(F.lit(0).alias("label"), F.col("w0").alias("n")), F.struct(F.lit(1).alias("label"), F.col("w1").alias("n")))).alias("l"))
        return held.where("l.n > 0").select("config", "side", "l.label", (F.col("probability") > 0.5).cast("int").alias("prediction"),
                                            "probability", F.col("l.n").alias("n"))

    def _scored(self, models: list[tuple[int, Fit, np.ndarray]]) -> DataFrame:
        """(config, side, label, prediction, probability, n) of all rows of the sides asked for, by logistic models."""
        asked: dict[tuple[int, str], list] = {}
        for config, fit, weights in models:
            for side in fit.sides:
                asked.setdefault((fit.part, side), []).append((config, self._columns(fit), weights))
        sent = self.spark.sparkContext.broadcast(asked)
        return self.rows.where("side <> 'fit'").select("part", "side", "label", "x").mapInArrow(
            _score(sent), "config int, side string, label int, prediction int, probability double").withColumn("n", F.lit(1).cast("long"))


def _points(batch: pa.RecordBatch) -> np.ndarray:
    """The arrays of ``x`` as rows of a matrix; a missing number is NaN."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)


# --- Newton steps -----------------------------------------------------------------------------

def _gram(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, sums = sent.value, {}
        for batch in batches:
            part, y = batch.column("part").to_numpy(), batch.column("label").to_numpy().astype(float)
            x = _points(batch)
            for p in np.unique(part).tolist():
                xs, ys = x[part == p], y[part == p]
                for model, columns, w in asked.get(p, ()):
                    rows = np.column_stack([xs[:, columns], np.ones(len(xs))])
                    z = rows @ w
                    q = 1 / (1 + np.exp(-z))
                    loss = np.logaddexp(0, z) - ys * z
                    one = np.concatenate([[loss.sum()], rows.T @ (q - ys), ((rows * (q * (1 - q))[:, None]).T @ rows).ravel()])
                    sums[model] = sums[model] + one if model in sums else one
        model = np.concatenate([np.full(v.size, m) for m, v in sums.items()] or [np.zeros(0)])
        place = np.concatenate([np.arange(v.size) for v in sums.values()] or [np.zeros(0)])
        yield pa.RecordBatch.from_arrays([pa.array(model, pa.int32()), pa.array(place, pa.int32()), pa.array(
            np.concatenate(list(sums.values()) or [np.zeros(0)]))], ["model", "place", "value"])

    return run


class _Newton:
    """The state of one fit. Steps that do not lower the objective are halved; L1 steps solve the local
    quadratic by coordinate descent."""

    def __init__(self, p: int, params: dict, rows: int):
        self.rows, self.l1 = rows, params.get("penalty") == "l1"
        self.strength = 1.0 / params.get("C", 1.0)
        self.most = params.get("max_iter", 100)
        self.weights = np.zeros(p + 1)  # asked next
        self.best, self.value, self.steps, self.done = self.weights, np.inf, 0, False
        self.move, self.halved = None, 0

    def penalty(self, w: np.ndarray) -> float:
        w = w[:-1]
        return self.strength * (np.abs(w).sum() if self.l1 else w @ w / 2)

    def step(self, sums: np.ndarray, tolerance: float) -> None:
        p = self.weights.size
        value = sums[0] + self.penalty(self.weights)
        if not value <= self.value:
            self.halved += 1
            self.done = self.halved == 30
            self.move = self.move / 2
            self.weights = self.best + self.move
            return
        gained, self.halved = self.value - value, 0
        self.best, self.value = self.weights, value
        self.steps += 1
        grad, hess = sums[1:p + 1].copy(), sums[p + 1:p + 1 + p * p].reshape(p, p).copy()
        hess[np.diag_indices(p)] += 1e-12 * self.rows
        if self.l1:
            self.move = _descend(self.best, grad, hess, self.strength) - self.best
        else:
            grad[:-1] += self.strength * self.best[:-1]
            hess[np.arange(p - 1), np.arange(p - 1)] += self.strength
            self.move = -np.linalg.solve(hess, grad)
        self.weights = self.best + self.move
        self.done = np.abs(self.move).max() < tolerance ** 0.5 * 1e-3 or gained <= tolerance * 1e-3 * abs(value) or self.steps >= self.most


def _descend(w: np.ndarray, grad: np.ndarray, hess: np.ndarray, strength: float, sweeps: int = 1000) -> np.ndarray:
    """The minimum of the quadratic around w plus strength * |w|, but for the last weight, by coordinates."""
    out, slope = w.copy(), grad.copy()
    for _ in range(sweeps):
        moved = 0.0
        for j in range(w.size):
            limit = strength if j < w.size - 1 else 0.0
            raw = hess[j, j] * out[j] - slope[j]
            new = np.sign(raw) * max(abs(raw) - limit, 0.0) / hess[j, j]
            if new != out[j]:
                slope += hess[:, j] * (new - out[j])
                moved = max(moved, abs(new - out[j]))
                out[j] = new
        if moved < 1e-12:
            break
    return out


# --- trees ------------------------------------------------------------------------------------

def _staged(fits: list[Fit]) -> list[tuple[Fit, list[Fit]]]:
    """(largest fit, the fits it contains): of forests in trees and depth, of boosted models in rounds."""
    groups: dict[tuple, list[Fit]] = {}
    for f in fits:
        p = dict(f.params)
        shared = {k: v for k, v in p.items() if k != "n_estimators" and not (k == "max_depth" and f.model == "RandomForest")}
        groups.setdefault((f.model, f.features, f.part, tuple(sorted(shared.items(), key=str))), []).append(f)
    out = []
    for (model, features, part, shared), members in groups.items():
        most = dict(shared, n_estimators=max(_trees(f) for f in members))
        if model == "RandomForest":
            most["max_depth"] = max(_depth(f) for f in members)
        out.append((Fit.of(model, list(features), most, part), members))
    return out


def _trees(fit: Fit) -> int:
    return _trees_of(dict(fit.params))


def _depth(fit: Fit) -> int:
    return _depth_of(fit.model, dict(fit.params))


def _few(k: int):
    """Some values of every part and feature: all of them if they are no more than BINS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            part, x = batch.column("part").to_numpy(), _points(batch)
            for p in np.unique(part).tolist():
                for f, column in enumerate(x[part == p].T):
                    s = seen.get((p, f), np.zeros(0))
                    if s.size <= BINS:
                        seen[p, f] = np.unique(np.concatenate([s, column[~np.isnan(column)] + 0.0]))[:BINS + 1]
        for (p, f), s in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, p), pa.int32()), pa.array(np.full(s.size, f), pa.int32()), pa.array(s)],
                                             ["part", "feature", "value"])

    return run


def _cells(sent):
    """A row per row and feature list of its part: the bins of the list, the side (0: to fit on) and the label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, columns, sides = sent.value
        number = {"fit": 0} | {s: 1 + i for i, s in enumerate(sides)}
        for batch in batches:
            part, label = batch.column("part").to_numpy(), batch.column("label").to_numpy(zero_copy_only=False)
            side, x = np.array([number.get(s, -1) for s in batch.column("side").to_pylist()]), _points(batch)
            for p in np.unique(part).tolist():
                mine = np.flatnonzero((part == p) & (side >= 0))
                if p not in edges or not mine.size:
                    continue
                bins = np.column_stack([np.searchsorted(e, c) for e, c in zip(edges[p], x[mine].T)]).astype(np.uint8)
                for unit, (of, some) in enumerate(columns):
                    if of == p:
                        starts = np.arange(mine.size + 1, dtype=np.int32) * some.size
                        data = pa.Array.from_buffers(pa.binary(), mine.size, [None, pa.py_buffer(starts), pa.py_buffer(
                            np.ascontiguousarray(bins[:, some]))])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(mine.size, unit), pa.int32()), pa.array(side[mine], pa.int32()), data,
                            pa.array(label[mine], pa.int32())], ["unit", "side", "bins", "label"])

    return run


def _dealt(work):
    """The cells of a batch packed for every job that reads them: side, bins, rows of label 0 and 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        jobs = work.value[0]
        for batch in batches:
            unit = batch.column("unit").to_numpy()
            bins = batch.column("bins").to_pylist()
            side, w0, w1 = (batch.column(c).to_numpy() for c in ("side", "w0", "w1"))
            for u in np.unique(unit).tolist():
                mine = np.flatnonzero(unit == u)
                data = None
                for n, ((of, *_), k) in enumerate(jobs):
                    if of == u:
                        data = data or np.column_stack([
                            side[mine].astype(np.uint8), np.frombuffer(b"".join([bins[i] for i in mine]), np.uint8).reshape(-1, k),
                            w0[mine].astype("<i8")[:, None].view(np.uint8), w1[mine].astype("<i8")[:, None].view(np.uint8)]).tobytes()
                        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([data], pa.binary())], ["job", "data"])

    return run


def _grow(work, by_cell: bool):
    """The scores of the held cells by the model of a job, summed over its trees; with the cell if jobs share a model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        jobs, seed, step = work.value
        got: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for n, data in zip(batch.column("job").to_pylist(), batch.column("data").to_pylist()):
                got.setdefault(n, []).append(np.frombuffer(data, np.uint8).reshape(-1, jobs[n][1] + 17))
        for n in sorted(got):
            (_, kind, params, lo, hi, asked), k = jobs[n]
            rows = np.concatenate(got.pop(n))
            side, bins = rows[:, 0], rows[:, 1:k + 1]
            w0, w1 = (np.ascontiguousarray(rows[:, i:i + 8]).view("<i8").ravel() for i in (k + 1, k + 9))
            fit, held = side == 0, np.flatnonzero(side > 0)
            del rows
            stages = [(min(_trees_of(p), hi), _depth_of(kind, p)) for _, p, _ in asked]
            grow = forest_sums if kind == "RandomForest" else boosted_sums
            sums = grow(np.asfortranarray(bins[fit]), w0[fit], w1[fit], np.asfortranarray(bins[held]), params, seed, lo, hi, stages, step)
            for (config, p, sides), total in zip(asked, sums):
                mine = np.isin(side[held] - 1, sides)
                at, m = held[mine], int(mine.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(m, config), pa.int32()), pa.array(side[at] - 1, pa.int32()),
                    pa.array([b.tobytes() for b in bins[at]] if by_cell else [None] * m, pa.binary()), pa.array(w0[at]), pa.array(w1[at]),
                    pa.array(np.full(m, _trees_of(p) if kind == "RandomForest" else 1), pa.int32()), pa.array(total[mine])],
                    ["config", "side", "cell", "w0", "w1", "trees", "total"])

    return run


def _trees_of(params: dict) -> int:
    return params.get("n_estimators", 100)


def _depth_of(model: str, params: dict) -> int:
    depth = params.get("max_depth", None if model == "RandomForest" else 6)
    return MOST_DEPTH if depth is None else depth


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Draws:
    """How often a tree draws each cell: for every row of it a Poisson number of mean one, or with a share one or none."""

    def __init__(self, bins: np.ndarray, w0: np.ndarray, w1: np.ndarray, seed: int, share: float | None = None):
        h = np.full(len(bins), seed, np.uint64)
        for column in bins.T:
            h = _mixed(h * np.uint64(31) + column.astype(np.uint64) + np.uint64(1))
        self.cell = np.concatenate([np.flatnonzero(w0), np.flatnonzero(w1)])
        label = np.repeat([0, 1], [np.count_nonzero(w0), np.count_nonzero(w1)])
        w = np.where(label == 0, w0[self.cell], w1[self.cell])
        order = np.argsort(w, kind="stable")
        self.n, self.cell, self.label, w = len(bins), self.cell[order], label[order].astype(bool), w[order]
        self.h = _mixed(h[self.cell] + self.label.astype(np.uint64))
        counts, first = np.unique(w, return_index=True)
        self.tables = [(lo, hi, _poisson(c) if share is None else _binomial(c, share)) for c, lo, hi in zip(
            counts.tolist(), first.tolist(), [*first[1:].tolist(), w.size])]

    def of(self, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows of label 1, rows) drawn of every cell."""
        z = _mixed(self.h + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        u = (z >> np.uint64(11)) / float(1 << 53)
        drawn = np.empty(u.size)
        for lo, hi, table in self.tables:
            drawn[lo:hi] = np.searchsorted(table, u[lo:hi], side="right")
        return np.bincount(self.cell[self.label], drawn[self.label], self.n), np.bincount(self.cell, drawn, self.n)


def _poisson(mean: int) -> np.ndarray:
    """Chances of up to 0, 1, 2... of a Poisson number."""
    n = np.arange(int(mean + 12 * np.sqrt(mean) + 20))
    return np.exp(-mean + n * np.log(mean) - np.concatenate([[0.0], np.log(n[1:]).cumsum()])).cumsum()


def _binomial(rows: int, share: float) -> np.ndarray:
    """Chances of up to 0, 1, 2... of rows, less than all of them."""
    n = np.arange(rows)
    ways = np.concatenate([[0.0], (np.log(rows - n[:-1]) - np.log(n[1:])).cumsum()])
    return np.exp(ways + n * np.log(share) + (rows - n) * np.log1p(-share)).cumsum()


def grow_tree(bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, leaf: float, ridge: float, pick,
              step: int = FIT_ROWS, ended: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """A tree grown level by level: feature (-1 at a leaf), bin (up to it: left), left (right is next), value.

    The gain of a split is the growth of G * G / (H + ridge), G and H sums of g and h; leaves have H >= leaf. pick
    says which (node, feature) a level may split on, as many at every node. For h = row weights and g = weight * label that is
    the Gini gain. ``ended`` is filled with the node in which each row ends.
    """
    feature, cut, left, value = [np.full(1, -1)], [np.zeros(1, int)], [np.zeros(1, int)], [np.array([g.sum() / (h.sum() + ridge)])]
    if ended is None:
        rows = np.flatnonzero(h > 0)
        if rows.size < len(bins):
            bins, g, h = bins.T[:, rows].T, g[rows], h[rows]
    rows, slot, ids, size = None, np.zeros(len(bins), np.int64), np.zeros(1, int), 1
    for level in range(depth):
        m = ids.size
        looked = pick(level, m).nonzero()[1].reshape(m, -1)
        split_of = _by_order if m * BINS > max(slot.size, 1 << 15) else _by_histogram
        gain, f, b, gl, hl, ga, ha = split_of(bins, rows, slot, g, h, m, looked, leaf, ridge, step)
        split = np.flatnonzero(gain > 1e-9 * np.maximum(ha, 1e-9))
        if not split.size:
            break
        f, b, gl, hl = f[split], b[split], gl[split], hl[split]
        whole = np.concatenate(feature), np.concatenate(cut), np.concatenate(left)
        for array, new in zip(whole, (f, b, size + 2 * np.arange(split.size))):
            array[ids[split]] = new
        feature, cut, left = [whole[0]], [whole[1]], [whole[2]]
        sums = np.column_stack([gl, ga[split] - gl]).ravel(), np.column_stack([hl, ha[split] - hl]).ravel()
        kids = 2 * split.size
        feature.append(np.full(kids, -1))
        cut.append(np.zeros(kids, int))
        left.append(np.zeros(kids, int))
        value.append(sums[0] / (sums[1] + ridge))
        number = np.full(m, -1)
        number[split] = np.arange(split.size)
        slot = number[slot]
        if split.size < m:
            kept = np.flatnonzero(slot >= 0)
            rows, slot = kept if rows is None else rows[kept], slot[kept]
        slot = 2 * slot + (_at(bins, rows, f[slot]) > b[slot])
        if ended is not None:
            ended[slice(None) if rows is None else rows] = size + slot
        ids, size = size + np.arange(kids), size + kids
        if not ridge:  # nodes of one label or too few rows are leaves
            going = (sums[0] > 0) & (sums[0] < sums[1]) & (sums[1] >= 2 * leaf)
            if not going.all():
                number, ids = np.cumsum(going) - 1, ids[going]
                kept = np.flatnonzero(going[slot])
                rows, slot = kept if rows is None else rows[kept], number[slot[kept]]
        if not ids.size:
            break
    return {"feature": np.concatenate(feature), "cut": np.concatenate(cut), "left": np.concatenate(left), "value": np.concatenate(value)}


def _at(bins: np.ndarray, rows: np.ndarray | None, feature: np.ndarray) -> np.ndarray:
    """The bin of every row in its feature."""
    rows = np.arange(len(bins)) if rows is None else rows
    return bins.ravel("K").take(feature * len(bins) + rows) if bins.flags.f_contiguous else bins[rows, feature]


def _gain(gl, hl, ga, ha, leaf: float, ridge: float) -> np.ndarray:
    gr, hr = ga - gl, ha - hl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl * gl / (hl + ridge) + gr * gr / (hr + ridge) - ga * ga / (ha + ridge)
    return np.where((hl >= leaf) & (hr >= leaf) & (hl > 1e-12) & (hr > 1e-12), gain, -np.inf)


def _by_histogram(bins, rows, slot, g, h, m: int, looked: np.ndarray, leaf: float, ridge: float, step: int):
    """(gain, feature, bin, left g, left h, g, h) of the best split of every node: the first of the best."""
    some = looked.shape[1]
    same = (looked == looked[0]).all()
    gs, hs = np.zeros((some, m * BINS)), np.zeros((some, m * BINS))
    for lo in range(0, slot.size, step):
        mine = slot[lo:lo + step]
        at = slice(lo, lo + step) if rows is None else rows[lo:lo + step]
        base, one, two = mine * BINS, g[at], h[at]
        for j in range(some):
            flat = base + (bins[at, looked[0, j]] if same else _at(bins, np.arange(lo, lo + mine.size) if rows is None else at, looked[mine, j]))
            gs[j] += np.bincount(flat, one, m * BINS)
            hs[j] += np.bincount(flat, two, m * BINS)
    gl, hl = (v.reshape(some, m, BINS).transpose(1, 0, 2).cumsum(axis=2) for v in (gs, hs))
    ga, ha = gl[:, 0, -1], hl[:, 0, -1]
    gain = _gain(gl, hl, ga[:, None, None], ha[:, None, None], leaf, ridge).reshape(m, -1)
    best, node = gain.argmax(axis=1), np.arange(m)
    j, b = best // BINS, best % BINS
    return gain[node, best], looked[node, j], b, gl[node, j, b], hl[node, j, b], ga, ha


def _by_order(bins, rows, slot, g, h, m: int, looked: np.ndarray, leaf: float, ridge: float, step: int):
    """The same for many nodes of few rows, whose histograms would be larger than the rows."""
    g, h = (g, h) if rows is None else (g[rows], h[rows])
    ga, ha = np.bincount(slot, g, m), np.bincount(slot, h, m)
    before = np.cumsum(ga) - ga, np.cumsum(ha) - ha
    gain, f, b, gl, hl = np.full(m, -np.inf), np.zeros(m, int), np.zeros(m, int), np.zeros(m), np.zeros(m)
    for j in range(looked.shape[1]):
        key = ((slot * BINS + _at(bins, rows, looked[slot, j])) << 32) + np.arange(slot.size)
        key.sort()
        order, key = key & 0xFFFFFFFF, key >> 32
        node = key // BINS
        last = np.flatnonzero(key[1:] != key[:-1])
        last = last[node[last] == node[last + 1]]
        if not last.size:
            continue
        of = node[last]
        one, two = np.cumsum(g[order])[last] - before[0][of], np.cumsum(h[order])[last] - before[1][of]
        found = _gain(one, two, ga[of], ha[of], leaf, ridge)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        top = np.maximum.reduceat(found, first)
        hit = np.flatnonzero(found == np.repeat(top, np.diff([*first, of.size])))
        hit = hit[np.concatenate([[True], of[hit[1:]] != of[hit[:-1]]])]
        hit = hit[found[hit] > gain[of[hit]]]
        to = of[hit]
        gain[to], f[to], b[to], gl[to], hl[to] = found[hit], looked[to, j], key[last[hit]] % BINS, one[hit], two[hit]
    return gain, f, b, gl, hl, ga, ha


def _walk(tree: dict, bins: np.ndarray, depths: list[int]) -> list[np.ndarray]:
    """The node of every row at the given depths, smallest first."""
    at, out = np.zeros(len(bins), int), []
    for level in range(depths[-1] + 1):
        feature = tree["feature"][at]
        inner = feature >= 0
        last = not inner.any()
        out += [at for d in depths[len(out):] if d == level or last]
        if len(out) == len(depths):
            return out
        at = np.where(inner, tree["left"][at] + (_at(bins, None, np.maximum(feature, 0)) > tree["cut"][at]), at)
    return out


def forest_sums(bins: np.ndarray, w0: np.ndarray, w1: np.ndarray, held: np.ndarray, params: dict, seed: int, lo: int, hi: int,
                stages: list[tuple[int, int]], step: int = FIT_ROWS) -> list[np.ndarray]:
    """Per held cell and stage (trees, depth) the summed share of label 1 over the trees from lo up to its own; a tree draws
    rows with replacement, and a split looks at the square root of the features. A tree's draws depend on its
    number and the level, so fewer trees and less depth give the same trees, cut."""
    k = bins.shape[1]
    some, draws = max(1, int(np.sqrt(k))), Draws(bins, w0, w1, seed)
    depths = sorted({d for _, d in stages})
    sums, out = {d: np.zeros(len(held)) for d in depths}, {}
    for t in range(lo, hi):
        out |= {s: sums[s[1]].copy() for s in stages if s[0] == t}

        def pick(level: int, m: int, t=t) -> np.ndarray:
            draw = np.random.default_rng([seed, t, level]).random((m, k))
            return draw <= np.partition(draw, some - 1, axis=1)[:, some - 1:some]

        pos, weight = draws.of(t)
        tree = grow_tree(bins, pos, weight, depths[-1], params.get("min_samples_leaf", 1), 0.0, pick, step)
        share = np.round(tree["value"] * SHARES) / SHARES
        for d, at in zip(depths, _walk(tree, held, depths)):
            sums[d] += share[at]
    return [out[s] if s in out else np.zeros(len(held)) if s[0] <= lo else sums[s[1]] for s in stages]


def boosted_sums(bins: np.ndarray, w0: np.ndarray, w1: np.ndarray, held: np.ndarray, params: dict, seed: int, lo: int, hi: int,
                 stages: list[tuple[int, int]], step: int = FIT_ROWS) -> list[np.ndarray]:
    """Per held cell and stage (rounds, depth) the chance of label 1 by rounds of trees on the gradient of the log loss, from
    even odds; a round draws its rows and features."""
    k, n = bins.shape[1], len(bins)
    rate, share, some = params.get("learning_rate", 0.3), params.get("subsample", 1.0), params.get("colsample_bytree", 1.0)
    depth = _depth_of("GradientBoosting", params)
    draws = Draws(bins, w0, w1, seed, share) if share < 1 else None
    # a row weighs a quarter at most
    leaf = max(1e-3, (params.get("min_samples_leaf", 1) - 1) / 4)
    pos, weight = w1.astype(float), (w0 + w1).astype(float)
    score, told, out, ended = np.zeros(n), np.zeros(len(held)), {}, np.zeros(n, int)
    for t in range(hi):
        out |= {s: told.copy() for s in stages if s[0] == t}
        among = np.zeros(k, bool)
        among[np.random.default_rng([seed, t]).permutation(k)[:max(1, int(some * k))]] = True
        if draws is not None:
            pos, weight = draws.of(t)
        p = 1 / (1 + np.exp(-score))
        g, h = pos - weight * (np.round(p * PARTS) / PARTS), weight * (np.round(p * (1 - p) * PARTS) / PARTS)
        ended[:] = 0
        tree = grow_tree(bins, g, h, depth, leaf, 1.0, lambda level, m: np.broadcast_to(among, (m, k)), step, ended)  # noqa: B023
        value = rate * tree["value"]
        score += value[ended]
        told += value[_walk(tree, held, [depth])[0]]
    return [1 / (1 + np.exp(-out.get(s, told))) for s in stages]


def _score(sent):
    names = ["config", "side", "label", "prediction", "probability"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        for batch in batches:
            part, side = batch.column("part").to_numpy(), np.array(batch.column("side").to_pylist())
            labels, x = batch.column("label").to_numpy(), _points(batch)
            for key in sorted(set(zip(part.tolist(), side.tolist()))):
                rows = np.flatnonzero((part == key[0]) & (side == key[1]))
                for config, columns, w in asked.get(key, ()):
                    found = 1 / (1 + np.exp(-(x[rows][:, columns] @ w[:-1] + w[-1])))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(rows.size, config), pa.int32()), pa.array([key[1]] * rows.size),
                        pa.array(labels[rows], pa.int32()), pa.array((found > 0.5).astype(np.int32)), pa.array(found)], names)

    return run
