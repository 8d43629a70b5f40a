"""Noise, components, clusters and anomalies are of the balanced training rows."""

import numpy as np
from pyspark.sql import functions as F

from wardwise.plans import learning_queries as L
from wardwise.plans import registry
from wardwise.plans.views import Clinic

FOLDER = "/root/testdata/sf0.001"


def brute_force(x, eps, least):
    near = np.array([((x - p) ** 2).sum(axis=1) <= eps * eps for p in x])
    core = near.sum(axis=1) >= least
    return core, ~core & ~near[:, core].any(axis=1)


def test_noise_of_the_balanced_matrix(spark, monkeypatch):
    c = Clinic(spark, FOLDER)
    full = L.balanced_rows(c)
    monkeypatch.setattr(L, "balanced_rows", lambda c: full)
    features = L.table(c).features
    rows = {(r[L.S.KEY], r["copy"]): r for r in L._noise(c).collect()}
    points = full.select(L.S.KEY, "copy", F.array(*[F.col(f"`{f}`") for f in features]).alias("x")).collect()
    assert len(rows) == len(points) == full.select("row").distinct().count()
    core, noise = brute_force(np.array([p.x for p in points]), 0.5, 10)
    got = [rows[p[0], p[1]] for p in points]
    assert [r.core for r in got] == core.tolist() and [r.noise for r in got] == noise.tolist()
    assert L._components(c).count() == len(points)
    assert L._clusters(c).agg(F.sum("rows")).first()[0] == len(points)


def test_registered():
    registry.load()
    assert {"density_noise", "density_noise_balanced"} <= set(registry.QUERIES)
