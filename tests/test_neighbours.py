"""Blocked neighbour work against brute force, with small blocks and many equal points."""

import numpy as np
import pandas as pd
import pytest

from wardwise.operators import neighbours as B


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    spread = np.concatenate([rng.normal(0, 1, (70, 3)), rng.normal(6, 0.4, (50, 3)),
                             rng.uniform(-20, 20, (20, 3))])
    same = np.repeat([[1.0, 2.0, 3.0]], 50, axis=0)  # a quarter of the rows are one point
    x = np.concatenate([spread, same])
    return pd.DataFrame(x, columns=list("abc")).assign(id=range(len(x)))


def squared(x):
    return ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)


@pytest.mark.parametrize("block_rows, eps, least", [(16, 0.5, 10), (16, 2.0, 5), (10_000, 1.0, 8)])
def test_density_noise(spark, points, block_rows, eps, least):
    d2 = squared(points[list("abc")].to_numpy())
    core = (d2 <= eps * eps).sum(1) >= least
    noise = ~core & ~((d2 <= eps * eps) & core[None, :]).any(1)
    got = B.density_noise(spark.createDataFrame(points), list("abc"), "id", eps, least,
                          block_rows).toPandas().sort_values("id")
    assert (got["core"].to_numpy() == core).all()
    assert (got["noise"].to_numpy() == noise).all()
    assert 0 < noise.sum() < len(points)


@pytest.mark.parametrize("block_rows", [16, 10_000])
def test_nearest(spark, points, block_rows):
    k = 5
    blocks, found = B.nearest(spark.createDataFrame(points), list("abc"), "id", k, block_rows)
    blocks, found = blocks.toPandas(), found.toPandas()
    assert blocks["w"].sum() == len(points) and blocks.groupby("block").size().max() <= block_rows
    x, w = np.stack(blocks["x"]), blocks["w"].to_numpy()
    pid = blocks["pid"].to_numpy()
    d2 = squared(x)
    where = {p: i for i, p in enumerate(pid)}
    for i, p in enumerate(pid):
        mine = found[found["pid"] == p].sort_values("place")
        copies = w.copy()
        copies[i] -= 1
        order = np.lexsort((pid, d2[i]))
        want = [j for j in order if copies[j] > 0][:k]
        got = [where[n] for n in mine["nid"]]
        assert np.allclose(d2[i][got], d2[i][want])
        assert list(mine["w"]) == [copies[j] for j in got]


@pytest.mark.parametrize("block_rows", [12])
def test_smote(spark, points, block_rows):
    pdf = points.assign(label=(points["id"] % 7 == 0).astype(int) + 2 * (points["id"] % 11 == 0))
    df = spark.createDataFrame(pdf)
    out = B.smote(df, list("abc"), "label", "id", block_rows=block_rows).toPandas()
    sizes = out.groupby("label").size()
    assert sizes.nunique() == 1 and sizes.iloc[0] == pdf.groupby("label").size().max()
    assert not out.duplicated(["id", "copy"]).any()
    assert (out[out["copy"] == 0].sort_values("id")[list("abc")].to_numpy()
            == pdf[list("abc")].to_numpy()).all()
    # every synthetic row lies between its row and one of the five nearest rows of its class
    for label, made in out[out["copy"] > 0].groupby("label"):
        own = pdf[pdf["label"] == label].reset_index(drop=True)
        x = own[list("abc")].to_numpy()
        d2 = squared(x)
        np.fill_diagonal(d2, np.inf)
        for r in made.itertuples():
            i = own.index[own["id"] == r.id][0]
            reach = np.sort(d2[i])[min(5, len(x) - 1) - 1] + 1e-9
            p = np.array([r.a, r.b, r.c])
            ends = x[d2[i] <= reach]
            step = ends - x[i]
            length = (step ** 2).sum(1)
            t = np.where(length > 0, ((p - x[i]) * step).sum(1) / np.where(length > 0, length, 1), 0)
            off = np.abs(x[i] + np.clip(t, 0, 1)[:, None] * step - p).max(1)
            assert off.min() < 1e-9
    again = B.smote(df.repartition(5), list("abc"), "label", "id", block_rows=block_rows).toPandas()
    key = ["id", "copy"]
    assert np.allclose(out.sort_values(key)[list("abc")], again.sort_values(key)[list("abc")])


def _block(rng, n, first, grid):
    x = rng.integers(0, 3, (n, 4)) + 1e6 if grid else rng.normal(size=(n, 6))
    x = x.astype(float)
    x[:3, 1] = [np.nan, np.inf, -np.inf]
    return pd.DataFrame({"pid": np.arange(n) + first, "w": rng.integers(1, 3, n), "x": list(x)})


@pytest.mark.parametrize("grid", [True, False])
def test_kernels_equal_plain_distances(grid):
    """Ties, far from the origin, missing and infinite coordinates; a point meets itself."""
    rng = np.random.default_rng(2)
    left = _block(rng, 300, 0, grid)
    right = pd.concat([left[:120], _block(rng, 200, 1000, grid)])
    with np.errstate(invalid="ignore"):
        d2 = squared_between(np.stack(left["x"]), np.stack(right["x"]))
    nid, w = right["pid"].to_numpy(), right["w"].to_numpy()
    got = B._nearest_kernel(5)(left, right).groupby("pid")
    for i, p in enumerate(left["pid"]):
        copies = w - (nid == p)
        want = [j for j in np.lexsort((nid, d2[i])) if copies[j] > 0 and np.isfinite(d2[i, j])][:5]
        mine = got.get_group(p) if p in got.groups else got.obj[:0]
        assert list(mine["nid"]) == list(nid[want]) and list(mine["w"]) == list(copies[want]) and np.allclose(mine["d2"], d2[i][want])
    for eps in (1.0, 2.0, np.sqrt(2)):
        assert list(B._count_kernel(eps)(left, right)["n"]) == list((d2 <= eps * eps) @ w)


def test_a_block_returns_only_points_within_a_rows_own_radius():
    rng = np.random.default_rng(3)
    left, right = _block(rng, 300, 0, False), _block(rng, 400, 1000, False)
    left["r2"] = rng.choice([0.0, 2.0, 6.0, np.inf], 300)
    whole = B._nearest_kernel(5)(left.drop(columns="r2"), right)
    r2 = left["r2"].to_numpy()[whole["pid"]]
    want = whole[whole["d2"].to_numpy() <= r2]
    got = B._nearest_kernel(5)(left, right)
    assert 0 < len(want) < len(whole) and (got[["pid", "nid", "w"]].to_numpy() == want[["pid", "nid", "w"]].to_numpy()).all()
    far = right.assign(x=[x + 100 for x in right["x"]])
    assert not set(left["pid"][left["r2"] < 10][3:]) & set(B._nearest_kernel(5)(left, far)["pid"])


def squared_between(a, b):
    diff = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", diff, diff)


def test_the_blocks_of_few_bytes_are_compared_in_many_tasks(spark, points):
    df = spark.createDataFrame(points)
    blocks, edges = B._blocked(B._distinct_points(df, list("abc"), "id"), 3, 8)
    own = blocks.select("block").distinct().selectExpr("block a", "block b")
    found = B._compare(blocks, blocks, own, B._nearest_kernel(2), "pid BIGINT, nid BIGINT, w BIGINT, d2 DOUBLE")
    assert found.rdd.getNumPartitions() == min(own.count(), 32) > 8
