"""Blocked windows give the plain window's result, with hot keys and without."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardwise.operators import ordered as O
from wardwise.operators.quantiles import exact_quantiles, quantiles_of_counts


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 3000
    ids = rng.choice(np.concatenate([np.arange(2000), rng.integers(0, 2**62, 4000)]), n, False)
    pdf = pd.DataFrame({
        "encounter_id": ids, "patient_nbr": np.where(rng.random(n) < 0.34, 1, rng.integers(2, 400, n)),
        "time_in_hospital": rng.integers(1, 15, n), "readmitted_code": rng.integers(0, 3, n)})
    return spark.createDataFrame(pdf).repartition(7), pdf.sort_values("encounter_id")


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_per_patient(rows, hot_rows):
    df, pdf = rows
    groups = pdf.groupby("patient_nbr")
    want = pdf.assign(
        encounter_index=groups.cumcount() + 1,
        rolling_avg=groups["time_in_hospital"].transform(lambda s: s.expanding().mean()),
        num_previous_readmissions=groups["readmitted_code"].transform(
            lambda s: s.cumsum() - s)).set_index("encounter_id")
    out = O.expanding_avg_stay(O.encounter_index(df, hot_rows=hot_rows), hot_rows=hot_rows)
    got = O.previous_readmissions(out, hot_rows=hot_rows).toPandas().set_index("encounter_id")
    got = got.loc[want.index]
    assert (got["encounter_index"] == want["encounter_index"]).all()
    assert np.allclose(got["rolling_avg"], want["rolling_avg"])
    assert (got["num_previous_readmissions"] == want["num_previous_readmissions"]).all()


def test_global_index_and_rolling(rows):
    df, pdf = rows
    want = pdf.assign(i=range(len(pdf)), r=pdf["readmitted_code"].rolling(100, min_periods=1).mean())
    want = want.set_index("encounter_id")
    got = O.rolling_readmission_rate(df, rows=100, block_rows=250).toPandas()
    got = got.set_index("encounter_id").loc[want.index]
    assert len(got) == len(pdf)
    assert (got["global_index"] == want["i"]).all()
    assert np.allclose(got["rolling_rate"], want["r"])


def test_negative_and_null_measures(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 4), (1, 3, None), (None, 4, 2), (None, 5, 6)],
                               "patient_nbr int, encounter_id long, time_in_hospital int")
    got = {r.encounter_id: r.rolling_avg
           for r in O.expanding_avg_stay(df, hot_rows=1).collect()}
    assert got == {1: None, 2: 4.0, 3: 4.0, 4: 2.0, 5: 4.0}


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_exact_quantiles(spark, hot_rows):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 900), "a": rng.normal(0, 1e6, 900),
                        "b": rng.integers(-5, 5, 900).astype(float)})
    probs = [0.0, 0.05, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), ["a", "b"], probs, [F.col("g")],
                          hot_rows).toPandas()
    assert len(got) == 3 * 2 * len(probs)
    for r in got.itertuples():
        want = np.quantile(pdf.loc[pdf.g == r.g, r.column], r.prob)
        assert np.isclose(r.value, want)


def test_blocks_follow_ranks_not_values(spark):
    ids = spark.range(200_000).select((F.col("id") + 10**12).cast("double").alias("value"))
    edges = O.rank_edges(ids, [], F.col("value"))
    assert len(edges) > 1000 and min(edges) >= 10**12
    wide = ids.withColumn("n", F.lit(1))
    got = quantiles_of_counts(wide.withColumn("k", F.lit("a")), [0.25, 0.5], hot_rows=1000)
    assert {r.prob: r.value for r in got.collect()} == {0.25: 10**12 + 49999.75, 0.5: 10**12 + 99999.5}
