"""Density noise compares pairs of blocks in rounds."""

import numpy as np
import pandas as pd

from wardwise.operators import neighbours as B


def test_rounds_give_the_same_rows_and_shuffle_part_of_the_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(0, 1, (120, 3)), columns=list("abc")).assign(id=range(120)))
    told = lambda **o: df_rows(B.density_noise(df, list("abc"), "id", 0.6, 4, 16, **o))
    df_rows = lambda d: sorted(map(tuple, d.collect()))
    whole = told(round_pairs=10_000)
    assert len(whole) == 120 and {r[1] for r in whole} == {r[2] for r in whole} == {True, False}
    asked, plain = [], B._compare
    monkeypatch.setattr(B, "_compare", lambda q, c, pairs, *rest: asked.append(pairs.count()) or plain(q, c, pairs, *rest))
    assert told(round_pairs=2) == whole
    n = sum(asked) // 2  # both passes go over all pairs
    assert len(asked) > 4 and sum(asked) == 2 * n and max(asked) < n

