"""The bundle gives the rows of its result sets."""

from collections import Counter

from pyspark.sql import functions as F

from wardwise.operators import suite
from wardwise.plans import suite_queries as Q


def test_bundle_rows(clinic):
    rows = Q._bundle(clinic).collect()
    n = Counter(r.result_set for r in rows)
    parts = {**suite.analytics_bundle(clinic.patients, clinic.medications, clinic.model_results, F.to_date(F.lit(Q.AS_OF))),
             **suite.summary_bundle(clinic.patients, clinic.model_results)}
    assert n == {name: k for name, df in parts.items() if (k := df.count())}
    for name in ("length_of_stay", "best_models"):
        df = Q.rounded(parts[name])
        names = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
        want = Counter("|".join(r) for r in df.select(*names).collect())
        assert Counter(r.cells for r in rows if r.result_set == name) == want
