"""Queries of balancing and density noise."""

from pyspark.sql import functions as F

from wardwise.functions import clinical as C
from wardwise.operators import neighbours as B
from wardwise.plans.model_queries import HASH, TARGET
from wardwise.plans.registry import register
from wardwise.plans.suite_queries import rounded

POINT = ["time_in_hospital", "num_lab_procedures", "num_medications", "number_inpatient"]


def _rows(c):
    return c.encounters.select("encounter_id", *POINT,
                               C.encode_target(F.col("readmitted")).alias("label"))


_D2 = " + ".join(f"(CAST(a.{f} AS DOUBLE) - b.{f}) * (CAST(a.{f} AS DOUBLE) - b.{f})" for f in POINT)
_SAME = ", ".join(POINT)
register("smote", lambda c: rounded(B.smote(_rows(c), POINT, "label", "encounter_id"), 6), f"""
WITH r AS (SELECT encounter_id, {_SAME}, {TARGET} AS label FROM {{encounters}}),
m AS (SELECT *, {HASH.format('encounter_id', 42)} AS h,
  MIN(encounter_id) OVER (PARTITION BY {_SAME}) AS pid FROM r WHERE label = 1),
sizes AS (SELECT COUNT(*) FILTER (WHERE label = 1) AS n,
  COUNT(*) FILTER (WHERE label = 0) - COUNT(*) FILTER (WHERE label = 1) AS wanted FROM r),
near AS (SELECT a.encounter_id AS id, b.encounter_id AS nid,
  ROW_NUMBER() OVER (PARTITION BY a.encounter_id ORDER BY {_D2}, b.pid, b.encounter_id) - 1 AS j
  FROM m a JOIN m b ON a.encounter_id <> b.encounter_id QUALIFY j < 5),
quota AS (SELECT m.*, wanted // n + CASE WHEN ROW_NUMBER() OVER (ORDER BY h, encounter_id)
  <= wanted % n THEN 1 ELSE 0 END AS copies FROM m, sizes),
drawn AS (SELECT q.*, unnest(range(1, copies + 1)) AS copy FROM quota q),
picks AS (SELECT d.*,
  CAST('0x' || substr(md5(encounter_id || ':' || copy || ':43'), 1, 15) AS BIGINT) % 5 AS j,
  CAST(CAST('0x' || substr(md5(encounter_id || ':' || copy || ':44'), 1, 15) AS BIGINT) >> 30
    AS DOUBLE) / 1073741824 AS gap FROM drawn d)
SELECT encounter_id, 0 AS copy, label, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in POINT)}
FROM r
UNION ALL SELECT p.encounter_id, CAST(p.copy AS INT), p.label,
  {', '.join(f'ROUND(p.{f} + p.gap * (CAST(o.{f} AS DOUBLE) - p.{f}), 6)' for f in POINT)}
FROM picks p JOIN near n ON n.id = p.encounter_id AND n.j = p.j
JOIN m o ON o.encounter_id = n.nid""")
_EPS, _MIN = 2.0, 10
register("density_noise",
         lambda c: B.noise_count(_rows(c), POINT, "encounter_id", _EPS, _MIN), f"""
WITH r AS (SELECT {_SAME}, COUNT(*) AS w FROM {{encounters}} GROUP BY ALL),
n AS (SELECT {', '.join('a.' + f for f in POINT)}, ANY_VALUE(a.w) AS w, SUM(b.w) AS seen
  FROM r a JOIN r b ON abs(a.num_lab_procedures - b.num_lab_procedures) <= {_EPS}
    AND {_D2} <= {_EPS * _EPS} GROUP BY ALL),
k AS (SELECT * FROM n WHERE seen >= {_MIN}),
z AS (SELECT a.w FROM n a WHERE a.seen < {_MIN} AND NOT EXISTS (SELECT 1 FROM k b
  WHERE abs(a.num_lab_procedures - b.num_lab_procedures) <= {_EPS} AND {_D2} <= {_EPS * _EPS}))
SELECT (SELECT CAST(SUM(w) AS BIGINT) FROM r) AS rows,
  COALESCE((SELECT CAST(SUM(w) AS BIGINT) FROM k), 0) AS core_rows,
  COALESCE((SELECT CAST(SUM(w) AS BIGINT) FROM z), 0) AS noise_rows""")
