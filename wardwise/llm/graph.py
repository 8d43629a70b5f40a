"""Connected components by alternating star contractions, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwise.llm.rows import observed, spread_join
from wardwise.session import materialize


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """(written edges, their number and a digest of them)."""
    out, seen = observed(edges, "edges", n=F.count(F.lit(1)), x=F.bit_xor(F.xxhash64("hi", "lo")))
    return out, (seen["n"], seen["x"])


def _stars(edges: DataFrame) -> bool:
    """Does every vertex have one root, which has none itself."""
    ends = edges.select(F.col("hi").alias("v"), F.lit(1).alias("roots"), F.lit(0).alias("leads")).union(
        edges.select("lo", F.lit(0), F.lit(1)))
    return ends.groupBy("v").agg(F.sum("roots").alias("roots"), F.max("leads").alias("leads")).where("roots > 1 OR roots = 1 AND leads = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of longs -> rows (id, root), root the least id of the component; roots have no row.

    Each round links the neighbours of every vertex to the least of them; a vertex with many neighbours
    is handled by aggregates and spread joins, never as a list or in one task. Rounds grow with the logarithm of
    the size.
    """
    cur, state = _written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    while state[0] and not _stars(cur):
        both = cur.select(F.col("hi").alias("v"), F.col("lo").alias("u")).union(cur.select("lo", "hi"))
        least, seen = observed(both.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")), "least", most=F.max("n"))
        met = spread_join(both, least.select("v", F.least("v", "m").alias("m")), ["v"], least, most_rows=seen["most"])
        large = materialize(met.where("u > v AND u <> m").select(F.col("u").alias("hi"), F.col("m").alias("lo")).distinct(), "large")
        down, seen = observed(large.groupBy("hi").agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("n")), "down", most=F.max("n"))
        small = spread_join(large, down.select("hi", "m"), ["hi"], down, most_rows=seen["most"] or 0).select(
            F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")
        ).select("e.*").where("hi <> lo").distinct()
        last = state
        cur, state = _written(small)
        if state == last:
            break
    return cur.select(F.col("hi").alias("id"), F.col("lo").alias("root"))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (id, root) once the links (a, b) are added: only the components that they touch are worked on."""
    end = lambda side: links.join(roots.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root")), side, "left").withColumn(
        side, F.coalesce(f"{side}_root", side)).drop(f"{side}_root")
    links = end("a")
    over = materialize(components(end("b")), "over").select(F.col("id").alias("_of"), F.col("root").alias("_over"))
    moved = roots.join(over, F.col("root") == F.col("_of"), "left").select("id", F.coalesce("_over", "root").alias("root"))
    known = roots.select(F.col("id").alias("_of"))
    return moved.union(over.join(known, "_of", "left_anti").select("_of", "_over"))
