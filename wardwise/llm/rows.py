"""Rows told apart by id and text, their removal, and joins of many rows with one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardwise.session import materialize

#: A list of rows (some 100 bytes each, hashed) is broadcast up to so many, beyond it is joined by shuffle.
MOST_BROADCAST = 250_000
#: So many rows of a key meet its one row of the other side in a task; keys with more are dealt over several.
KEY_ROWS = 512


def text_id(text: str = "text") -> Column:
    return F.xxhash64(F.col(text))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the rows (doc_id, text_id) of a written table `dropped`."""
    side = dropped.select(F.col("doc_id").alias("_drop_id"), F.col("text_id").alias("_drop_text")).distinct()
    if dropped.count() <= MOST_BROADCAST:
        side = F.broadcast(side)
    met = F.col("doc_id").eqNullSafe(F.col("_drop_id")) & (text_id() == F.col("_drop_text"))
    return docs.join(side, met, "left_anti")


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """The written table and aggregates of its rows, taken while they are written."""
    seen = Observation()
    out = materialize(df.observe(seen, *(m.alias(k) for k, m in metrics.items())), name)
    return out, seen.get


def spread_join(rows: DataFrame, side: DataFrame, on: list[str], counts: DataFrame, how: str = "inner",
                key_rows: int | None = None, most_rows: int | None = None) -> DataFrame:
    """rows joined to side, which has one row per key, without all rows of a hot key in one task.

    `counts` (on, n) says how many rows a key has. Keys with over KEY_ROWS are dealt over several copies of
    the side's row; the list of these keys, a KEY_ROWS-th of the rows at most, is broadcast if it is small, else
    joined. most_rows says, if known, how many rows the hottest key has. Keys are not null.
    """
    most = KEY_ROWS if key_rows is None else key_rows
    if most_rows is not None and most_rows <= most:
        return rows.join(side, on, how)
    names = [f"_hot{i}" for i in range(len(on))]
    hot, seen = observed(counts.where(F.col("n") > most).select(
        *(F.col(k).alias(h) for k, h in zip(on, names)), F.ceil(F.col("n") / most).cast("int").alias("_copies")), "hot", n=F.count(F.lit(1)))
    n_hot = seen["n"]
    if not n_hot:
        return rows.join(side, on, how)
    hot = F.broadcast(hot) if n_hot <= MOST_BROADCAST else hot
    met = lambda df: [df[k] == hot[h] for k, h in zip(on, names)]
    copies = F.coalesce("_copies", F.lit(1))
    dealt = rows.join(hot, met(rows), "left").withColumn(
        "_deal", F.pmod(F.xxhash64(F.monotonically_increasing_id()), copies).cast("int")).drop(*names, "_copies")
    copied = side.join(hot, met(side), "left").withColumn("_deal", F.explode(F.sequence(F.lit(0), copies - 1))).drop(*names, "_copies")
    return dealt.join(copied, [*on, "_deal"], how).drop("_deal")
