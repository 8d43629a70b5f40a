"""Running and rolling computations that stay bounded per task.

A window over one key puts all rows of the key into one task. The rows per key are therefore counted
first, reading only the key columns. Without a key above ``hot_rows`` the plain window runs: one
shuffle. A hot key (and every global computation) is cut into value blocks of the ordering number:
the totals of the earlier blocks are carried in, and the window runs inside one block only. Totals
are summed in two levels, so no step sees more rows than the number of blocks of one super block.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise.session import materialize

HOT_ROWS = 1_000_000
BLOCKS = 1024
SHIFTS = (20, 40)
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def _same(left: DataFrame, right: DataFrame, pairs) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    block_of: Column,
    measures: dict[str, Column],
    hot_rows: int = HOT_ROWS,
    shifts: tuple[int, int] = SHIFTS,
    by_rank: bool = False,
) -> DataFrame:
    """Add, per measure, the sum from the first row of the key through the current row.

    ``block_of`` is a whole number that never falls along ``order``; rows with equal high bits
    share a block. With ``by_rank`` it may be any number, and blocks are cut at its quantiles, so
    they are even however the values lie. Without keys the whole table is one run.
    """
    tagged = _tag_hot(df, keys, hot_rows)
    if tagged is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*_UP_TO_HERE)
        return df.select("*", *[F.sum(expr).over(w).alias(n) for n, expr in measures.items()])
    if by_rank:
        tagged = tagged.withColumn("_value", block_of.cast("double"))
        splits = [-math.inf, *rank_edges(tagged.filter("_hot"), keys, F.col("_value")), math.inf]
        tagged = Bucketizer(splits=splits, inputCol="_value", outputCol="_block",
                            handleInvalid="keep").transform(tagged)
        block_of, shifts = F.col("_block").cast("bigint"), (0, 5)
    tagged = (tagged
              .withColumn("_low", F.when(F.col("_hot"), F.shiftright(block_of, shifts[0])))
              .withColumn("_high", F.when(F.col("_hot"), F.shiftright(block_of, shifts[1]))))
    part = [*keys, "_high", "_low"]
    carry = _carry(tagged.filter("_hot"), keys, measures)
    joined = tagged.join(carry, _same(tagged, carry, [(c, f"{c}_c") for c in part]), "left")
    inside = (Window.partitionBy(*[tagged[c] for c in part]).orderBy(*order)
              .rowsBetween(*_UP_TO_HERE))
    return joined.select(
        *[tagged[c] for c in df.columns],
        *[(F.sum(expr).over(inside) + F.coalesce(F.col(f"_carry_{name}"), F.lit(0))).alias(name)
          for name, expr in measures.items()],
    )


def rank_edges(rows: DataFrame, keys: list[str], value: Column, blocks: int = BLOCKS) -> list[float]:
    """Values between which every hot key has about the same number of rows, from a sketch.

    A key with few distinct values gives few edges. Edges of several keys are simply united; there
    are at most ``blocks`` per hot key.
    """
    probs = [i / blocks for i in range(1, blocks)]
    found = rows.groupBy(*keys).agg(F.percentile_approx(value, probs).alias("e")).collect()
    return sorted({x for r in found for x in r["e"] or () if math.isfinite(x)})


def _tag_hot(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Rows with ``_hot`` where their key is hot; None where no key is."""
    if not keys:
        return df.withColumn("_hot", F.lit(True))
    names = [f"_k{i}" for i in range(len(keys))]
    hot = materialize(
        df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows)
        .select(*names, F.lit(True).alias("_hot")), "hot-keys")
    if hot.isEmpty():
        return None
    # A listed key has more than hot_rows rows, so there are at most rows / hot_rows of them:
    # small enough to broadcast by construction.
    return df.join(F.broadcast(hot), _same(df, hot, zip(keys, names)), "left").drop(*names)


def _carry(rows: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Totals of all earlier blocks, per block. The block totals are written once, so that both
    levels, and Spark's choice of the join, rest on the small table."""
    low = materialize(rows.groupBy(*keys, "_high", "_low").agg(
        *[F.sum(expr).alias(f"_t_{name}") for name, expr in measures.items()]), "block-totals")
    high = low.groupBy(*keys, "_high").agg(
        *[F.sum(f"_t_{name}").alias(f"_t_{name}") for name in measures])
    in_high = Window.partitionBy(*keys, "_high").orderBy("_low").rowsBetween(*_BEFORE)
    in_key = Window.partitionBy(*keys).orderBy("_high").rowsBetween(*_BEFORE)
    low = low.select(
        *[F.col(k).alias(f"{k}_c") for k in keys],
        F.col("_high").alias("_high_c"), F.col("_low").alias("_low_c"),
        *[F.coalesce(F.sum(f"_t_{m}").over(in_high), F.lit(0)).alias(f"_a_{m}") for m in measures])
    high = high.select(
        *[F.col(k).alias(f"{k}_h") for k in keys], F.col("_high").alias("_high_h"),
        *[F.coalesce(F.sum(f"_t_{m}").over(in_key), F.lit(0)).alias(f"_b_{m}") for m in measures])
    pairs = [(f"{k}_c", f"{k}_h") for k in [*keys, "_high"]]
    return low.join(high, _same(low, high, pairs)).select(
        *[f"{k}_c" for k in [*keys, "_high", "_low"]],
        *[(F.col(f"_a_{m}") + F.col(f"_b_{m}")).alias(f"_carry_{m}") for m in measures])


def encounter_index(df: DataFrame, patient: str = "patient_nbr", order: str = "encounter_id",
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number the encounters of each patient from one. Run it before the index-admission filter."""
    return running_sums(df, [patient], [F.col(order)], F.col(order),
                        {"encounter_index": F.lit(1)}, hot_rows)


def expanding_avg_stay(df: DataFrame, patient: str = "patient_nbr", order: str = "encounter_id",
                       stay: str = "time_in_hospital", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean stay of a patient from the first encounter through the current one."""
    sums = running_sums(df, [patient], [F.col(order)], F.col(order), {
        "_total": F.coalesce(F.col(stay), F.lit(0)),
        "_known": F.when(F.col(stay).isNull(), 0).otherwise(1),
    }, hot_rows)
    mean = F.try_divide(F.col("_total").cast("double"), F.col("_known"))
    return sums.withColumn("rolling_avg", mean).drop("_total", "_known")


def previous_readmissions(df: DataFrame, patient: str = "patient_nbr",
                          order: str = "encounter_id", value: str = "readmitted_code",
                          hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sum of the readmission codes of the earlier encounters of the same patient."""
    code = F.coalesce(F.col(value), F.lit(0))
    sums = running_sums(df, [patient], [F.col(order)], F.col(order), {"_through": code}, hot_rows)
    return sums.withColumn("num_previous_readmissions", F.col("_through") - code).drop("_through")


def global_encounter_index(df: DataFrame, order: str = "encounter_id") -> DataFrame:
    """Position of every row in encounter order, from zero, over the whole table."""
    out = running_sums(df, [], [F.col(order)], F.col(order), {"global_index": F.lit(1)})
    return out.withColumn("global_index", F.col("global_index") - 1)


def rolling_readmission_rate(df: DataFrame, value: str = "readmitted_code",
                             order: str = "encounter_id", rows: int = 1000,
                             block_rows: int = 65_536) -> DataFrame:
    """Mean of the last ``rows`` values in encounter order, over the whole table.

    Every block also receives the last rows of the block before it, so the window of a block never
    needs another block.
    """
    block_rows = max(block_rows, rows)
    indexed = global_encounter_index(df, order)
    block = F.floor(F.col("global_index") / block_rows)
    feeds_next = F.col("global_index") % block_rows >= block_rows - (rows - 1)
    copies = F.when(feeds_next, F.array(block, block + 1)).otherwise(F.array(block))
    spread = indexed.withColumn("_block", F.explode(copies))
    w = Window.partitionBy("_block").orderBy("global_index")
    through = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Running totals and the totals ``rows`` before, instead of summing every frame anew.
    spread = (spread
              .withColumn("_sum", F.sum(F.coalesce(F.col(value), F.lit(0))).over(through))
              .withColumn("_n", F.count(value).over(through)))
    inside = lambda c: F.col(c) - F.coalesce(F.lag(c, rows).over(w), F.lit(0))
    return (spread
            .withColumn("rolling_rate", F.try_divide(inside("_sum").cast("double"), inside("_n")))
            .filter(F.col("_block") == block).drop("_block", "_sum", "_n"))
