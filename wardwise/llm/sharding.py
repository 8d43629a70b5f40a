"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` points of a ring of CELLS cells. A row starts at the cell of its key's hash and
goes clockwise to the next point whose shard has room. All rows of a cell walk the same way, so the
walk is settled on the counts per cell (a table of fixed size); rows then need only their rank
within the cell. The bound on a shard is its share of the rows, so counts differ by one at most,
and only the overflow moves when rows or shards are added.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

BITS = 14
CELLS = 1 << BITS
PIECES = T.StructType([
    T.StructField("cell", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
    T.StructField("slot_base", T.LongType()),
])


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """Points (cell, shard) in clockwise order. Adding a shard leaves the others' points in place."""
    points = []
    for s in range(shards):
        for v in range(vnodes):
            h = int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big")
            points.append((h >> (64 - BITS), h, s))
    return [(cell, s) for cell, _, s in sorted(points)]


def settle(counts: dict[int, int], points: list[tuple[int, int]], shards: int) -> list[tuple]:
    """Pieces (cell, shard, first rank, end rank, first slot); shares differ by one row at most."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slots, pieces = [0] * shards, []
    cells = [c for c, _ in points]
    waiting = [(c, bisect_left(cells, c), 0, n) for c, n in sorted(counts.items()) if n]
    for step in range(len(points)):
        if not waiting:
            break
        later = []
        for cell, first, lo, n in waiting:
            shard = points[(first + step) % len(points)][1]
            take = min(n - lo, room[shard])
            if take:
                pieces.append((cell, shard, lo, lo + take, slots[shard]))
                room[shard] -= take
                slots[shard] += take
            if lo + take < n:
                later.append((cell, first, lo + take, n))
        waiting = later
    return pieces


def cell_of(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS).cast("int")


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24,
                  vnodes: int = 64) -> DataFrame:
    """One row per row of docs: key, size, text_crc32, shard, slot (gapless from 0 in its shard).

    A null text has no bytes; null keys share one place on the ring. Rows equal in key, size and
    checksum are counted first and dealt out as a range, so a row repeated any number of times
    needs no task of its own. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).alias("key"), cell_of(F.col(key)).alias("cell"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    counts = dict(docs.groupBy(cell_of(F.col(key)).alias("cell")).count().collect())
    pieces = spark.createDataFrame(settle(counts, ring(shards, vnodes), shards), PIECES)
    ranked = Window.partitionBy("cell").orderBy(F.xxhash64("key"), "key", "size", "text_crc32")
    groups = (rows.groupBy("cell", "key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("end", F.sum("n").over(ranked.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("start", F.col("end") - F.col("n")))
    # at most CELLS + shards * vnodes pieces, whatever the input
    placed = groups.join(F.broadcast(pieces), "cell").where("start < hi AND end > lo")
    rank = F.explode(F.sequence(F.greatest("start", "lo"), F.least("end", "hi") - 1))
    return (placed.select("key", "size", "text_crc32", "shard", "lo", "slot_base", rank.alias("rank"))
            .select(F.col("key").alias(key), "size", "text_crc32", "shard",
                    (F.col("slot_base") + F.col("rank") - F.col("lo")).alias("slot")))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 shards: int = 24, vnodes: int = 64) -> None:
    """Whole rows below path/shard=N. Rows equal in key, size and checksum stay in one file set,
    that of their first copy."""
    places = (assign_shards(docs, key, text, shards, vnodes)
              .groupBy(F.col(key).alias("_key"), F.col("size").alias("_size"),
                       F.col("text_crc32").alias("_crc")).agg(F.min("shard").alias("shard")))
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    kept = docs.drop("shard").withColumn("_s", size).withColumn("_c", crc)
    met = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_s") == F.col("_size")) & (F.col("_c") == F.col("_crc"))
    kept.join(places, met).drop("_key", "_size", "_crc", "_s", "_c").write.partitionBy("shard").parquet(path)
