"""Seeded, engine-independent hashing: a retried task draws the same values again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def seeded_hash(seed: int, *keys: Column) -> Column:
    """60-bit non-negative integer, uniform over the keys."""
    text = F.concat_ws(":", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def seeded_unit(seed: int, *keys: Column) -> Column:
    """Uniform double in [0, 1)."""
    return (F.shiftright(seeded_hash(seed, *keys), HASH_BITS - 30)).cast("double") / float(1 << 30)
