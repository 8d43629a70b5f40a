"""Benchmark decontamination by a prefix-filtered set join with exact verification.

Benchmark items become windows of `window` words (shorter items one window), windows become shingles of
SHINGLE words. Documents are read once: their words are dealt into stretches of STRETCH words, and wherever one of
the benchmark's shingles may stand, the stretch is kept with the shingles' places and a window's words on
either side. The shingles are then ordered by how often they occur; a window needs all its shingles, so
its rarest one is a sufficient prefix, and windows with a shingle that occurs nowhere are dropped. Places, without
words, meet windows on that shingle; its place gives the window's place, bounds on place and length
follow, and each stretch's words are compared with the windows that may stand there. All of it is linear in a text,
however it repeats itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise.llm import words as W
from wardwise.llm.rows import text_id
from wardwise.session import Temporary, materialize

SHINGLE = 5
#: Bits of the filter that tells tasks which shingles the benchmark has: 2 MB, whatever the benchmark's size.
FILTER_BITS = 24
#: Windows are broadcast up to this count (some 150 bytes each), beyond it they are shuffled.
MOST_BROADCAST = 100_000
STRETCH = 128

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _shingles(w: W.Words, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first word, hash, size) of all runs of the given sizes."""
    parts = [(*w.runs(k), k) for k in sizes]
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
            np.concatenate([np.full(p[0].size, p[2]) for p in parts]))


def _windows(window: int):
    """Per item and window its words and shingles."""
    schema = "item_id long, words string, len int, shingles array<struct<hash:long,off:int,size:int>>"

    def run(batches: Iterator[pa.RecordBatch]):
        for rows, buf, offsets in W.pieces(batches):
            w = W.Words(buf, offsets, W.ALPHANUMERIC, W.FOLDED)
            low = _LOWER[buf]
            runs = {k: dict(zip(*(x.tolist() for x in (w.runs(k)[0], W.signed(w.runs(k)[1]))))) for k in range(1, SHINGLE + 1)}
            out = []
            for item, a, b in zip(rows.column("item_id").to_pylist(), w.first[:-1], w.first[1:]):
                size = min(window, b - a)
                k = min(SHINGLE, size)
                for s in range(a, b - size + 1) if size else ():
                    text = " ".join(low[w.starts[i]:w.ends[i]].tobytes().decode() for i in range(s, s + size))
                    out.append({"item_id": item, "words": text, "len": size, "shingles": [
                        {"hash": runs[k][i], "off": i - s, "size": k} for i in range(s, s + size - k + 1)]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("item_id", pa.int64()), ("words", pa.string()), ("len", pa.int32()),
                ("shingles", pa.list_(pa.struct([("hash", pa.int64()), ("off", pa.int32()), ("size", pa.int32())])))]))

    return run, schema


def _passages(window: int, sizes: list[int], bits):
    """Per document its number of words, a hash of them, and the stretches with possible shingles."""
    hit = pa.struct([("hash", pa.int64()), ("at", pa.int32())])
    passage = pa.struct([("start", pa.int32()), ("words", pa.string()), ("hits", pa.list_(hit))])
    schema = ("doc_id long, text_id long, n_words long, words_hash long, "
              "passages array<struct<start:int,words:string,hits:array<struct<hash:long,at:int>>>>")

    def run(batches: Iterator[pa.RecordBatch]):
        known = bits.value
        for rows, buf, offsets in W.pieces(batches):
            w = W.Words(buf, offsets, W.ALPHANUMERIC, W.FOLDED)
            at, hashes, _ = _shingles(w, sizes)
            slot = hashes >> np.uint64(64 - FILTER_BITS)
            may = (known[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
            at, hashes = at[may], W.signed(hashes[may])
            order = np.argsort(at, kind="stable")
            at, hashes = at[order], hashes[order]
            found: list[list] = [[] for _ in range(len(rows))]
            low = _LOWER[buf] if at.size else buf
            doc = np.searchsorted(w.first, at, "right") - 1
            part = (at - w.first[doc]) // STRETCH
            cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(part) != 0)) + 1
            for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [at.size]])) if at.size else ():
                d = doc[a]
                start = max(w.first[d], at[a] - window + 1)
                end = min(w.first[d + 1], at[b - 1] + window)
                text = " ".join(low[w.starts[i]:w.ends[i]].tobytes().decode() for i in range(start, end))
                found[d].append({"start": int(start - w.first[d]), "words": text, "hits": [
                    {"hash": h, "at": p} for h, p in zip(hashes[a:b].tolist(), (at[a:b] - w.first[d]).tolist())]})
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), rows.column("text_id"), pa.array(w.counts, pa.int64()), pa.array(W.signed(w.text_hashes())),
                pa.array([f or None for f in found], pa.list_(passage))], ["doc_id", "text_id", "n_words", "words_hash", "passages"])

    return run, schema


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, items (sorted strings), contaminated, text_id.

    Words are runs of digits, letters and code points above ASCII, with A-Z in lower case. A word is hit
    if it stands in an occurrence of a window; a document is contaminated if a twentieth of its words
    or more are hit. Null and empty texts have no words; items without words have no window; equal
    windows of several items count for each. Windows of items without item_id are hit, but name no item.
    Repeated rows are judged once and listed each; other columns are ignored.
    """
    with Temporary(docs.sparkSession) as tables:
        return tables.keep(_judged(docs, benchmark, window), "contamination")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    spark = docs.sparkSession
    run, schema = _windows(window)
    windows = materialize(benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(run, schema), "windows")
    shingles = windows.select("words", "len", F.explode("shingles").alias("s")).select("words", "len", "s.*")
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect())
    known = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    # at most as many rows as the filter has words of 64 bits
    for word, mask in (shingles.select(slot.alias("slot")).distinct()
                       .groupBy(F.shiftright("slot", 6).alias("word"))
                       .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("mask")).collect()):
        known[word] = np.uint64(mask & (2**64 - 1))
    run, schema = _passages(window, sizes or [SHINGLE], spark.sparkContext.broadcast(known))
    read = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", text_id().alias("text_id")).mapInArrow(run, schema), "passages")

    # equal rows have equal stretches; each is judged once
    own = materialize(read.where("passages IS NOT NULL").dropDuplicates(["doc_id", "words_hash"]).select(
        "doc_id", "words_hash", "n_words", F.explode("passages").alias("p")).select(
        F.xxhash64("doc_id", "words_hash", "p.start").alias("stretch"), "doc_id", "words_hash", "n_words", "p.*"), "stretches")
    spots = own.select("stretch", "start", "n_words", F.explode("hits").alias("h")).select(
        "stretch", "start", "n_words", F.col("h.hash").alias("hash"), F.col("h.at").alias("at"))
    often = spots.groupBy("hash").agg(F.count(F.lit(1)).alias("often"))

    # the rarest shingle of each window that has all its shingles somewhere
    distinct = shingles.select("words", "len", "hash", "off").distinct()
    prefix = (distinct.join(often, "hash", "left").groupBy("words", "len")
              .agg(F.min(F.coalesce("often", F.lit(0))).alias("rarest"),
                   F.min_by(F.struct("hash", "off"), F.struct("often", "hash", "off")).alias("p"))
              .where("rarest > 0").select(F.col("words").alias("window"), "len", "p.hash", "p.off"))
    prefix = materialize(prefix, "prefixes")
    side = F.broadcast(prefix) if prefix.count() <= MOST_BROADCAST else prefix
    placed = spots.join(side, "hash").withColumn("from", F.col("at") - F.col("off")).where(
        "from >= start AND from + len <= n_words").select("stretch", "from", "len", "window")
    # `words` has single spaces: a window stands there if the words between two places equal it
    known = own.select("stretch", "doc_id", "words_hash", "start", F.split("words", " ").alias("tokens"))
    same = F.array_join(F.slice("tokens", F.col("from") - F.col("start") + 1, F.col("len")), " ") == F.col("window")
    hits = materialize(placed.join(known, "stretch").where(same).select(
        "doc_id", "words_hash", "from", (F.col("from") + F.col("len")).alias("to"), "window").distinct(), "hits")

    doc = Window.partitionBy("doc_id", "words_hash").orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.groupBy("doc_id", "words_hash", "from").agg(F.max("to").alias("to"))
    covered = (spans.withColumn("seen", F.coalesce(F.max("to").over(doc), F.lit(0)))
               .groupBy("doc_id", "words_hash").agg(
                   F.sum(F.greatest(F.col("to") - F.greatest("from", "seen"), F.lit(0))).cast("long").alias("n_hit")))
    owners = windows.select(F.col("words").alias("window"), "item_id").distinct()
    items = (hits.select("doc_id", "words_hash", "window").distinct().join(owners, "window")
             .groupBy("doc_id", "words_hash")
             .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    named = items.select(F.col("doc_id").alias("_item_id"), F.col("words_hash").alias("_item_hash"), "items")
    judged = covered.join(named, F.col("doc_id").eqNullSafe(F.col("_item_id")) & (
        F.col("words_hash") == F.col("_item_hash"))).select(
        F.col("doc_id").alias("_id"), F.col("words_hash").alias("_hash"), "n_hit", "items")
    met = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("words_hash") == F.col("_hash"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return read.select("doc_id", "text_id", "n_words", "words_hash").join(judged, met, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "text_id")
