"""Language-model scoring with a hashed maximum-entropy model whose size follows the corpus.

A token's probability is P(class | history) * P(member | class, history) * P(token | cell). The first two are
softmax models over hashed features of the history: the word before, the last two words, and the word
before with the third word back (a skip). A word's class comes from its last two bytes; frequent words own a member
of their class, the others share the rest by hash, with smoothed counts inside. Classes and members grow
with the number of distinct words.

Every feature holds the word before, so tokens are dealt into shards by that word's hash and a shard keeps the
weights of its features alone: there are as many shards as the training tokens fill, each with SLOTS rows a
feature and model, and no weight leaves its shard. A word before so many tokens that they would fill a good part
of a shard is dealt over several by document, each with weights of its own. Tokens travel as compressed arrays of slots, not as
rows. A shard puts its training tokens into an order of their own, by a hash of what they hold, takes
gradient steps over batches of them, and then scores all its tokens in sparse numpy batches; sums per document
come back. So the scores depend on the table alone, not on how it is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise.llm import words as W
from wardwise.llm.rows import spread_join
from wardwise.session import Temporary, materialize

#: Rows of weights a feature and model in each shard, and the training tokens that ask for one more shard.
SLOT_BITS, SHARD_TOKENS = 16, 1 << 21
SLOTS = 1 << SLOT_BITS
HOT_TOKENS = SHARD_TOKENS >> 2
TEMPLATES = 3
#: Counts of so many frequent words travel with the tasks (some 12 MB); the others are joined by shuffle.
FREQUENT = 1 << 19
BATCH, RATE, START_SUM = 4096, 0.35, 0.5
#: Texts of so many bytes share one array per shard; sums of so many documents and shards are held at a time.
BLOCK, MOST_SUMS = 1 << 22, 1 << 21
END, START = np.uint64(0x6A09E667F3BCC908), np.uint64(0xBB67AE8584CAA73B)
_SALTS = [np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC949D7C7509E6557, 0xFF51AFD7ED558CCD)]


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words, tokens with an end after each text, each token's place in its text, its last two bytes)."""
    w = W.Words(buf, offsets, W.NOT_SPACE, W.FOLDED)
    tokens = np.insert(w.hashes, w.first[1:], END)
    sizes = w.counts + 1
    place = np.arange(tokens.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    last = W._FOLD[buf[w.ends - 1]] if w.ends.size else np.zeros(0, int)
    before = np.where(w.ends - w.starts > 1, W._FOLD[buf[np.maximum(w.ends - 2, 0)]], 0) if w.ends.size else last
    return w, tokens, place, np.insert(before * 256 + last, w.first[1:], 1 << 16)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []

    def flush():
        keys, first, back = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        n = np.bincount(back, np.concatenate([h[1] for h in held])).astype(np.int64)
        tails = np.concatenate([h[2] for h in held])[first]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(W.signed(keys)), pa.array(n), pa.array(tails, pa.int32())], ["token", "n", "tail"])

    for _, buf, offsets in W.pieces(batches):
        _, tokens, _, tails = _tokens(buf, offsets)
        keys, first, n = np.unique(tokens, return_index=True, return_counts=True)
        held.append((keys, n, tails[first]))
        if len(held) == 16:
            yield flush()
    if held:
        yield flush()


@dataclass
class Cells:
    """Classes and members of words: the frequent words' own cells, and the counts of all cells."""

    side: int
    keys: np.ndarray
    n: np.ndarray
    cell: np.ndarray
    mass: np.ndarray
    #: Words that many tokens follow, and over how many shards these go.
    hot: np.ndarray
    parts: np.ndarray

    @classmethod
    def shared(cls, side: int, tokens: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """The shared cell of a token: class by its last bytes, member among the upper half by hash."""
        classes = W.mix(tails.astype(np.uint64) + np.uint64(17)) % np.uint64(side)
        members = np.uint64(side // 2) + (W.mix(tokens) >> np.uint64(40)) % np.uint64(side // 2)
        return (classes * np.uint64(side) + members).astype(np.int64)

    def look_up(self, tokens: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index among the frequent words or -1, cell)."""
        out = self.shared(self.side, tokens, tails)
        if not self.keys.size:
            return np.full(tokens.size, -1), out
        at = np.searchsorted(self.keys, tokens)
        at[at == self.keys.size] = 0
        known = self.keys[at] == tokens
        return np.where(known, at, -1), np.where(known, self.cell[at], out)


@dataclass
class Counts:
    """Token counts of the training documents: whole table, totals, and the cells."""

    table: DataFrame
    total: int
    distinct: int
    cells: Cells


def classes_for(distinct: int) -> int:
    """Classes, and members of each: a power of two that grows as the fifth root of the distinct words."""
    return max(8, 1 << round(np.log2(max(distinct, 2)) / 5))


def _masses(side: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(side * side)
        for b in batches:
            cell = Cells.shared(side, b.column("token").to_numpy().view(np.uint64), b.column("tail").to_numpy().astype(np.int64))
            total += np.bincount(cell, b.column("n").to_numpy() + 0.5, side * side)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(side * side)), pa.array(total)], ["cell", "mass"])

    return run


def count_tokens(docs: DataFrame) -> Counts:
    table = materialize(docs.where(~held_out(F.col("doc_id"))).select("text").mapInArrow(_count, "token long, n long, tail int")
                        .groupBy("token").agg(F.sum("n").alias("n"), F.first("tail").alias("tail")), "counts")
    total, distinct = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    side = classes_for(distinct)
    top = table.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    keys, n, tails = top["token"].to_numpy().view(np.uint64), top["n"].to_numpy().astype(np.int64), top["tail"].to_numpy().astype(np.int64)
    cell = Cells.shared(side, keys, tails)
    mass = np.full(side * side, 0.5)
    # as many rows as there are cells
    for c, m in table.select("token", "n", "tail").mapInArrow(_masses(side), "cell long, mass double").groupBy("cell").agg(F.sum("mass")).collect():
        mass[c] += m
    # the most frequent words own the lower members of their classes
    free = np.zeros(side, int)
    for i in range(min(keys.size, 8 * side * side)):
        c = cell[i] // side
        if free[c] < side // 2:
            mass[cell[i]] -= n[i] + 0.5
            cell[i] = c * side + free[c]
            mass[cell[i]] += n[i] + 0.5
            free[c] += 1
    # a text starts where another ends
    many = n > HOT_TOKENS
    hot = np.where(keys[many] == END, START, keys[many])
    parts, by_key = n[many] // HOT_TOKENS + 1, np.argsort(hot)
    order = np.argsort(keys)
    return Counts(table, total, distinct, Cells(side, keys[order], n[order], cell[order], mass, hot[by_key], parts[by_key]))


# --- tokens into shards -----------------------------------------------------------------------

def _slots(tokens: np.ndarray, place: np.ndarray, keys: np.ndarray, cells: Cells, n_shards: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(shard, slot of each template): the word before; it and the second; it and the third word back. keys
    are the documents' of the tokens."""
    def back(s: int) -> np.ndarray:
        out = np.full(tokens.size, START)
        if s < tokens.size:
            out[s:] = tokens[:-s]
        out[place < s] = START
        return out

    one, two, three = back(1), back(2), back(3)
    shard = W.mix(one) >> np.uint64(32)
    if cells.hot.size:
        at = np.minimum(np.searchsorted(cells.hot, one), cells.hot.size - 1)
        parts = np.where(cells.hot[at] == one, cells.parts[at], 1).astype(np.uint64)
        shard = shard + (W.mix(keys.astype(np.uint64)) >> np.uint64(20)) % parts
    shard %= np.uint64(n_shards)
    keys = [W.mix(one ^ _SALTS[0]), W.mix(W.mix(one) + two * _SALTS[1]), W.mix(W.mix(one) + three * _SALTS[2])]
    return shard.astype(np.int64), [(k >> np.uint64(64 - SLOT_BITS)).astype(np.uint16) for k in keys]


_EVENTS = "shard int, block long, docs binary, counts binary, slots binary, cells binary"
_CODEC = "zstd"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays byte by byte, low bytes together, compressed; the size before compression comes first."""
    raw = b"".join(a.view(np.uint8).reshape(a.size, -1).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, _CODEC, asbytes=True)


def _unpack(data: bytes, kind, n: int, k: int) -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), _CODEC, asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.reshape(size, n).T).reshape(-1).view(kind) for p in raw.reshape(k, -1)] if n else [np.zeros(0, kind)] * k


def _deal(sent, n_shards: int):
    """Per block of texts and shard one row: the documents with tokens there, how many each, and the tokens."""
    names = ["shard", "block", "docs", "counts", "slots", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = sent.value
        for rows, buf, offsets in W.pieces(batches, limit=BLOCK):
            w, tokens, place, tails = _tokens(buf, offsets)
            doc = np.repeat(np.arange(len(rows)), w.counts + 1)
            keys = (rows.column("key").to_numpy() << 1) | rows.column("held").to_numpy(zero_copy_only=False).astype(np.int64)
            _, cell = cells.look_up(tokens, tails)
            block = int(W.signed(W.mix(keys.view(np.uint64)).sum(keepdims=True))[0])
            shard, slots = _slots(tokens, place, keys[doc], cells, n_shards)
            order = np.argsort((shard.astype(np.uint64) << np.uint64(44)) | (doc.astype(np.uint64) << np.uint64(16)) | slots[0])
            shard, doc, cell = shard[order], doc[order], cell[order].astype(np.uint32)
            slots = [s[order] for s in slots]
            bounds = np.searchsorted(shard, np.arange(n_shards + 1))
            out = []
            for s in range(n_shards):
                a, b = bounds[s], bounds[s + 1]
                if a < b:
                    some, counts = np.unique(doc[a:b], return_counts=True)
                    out.append((s, block, keys[some].tobytes(), _pack(counts.astype(np.uint32)), _pack(*(x[a:b] for x in slots)), _pack(cell[a:b])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), *[pa.binary()] * 4))], names)

    return run


# --- the model of a shard ---------------------------------------------------------------------

def _highest(z: np.ndarray) -> np.ndarray:
    """The greatest value of every row, column by column: rows are short, and a reduction over each is slow."""
    out = z[:, 0].copy()
    for j in range(1, z.shape[1]):
        np.maximum(out, z[:, j], out=out)
    return out[:, None]


class Shard:
    """Weights of the class model and of the member model, a row per slot and template."""

    def __init__(self, cells: Cells, batch: int = BATCH):
        side = self.side = cells.side
        self.batch = batch
        self.weights = [np.zeros((TEMPLATES * SLOTS, side), np.float32) for _ in range(2)]
        self.seen = [np.full(TEMPLATES * SLOTS, START_SUM, np.float32) for _ in range(2)]
        share = cells.mass.reshape(side, side)
        self.classes = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
        self.members = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)

    def rows(self, slots: list[np.ndarray], cls: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Rows of weights for the class and for the member, whose features hold the class."""
        by_class = [s.astype(np.int64) + i * SLOTS for i, s in enumerate(slots)]
        turn = cls * 40503 + 12345
        return by_class, [((s + turn) & (SLOTS - 1)) + i * SLOTS for i, s in enumerate(slots)]

    def forward(self, slots: list[np.ndarray], cls: np.ndarray) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """(rows, log probabilities of all outcomes) of both models."""
        out = []
        for rows, weights, base in zip(self.rows(slots, cls), self.weights, (self.classes, self.members[cls])):
            z = base + weights.take(rows[0], axis=0)
            for r in rows[1:]:
                z += weights.take(r, axis=0)
            z -= _highest(z)
            z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
            out.append((rows, z))
        return out

    def step(self, slots: list[np.ndarray], cell: np.ndarray) -> None:
        """One step on a batch: per row the sum of its errors, by a rate that falls with what the row has seen."""
        cls, member = cell // self.side, cell % self.side
        for (rows, logs), target, weights, seen in zip(self.forward(slots, cls), (cls, member), self.weights, self.seen):
            error = -np.exp(logs)
            error[np.arange(target.size), target] += 1
            for r in rows:
                # rows of one template differ in their slots only, and 16 bits are sorted by radix
                order = np.argsort(r.astype(np.uint16), kind="stable")
                ordered = r[order]
                first = np.flatnonzero(np.diff(ordered, prepend=-1))
                total = np.add.reduceat(error.take(order, axis=0), first, axis=0)
                at = ordered[first]
                seen[at] += (total * total).sum(axis=1)
                weights[at] += RATE * total / np.sqrt(seen[at])[:, None]

    def train(self, slots: list[np.ndarray], cell: np.ndarray) -> None:
        """Batches in an order that only what the tokens hold decides."""
        held = sum((s.astype(np.uint64) << np.uint64(SLOT_BITS * i) for i, s in enumerate(slots)), np.zeros(cell.size, np.uint64))
        order = np.argsort(W.mix(held ^ W.mix(cell.astype(np.uint64))), kind="stable")
        for lo in range(0, cell.size, self.batch):
            at = order[lo:lo + self.batch]
            self.step([s[at] for s in slots], cell[at])

    def log10(self, slots: list[np.ndarray], cell: np.ndarray) -> np.ndarray:
        """log10 of the cell's probability."""
        out = np.empty(cell.size)
        for lo in range(0, cell.size, BATCH):
            c = cell[lo:lo + BATCH]
            cls, member = c // self.side, c % self.side
            (_, a), (_, b) = self.forward([s[lo:lo + BATCH] for s in slots], cls)
            each = np.arange(c.size)
            out[lo:lo + BATCH] = (a[each, cls] + b[each, member]).astype(float) / np.log(10)
        return out


def _model(sent, size: int):
    """Per shard: train on its tokens of training documents; then per block the sum of each document's tokens."""
    names = ["block", "docs", "sums"]

    def finished(cells: Cells, held: list[tuple]) -> pa.RecordBatch:
        learns = [np.repeat(keys & 1 == 0, counts) for _, keys, counts, _, _ in held]
        model = Shard(cells, size)
        model.train([np.concatenate([h[3][i][at] for h, at in zip(held, learns)]) for i in range(TEMPLATES)],
                    np.concatenate([h[4][at] for h, at in zip(held, learns)]).astype(np.int64))
        out = []
        for block, keys, counts, slots, cell in held:
            first = np.cumsum(counts) - counts
            out.append((block, (keys >> 1).tobytes(), np.add.reduceat(model.log10(slots, cell.astype(np.int64)), first).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one shard to a task
        cells, held = sent.value, {}
        for batch in batches:
            for shard, block, docs, counts, slots, cell in zip(*(batch.column(c) for c in ("shard", "block", "docs", "counts", "slots", "cells"))):
                keys = np.frombuffer(docs.as_py(), np.int64)
                counts = _unpack(counts.as_py(), np.uint32, keys.size, 1)[0].astype(np.int64)
                n = int(counts.sum())
                held.setdefault(shard.as_py(), []).append((
                    block.as_py(), keys, counts, _unpack(slots.as_py(), np.uint16, n, TEMPLATES), _unpack(cell.as_py(), np.uint32, n, 1)[0].astype(np.uint16)))
        for shard in sorted(held):
            yield finished(cells, held.pop(shard))

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over all shards of the documents of some blocks; at most MOST_SUMS parts are held at a time."""
    held, size = [], 0

    def compact():
        keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(back, np.concatenate([v for _, v in held]))

    for batch in batches:
        for docs, sums in zip(batch.column("docs"), batch.column("sums")):
            held.append((np.frombuffer(docs.as_py(), np.int64), np.frombuffer(sums.as_py(), np.float64)))
            size += held[-1][0].size
            if size > MOST_SUMS:
                held[:] = [compact()]
                size = 0
    if held:
        keys, sums = compact()
        for lo in range(0, keys.size, 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[lo:lo + (1 << 16)]), pa.array(sums[lo:lo + (1 << 16)])], ["key", "log10"])


# --- documents --------------------------------------------------------------------------------

def _read(sent):
    """Per document its tokens, and what needs no model: log counts of frequent words and log masses of cells."""
    schema = "doc_id long, key long, n_tokens long, n_known long, log_counts double, log_mass double, rare array<long>"

    def run(batches: Iterator[pa.RecordBatch]):
        cells = sent.value
        mass = np.log10(cells.mass)
        for rows, buf, offsets in W.pieces(batches):
            w, tokens, _, tails = _tokens(buf, offsets)
            at, cell = cells.look_up(tokens, tails)
            bounds = w.first + np.arange(w.first.size)
            log_n = np.where(at >= 0, np.log10(cells.n[at] + 0.5) if cells.n.size else 0.0, 0.0)
            rare = at < 0
            rare_bounds = np.concatenate([[0], np.cumsum(rare)])[bounds]
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), rows.column("key"), pa.array(np.diff(bounds), pa.int64()),
                pa.array(np.diff(bounds) - np.diff(rare_bounds), pa.int64()),
                pa.array(np.add.reduceat(log_n, bounds[:-1])), pa.array(np.add.reduceat(mass[cell], bounds[:-1])),
                W.listed(W.signed(tokens[rare]), rare_bounds, pa.int64())],
                ["doc_id", "key", "n_tokens", "n_known", "log_counts", "log_mass", "rare"])

    return run, schema


def score(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the whole text, A-Z in lower case, and one end. base_score is the smoothed unigram
    log10 probability, score the model's. A null text is empty and has the end only; a null doc_id learns.
    Repeated rows learn as often as they stand and score alike; other columns are ignored. Without training
    documents every token is unknown.
    """
    with Temporary(docs.sparkSession) as tables:
        return tables.keep(_scored(docs), "scores")


def _scored(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = count_tokens(texts)
    cells = spark.sparkContext.broadcast(counts.cells)
    # equal rows have one key, of 62 bits, and equal scores
    key = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))), 2)
    keyed = texts.withColumns({"key": key, "held": held_out(F.col("doc_id"))})
    run, schema = _read(cells)
    read = materialize(keyed.select("doc_id", "key", "text").mapInArrow(run, schema), "read")

    n_shards = counts.total // SHARD_TOKENS + 8
    dealt = keyed.select("key", "held", "text").mapInArrow(_deal(cells, n_shards), _EVENTS)
    dealt = dealt.repartitionById(n_shards, F.col("shard"))
    sums = dealt.mapInArrow(_model(cells, BATCH), "block long, docs binary, sums binary").repartition("block")
    modelled = sums.select("docs", "sums").mapInArrow(_summed, "key long, log10 double").groupBy(F.col("key").alias("_key")).agg(F.sum("log10").alias("log10"))
    # rare words: counts by shuffle
    once = materialize(read.groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "once")
    rare = (read.where("size(rare) > 0").select("key", F.explode("rare").alias("token"))
            .join(counts.table.select("token", "n"), "token", "left").groupBy(F.col("key").alias("_rare"))
            .agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_logs"), F.count("n").alias("rare_known")))
    label = once.select("key", "copies").join(modelled, F.col("key") == F.col("_key")).join(rare, F.col("key") == F.col("_rare"), "left")
    label = materialize(label.select("key", (F.col("log10") / F.col("copies")).alias("log10"),
                         F.coalesce(F.col("rare_logs") / F.col("copies"), F.lit(0.0)).alias("rare_logs"),
                         F.coalesce((F.col("rare_known") / F.col("copies")).cast("long"), F.lit(0)).alias("rare_known")), "label")
    logs = F.col("log_counts") + F.col("rare_logs")
    unit = float(np.log10(counts.total + 0.5 * (counts.distinct + 1)))
    met = spread_join(read.drop("rare"), label, ["key"], once.select("key", F.col("copies").alias("n")))
    return met.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (logs - F.col("log_mass") + F.col("log10")).alias("score"))
