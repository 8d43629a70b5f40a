"""Prefix trie of conversations over a splitter skeleton.

A conversation becomes a path: 24 bytes a turn, the first half of the sha256 of role and text and the
text's byte count, so paths sort like sequences of turns. Splitter paths cut the sorted conversations into
shards of about equal work. A node whose members lie in several shards is a prefix of a splitter, so the trie
of the splitter paths, the skeleton, is broadcast, and every shard, sorted, finishes all other nodes on its
own in one pass over its rows. Of the skeleton's nodes it gives partial aggregates, which are reduced over
the shards and then summed up the skeleton. Shards are cut by (path, conv_id), so copies of one
conversation, however many, are spread over shards too.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwise.session import Temporary, materialize

TURN = 24
SHARED, HEAD = 5, 9
#: Turns of a shard; shards are as many as the session's shuffle partitions, or more, up to MOST_SHARDS.
SHARD_TURNS, MOST_SHARDS = 1 << 17, 1 << 14
#: Splitters are quantiles of so many candidates a shard, whose paths have so many bytes at most.
CANDIDATES, CANDIDATE_BYTES = 4, 1 << 23
#: Ids of a skeleton node's ends in one row.
CHUNK = 512
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_record(role: Column, text: Column) -> Column:
    """48 hex digits: 16 bytes of the sha256 of the turn, 8 of its text's byte count."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.lower(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))


def paths(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, path) of conversations (conv_id, turn, role, text), turns in order, null first.

    Turns of equal number go by digest. Null roles and texts are empty; repeated rows are turns of their own; rows
    without conv_id belong to no conversation. A path is one value: 24 bytes a turn.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_record(F.col("role"), F.col("text")).alias("record"))
    # linear in the turns: hex is joined once
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "record"))).alias("t")).select(
        "conv_id", F.unhex(F.array_join(F.col("t.record"), "")).alias("path"))


def rebuild(own: DataFrame) -> DataFrame:
    """Paths whose first h turns are those of conversation c - c % 5; h is crc32 of the decimal c, mod 9."""
    c = F.col("conv_id")
    heads = own.select(c.alias("_base"), F.substring("path", 1, TURN * (HEAD - 1)).alias("_head")).where(F.col("_base") % SHARED == 0)
    h = (F.crc32(c.cast("string").cast("binary")) % HEAD).cast("int")
    return own.join(heads, c - c % SHARED == F.col("_base"), "left").select(
        "conv_id", F.concat(F.substring(F.coalesce("_head", F.lit(b"")), F.lit(1), TURN * h),
                            F.substring("path", TURN * h + 1, F.octet_length("path"))).alias("path"))


@dataclass
class Skeleton:
    """The trie of the splitters: node 0 is the root, parents come before children."""

    splitters: list[tuple[bytes, int]]
    child: dict[tuple[int, bytes], int]
    parent: list[int]
    depth: list[int]
    size: list[int]


def skeleton(rebuilt: DataFrame) -> Skeleton:
    spark = rebuilt.sparkSession
    weight = F.octet_length("path") / TURN + 1
    n, total = rebuilt.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0.0))).first()
    n_shards = min(MOST_SHARDS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total // SHARD_TURNS) + 1))
    out = Skeleton([], {}, [-1], [0], [0])
    if not n:
        return out
    # about CANDIDATES * n_shards conversations, by hash of their ids, which differ
    key = F.shiftrightunsigned(F.xxhash64("conv_id"), 12)
    share = min(1.0, CANDIDATES * n_shards / n)
    drawn = rebuilt.where(key <= int(share * (1 << 52))).select(key.alias("key"), "conv_id", "path")
    drawn = materialize(drawn, "candidates")
    sizes, last, held = drawn.select("key", F.octet_length("path").alias("bytes")).orderBy("key").toArrow(), -1, 0
    for k, b in zip(sizes["key"].to_pylist(), sizes["bytes"].to_pylist()):
        held += b
        if held > CANDIDATE_BYTES:
            break
        last = k
    found = sorted((bytes(r.path), r.conv_id) for r in drawn.where(F.col("key") <= last).select("path", "conv_id").toLocalIterator())
    load, whole, cut = 0, sum(len(p) // TURN + 1 for p, _ in found), 1
    for path, conv in found:
        if load * n_shards >= cut * whole:
            out.splitters.append((path, conv))
            cut = load * n_shards // whole + 1
        load += len(path) // TURN + 1
    for path, _ in out.splitters:
        node = 0
        for i in range(0, len(path), TURN):
            record = path[i:i + TURN]
            at = out.child.get((node, record))
            if at is None:
                at = out.child[node, record] = len(out.parent)
                out.parent.append(node)
                out.depth.append(out.depth[node] + 1)
                out.size.append(int.from_bytes(record[16:], "big"))
            node = at
    return out


def _assign(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = sent.value.splitters
        for batch in batches:
            shard = [bisect_right(splitters, (p.as_py(), c.as_py())) for p, c in zip(batch.column("path"), batch.column("conv_id"))]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    return run


_ROW = pa.schema([
    ("skel", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_skel", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("first", pa.int64()), ("ids", pa.binary())])
_ROW_SQL = ("skel long, conv_id long, depth long, parent_conv_id long, parent_skel long, n_convs long, n_children long, "
            "n_leaves long, saved_tokens long, ends_sha256 string, first long, ids binary")


class _Node:
    """An open node on the path of the current row; sums are over its closed children and its own ends."""

    __slots__ = ("record", "skel", "conv", "convs", "children", "leaves", "saved", "ends", "held")

    def __init__(self, record: bytes, skel: int):
        self.record, self.skel = record, skel
        self.conv, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends = [] if skel >= 0 else None
        self.held: list[tuple] = []

    def member(self, conv: int, n: int = 1) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.convs += n


def _finish(sent):
    """One pass over sorted paths: rows of finished nodes, partial aggregates and ends of skeleton nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        child, out = sent.value.child, []
        stack = [_Node(b"", 0)]

        def ends(node: _Node) -> None:
            if node.ends:
                out.append((node.skel, *(None,) * 9, node.ends[0], ",".join(map(str, node.ends)).encode()))
                node.ends = []

        def close() -> None:
            node = stack.pop()
            if node.skel >= 0:
                ends(node)
                out.append((node.skel, node.conv, None, None, None, node.convs, node.children, node.leaves, node.saved, None, None, None))
                return
            above, depth = stack[-1], len(stack)
            for held in node.held:
                out.append((None, held[0], depth + 1, node.conv, None, *held[1:], None, None))
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.convs - 1) * int.from_bytes(node.record[16:], "big")
            row = (node.conv, node.convs, node.children, leaves, saved, node.ends.hexdigest() if node.ends else _NO_ENDS)
            if above.skel >= 0:
                out.append((None, row[0], depth, None, above.skel, *row[1:], None, None))
            else:
                above.held.append(row)
            above.member(node.conv, node.convs)
            above.children += 1
            above.leaves += leaves
            above.saved += saved

        for batch in batches:
            for path, conv in zip(batch.column("path"), batch.column("conv_id").to_pylist()):
                path = path.as_py()
                n = len(path) // TURN
                same = 0
                while same < n and same + 1 < len(stack) and stack[same + 1].record == path[TURN * same:TURN * same + TURN]:
                    same += 1
                while len(stack) > same + 1:
                    close()
                for i in range(same, n):
                    record, above = path[TURN * i:TURN * i + TURN], stack[-1].skel
                    stack.append(_Node(record, child.get((above, record), -1) if above >= 0 else -1))
                node = stack[-1]
                node.member(conv)
                if node.skel >= 0:
                    node.ends.append(conv)
                    if len(node.ends) == CHUNK:
                        ends(node)
                elif node.ends is None:
                    node.ends = hashlib.sha256(str(conv).encode())
                else:
                    node.ends.update(f",{conv}".encode())
                if len(out) >= 4096:
                    yield _batch(out)
        while stack:
            close()
            if len(out) >= 4096:
                yield _batch(out)
        yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ROW)
    out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW)], schema=_ROW)
    rows.clear()
    return out


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each skeleton node's ids, from rows in order; one row is held."""
    now, digest = None, None
    names = ["_ends_skel", "ends_sha256"]
    done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], names)
    for batch in batches:
        for skel, ids in zip(batch.column("skel").to_pylist(), batch.column("ids")):
            if skel != now:
                if digest is not None:
                    yield done()
                now, digest = skel, hashlib.sha256(ids.as_buffer())
            else:
                digest.update(b",")
                digest.update(ids.as_buffer())
    if digest is not None:
        yield done()


def _reduced(spark: SparkSession, frame: Skeleton, parts: DataFrame) -> DataFrame:
    """The skeleton's nodes; as many rows as the skeleton has are gathered and summed up from the leaves."""
    size = len(frame.parent)
    convs, children, leaves, saved = ([0] * size for _ in range(4))
    conv: list[int | None] = [None] * size
    sums = [F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    for s, low, *rest in parts.groupBy("skel").agg(F.min("conv_id"), *sums).collect():
        conv[s], (convs[s], children[s], leaves[s], saved[s]) = low, rest
    for s in range(size - 1, -1, -1):
        leaves[s] = leaves[s] if children[s] else 1
        saved[s] += (convs[s] - 1) * frame.size[s]
        p = frame.parent[s]
        if p >= 0:
            conv[p] = min(x for x in (conv[p], conv[s]) if x is not None)
            convs[p] += convs[s]
            children[p] += 1
            leaves[p] += leaves[s]
            saved[p] += saved[s]
    above = [conv[p] if p >= 0 else None for p in frame.parent]
    table = pa.table({"skel": pa.array(range(size), pa.int64()), "conv_id": pa.array(conv, pa.int64()), "depth": pa.array(frame.depth, pa.int64()),
                      "parent_conv_id": pa.array(above, pa.int64()), "n_convs": pa.array(convs, pa.int64()), "n_children": pa.array(children, pa.int64()),
                      "n_leaves": pa.array(leaves, pa.int64()), "saved_tokens": pa.array(saved, pa.int64())})
    return spark.createDataFrame(table)


_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rebuilt: DataFrame) -> DataFrame:
    """One row per node of the trie of paths (conv_id, path), conv_id unique; see prefix_trie."""
    spark = rebuilt.sparkSession
    frame = skeleton(rebuilt)
    sent = spark.sparkContext.broadcast(frame)
    dealt = rebuilt.mapInArrow(_assign(sent), "shard int, conv_id long, path binary")
    dealt = dealt.repartitionById(len(frame.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    rows = materialize(dealt.mapInArrow(_finish(sent), _ROW_SQL), "nodes")
    parts = rows.where("skel IS NOT NULL AND ids IS NULL AND conv_id IS NOT NULL")
    if parts.isEmpty():
        return rows.where("false").select(_RESULT)
    kept = materialize(_reduced(spark, frame, parts), "skeleton")
    ends = rows.where("ids IS NOT NULL").select("skel", "first", "ids").repartition("skel").sortWithinPartitions("skel", "first").mapInArrow(
        _hash_ends, "_ends_skel long, ends_sha256 string")
    # the skeleton has CANDIDATE_BYTES / TURN nodes at most
    top = kept.join(ends, F.col("skel") == F.col("_ends_skel"), "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    over = F.broadcast(kept.select(F.col("skel").alias("_skel"), F.col("conv_id").alias("_over")))
    local = rows.where("skel IS NULL").join(over, F.col("parent_skel") == F.col("_skel"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_over"))
    return local.select(_RESULT).unionByName(top.select(_RESULT))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations, the empty one included:
    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Other columns are ignored; see paths for nulls, ties and repeated rows. An empty table has no nodes, not even
    a root. A task holds the open nodes of one path and the direct children of those that are not in the
    skeleton. The digest of a node's ends is a sequence by its nature: one task streams over the node's
    ids, CHUNK a row.
    """
    with Temporary(conversations.sparkSession) as tables:
        own = materialize(paths(conversations), "paths")
        return tables.keep(trie(materialize(rebuild(own), "rebuilt")), "trie")
