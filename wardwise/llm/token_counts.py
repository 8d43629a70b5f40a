"""Edit-aware token counts over pre-token segment trees.

Each document keeps the length and token count of its pre-tokens in blocks, with a segment tree of sums over
the blocks. An edit replaces a range of code points: the tree finds the block, the text is cut into pre-tokens
again from a boundary before the edit until a cut meets an old one after it, only those pre-tokens are
encoded, and the sums on the blocks' paths are updated.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardwise.llm import words as W

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pre-token pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points before a pre-token's end that an edit must not touch for it to stay as it is.
CONTEXT = 3
BLOCK = 64
MOST_REMEMBERED = 500_000


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """The vocabulary file, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Counter:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken

        self.cut = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def count(self, tokens: list[str]) -> list[int]:
        known = self.known
        if len(known) > MOST_REMEMBERED:
            known.clear()
        for t in tokens:
            if t not in known:
                known[t] = len(self.encoding.encode_ordinary(t))
        return [known[t] for t in tokens]


class Tree:
    """Sums of lengths and counts over blocks of pre-tokens, as an array tree with node 1 on top."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        self._build([lengths[i:i + BLOCK] for i in range(0, lengths.size, BLOCK)] or [lengths],
                    [counts[i:i + BLOCK] for i in range(0, counts.size, BLOCK)] or [counts])

    def _build(self, lengths: list[np.ndarray], counts: list[np.ndarray]):
        self.lengths, self.counts = lengths, counts
        self.size = 1 << max(0, (len(lengths) - 1).bit_length())
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        for i, (a, b) in enumerate(zip(lengths, counts)):
            self.sums[self.size + i] = a.sum(), b.sum()
        for i in range(self.size - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """(block, code points before it) of the block that holds place `at`, or the last one."""
        node, before = 1, 0
        while node < self.size:
            left = int(self.sums[2 * node, 0])
            node, before = (2 * node, before) if at < before + left else (2 * node + 1, before + left)
        block = min(node - self.size, len(self.lengths) - 1)
        return block, before if block == node - self.size else self.chars - int(self.lengths[block].sum())

    def replace(self, first: int, last: int, lengths: np.ndarray, counts: np.ndarray):
        """Blocks first..last become the given pre-tokens; with as many blocks only their paths change."""
        n = last - first + 1
        if 0 < lengths.size <= 2 * BLOCK * n and lengths.size >= n:
            for i, (a, b) in enumerate(zip(np.array_split(lengths, n), np.array_split(counts, n)), first):
                self.lengths[i], self.counts[i] = a, b
                node = self.size + i
                self.sums[node] = a.sum(), b.sum()
                while node > 1:
                    node //= 2
                    self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
        else:
            parts = range(0, lengths.size, BLOCK)
            self._build([*self.lengths[:first], *(lengths[i:i + BLOCK] for i in parts), *self.lengths[last + 1:]] or [lengths],
                        [*self.counts[:first], *(counts[i:i + BLOCK] for i in parts), *self.counts[last + 1:]] or [counts])


def apply_edit(tree: Tree, text: str, start: int, end: int, put: str, counter: Counter) -> tuple[str, int]:
    """(text after the edit, pre-tokens encoded). Places outside the text are moved to its ends."""
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    new, shift = text[:start] + put + text[end:], len(put) - (end - start)
    # the first block in which a pre-token ends near the edit, and the pre-token that starts there
    first, at = tree.find(max(start - CONTEXT, 0))
    if first and at > start - CONTEXT:
        first -= 1
        at -= int(tree.lengths[first].sum())
    ends = at + np.cumsum(tree.lengths[first])
    keep = int(np.searchsorted(ends, start - CONTEXT, "right"))
    begin = at + int(tree.lengths[first][:keep].sum())
    # cut again until a cut falls on an old one behind the edit
    last, behind = first, at + int(tree.lengths[first].sum())
    while behind <= end and last + 1 < len(tree.lengths):
        last += 1
        behind += int(tree.lengths[last].sum())
    found, pos = [], begin
    block_ends = np.concatenate([[at], at + np.cumsum(np.concatenate(tree.lengths[first:last + 1]))])
    old = set(block_ends[block_ends >= end].tolist())
    for m in counter.cut.finditer(new, begin):
        if pos - shift in old and pos >= start + len(put):
            break
        while pos - shift >= behind and last + 1 < len(tree.lengths):
            last += 1
            more = behind + np.cumsum(tree.lengths[last])
            old.update(more.tolist())
            behind = int(more[-1]) if more.size else behind
            if pos - shift in old and pos >= start + len(put):
                break
        if pos - shift in old and pos >= start + len(put):
            break
        found.append(m.group())
        pos = m.end()
    lengths = np.concatenate(tree.lengths[first:last + 1])
    counts = np.concatenate(tree.counts[first:last + 1])
    rest = int(np.searchsorted(at + np.cumsum(lengths), pos - shift, "right")) if pos < len(new) else lengths.size
    tree.replace(first, last, np.concatenate([lengths[:keep], np.array([len(t) for t in found], np.int64), lengths[rest:]]),
                 np.concatenate([counts[:keep], np.array(counter.count(found), np.int64), counts[rest:]]))
    return new, len(found)


def _rows(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, size) for at in range(0, batch.num_rows, size))


def _built(ranks):
    def run(batches: Iterator[pa.RecordBatch]):
        counter = Counter(ranks.value)
        for rows, buf, offsets in W.pieces(batches):
            whole = buf.tobytes()
            cut = [counter.cut.findall(whole[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            flat = [t for c in cut for t in c]
            bounds = np.concatenate([[0], np.cumsum([len(c) for c in cut])])
            counts = np.array(counter.count(flat), np.int64)
            sums = np.concatenate([[0], np.cumsum(counts)])[bounds]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, W.listed(np.array([len(t) for t in flat], np.int32), bounds, pa.int32()),
                 W.listed(counts.astype(np.int32), bounds, pa.int32()), pa.array(np.diff(sums), pa.int64())],
                [*rows.schema.names, "leaf_chars", "leaf_tokens", "n_tokens"])

    return run


def build_trees(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """docs with the leaves of their trees (leaf_chars, leaf_tokens) and n_tokens, the top's sum.
    A null text is empty and has no leaves; columns of these names are replaced."""
    docs = docs.drop("leaf_chars", "leaf_tokens", "n_tokens")
    leaves = T.ArrayType(T.IntegerType())
    schema = T.StructType([*docs.schema, T.StructField("leaf_chars", leaves), T.StructField("leaf_tokens", leaves),
                           T.StructField("n_tokens", T.LongType())])
    return docs.mapInArrow(_built(docs.sparkSession.sparkContext.broadcast(ranks)), schema)


def _edited(ranks, edits: str):
    def run(batches: Iterator[pa.RecordBatch]):
        counter = Counter(ranks.value)
        for batch in batches:
            for rows in _rows(batch):
                out = {"text": [], "leaf_chars": [], "leaf_tokens": [], "n_tokens": [], "n_encoded": []}
                for text, lengths, counts, todo in zip(*(rows.column(c) for c in ("text", "leaf_chars", "leaf_tokens", edits))):
                    given, text, encoded = text.as_py(), text.as_py() or "", 0
                    tree = Tree(*(np.array(x.values.to_numpy() if x.is_valid else [], np.int64) for x in (lengths, counts)))
                    for e in todo.as_py() or ():
                        text, n = apply_edit(tree, text, e["start"], e["end"], e["text"] or "", counter)
                        encoded += n
                    out["text"].append(text if todo.is_valid or given is not None else None)
                    out["leaf_chars"].append(np.concatenate(tree.lengths).astype(np.int32))
                    out["leaf_tokens"].append(np.concatenate(tree.counts).astype(np.int32))
                    out["n_tokens"].append(tree.tokens)
                    out["n_encoded"].append(encoded)
                kinds = {"text": pa.string(), "n_tokens": pa.int64(), "n_encoded": pa.int64()}
                names = [n for n in rows.schema.names if n != edits and n != "n_encoded"] + ["n_encoded"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[n], kinds.get(n, pa.list_(pa.int32()))) if n in out else rows.column(n) for n in names], names)

    return run


def apply_edits(trees: DataFrame, ranks: dict[bytes, int], edits: str = "edits") -> DataFrame:
    """trees after the edits of the array column `edits` (start, end, text), one after the other, each in the
    places of the text before it: text, leaves and n_tokens are updated, n_encoded counts the
    pre-tokens that were encoded. No edits, or null, leave a row as it is."""
    kept = trees.drop("n_encoded")
    schema = T.StructType([*kept.drop(edits).schema, T.StructField("n_encoded", T.LongType())])
    return kept.mapInArrow(_edited(trees.sparkSession.sparkContext.broadcast(ranks), edits), schema)
