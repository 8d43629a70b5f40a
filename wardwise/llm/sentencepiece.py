"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

A vocabulary file gives the pieces and their log scores; the trie holds the pieces' bytes, so that one array
lookup per byte follows all pieces that start at a place. Spaces become the marker U+2581, one is put before
the text. No piece has a marker after another character, so the best path of a text is the best paths of
its segments (markers, then other characters): each different segment of a task is searched once, many
at a time, as arrays. Characters that no piece covers fall back to byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardwise.llm import words as W

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Segments that a task remembers before it starts anew.
MOST_REMEMBERED = 400_000
#: Below the least score, for a character without a piece.
UNKNOWN = 10.0


class Trie:
    """Double array over bytes: state s goes on byte b to t = base[s] + b + 1 if check[t] == s."""

    def __init__(self, keys: list[bytes], values: list[int]):
        nodes: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for key, value in zip(keys, values):
            at = 0
            for b in key:
                if b not in nodes[at]:
                    nodes[at][b] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][b]
            ends[at] = value
        size = 4 * len(nodes) + 4096
        used, base_of, place = np.zeros(size, bool), {}, {0: 0}
        used[0] = True
        low = {}  # by number of children, where the search goes on
        for node in sorted((i for i, c in enumerate(nodes) if c), key=lambda i: -len(nodes[i])):
            children = np.array(sorted(nodes[node]))
            at = low.get(children.size, 0)
            while True:
                tries = np.arange(at, at + 2048)
                fits = ~used[tries[:, None] + children + 1].any(axis=1)
                if fits.any():
                    break
                at += 2048
            low[children.size] = at = int(tries[fits.argmax()])
            used[at + children + 1] = True
            base_of[node] = at
            for c, child in nodes[node].items():
                place[child] = at + c + 1
        self.base, self.check, self.value = (np.full(size, x, np.int32) for x in (0, -1, -1))
        for node, at in base_of.items():
            self.base[place[node]] = at
            for child in nodes[node].values():
                self.check[place[child]], self.value[place[child]] = place[node], ends[child]


class Vocabulary:
    """Pieces, scores, the trie, and the ids of the 256 byte pieces."""

    def __init__(self, pieces: list[str], scores: list[float], ordinary: list[bool], byte_ids: list[int], unknown: int):
        self.scores = np.array(scores)
        self.byte_ids = np.array(byte_ids, np.int32)
        self.unknown = unknown
        keys = [i for i, o in enumerate(ordinary) if o]
        if any(MARK in p.lstrip(MARK) for i, p in enumerate(pieces) if ordinary[i]):
            raise ValueError("a piece has a marker after another character")
        self.trie = Trie([pieces[i].encode() for i in keys], keys)
        self.longest = max(len(pieces[i].encode()) for i in keys)
        self.unknown_score = float(min(self.scores[keys])) - UNKNOWN
        text = [p.replace(MARK, " ").encode() if o else b"" for p, o in zip(pieces, ordinary)]
        for b, i in enumerate(byte_ids):
            text[i] = bytes([b])
        self.lengths = np.array([len(t) for t in text])
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.text = np.frombuffer(b"".join(text), np.uint8)


def zipf_scores(scores: list[float]) -> list[float]:
    """Log probabilities by Zipf's law from the order of the given scores, the highest first."""
    order = np.argsort(-np.array(scores), kind="stable")
    mass = 1 / np.arange(1, len(scores) + 1)
    out = np.empty(len(scores))
    out[order] = np.log(mass / mass.sum())
    return out.tolist()


def load_vocabulary(path: str = VOCABULARY, ranked: bool = True) -> Vocabulary:
    """Read a model file on the driver; the vocabulary goes to the tasks as a broadcast of its own size.

    `ranked`: the file's scores only rank the pieces, as those of merges do, and become log scores by
    Zipf's law; else they are log scores already.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    ordinary = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    scores = [model.get_score(i) for i in range(n)]
    return Vocabulary(pieces, zipf_scores(scores) if ranked else scores, ordinary,
                      [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], model.unk_id())


def viterbi(vocab: Vocabulary, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece ids of all segments in order, bounds by segment, score by segment)."""
    sizes = np.array([len(s) for s in segments])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(segments), np.uint8)
    n = data.size
    seg_start, seg_end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    trie, char = vocab.trie, (data & 0xC0) != 0x80
    # all pieces at all places: the walks of every place go on together, byte by byte
    at = np.flatnonzero(char)
    state, begin = np.zeros(at.size, np.int64), at
    edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    covered = np.zeros(n + 1, bool)
    next_char = np.concatenate([at[1:], [n]])
    width = np.zeros(n, np.int64)
    width[at] = next_char - at
    for step in range(vocab.longest):
        pos = begin + step
        inside = pos < seg_end[begin]
        begin, state, pos = begin[inside], state[inside], pos[inside]
        if not begin.size:
            break
        to = trie.base[state] + data[pos].astype(np.int64) + 1
        to[to >= trie.check.size] = 0
        going = (trie.check[to] == state) & (to > 0)
        begin, state, pos = begin[going], to[going], pos[going]
        value = trie.value[state]
        full = value >= 0
        edges.append((begin[full], pos[full] + 1, value[full].astype(np.int64)))
        single = full & (pos + 1 - begin == width[begin])
        covered[begin[single]] = True
    bare = at[~covered[at]]
    edges.append((bare, bare + width[bare], np.full(bare.size, -1)))
    start, end, piece = (np.concatenate([e[i] for e in edges]) for i in range(3))
    gain = np.where(piece >= 0, vocab.scores[piece], vocab.unknown_score)
    # best path by the place of the edge's end in its segment; of equal scores the longest last piece
    reach = end - seg_start[start]
    order = np.lexsort((start, end, reach))
    start, end, piece, gain, reach = start[order], end[order], piece[order], gain[order], reach[order]
    best = np.zeros(n + 1)
    chosen = np.zeros(n + 1, np.int64)
    base_at = start - seg_start[start]
    cuts = np.concatenate([np.flatnonzero(np.diff(reach, prepend=-1)), [reach.size]])
    # best[] of a segment's places is kept one above the place, its start being 0
    for a, b in zip(cuts[:-1], cuts[1:]):
        score = np.where(base_at[a:b] > 0, best[start[a:b] - 1], 0.0) + gain[a:b]
        first = np.flatnonzero(np.diff(end[a:b], prepend=-1))
        top = np.maximum.reduceat(score, first)
        sizes_of = np.diff(np.append(first, b - a))
        hit = np.flatnonzero(score == np.repeat(top, sizes_of))
        owner = np.repeat(np.arange(first.size), sizes_of)[hit]
        hit = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]
        best[end[a:b][first] - 1] = top
        chosen[end[a:b][first] - 1] = a + hit
    # back from the ends, one piece of every unfinished segment at a time
    number, cur = np.arange(sizes.size)[sizes > 0], bounds[1:][sizes > 0] - 1
    taken: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while number.size:
        e = chosen[cur]
        taken.append((number, start[e], piece[e]))
        cur = start[e] - 1
        on = start[e] > bounds[number]
        number, cur = number[on], cur[on]
    seg, place, ids = (np.concatenate([t[i] for t in taken]) if taken else np.zeros(0, np.int64) for i in range(3))
    order = np.argsort(place, kind="stable")
    seg, place, ids = seg[order], place[order], ids[order]
    # bytes instead of characters without a piece
    copies = np.where(ids < 0, width[place] if n else 0, 1)
    seg, out = np.repeat(seg, copies), np.repeat(ids, copies)
    byte_at = np.repeat(place, copies) + np.arange(out.size) - np.repeat(np.cumsum(copies) - copies, copies)
    out = np.where(out < 0, vocab.byte_ids[data[byte_at]] if n else 0, out)
    totals = np.where(sizes > 0, best[np.maximum(bounds[1:] - 1, 0)] if n else 0.0, 0.0)
    return out, np.searchsorted(seg, np.arange(sizes.size + 1)), totals


#: A segment: spaces, then others; a line end or a literal marker stands alone, as no piece has one.
_SEGMENT = re.compile(f" *[^ \n{MARK}]+| +|\n|{MARK}")


def _gather(values: np.ndarray, bounds: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists picked, end to end, and their sizes."""
    sizes = bounds[picks + 1] - bounds[picks]
    at = np.repeat(bounds[picks] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    return values[at], sizes


class Encoder:
    """Encodes texts; remembers the best path of each segment it has met."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._forget()

    def _forget(self):
        # a literal marker decodes to itself only as bytes
        self.known: dict[str, int] = {MARK: 0}
        self.ids = self.vocab.byte_ids[list(MARK.encode())].astype(np.int64)
        self.bounds, self.scores = np.array([0, 3]), np.array([self.vocab.unknown_score])

    def _learn(self, segments: list[str]):
        ids, bounds, scores = viterbi(self.vocab, [s.replace(" ", MARK).encode() for s in segments])
        self.known.update(zip(segments, range(len(self.known), len(self.known) + len(segments))))
        self.bounds = np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
        self.ids = np.concatenate([self.ids, ids])
        self.scores = np.concatenate([self.scores, scores])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids end to end, bounds by text, scores by text); an empty text has none."""
        parts = [_SEGMENT.findall(" " + t) if t else [] for t in texts]
        if len(self.known) > MOST_REMEMBERED:
            self._forget()
        new = {s for p in parts for s in p if s not in self.known}
        if new:
            self._learn(sorted(new))
        counts = np.array([len(p) for p in parts])
        picks = np.fromiter((self.known[s] for p in parts for s in p), np.int64, int(counts.sum()))
        ids, sizes = _gather(self.ids, self.bounds, picks)
        ends = np.concatenate([[0], np.cumsum(counts)])
        sums = np.concatenate([[0], np.cumsum(sizes)])
        score = np.concatenate([[0.0], np.cumsum(self.scores[picks])])
        return ids, sums[ends], score[ends[1:]] - score[ends[:-1]]


def decode_ids(vocab: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of the id lists: markers become spaces, the first one goes; broken bytes become U+FFFD."""
    data, sizes = _gather(vocab.text, vocab.offsets, ids)
    ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
    whole = data.tobytes()
    texts = [whole[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts]


def _encoded(vocab):
    def run(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(vocab.value)
        for rows, buf, offsets in W.pieces(batches):
            whole = buf.tobytes()
            texts = [whole[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            ids, bounds, scores = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, W.listed(ids.astype(np.int32), bounds, pa.int32()), pa.array(scores)],
                [*rows.schema.names, "piece_ids", "piece_score"])

    return run


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """docs with piece_ids and piece_score (the path's log score). Columns of these names are replaced;
    a null or empty text has no pieces and score 0."""
    docs = docs.drop("piece_ids", "piece_score")
    out = T.StructType([*docs.schema, T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
                        T.StructField("piece_score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    return docs.mapInArrow(_encoded(sent), out)


def _decoded(vocab):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                lists = rows.column("piece_ids")
                bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
                texts = decode_ids(vocab.value, lists.flatten().to_numpy().astype(np.int64), bounds)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*rows.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, vocab: Vocabulary) -> DataFrame:
    """encoded with `decoded`, the text of its piece_ids; no ids (or null) give an empty text."""
    encoded = encoded.drop("decoded")
    sent = encoded.sparkSession.sparkContext.broadcast(vocab)
    return encoded.mapInArrow(_decoded(sent), T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())]))
