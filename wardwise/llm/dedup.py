"""Substring dedup by hashing lines, paragraphs and pieces of text.

Units of a text are its lines, however short, its paragraphs, and passages: the words are cut, by content,
where a word's hash is less than its neighbours', so that a passage is cut alike wherever it stands, and two
neighbouring pieces are a unit. Pieces are made twice, inside lines and over line ends. Units are normalised
(A-Z in lower case, runs of white space, line ends too, as one), digested to 128 bits and grouped over all
documents. The earliest occurrence by (doc_id, row, place) stays; the others are removed, with their offsets
in the original text. The earliest occurrence of every piece stays, since whatever removes one has an
earlier copy of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwise.llm import words as W
from wardwise.session import Temporary, materialize

REACH = 3
#: Least words of a line, and of a passage or paragraph.
LEAST_WORDS, PASSAGE_WORDS = 1, 8
#: A piece without a cut is cut after so many words; at the latest after twice as many.
MOST_WORDS = 48
_SECOND = 0xA0761D6478BD642F


def _forced(cut: np.ndarray, weak: np.ndarray) -> np.ndarray:
    """Further cuts in pieces of over MOST_WORDS words: at the next word that no neighbour is less than, so that
    a repeated word or short cycle is cut in the same phase everywhere."""
    at = np.flatnonzero(cut)
    ends = np.append(at[1:], cut.size)
    out = cut.copy()
    for lo, hi in zip(at[ends - at > MOST_WORDS], ends[ends - at > MOST_WORDS]):
        places = np.flatnonzero(weak[lo:hi]) + lo
        while hi - lo > MOST_WORDS:
            i = np.searchsorted(places, lo + MOST_WORDS)
            lo = min(places[i] if i < places.size else hi, lo + 2 * MOST_WORDS)
            if lo < hi:
                out[lo] = True
    return out


def _cuts(hashes: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Is the word the first of a piece; pieces end where the next run of words opens."""
    n = hashes.size
    number = np.cumsum(opens)
    least, weak = np.ones(n, bool), np.ones(n, bool)
    for s in range(1, REACH + 1):
        same = number[s:] == number[:-s]
        least[s:] &= ~same | (hashes[s:] < hashes[:-s])
        least[:-s] &= ~same | (hashes[:-s] <= hashes[s:])
        weak[s:] &= ~same | (hashes[s:] <= hashes[:-s])
        weak[:-s] &= ~same | (hashes[:-s] <= hashes[s:])
    return _forced(opens | least, weak)


def _pairs(cut: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of two neighbouring pieces of a run."""
    at = np.flatnonzero(cut)
    ends = np.append(at[1:], cut.size)
    has_next = np.flatnonzero(~np.append(opens[at][1:], True))
    return at[has_next], ends[has_next + 1]


def _runs(opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(opens)
    return at, np.append(at[1:], opens.size)


def _spans(w: W.Words, buf: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of all units, each span once."""
    n = w.starts.size
    line = np.searchsorted(np.flatnonzero(buf == 10), w.starts)
    text = np.zeros(n, bool)
    text[w.first[:-1][w.first[:-1] < n]] = True
    step = np.diff(line, prepend=line[0])
    of_line, of_paragraph = text | (step > 0), text | (step > 1)
    lines = _runs(of_line)
    found = [_runs(of_paragraph), _pairs(_cuts(w.hashes, of_line), of_line), _pairs(_cuts(w.hashes, text), text)]
    found = [(lo[hi - lo >= PASSAGE_WORDS], hi[hi - lo >= PASSAGE_WORDS]) for lo, hi in found]
    kept = lines[1] - lines[0] >= least_words
    left = np.concatenate([lines[0][kept], *(lo for lo, _ in found)])
    right = np.concatenate([lines[1][kept], *(hi for _, hi in found)])
    one = np.unique(left * (n + 1) + right)
    return one // (n + 1), one % (n + 1)


def _digests(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each span's words, wherever it stands."""
    size = (right - left).astype(np.uint64)
    out = []
    for base in (W._RUN, _SECOND):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * W.powers(base, hashes.size)[:hashes.size], dtype=np.uint64)])
        back = W.powers(pow(base, -1, 1 << 64), hashes.size)
        out.append(W.mix(W.mix((total[right] - total[left]) * back[left]) + size))
    return out


def _units(least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offsets in W.pieces(batches):
            w = W.Words(buf, offsets, W.NOT_SPACE, W.FOLDED)
            if not w.starts.size:
                continue
            left, right = _spans(w, buf, least_words)
            keys = _digests(w.hashes, left, right)
            points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # code points before each byte
            doc = np.searchsorted(w.first, left, "right") - 1
            zero = points[offsets[doc]]
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id").take(pa.array(doc)), rows.column("row").take(pa.array(doc)),
                pa.array(points[w.starts[left]] - zero, pa.int64()), pa.array(points[w.ends[right - 1]] - zero, pa.int64()),
                pa.array(right - left, pa.int64()), pa.array(W.signed(keys[0])), pa.array(W.signed(keys[1]))],
                ["doc_id", "row", "start", "end", "n_words", "d1", "d2"])

    return run


def repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per repeated unit of docs (doc_id, text, row): doc_id, row, start, end, n_words, and the kept
    occurrence's first_doc_id and first_start. Offsets are code points of the whole original text.

    `row` tells apart rows of equal doc_id. Null and empty texts have no units; lines of fewer than
    `least_words` words are no units; a null doc_id ranks first. docs is read twice and must give the same
    rows both times, as a scan of files does.
    """
    with Temporary(docs.sparkSession) as tables:
        return tables.keep(_repeated(docs, least_words), "repeats")


def _repeated(docs: DataFrame, least_words: int) -> DataFrame:
    # made twice, once a branch: written, the units alone take more than the input
    units = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "row", "text").mapInArrow(
        _units(least_words), "doc_id long, row long, start long, end long, n_words long, d1 long, d2 long")
    first = (units.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "row", "start")).alias("kept"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("d1", "d2", "kept"))
    return units.join(first, ["d1", "d2"]).where("NOT (struct(doc_id, row, start) <=> kept)").select(
        "doc_id", "row", "start", "end", "n_words", F.col("kept.doc_id").alias("first_doc_id"),
        F.col("kept.start").alias("first_start"))


def _cut_out():
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = []
            for text, spans in zip(texts, batch.column("_spans").to_pylist()):
                parts, at = [], 0
                for s in sorted(spans or [], key=lambda x: (x["start"], x["end"])):
                    parts.append(text[at:max(at, s["start"])])
                    at = max(at, s["end"])
                out.append(None if text is None else "".join(parts) + text[at:])
            names = [n for n in batch.schema.names if n != "_spans"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, batch.schema.field("text").type) if n == "text" else batch.column(n) for n in names], names)

    return run


def remove_repeats(docs: DataFrame, least_words: int = PASSAGE_WORDS) -> DataFrame:
    """docs without repeated units; `removed` lists (start, end) in the original text. With least_words=1 every
    repeated line goes, however short."""
    held = materialize(docs.drop("removed").withColumn("row", F.monotonically_increasing_id()), "rows")
    spans = repeats(held, least_words).groupBy(F.col("row").alias("_row")).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    joined = held.join(spans, F.col("row") == F.col("_row"), "left").drop("_row", "row").withColumn("removed", F.col("_spans"))
    schema = joined.drop("_spans").schema
    return joined.mapInArrow(_cut_out(), schema)
