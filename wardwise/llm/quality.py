"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Words and word pairs of all documents are counted into BUCKETS hash buckets, once for the whole
corpus and once for a trusted sample; a document's score is the mean log ratio of the two
multinomials over its n-grams. Documents below the `lost` quantile of held-out trusted scores are
rejected.
All steps are DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 14
BUCKETS = 1 << BITS
SYMBOLS = "#*$%&|<>"
#: One trusted document in so many is left out of the counts and sets the threshold, as its n-grams are
#: then as new to the counts as those of any unlabelled document.
FOLDS = 5
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rules:
    log_ratios: tuple[float, ...]
    threshold: float
    n_trusted: int


def _spaced(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def _hashes(text: Column) -> Column:
    """A 64-bit hash per word; words are runs of anything but ASCII white space."""
    return F.transform(F.array_remove(F.split(_spaced(text), " "), ""), lambda w: F.xxhash64(w))


def _pairs(h: Column) -> Column:
    """Hashes of neighbouring words; the last stands for the last word and the end."""
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BITS).cast("int")


def trusted_sample(labels: DataFrame, bound: int = 20_000) -> DataFrame:
    """Ids of labelled good and harmless documents; of more than `bound`, those of least hash."""
    good = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def _score(h: Column, pairs: Column, log_ratios: tuple[float, ...]) -> Column:
    # one literal, folded before the run; an array of many literals would burden the planner
    table = F.split(F.lit(",".join(map(repr, log_ratios))), ",").cast("array<double>")
    total = F.aggregate(F.concat(h, pairs), F.lit(0.0), lambda a, x: a + F.get(table, _bucket(x)))
    return total / (2 * F.size(h))


def fit_rules(docs: DataFrame, labels: DataFrame, lost: float = 0.005, bound: int = 20_000) -> Rules:
    """Counts over all documents; trusted counts and the threshold from at most `bound` labelled rows.

    Without trusted documents every ratio is 0 and nothing falls below the threshold.
    """
    held = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)) == 0
    trusted = trusted_sample(labels, bound).withColumn("held", held)
    # the sample has at most `bound` ids
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted), "doc_id", "left")
    hashed = marked.select("held", _hashes(F.col("text")).alias("h")).withColumn("p", _pairs(F.col("h")))
    grams = hashed.select("held", F.explode(F.concat("h", "p")).alias("gram"))
    counts = {r[0]: (r[1], r[2]) for r in grams.groupBy(_bucket(F.col("gram"))).agg(
        F.count(F.lit(1)), F.count_if(~F.col("held"))).collect()}
    raw_total = sum(c for c, _ in counts.values()) + BUCKETS
    good_total = sum(t for _, t in counts.values()) + BUCKETS
    if good_total == BUCKETS:
        return Rules((0.0,) * BUCKETS, -math.inf, 0)
    ratios = tuple(
        math.log((counts.get(b, (0, 0))[1] + 1) / good_total) - math.log((counts.get(b, (0, 0))[0] + 1) / raw_total)
        for b in range(BUCKETS))
    scores = (hashed.where("held AND size(h) > 0")
              .select(_score(F.col("h"), F.col("p"), ratios).alias("s")))
    threshold, n = scores.agg(F.percentile("s", F.lit(lost)), F.count("s")).first()
    return Rules(ratios, -math.inf if threshold is None else threshold, n)


def _keyed_windows(h: Column, pairs: Column) -> Column:
    """Sorted (hash, position), one per 3-word window; hashes have 64 bits in texts of any length."""
    windows = F.slice(pairs, 1, F.greatest(F.size(h) - 2, F.lit(0)))
    return F.sort_array(F.transform(windows, lambda x, i: F.struct(F.xxhash64(x, F.get(h, i + 2)).alias("h"), i.alias("i"))))


def _repeated_at(keyed: Column) -> Column:
    """Positions of windows that occur twice or more: equal ones are neighbours after the sort."""
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter(keyed, lambda x, i: same(x, F.get(keyed, i + 1)) | same(x, F.get(keyed, i - 1)))
    return F.sort_array(F.transform(twice, lambda x: x["i"].cast("long")))


def _covered(at: Column) -> Column:
    """Words inside 3-word windows that start at the given positions."""
    steps = F.transform(at, lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def apply_rules(docs: DataFrame, rules: Rules) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    A null text has no words and fails; columns of docs that carry one of these names are replaced.
    Write the result before filtering on kept: pushed down, its expression would grow vast. Texts of
    any length are read whole, and the work on one is linear but for the sort of its windows.
    """
    text, spaced = F.coalesce(F.col("text"), F.lit("")), _spaced(F.col("text"))
    plain = text
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    h = F.col("_h")
    out = (docs.withColumn("_h", _hashes(F.col("text")))
           .withColumns({"_p": _pairs(h), "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))})
           .withColumn("_keyed", _keyed_windows(h, F.col("_p")))
           .withColumn("_at", _repeated_at(F.col("_keyed")))
           .withColumns({
               "n_words": F.size(h).cast("long"),
               "word_chars": F.char_length(F.replace(spaced, F.lit(" "), F.lit(""))).cast("long"),
               "n_symbols": (F.octet_length(text) - F.octet_length(plain)).cast("long"),
               "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
               "n_repeat_words": _covered(F.col("_at")),
               "score": F.when(F.size(h) > 0, _score(h, F.col("_p"), rules.log_ratios))}))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(rules.threshold)))
            .drop("_h", "_p", "_lines", "_keyed", "_at"))
