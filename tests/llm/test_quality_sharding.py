import collections
import math
import re
import zlib

import numpy as np
import xxhash

from wardwise.llm import quality, queries, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c"), (5, "é\x85ü a\xa0b | <x>"), (6, "w " * 5000), (6, "x\ny\nx\n\nx"),
         (None, " ".join(f"w{i}" for i in range(60))), (8, " ".join(f"w{i % 700}" for i in range(30_000)))]


def test_base_columns(spark, docs):
    rules = quality.Rules((0.0,) * quality.BUCKETS, float("-inf"), 0)
    for r in quality.apply_rules(docs(EDGES), rules).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base(r.text or "") and r.kept == (not r.base_failed)


def test_rules_part_good_from_bad(spark, docs):
    good = [(i, " ".join(f"word{(i * 7 + j * j) % 90}" for j in range(80))) for i in range(60)]
    bad = [(100 + i, " ".join(f"junk{(i * 5 + j * j * j) % 90}" for j in range(80))) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(100, 0, 0), (None, 1, 0), (0, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    table = docs(good + bad + [(200, None)])
    rules = quality.fit_rules(table, labels)
    kept = {r.doc_id for r in quality.apply_rules(table, rules).collect() if r.kept}
    assert kept <= set(range(60)) and len(kept) > 45
    assert quality.fit_rules(table, labels.limit(0)).threshold == float("-inf")
    assert quality.apply_rules(docs([]), rules).count() == 0
    assert quality.fit_rules(docs([]), labels).n_trusted == 0


def test_query_against_brute_force(spark, documents):
    got = {r.doc_id: r for r in queries.op8_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    for r in documents.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == base(r.text or "")
        assert not (g.kept and g.base_failed)


def test_verdicts_against_brute_force(spark):
    """The log ratios, the threshold and every verdict, computed one word at a time."""
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    long = lambda x, seed=42: xxhash.xxh64(signed(x).to_bytes(8, "little", signed=True), seed=seed).intdigest()
    held = {d for d in good if signed(xxhash.xxh64((1).to_bytes(4, "little"), seed=long(d)).intdigest()) % 5 == 0}

    def buckets(text):
        h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in WORD.findall(text)]
        pairs = [long(b, long(a)) for a, b in zip(h, h[1:])] + ([long(h[-1])] if h else [])
        return [x >> 64 - quality.BITS for x in h + pairs]

    raw, trusted = collections.Counter(), collections.Counter()
    for d, t in texts.items():
        raw.update(buckets(t))
        if d in good and d not in held:
            trusted.update(buckets(t))
    total, own = sum(raw.values()) + quality.BUCKETS, sum(trusted.values()) + quality.BUCKETS
    ratio = [math.log((trusted[b] + 1) / own) - math.log((raw[b] + 1) / total) for b in range(quality.BUCKETS)]
    score = {d: sum(ratio[b] for b in buckets(t)) / len(buckets(t)) for d, t in texts.items() if buckets(t)}
    cut = np.percentile([score[d] for d in held if d in score], 0.5)
    for r in queries.op8_quality_rules(spark, folder).collect():
        if r.n_words:
            assert math.isclose(r.score, score[r.doc_id], abs_tol=1e-9)
            if abs(score[r.doc_id] - cut) > 1e-9:
                assert r.kept == (not r.base_failed and score[r.doc_id] >= cut)


def test_repeats_in_a_text_of_many_windows(spark, docs):
    text = " ".join(f"w{i}" for i in range(200_000)) + " w5 w6 w7 w199998"
    r = quality.apply_rules(docs([(1, text)]), quality.Rules((0.0,) * quality.BUCKETS, float("-inf"), 0)).first()
    assert (r.n_words, r.n_repeat_words) == (200_004, 6)


def settled(rows, shards):
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min([counts[s] for s in range(shards)]) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_shards_are_even_and_gapless(spark, documents):
    rows = queries.op7_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    assert len(rows) == len(texts)
    settled(rows, 24)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))


def test_repeated_rows_and_nulls(docs):
    rows = sharding.assign_shards(docs([(None, None)] * 40 + [(5, "same")] * 30 + [(i, "é") for i in range(9)]), shards=7).collect()
    assert len(rows) == 79
    settled(rows, 7)
    assert {r.size for r in rows} == {8, 12, 10}
    assert sharding.assign_shards(docs([])).count() == 0


def test_few_rows_move_when_a_shard_comes(docs):
    table = docs([(i, "t") for i in range(3000)])
    a, b = ({r.doc_id: r.shard for r in sharding.assign_shards(table, shards=n).collect()} for n in (10, 11))
    assert sum(a[i] != b[i] for i in a) < 2 * 3000 / 11


def test_settle_walks_clockwise():
    points = [(10, 0), (20, 1), (30, 2)]
    assert sharding.settle({5: 3}, points, 3) == [(5, 0, 0, 1, 0), (5, 1, 1, 2, 0), (5, 2, 2, 3, 0)]
    assert sharding.settle({}, points, 3) == []


def test_written_shards(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs([(i, f"text {i}") for i in range(50)]), path, shards=4)
    assert spark.read.parquet(path).count() == 50
