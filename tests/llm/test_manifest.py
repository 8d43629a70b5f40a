import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS
from wardwise.llm import manifest, queries

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text=...):
    doc_id, own, lang, source, n_chars = row
    parts = (doc_id, source, lang, n_chars, own if text is ... else text)
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in parts))


def climb(nodes):
    """(root, siblings of every node as (left, right) lists by level)"""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        for p, i in zip(paths, at):
            run = runs[i // 8]
            p.append((run[:i % 8], run[i % 8 + 1:]))
        at, nodes = [i // 8 for i in at], [sha("".join(r)) for r in runs]
    return nodes[0], paths


def expected(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((mine, *climb([leaf(r) for r in mine])))
    root, tops = climb([t[1] for t in trees])
    for (mine, subroot, paths), top in zip(trees, tops):
        for r, path in zip(mine, paths):
            steps = path + top
            found = r[1]
            if r[0] is not None and found is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                found = found.translate(LOW)
            folded = leaf(r, found)
            for left, right in steps:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join("".join(a + b) for a, b in steps))
            yield r[0], leaf(r), subroot, root, proof, folded, folded == root


def tampered():
    text = F.col("text")
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, manifest.lowered(text)).otherwise(text)


def check(spark, rows, **extra):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    out = manifest.verify(df.withColumns(extra) if extra else df, tampered()).collect()
    assert Counter(map(tuple, out)) == Counter(expected(rows))
    return out


def test_nulls_ties_long_texts_and_many_languages(spark):
    rows = [(i, f"Text {i} É", ["en", "de", None, "", "é", "z"][i % 6], f"s{i % 3}", i) for i in range(150)]
    rows += [(None, "No id", "en", None, None), (None, None, None, None, None), (7, "", "en", "", 0), (7, "X" * 300_000, "en", "s", 1)]
    rows += [(3, "same Row", "en", "s", 2)] * 40 + [(1000 + i, "T", f"l{i}", "s", 1) for i in range(70)]
    out = check(spark, rows)
    assert {r.verified for r in out} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 700])
def test_one_language_of_many_sizes(spark, n):
    rows = [(3 * i, f"Doc {i}", "en", "s", 1) for i in range(n)]
    check(spark, rows, leaf=F.lit("clash"), tree=F.lit(1), found=F.lit(0), _lang=F.lit("x"))


def test_lanes_above_several_levels(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LANE", 2)
    check(spark, [(i, f"Doc {i}", "en" if i % 3 else "de", "s", 1) for i in range(1200)])


def test_empty_table(spark):
    assert manifest.verify(spark.createDataFrame([], DOCS), tampered()).count() == 0


def test_query_against_brute_force(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    out = queries.op11_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    assert Counter(map(tuple, out)) == Counter(expected(rows))
