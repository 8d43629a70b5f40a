import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS
from wardwise.llm import language as la
from wardwise.llm import queries

SF = "/root/testdata/sf0.01"


def grams(text, bits):
    """Counts of buckets, one n-gram at a time."""
    mask, out = (1 << 64) - 1, Counter()
    points = [ord(c) for c in text.lower()]
    odd = [int(x) for x in la._ODD]
    for i in range(len(points)):
        h = 0
        for n, p in enumerate(points[i:i + la.ORDERS]):
            h = (h * odd[0] + p * odd[n] + odd[3]) & mask
            out[((h ^ (h >> 29)) * odd[1] & mask) >> (64 - bits)] += 1
    return out


@pytest.mark.parametrize("text", ["", "a", "É!", "Das ist ein Haus.\n", "xyz " * 700, "\U0001f600 ok", "ab"])
def test_features_against_one_at_a_time(text, monkeypatch):
    at, n = la.features(text, 12)
    assert dict(zip(at.tolist(), n.tolist())) == grams(text, 12)
    monkeypatch.setattr(la, "PIECE", 7)
    again = la.features(text, 12)
    assert (again[0] == at).all() and (again[1] == n).all()


def test_step_against_the_rule_one_weight_at_a_time():
    rnd = np.random.default_rng(2)
    ftrl, z, n = la.Ftrl(4, 3, l1=0.1, l2=0.3), np.zeros((17, 3)), np.zeros((17, 3))

    def weight(i, c):
        if i == 16:
            return -z[i, c] * ftrl.alpha / (ftrl.beta + n[i, c] ** 0.5)
        if abs(z[i, c]) <= ftrl.l1:
            return 0.0
        return -(z[i, c] - np.sign(z[i, c]) * ftrl.l1) / ((ftrl.beta + n[i, c] ** 0.5) / ftrl.alpha + ftrl.l2)

    for _ in range(30):
        at, label = np.sort(rnd.choice(16, 5, replace=False)), int(rnd.integers(3))
        x = rnd.random(5)
        ftrl.step(at, x, label)
        p = la.softmax(np.array([sum(v * weight(i, c) for i, v in zip(at, x)) + weight(16, c) for c in range(3)]))
        now = {(i, c): weight(i, c) for i in [*at, 16] for c in range(3)}
        for i, v in [*zip(at, x), (16, 1.0)]:
            for c in range(3):
                g = (p[c] - (c == label)) * v
                z[i, c] += g - ((n[i, c] + g * g) ** 0.5 - n[i, c] ** 0.5) / ftrl.alpha * now[i, c]
                n[i, c] += g * g
    assert np.allclose(ftrl.z, z) and np.allclose(ftrl.n, n)
    assert (ftrl.matrix()[:-1] == 0).any()


def test_temperature_has_the_least_loss():
    rnd = np.random.default_rng(3)
    labels = rnd.integers(0, 3, 400)
    logits = 5 * (rnd.normal(size=(400, 3)) + 1.5 * np.eye(3)[labels])
    loss = lambda t: -np.log(la.softmax(logits / t)[np.arange(400), labels]).mean()
    best = la.temperature(logits, labels)
    assert all(loss(best) <= loss(best * f) + 1e-9 for f in (0.5, 0.9, 1.1, 2.0)) and best > 1
    assert la.temperature(np.zeros((0,)), np.zeros(0, np.int64)) == 1.0


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {r.doc_id: r for r in queries.op12_language_id(spark, SF).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(out) == len(rows)
    held = [r for r in rows if out[r.doc_id].held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == out[r.doc_id].held_out for r in rows)
    right = [out[r.doc_id].lang_pred == r.lang for r in held]
    scores = [out[r.doc_id].score for r in held]
    assert np.mean(right) >= 0.95 and all(0 <= s <= 1 for s in scores)
    assert abs(np.mean(scores) - np.mean(right)) < 0.05


def test_lang_source_and_id_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = la.train(docs.where(~la.held_out(F.col("doc_id"))), 200)
    held = docs.where(la.held_out(F.col("doc_id")))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in la.predict(held, model).collect()}
    other = held.withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None)).repartition(5)
    assert {r.doc_id - 10**6: (r.lang_pred, r.score) for r in la.predict(other, model).collect()} == plain


def test_partitions_do_not_change_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang")
    one, many = la.train(docs.repartition(1), 40), la.train(docs.repartition(11), 40)
    assert one.langs == many.langs and (one.weights == many.weights).all() and (one.idf == many.idf).all()
    assert one.temperature == many.temperature


def test_edge_texts(spark):
    words = {"en": "the quick brown fox ", "": "zxzx qyqy ", "it": "perché così "}
    rows = [(i, words[k] * (1 + i % 5), k, "s", 1) for i, k in enumerate(list(words) * 40)]
    rows += [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (502, " 123 \n!", "it", "s", 0), (503, "Ж", None, "s", 1),
             (None, "the fox", "en", "s", 1), (504, "perché " * 100_000, "it", "s", 1)] + [(505, "the fox", "en", "s", 1)] * 30
    df = spark.createDataFrame(rows, DOCS).repartition(3).withColumns({"label": F.lit(9), "bucket": F.lit(1), "score": F.lit("x")})
    out = la.identify(df, 60).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (500, 501, 502))
    assert by[503].lang_pred in words and by[504].lang_pred == "it" and by[505].lang_pred == "en" and not by[None].held_out
    assert sum(by[i].lang_pred == k for i, k in enumerate(list(words) * 40)) >= 118


def test_nothing_to_learn_from(spark):
    assert la.identify(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(i, "some text", None, "s", 1) for i in range(6)]
    assert {(r.lang_pred, r.score) for r in la.identify(spark.createDataFrame(rows, DOCS)).collect()} == {("und", 0.0)}
