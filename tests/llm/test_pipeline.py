import random

import pytest

import corpus_pipeline
from tests.llm.test_joins import contaminated, linked_groups
from wardwise.llm import secrets

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, documents):
    docs, held = documents, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        held.append((name, {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}))
        assert out.columns[:5] == documents.columns
        docs = spark.createDataFrame(out.collect(), out.schema).select(documents.columns)
    by = {n: (a, b) for n, a, b in held}
    before, after = by["jaccard_join"]
    groups = linked_groups([(d, r.text) for d, r in before.items()], 5, 80)
    assert set(after) == {c for _, _, c in groups}
    before, after = by["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(after) == {d for d, *_, bad in contaminated([(d, r.text) for d, r in before.items()], items) if not bad}
    before, after = by["secret_scans"]
    assert set(before) == set(after)
    assert all(r.n_chars == len(r.text) for r in after.values())
    assert secrets.scan(spark.createDataFrame(list(after.values())), secrets.BASE_RULES).where("size(spans) > 0").count() == 0
    before, after = by["sentencepiece_coding"]
    assert set(before) == set(after) and all(r.round_trip and r.text == before[r.doc_id].text for r in after.values())


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    """Folder of a table with nulls in any column, empty and long texts, repeated rows and copies; and an empty one."""
    rnd = random.Random(11)
    words = lambda n: " ".join(f"w{rnd.randint(0, 3000)}" for _ in range(n))
    item = " ".join(f"quiz{i}" for i in range(20))
    good, long = words(80), words(40_000)
    near = good.split()
    near[40] = "changed"
    rows = [(1, good, "en", "s", len(good)), (1, good, "en", "s", len(good)), (2, good, None, None, None), (3, " ".join(near), "en", "s", 1),
            (None, words(70), None, None, None), (4, None, "en", "s", None), (None, None, None, None, None), (5, "", "en", "s", 0),
            (6, long, "en", "s", len(long)), (7, words(60) + " " + item + " " + words(20), "en", "s", 1),
            (8, words(60) + "\npassword = Abcdef12345\n" + words(20), "de", "s", 1), (9, "too short", "en", "s", 9), (10, "again and again " * 40, "en", "s", 1)]
    folder = tmp_path_factory.mktemp("edges")
    names = "doc_id long, text string, lang string, source string, n_chars long"
    for name, table in (("full", rows), ("none", [])):
        spark.createDataFrame(table, names).repartition(3).write.parquet(f"{folder}/{name}/documents.parquet")
        # none is trusted, so that only the base rules reject
        spark.createDataFrame([(1, 0, 0), (9, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/{name}/labels.parquet")
        spark.createDataFrame([(1, item), (2, None), (None, "quiz")], "item_id long, text string").write.parquet(f"{folder}/{name}/benchmark.parquet")
    return folder, rows


def ids(df):
    return sorted((r.doc_id is not None, r.doc_id or 0) for r in df.collect())


def test_stages_on_edge_rows(spark, edges):
    folder, rows = edges
    folder = f"{folder}/full"
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    every = sorted((r[0] is not None, r[0] or 0) for r in rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "benchmark_decontamination", "secret_scans", "sentencepiece_coding"]

    judged = stages["quality_rules"](spark, docs, folder)
    gone = {(True, 4), (True, 5), (True, 9), (True, 10)}  # null, empty, short, repetitive; and the null row of null id
    left = ids(judged)
    assert judged.columns == docs.columns and not gone & set(left) and left.count((False, 0)) == 1
    assert {(True, 1), (True, 6)} <= set(left) and left.count((True, 1)) == 2

    one = ids(stages["jaccard_join"](spark, docs, folder))
    assert one.count((False, 0)) == 2
    assert one.count((True, 1)) == 1 and (True, 2) not in one and (True, 3) not in one
    assert {(True, 4), (True, 5), (True, 9)} <= set(one)

    clean = ids(stages["benchmark_decontamination"](spark, docs, folder))
    assert clean == [x for x in every if x != (True, 7)]

    redacted = stages["secret_scans"](spark, docs, folder)
    texts = {r.doc_id: r for r in redacted.collect()}
    assert ids(redacted) == every and redacted.columns == docs.columns
    assert "Abcdef12345" not in texts[8].text and texts[6].text == rows[8][1] and texts[4].text is None and texts[5].text == ""
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in redacted.collect())

    coded = stages["sentencepiece_coding"](spark, docs, folder)
    assert ids(coded) == every and all(r.round_trip for r in coded.collect())


def test_pipeline_on_edge_rows_and_on_nothing(spark, edges):
    folder, _ = edges
    out = corpus_pipeline.run(spark, f"{folder}/full").collect()
    kept = [r.doc_id for r in out]
    assert kept.count(1) == 1 and {6, 8} <= set(kept) and not {2, 3, 4, 5, 7, 9, 10} & set(kept)
    assert all(r.round_trip for r in out)
    docs = spark.read.parquet(f"{folder}/none/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, f"{folder}/none").count() == 0, name
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
