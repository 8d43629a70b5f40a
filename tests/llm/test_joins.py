import collections
import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from wardwise.llm import decontaminate, dedup, graph, jaccard, queries
from wardwise.llm import rows as jr

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, k):
    w = SPACE.findall((text or "").translate(LOW))
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def linked_groups(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min([x for x in (least.get(find(i)), d) if x is not None], default=None)
    return collections.Counter((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def variants(seed, n, size, edits):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(size)]
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(size)] = f"v{rnd.randint(0, 30)}"
        yield " ".join(words)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_groups_against_all_pairs(docs, k, percent):
    texts = [*variants(1, 40, 120, 6), *variants(2, 25, 40, 2), *variants(3, 20, 300, 25), *variants(1, 5, 120, 1)]
    texts += ["", None, " \n", "One", "one", "ONE two", "one two", "a b c", "A b\tc", "x " * 400, "x " * 90, "É é", "é é"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[0]), (None, None)]
    out = jaccard.jaccard_groups(docs(rows), k, percent).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked_groups(rows, k, percent)


def test_pairs_inside_a_group_grow_as_the_group_does(docs, monkeypatch):
    met, plain = {}, jaccard.materialize
    for n in (100, 200, 400):
        monkeypatch.setattr(jaccard, "materialize", lambda df, name="stage", n=n: (
            lambda out: met.update({(n, name): out.count()}) or out if name in ("tests", "inner") else out)(plain(df, name)))
        rows = list(enumerate(variants(9, n, 300, 14)))
        out = jaccard.jaccard_groups(docs(rows), 5, 80).collect()
        if n == 200:
            assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked_groups(rows, 5, 80)
    total = {n: met.get((n, "tests"), 0) + met.get((n, "inner"), 0) for n in (100, 200, 400)}
    assert total[200] <= 3 * total[100] + 100 and total[400] <= 3 * total[200] + 100


def test_a_loose_family_is_one_group(docs, monkeypatch):
    """Sets joined the group of one band's first only: a family fell into several groups, whose sets all met each other."""
    seen, plain = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name="stage": (lambda out: seen.update({name: out.count()}) or out)(plain(df, name)))
    rows = list(enumerate(variants(9, 150, 300, 30)))
    out = jaccard.jaccard_groups(docs(rows), 5, 80).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked_groups(rows, 5, 80)
    assert seen["pairs"] <= 15


def test_only_tokens_that_can_still_link_are_dealt(docs, monkeypatch):
    """Counts in a sketch of fixed size let ever more tokens through as it filled up."""
    seen, plain = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name="stage": seen.setdefault(name, plain(df, name)) if name in ("apart", "places") else plain(df, name))
    rows = list(enumerate([*variants(9, 200, 300, 14), *variants(4, 60, 80, 7)]))
    out = jaccard._groups(docs(rows), 5, 80).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked_groups(rows, 5, 80)
    holders = collections.defaultdict(list)
    for r in seen["apart"].collect():
        for t in r.delta:
            holders[r.group, t].append((r.comp, r.core))
    places = seen["places"].collect()
    assert places and all(len({c for c, _ in holders[p.group, p.token]}) > 1 and not all(core for _, core in holders[p.group, p.token]) for p in places)


def test_hot_keys_are_dealt_out(docs, monkeypatch):
    monkeypatch.setattr(jr, "KEY_ROWS", 3)
    monkeypatch.setattr(jaccard, "SET_ROWS", 3)
    rows = list(enumerate([*variants(1, 30, 80, 4), *variants(2, 12, 60, 2)])) + [(100 + i, "same words in all of these rows") for i in range(20)]
    out = jaccard.jaccard_groups(docs(rows).withColumns({"sig": F.lit(1), "group": F.lit(2), "n": F.lit("x")}), 3, 90).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked_groups(rows, 3, 90)


def test_query_against_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    out = queries.op10_jaccard_join(spark, "/root/testdata/sf0.001").collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked_groups(rows, 3, 90)


def test_one_of_each_group_stays(docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(4, text), (2, text + " more"), (2, text + " more"), (9, "other words " + text[::-1]), (5, None), (6, "")]
    assert sorted(r.doc_id for r in jaccard.first_of_groups(docs(rows)).collect()) == [2, 5, 6, 9]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(60, 90)] + [(7, 7)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(2, 41)}, **{i: 60 for i in [*range(61, 90), 100]}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def contaminated(rows, items, window=13):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOW))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(item)
    for d, text in rows:
        w = ALNUM.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                for item in windows.get(tuple(w[i:i + n]), ()):
                    found.add(item)
                    hit.update(range(i, i + n))
        yield d, len(w), len(hit), tuple(sorted(map(str, found))), bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_of_edge_texts(spark, docs):
    item = " ".join(f"Q{i}" for i in range(20))
    items = [(1, item), (11, item), (2, "Short, item"), (3, None), (4, "..."), (5, "the"), (None, "null id item " * 5), (6, "a b a b a b a b")]
    rows = [(1, None), (2, ""), (3, item.lower() + "! " + item), (4, "x " * 900 + item[:39] + " y"), (5, "short item. Short  ITEM"),
            (5, "the the"), (None, item), (7, "a b " * 40), (8, "null id item " * 9), (3, item.lower() + "! " + item), (9, "Q1 Q2 " * 50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows += [(10, "w " * 40 + " ".join(f"Q{i}" for i in range(20)) + " w" * 500), (11, "a b " * 2000)]
    clash = {"stretch": F.lit(1), "hash": F.lit(0), "window": F.lit("x"), "words": F.lit("y")}
    out = decontaminate.contamination(docs(rows).withColumns(clash), bench.withColumns(clash)).collect()
    # an item without item_id is hit, but not named
    want = collections.Counter((d, n, h, tuple(x for x in found if x != "None"), bad) for d, n, h, found, bad in contaminated(rows, items))
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in out) == want
    assert {r.n_hit for r in decontaminate.contamination(docs(rows), bench.limit(0)).collect()} == {0}
    assert decontaminate.contamination(docs([]), bench).count() == 0


def test_contamination_is_linear_in_a_repetitive_text(spark, docs):
    bench = spark.createDataFrame([(1, "a b a b a b a b")], "item_id long, text string")
    took = {}
    for n in (1000, 8000, 80_000):
        began = time.time()
        r = decontaminate.contamination(docs([(1, "a b " * (n // 2))]), bench).first()
        took[n] = time.time() - began
        assert (r.n_words, r.n_hit, r["items"]) == (n, n, ["1"])
    assert took[80_000] < 2 * took[8000] + 5


def test_contamination_query(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    want = {x[0]: x for x in contaminated([(r.doc_id, r.text) for r in documents.collect()], items)}
    for r in queries.op5_benchmark_decontamination(spark, "/root/testdata/sf0.001").collect():
        d, n, hit, found, bad = want[r.doc_id]
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), digest, bad)


def test_repeated_passages_go(docs):
    rnd = random.Random(4)
    words = lambda n: " ".join(f"t{rnd.randint(0, 10**6)}" for _ in range(n))
    passage, line = words(60), words(9)
    rows = [(1, words(30) + " " + passage + " " + words(20)), (2, words(50) + " " + passage.upper() + "  " + words(9)),
            (3, words(80)), (4, line + "\nshort line\n" + words(20)), (5, "é\n" + line + "\nshort line"), (6, None), (7, ""),
            (8, line), (8, line)]
    out = {}
    for r in dedup.remove_repeats(docs(rows)).collect():
        out.setdefault(r.doc_id, []).append(r)
    texts = {d: t for d, t in rows}
    assert out[1][0].text == texts[1] and out[3][0].text == texts[3] and out[4][0].text == texts[4]
    cut = sum(b - a for a, b in {(s.start, s.end) for s in out[2][0].removed})
    assert cut and len(out[2][0].text.split()) < 59 + 60 - 30
    assert out[5][0].text == "é\n\nshort line" and [(s.start, s.end) for s in out[5][0].removed] == [(2, 2 + len(line))]
    assert out[6][0].text is None and out[7][0].text == "" and [r.text for r in out[8]] == ["", ""]
    assert dedup.remove_repeats(docs([])).count() == 0


def test_dedup_query_names_equal_texts(spark, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = queries.op3_substring_dedup(spark, "/root/testdata/sf0.001").collect()
    norm = lambda t: " ".join(SPACE.findall(t.translate(LOW)))
    for r in rows:
        unit = norm(texts[r.doc_id][r.start:r.end])
        assert len(unit.split(" ")) == r.n_words >= dedup.LEAST_WORDS
        assert (norm(texts[r.first_doc_id][r.first_start:]) + " ").startswith(unit)
        assert (r.first_doc_id, r.first_start) < (r.doc_id, r.start)
