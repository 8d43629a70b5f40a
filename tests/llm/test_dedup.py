import random
import re

from pyspark.sql import functions as F

from wardwise.llm import dedup, queries


def test_short_lines_and_rewrapped_passages_go(docs):
    rnd = random.Random(9)
    some = lambda n: [f"t{rnd.randint(0, 10**6)}" for _ in range(n)]
    wrap = lambda w, k: "\n".join(" ".join(w[i:i + k]) for i in range(0, len(w), k))
    verse, same = some(70), " ".join(["na"] * 400)
    rows = [(1, "All rights reserved.\n" + " ".join(some(20))), (2, " ".join(some(9)) + "\nall  rights RESERVED."),
            (3, "\n".join(["}", *some(3), "}"])), (4, wrap(some(12) + verse + some(5), 5)), (5, wrap(some(3) + verse, 4)),
            (6, "x " + same + " y"), (7, " ".join(some(4)) + " " + same)]
    out = {r.doc_id: r for r in dedup.remove_repeats(docs(rows), least_words=1).collect()}
    assert out[1].text == rows[0][1] and out[4].text == rows[3][1]
    assert out[2].text == rows[1][1].split("\n")[0] + "\n"
    assert out[3].text.count("}") == 1
    assert sum(w in out[5].text.split() for w in verse) <= 30
    assert out[7].text.split().count("na") <= 2 * dedup.MOST_WORDS
    listed = {(r.doc_id, r.n_words) for r in dedup.repeats(docs(rows).withColumn("row", F.lit(0).cast("long"))).collect()}
    assert {(2, 3), (3, 1)} <= listed


def units(text):
    """(start, end, normalised words) of all lines with a word and all paragraphs of eight words or more."""
    words = [(m.start(), m.end(), text.count("\n", 0, m.start())) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for most, least in ((0, 1), (1, 8)):
        run = []
        for i, w in enumerate(words):
            run.append(w)
            if i + 1 == len(words) or words[i + 1][2] - w[2] > most:
                if len(run) >= least:
                    yield run[0][0], run[-1][1], tuple(text[a:b].translate(low) for a, b, _ in run)
                run = []


def test_every_repeated_line_and_paragraph_is_listed(spark, documents):
    seen, want = {}, set()
    found = sorted((r.doc_id, a, b, key) for r in documents.collect() for a, b, key in units(r.text or ""))
    for doc, a, b, key in found:
        if key in seen and seen[key] != (doc, a):
            want.add((doc, a, b))
        seen.setdefault(key, (doc, a))
    got = {(r.doc_id, r.start, r.end) for r in queries.op3_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert len(want) > 200 and want <= got
