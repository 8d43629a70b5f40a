import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wardwise.llm import conversation_trie as ct
from wardwise.llm import queries

TURNS = "conv_id long, turn long, role string, text string"


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
            if d:
                below[t[:d - 1]].add(t[:d])
        ends[t].append(c)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in below[p]) or 1
        saved[p] = sum(saved[x] for x in below[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    for p, m in members.items():
        yield (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), leaves[p], saved[p],
               hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())


def check(spark, rows, parts=3, **extra):
    df = spark.createDataFrame(rows, TURNS).repartition(parts)
    out = ct.prefix_trie(df.withColumns(extra) if extra else df).collect()
    assert Counter(map(tuple, out)) == Counter(expected(rows))


def talks(n, width, depth):
    for c in range(n):
        key = zlib.crc32(f"seed{c % width}".encode())
        for t in range(depth):
            yield c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t} {'é' * (key >> t & 1)} {key >> (t // 2) & 3}"


@pytest.mark.parametrize(("n", "width", "depth"), [(60, 60, 6), (400, 7, 9), (300, 300, 12), (3, 1, 1)])
def test_nodes_against_brute_force(spark, n, width, depth):
    check(spark, list(talks(n, width, depth)))


def test_nulls_ties_repeats_and_long_conversations(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, 0, None, "x"), (1, 0, None, "x"), (2, 3, "", ""), (2, None, "a", "b"),
            (None, 0, "user", "nobody"), (-7, 1, "user", "below zero"), (-5, 1, "user", "base below zero"), (8, 0, "u", "y" * 200_000)]
    rows += [(c, t, "user", f"t{t}") for c in (20, 21, 22, 23) for t in range(300)]
    check(spark, rows, shard=F.lit(1), path=F.lit("clash"), skel=F.lit(0), _base=F.lit(1))


def test_hot_conversation_spans_shards(spark, monkeypatch):
    monkeypatch.setattr(ct, "CHUNK", 16)
    rows = [(c, t, "user", f"same {t}") for c in range(900) for t in range(4)] + list((c + 1000, *r) for c, *r in talks(300, 300, 5))
    check(spark, rows)


def test_few_candidate_bytes_only_change_the_shards(spark, monkeypatch):
    monkeypatch.setattr(ct, "CANDIDATE_BYTES", 500)
    check(spark, list(talks(200, 40, 6)))


def test_empty_tables(spark):
    assert ct.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert ct.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = queries.op13_conversation_trie(spark, "/root/testdata/sf0.01").collect()
    assert Counter(map(tuple, out)) == Counter(expected(rows))
