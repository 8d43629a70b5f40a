import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardwise.llm import chat, lm, queries, sentencepiece, token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocab():
    return sentencepiece.load_vocabulary()


def best_score(vocab, pieces, text):
    t = "▁" + "".join({" ": "▁", "▁": "\0"}.get(c, c) for c in text)
    best = [0.0] + [-math.inf] * len(t)
    for i, c in enumerate(t):
        if c not in pieces:
            best[i + 1] = max(best[i + 1], best[i] + vocab.unknown_score)
        for j in range(i + 1, min(len(t), i + vocab.longest) + 1):
            if t[i:j] in pieces:
                best[j] = max(best[j], best[i] + pieces[t[i:j]])
    return best[-1]


def texts(n=150, alphabet="abc theéü \n▁中\U0001f600\t<0x41>"):
    rnd = random.Random(3)
    return ["", " ", "  ", "▁", " ▁ ", "a  b", "\n\n", " x ", *(
        "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n))]


def test_viterbi_is_best_and_round_trips(vocab):
    import sentencepiece as library

    model = library.SentencePieceProcessor(model_file=sentencepiece.VOCABULARY)
    pieces = {model.id_to_piece(i): vocab.scores[i] for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    ids, bounds, scores = sentencepiece.Encoder(vocab).encode(texts())
    assert sentencepiece.decode_ids(vocab, ids, bounds) == texts()
    for t, s in zip(texts(), scores):
        assert math.isclose(s, best_score(vocab, pieces, t) if t else 0.0, rel_tol=1e-9, abs_tol=1e-9)


def test_trie_finds_what_was_put_in():
    words = [b"a", b"ab", b"abc", b"b", b"ba", bytes([255]), bytes([0, 1])]
    trie = sentencepiece.Trie(words, list(range(len(words))))
    for i, w in enumerate(words):
        s = 0
        for b in w:
            t = trie.base[s] + b + 1
            assert trie.check[t] == s
            s = t
        assert trie.value[s] == i


def test_coded_table(docs, vocab):
    table = docs([(1, None), (2, ""), (2, "héllo wörld"), (None, "x" * 20_000)]).withColumnRenamed("lang", "piece_ids")
    out = sentencepiece.decode(sentencepiece.encode(table, vocab), vocab).collect()
    assert [r.decoded for r in out] == [r.text or "" for r in out] and all(len(r.piece_ids) > 0 for r in out if r.text)
    assert sentencepiece.encode(docs([]), vocab).count() == 0


def test_sentencepiece_query_round_trips(spark):
    rows = queries.op4_sentencepiece(spark, SF).collect()
    assert len(rows) == 200 and all(r.round_trip for r in rows)


def test_trees_follow_edits():
    counter, rnd = token_counts.Counter(token_counts.load_ranks()), random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'ll", "é", "12", "!", "\t", "the ", "ing", "中", ".", "  \n "]
    for _ in range(150):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 400)))
        cut = counter.cut.findall(text)
        tree = token_counts.Tree(np.array([len(t) for t in cut], np.int64), np.array(counter.count(cut), np.int64))
        for _ in range(6):
            at = rnd.randint(-2, len(text) + 2)
            put = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 5)))
            text, _n = token_counts.apply_edit(tree, text, at, at + rnd.choice([0, 0, 1, 3, 40]), put, counter)
            assert np.concatenate(tree.lengths).tolist() == [len(t) for t in counter.cut.findall(text)]
            assert tree.tokens == len(counter.encoding.encode_ordinary(text)) and tree.chars == len(text)


def test_an_edit_encodes_little():
    counter = token_counts.Counter(token_counts.load_ranks())
    cut = counter.cut.findall("some words here. " * 5000)
    tree = token_counts.Tree(np.array([len(t) for t in cut], np.int64), np.array(counter.count(cut), np.int64))
    assert token_counts.apply_edit(tree, "".join(cut), 40_000, 40_004, "new", counter)[1] < 8


def test_token_query(spark, documents):
    counter = token_counts.Counter(token_counts.load_ranks())
    got = {r.doc_id: r for r in queries.op2_token_counts(spark, SF).collect()}
    for r in documents.withColumn("edits", queries.sample_edits(documents.text)).collect():
        text = r.text or ""
        assert got[r.doc_id].n_tokens == len(counter.encoding.encode_ordinary(text))
        for e in r.edits:
            text = text[:e.start] + e.text + text[e.end:]
        assert got[r.doc_id].n_tokens_edited == len(counter.encoding.encode_ordinary(text))


def test_edits_of_nulls(spark):
    ranks = token_counts.load_ranks()
    rows = [(1, None, None), (2, "", [(0, 0, "new text")]), (3, "kept as is", None), (4, None, [(5, 9, None)])]
    table = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:long,end:long,text:string>>")
    out = {r.doc_id: (r.text, r.n_tokens) for r in token_counts.apply_edits(token_counts.build_trees(table, ranks), ranks).collect()}
    assert out[1] == (None, 0) and out[2] == ("new text", 2) and out[3][0] == "kept as is" and out[4][1] == 0


def summary(turns):
    whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    loss = "".join(t or "" for _, r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_formatted_conversations_read_back(spark):
    rnd, turns = random.Random(9), []
    bits = ["<|im_end|>", "<|", "|>", "<\\|", "\\", "word ", "<", "\n", "é", "assistant", "<|nl|>"]
    for conv in range(30):
        for turn in range(rnd.randint(1, 12)):
            role = "system" if turn == 0 and conv % 2 else rnd.choice(["user", "assistant", "ro\nle", "", None])
            turns.append((conv, turn, role, rnd.choice([None, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 90)))])))
    turns += [(50, t, "assistant" if t % 2 else "system" if t == 0 else "user", f"turn {t}") for t in range(3000)]
    turns += [(None, 0, "user", "x"), (60, None, "assistant", "a"), (60, 1, "user", "u"), (60, 1, "user", "u")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    windows = chat.format_windows(table, budget=60, history_tokens=30)
    by_conv = collections.defaultdict(list)
    for c, t, r, x in turns:
        by_conv[c].append((t, r, x))
    for r in chat.read_back(windows).collect():
        want = summary(sorted(by_conv[r.conv_id], key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or "")))
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want, r.conv_id
    for w in windows.where("conv_id = 50 AND (window > 0 OR part > 0)").collect():
        assert chat.parse(w.formatted)[0] == ("system", "turn 0") and (w.n_turns == 1 or w.n_tokens <= 60)
    assert chat.read_back(chat.format_windows(table.limit(0))).count() == 0


def test_chat_query(spark):
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text))
    said = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    rows = queries.op9_chat_formatting(spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == {
        c: summary(sorted(t)) for c, t in turns.items()}


def check_scores(rows, documents):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    texts = [(d, zlib.crc32(str(d).encode()) % 5 == 1 if d is not None else False,
              [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)), None]) for d, t in documents]
    counts = collections.Counter(w for _, h, ws in texts if not h for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = collections.Counter()
    for d, h, ws in texts:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        want[(d, h, len(ws), sum(w in counts for w in ws), total, round(base, 6))] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want


def test_lm_query(spark, documents):
    rows = queries.op6_lm_scoring(spark, SF).collect()
    check_scores(rows, [(r.doc_id, r.text) for r in documents.collect()])
    assert all(r.score < 0 for r in rows)


def test_lm_learns_and_handles_nulls(docs):
    # every second word follows from the one before
    rnd = random.Random(1)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rnd.randint(0, 20)} {'xy'[i % 2]}" for _ in range(200))) for i in range(80)]
    rows += [(500, None), (500, ""), (None, "a1 x"), (7, rows[7][1]), (501, "q" * 30_000)]
    out = lm.score(docs(rows)).collect()
    check_scores(out, rows)
    held = [r for r in out if r.held_out and r.n_tokens > 100]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.score(docs([])).count() == 0


def test_lm_probabilities_sum_to_one(docs):
    table = docs([(i, "a b c a b d " * 5) for i in range(2, 30)])
    cells = lm.count_tokens(table).cells
    model = lm.Shard(cells)
    model.train([np.full(50, i, np.uint16) for i in range(lm.TEMPLATES)], np.arange(50) % cells.side ** 2)
    every = np.arange(cells.side ** 2)
    assert math.isclose((10 ** model.log10([np.full(every.size, 1, np.uint16)] * lm.TEMPLATES, every)).sum(), 1.0, rel_tol=1e-4)
    known = np.bincount(cells.cell, cells.n + 0.5, minlength=cells.side ** 2)
    assert np.allclose(known + 0.5, cells.mass)


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def one_token_at_a_time(rows, counts, n_shards):
    """Scores by document of the same model, with weights in a dictionary and one token after the other."""
    cells, side = counts.cells, counts.cells.side
    salts = [int(x) for x in lm._SALTS]
    shards, scores = collections.defaultdict(list), {}
    parts = dict(zip(cells.hot.tolist(), cells.parts.tolist()))
    for doc, (key, held, text) in enumerate(rows):
        data = np.frombuffer(text.encode(), np.uint8)
        _, tokens, _, tails = lm._tokens(data, np.array([0, data.size]))
        at, cell = cells.look_up(tokens, tails)
        scores[doc] = 0.0
        tokens = [int(t) for t in tokens]
        for i, (t, c) in enumerate(zip(tokens, cell.tolist())):
            one, two, three = (tokens[i - k] if i >= k else int(lm.START) for k in (1, 2, 3))
            shard = (mixed(one) >> 32) + ((mixed(key << 1 | held) >> 20) % parts[one] if one in parts else 0)
            keys = mixed(one ^ salts[0]), mixed((mixed(one) + two * salts[1]) % 2**64), mixed((mixed(one) + three * salts[2]) % 2**64)
            shards[shard % n_shards].append((doc, held, tuple(k >> 64 - lm.SLOT_BITS for k in keys), c))
            n = cells.n[at[i]] if at[i] >= 0 else 0
            scores[doc] += math.log10((n + 0.5) / cells.mass[c])
    share = cells.mass.reshape(side, side)
    for events in shards.values():
        weights, seen = collections.defaultdict(lambda: np.zeros(side)), collections.defaultdict(lambda: lm.START_SUM)

        def spread(slots, c, weights=weights):
            cls, member = divmod(c, side)
            for kind, base, target in ((0, share.sum(axis=1) / share.sum(), cls), (1, share[cls] / share[cls].sum(), member)):
                rows = [(kind, i, s if not kind else s + cls * 40503 + 12345 & lm.SLOTS - 1) for i, s in enumerate(slots)]
                p = base * np.exp(sum(weights[r] for r in rows))
                yield rows, p / p.sum(), target

        def order(e):
            held = sum(s << lm.SLOT_BITS * i for i, s in enumerate(e[2]))
            return mixed(held ^ mixed(e[3]))

        learn = sorted((e for e in events if not e[1]), key=order)
        for lo in range(0, len(learn), lm.BATCH):
            total = collections.defaultdict(lambda: np.zeros(side))
            for _, _, slots, c in learn[lo:lo + lm.BATCH]:
                for rows, p, target in spread(slots, c):
                    for r in rows:
                        total[r] += np.eye(side)[target] - p
            for r, g in total.items():
                seen[r] += (g * g).sum()
                weights[r] = weights[r] + lm.RATE * g / seen[r] ** 0.5
        for doc, _, slots, c in events:
            scores[doc] += sum(math.log10(p[target]) for _, p, target in spread(slots, c))
    return scores


def test_lm_against_one_token_at_a_time(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 32)
    monkeypatch.setattr(lm, "HOT_TOKENS", 40)
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["aa", "ba", "ca", "the", "xy", f"r{rnd.randint(0, 40)}"]) for _ in range(30))) for i in range(30)]
    table = docs(rows)
    got = {r.doc_id: r.score for r in lm.score(table).collect()}
    counts = lm.count_tokens(table)
    assert counts.cells.parts.max() > 1
    key = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), "text"), 2)
    keys = {r.doc_id: (r.key, r.held, r.text) for r in table.select("doc_id", key.alias("key"), lm.held_out(F.col("doc_id")).alias("held"), "text").collect()}
    want = one_token_at_a_time([keys[d] for d, _ in rows], counts, counts.total // lm.SHARD_TOKENS + 8)
    assert all(math.isclose(got[d], want[i], rel_tol=1e-4) for i, (d, _) in enumerate(rows))


def test_lm_row_maxima():
    """Column by column, as a reduction over each short row took most of a step."""
    z = np.random.default_rng(2).normal(size=(500, 16)).astype(np.float32)
    assert (lm._highest(z) == z.max(axis=1, keepdims=True)).all() and (lm._highest(z[:, :1]) == z[:, :1]).all()


def test_lm_scores_do_not_depend_on_partitions(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = ({r.doc_id: r.score for r in lm.score(table.repartition(n)).collect()} for n in (1, 16))
    assert all(math.isclose(one[d], many[d], rel_tol=1e-9) for d in one)


def test_lm_gains_on_held_out_documents(spark):
    rows = [r for r in queries.op6_lm_scoring(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    model, base = (sum(r[c] for r in rows) / tokens for c in ("score", "base_score"))
    print(f"log10 a token: {base:.3f} by unigram counts, {model:.3f} by the model")
    assert model > base + 0.05


def windows_of(turns, budget, history_turns, history_tokens, part_turns):
    """(part, repeated turns, new turns) of one conversation's ordered (role, text, tokens), one turn after the other."""
    out, system, fresh, shown = [], None, [], []
    for i, turn in enumerate(turns):
        full = fresh and sum(t[2] for t in shown + fresh) + turn[2] > budget
        if full or i % part_turns == 0:
            if fresh:
                out.append(((i - 1) // part_turns, shown, fresh))
            back, room = [], history_tokens
            for j in range(i - 1, max(i - 1 - history_turns, -1), -1):
                if turns[j][2] > room or (system is not None and j == system):
                    break
                back.insert(0, turns[j])
                room -= turns[j][2]
            shown, fresh = ([turns[system]] if system is not None else []) + back, []
        if system is None and turn[0] == "system":
            system = i
        fresh.append(turn)
    return out + ([((len(turns) - 1) // part_turns, shown, fresh)] if fresh else [])


def test_windows_of_long_conversations_against_one_turn_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_TURNS", 16)
    rnd = random.Random(8)
    word = lambda: "w" * rnd.randint(1, 3)
    rows = []
    for conv, n in ((1, 16), (2, 17), (3, 100), (4, 5), (5, 64), (None, 40)):
        for i in range(n):
            role = "system" if (conv, i) in ((2, 0), (3, 20), (5, 15)) else ("user", "assistant")[i % 2]
            # conversation 5 has one turn number only: its turns go by role and text
            rows.append((conv, 7 if conv == 5 else i, role, f"{i:03d} " + " ".join(word() for _ in range(rnd.randint(0, 9)))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumns({"part": F.lit(1), "kind": F.lit("x"), "pos": F.lit(0)})
    got = {}
    for w in chat.format_windows(df, budget=60, history_tokens=30).orderBy("part", "window").collect():
        turns = chat.parse(w.formatted)
        got.setdefault(w.conv_id, []).append((w.part, turns[:w.n_repeated], turns[w.n_repeated:]))
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv))
        turns = [(role, text, len(re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]", text)) + chat.TURN_TOKENS) for _, role, text in mine]
        plain = lambda ts: [t[:2] for t in ts]
        assert got[conv] == [(p, plain(a), plain(b)) for p, a, b in windows_of(turns, 60, 2, 30, 16)]
