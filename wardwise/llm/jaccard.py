"""N-gram Jaccard join over a token-group matrix.

Texts become sets of hashed word shingles. Similar sets are gathered into groups: sets with a min-hash band
in common are compared, by their least hashes, with the band's first set, and those not far from it join its
group; a set that joins several makes them one. The matrix holds, for every token of the sets' prefixes (their rarest tokens), the groups whose
union has it, with the group's least and largest set and the token's first place. A set queries it with its
prefix: only other groups whose size and place bounds leave room for the asked overlap are opened, and
their sets with the token are compared exactly. The prefix is long enough that no link is lost,
whatever the groups.

Inside a group every set is kept as its difference from the group's centre: the tokens that most members
have. Sets are compared by their differences alone, as two sets differ by what their differences differ
by. Sets whose differences are small together are linked without a look, one edge per set joins them.
The others, open ones, first test a few sets with a similar difference; what is linked is contracted.
Then a prefix join over the differences, rarest tokens first, finds what can still link different
components: the tokens of two such differences must overlap by half of what they exceed the threshold by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise.llm import words as W
from wardwise.llm.graph import components, merged
from wardwise.llm.rows import MOST_BROADCAST, observed, spread_join, text_id, without
from wardwise.session import Temporary, materialize

SKETCH_BITS = 20
BANDS, ROWS = 6, 3
#: Hundredths of similarity below the asked ones that still bring a set into a group.
APART = 50
#: Least rows of a group whose centre is taken from its members' differences.
CENTRED = 8
#: Ways in which an open set looks for another with a similar difference.
TRIES = 3
#: Arrow rows are handled in slices of about so many bytes.
SLICE = 1 << 22
#: Buckets of a set's tally.
TALLY = 512
#: Sets of a group that meet one copy of its pivot's set.
SET_ROWS = 128
_SEEDS = np.random.default_rng(7).integers(1, 2**63, (BANDS * ROWS, 2), dtype=np.uint64) | np.uint64(1)


def _sets(batches: Iterator[pa.RecordBatch], k: int):
    """(rows, tokens, bounds): each text's distinct shingle hashes, ascending."""
    for rows, buf, offsets in W.pieces(batches):
        w = W.Words(buf, offsets, W.NOT_SPACE, W.FOLDED)
        at, tokens = w.runs(k)
        counts = w.counts
        bounds = np.searchsorted(at, w.first)
        few = np.flatnonzero((counts > 0) & (counts < k))
        if few.size:
            short = W.mix(w.text_hashes()[few] + counts[few].astype(np.uint64))
            tokens = np.insert(tokens, bounds[few], short)
            bounds = bounds + np.concatenate([[0], np.cumsum((counts > 0) & (counts < k))])
        for a, b in zip(bounds[:-1], bounds[1:]):
            tokens[a:b].sort()
        new = np.ones(tokens.size, bool)
        new[1:] = tokens[1:] != tokens[:-1]
        new[bounds[:-1][bounds[:-1] < tokens.size]] = True
        kept = np.concatenate([[0], np.cumsum(new)])
        yield rows, tokens[new], kept[bounds]


def _signatures(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return W.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def _profile(k: int):
    """Per text its set's size, signature, bands and least hashes; per task the tokens by sketch bucket."""
    schema = "doc_id long, text_id long, n long, sig long, bands array<long>, mins array<short>, buckets array<long>"

    names = ["doc_id", "text_id", "n", "sig", "bands", "mins", "buckets"]

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for rows, tokens, bounds in _sets(batches, k):
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            bands, mins = np.zeros((len(n), BANDS), np.uint64), np.zeros((len(n), BANDS * ROWS), np.int16)
            if full.size:
                for i, (a, b) in enumerate(_SEEDS):
                    low = np.minimum.reduceat(W.mix((tokens ^ a) * b), bounds[:-1][full])
                    bands[full, i // ROWS] = W.mix(bands[full, i // ROWS] * np.uint64(31) + low + np.uint64(i // ROWS))
                    mins[full, i] = (low & np.uint64(0x7FFF)).astype(np.int16)
            np.add.at(sketch, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            m = len(n)
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), rows.column("text_id"), pa.array(n, pa.int64()),
                pa.array(W.signed(_signatures(tokens, bounds))),
                W.listed(W.signed(bands.ravel()), np.arange(m + 1) * BANDS, pa.int64()),
                W.listed(mins.ravel(), np.arange(m + 1) * BANDS * ROWS, pa.int16()),
                pa.nulls(m, pa.list_(pa.int64()))], names)
        used = np.flatnonzero(sketch)
        for part in np.array_split(used, max(1, used.size // 4096)):
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int16())),
                pa.array([(part << 40) | np.minimum(sketch[part], (1 << 40) - 1)], pa.list_(pa.int64()))], names)

    return run, schema


def _prefixes(k: int, percent: int, rarity):
    """Per text with room for a different partner, its set's rarest tokens, rarest first."""
    schema = "sig long, n long, tokens array<long>"

    def run(batches):
        order = rarity.value
        for _, tokens, bounds in _sets(batches, k):
            n = np.diff(bounds)
            length = np.where(100 * n >= percent * (n + 1), n - (percent * n + 99) // 100 + 1, 0)
            keys = (order[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(40)) | (
                tokens & np.uint64((1 << 40) - 1))
            picked = np.flatnonzero(length)
            chosen = [tokens[a:b][np.argsort(keys[a:b], kind="stable")[:m]] for a, b, m in zip(
                bounds[:-1][picked], bounds[1:][picked], length[picked])]
            yield pa.RecordBatch.from_arrays([
                pa.array(W.signed(_signatures(tokens, bounds)[picked])), pa.array(n[picked], pa.int64()),
                W.listed(W.signed(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64),
                         np.concatenate([[0], np.cumsum(length[picked])]), pa.int64())], ["sig", "n", "tokens"])

    return run, schema


def _whole_sets(k: int, carried: list[str]):
    """(sig, tokens, carried columns) of the rows whose set has the signature `wanted`; a task gives each once."""
    schema = "sig long, tokens binary" + "".join(f", {c} long" for c in carried)

    def run(batches):
        seen = set()
        for rows, tokens, bounds in _sets(batches, k):
            sigs, new = W.signed(_signatures(tokens, bounds)), []
            for i, (sig, wanted) in enumerate(zip(sigs.tolist(), rows.column("wanted").to_pylist())):
                if sig == wanted and sig not in seen:
                    seen.add(sig)
                    new.append(i)
            yield pa.RecordBatch.from_arrays([
                pa.array(sigs[new], pa.int64()), pa.array([tokens[bounds[i]:bounds[i + 1]].tobytes() for i in new], pa.binary()),
                *(rows.column(c).take(pa.array(new, pa.int64())) for c in carried)], ["sig", "tokens", *carried])

    return run, schema


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, batch.num_rows * SLICE // max(batch.nbytes, 1))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def _linked(percent: int):
    """The pairs (a, b) whose whole sets x and y are as similar as asked."""
    def run(batches):
        for batch in _sliced(batches):
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.intersect1d(x, y, assume_unique=True).size
                keep.append(100 * both >= percent * (x.size + y.size - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets_of(texts: DataFrame, classes: DataFrame, wanted: DataFrame, k: int, carried: list[str] | None = None) -> DataFrame:
    """The whole sets (sig, tokens) of some signatures and the columns they come with, read again from one
    text of each class; a few times where a row is repeated as a whole."""
    carried = carried or []
    ids = materialize(classes.join(wanted, "sig").select(
        F.col("rep.doc_id").alias("_id"), F.col("rep.text_id").alias("_text"), F.col("sig").alias("wanted"), *carried), "ids")
    side = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    run, schema = _whole_sets(k, carried)
    met = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_id() == F.col("_text"))
    return texts.join(side, met).select("text", "wanted", *carried).mapInArrow(run, schema)


def _counted(pairs: DataFrame, column: str) -> DataFrame:
    return pairs.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, n, tally): how many tokens of a set are in each of TALLY buckets, modulo 256."""
    for batch in _sliced(batches):
        tallies, n = [], []
        for tokens in batch.column("tokens"):
            tokens = np.frombuffer(tokens.as_buffer(), np.uint64)
            n.append(tokens.size)
            tallies.append(np.bincount((W.mix(tokens) % np.uint64(TALLY)).astype(np.int64), minlength=TALLY).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(n, pa.int64()), pa.array(tallies, pa.binary())], ["sig", "n", "tally"])


def _may_link(percent: int):
    """The pairs whose sets may differ little enough: buckets differ by no more than the sets do."""
    def run(batches):
        for batch in _sliced(batches):
            keep = []
            for n, m, x, y in zip(batch.column("n").to_pylist(), batch.column("m").to_pylist(), batch.column("x"), batch.column("y")):
                apart = np.frombuffer(x.as_buffer(), np.uint8) - np.frombuffer(y.as_buffer(), np.uint8)
                least = np.minimum(apart, 0 - apart).sum(dtype=np.int64)
                keep.append((100 + percent) * least <= (100 - percent) * (n + m))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The written pairs (a, b) of signatures whose written sets are as similar as asked."""
    tallies = materialize(sets.mapInArrow(_tallied, "sig long, n long, tally binary").dropDuplicates(["sig"]), "tallies")
    x = tallies.select(F.col("sig").alias("a"), "n", F.col("tally").alias("x"))
    y = tallies.select(F.col("sig").alias("b"), F.col("n").alias("m"), F.col("tally").alias("y"))
    met = spread_join(spread_join(pairs, x, ["a"], _counted(pairs, "a")), y, ["b"], _counted(pairs, "b"))
    pairs = materialize(met.select("a", "b", "n", "m", "x", "y").mapInArrow(_may_link(percent), "a long, b long"), "near")
    x = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("y"))
    met = spread_join(spread_join(pairs, x, ["a"], _counted(pairs, "a")), y, ["b"], _counted(pairs, "b"))
    return met.select("a", "b", "x", "y").mapInArrow(_linked(percent), "a long, b long")


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that a set has and its pivot has not, and, as complements, the other way round."""
    for batch in _sliced(batches):
        found, n = [], []
        for x, y in zip(batch.column("tokens"), batch.column("pivot")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            found.append(np.concatenate([np.setdiff1d(x, y, True), ~np.setdiff1d(y, x, True)]))
            n.append(x.size)
        bounds = np.concatenate([[0], np.cumsum([f.size for f in found])])
        yield pa.RecordBatch.from_arrays([
            batch.column("group"), batch.column("sig"), batch.column("members"), pa.array(n, pa.int64()),
            W.listed(W.signed(np.concatenate(found or [np.zeros(0, np.uint64)])), bounds, pa.int64())],
            ["group", "sig", "members", "n", "delta"])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds) of a list column without nulls."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]], bounds - bounds[0]


def _near(percent: int):
    """The pairs (a, b) of sizes n and m whose differences dx and dy differ little enough."""
    def run(batches):
        for batch in _sliced(batches):
            dx, bx = _lists(batch.column("dx"))
            dy, by = _lists(batch.column("dy"))
            keep = []
            for i, both in enumerate(zip(batch.column("n").to_pylist(), batch.column("m").to_pylist())):
                apart = np.setxor1d(dx[bx[i]:bx[i + 1]], dy[by[i]:by[i + 1]], assume_unique=True).size
                keep.append((100 + percent) * apart <= (100 - percent) * sum(both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _tested(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The written pairs (a, b) of sets of one group that are linked, told by their differences."""
    x = held.select(F.col("sig").alias("a"), "n", F.col("delta").alias("dx"))
    y = held.select(F.col("sig").alias("b"), F.col("n").alias("m"), F.col("delta").alias("dy"))
    met = spread_join(spread_join(pairs, x, ["a"], _counted(pairs, "a")), y, ["b"], _counted(pairs, "b"))
    return met.select("a", "b", "n", "m", "dx", "dy").mapInArrow(_near(percent), "a long, b long")


def _sketch(rows: DataFrame) -> np.ndarray:
    """Counts by bucket from rows (b, n), at most one per bucket after the sum."""
    order = np.zeros(1 << SKETCH_BITS, np.uint32)
    seen = rows.groupBy("b").agg(F.least(F.sum("n"), F.lit((1 << 24) - 1)).cast("int").alias("n")).toArrow()
    order[seen["b"].to_numpy()] = seen["n"].to_numpy()
    return order


def _places(held: DataFrame, percent: int) -> DataFrame:
    """Rows (group, token, sig, n, size, e, pos, core, comp): the rarest tokens of every difference.

    A set whose partners need `o` tokens in common takes all but its o - 1 commonest ones. Tokens that no two
    sets have which could still be linked (of two components, one of them open) come first and are left out.
    """
    need = F.ceil(F.when(F.col("core"), F.col("e") - F.col("e0") + 1).otherwise(F.col("e") + F.col("e0")) / (2 * (100 + percent)))
    tokens = held.select("group", "sig", "n", F.size("delta").cast("long").alias("size"), "e", "core", "comp",
                         F.greatest(F.lit(1), need).alias("need"), F.explode("delta").alias("token"))
    shared = materialize(tokens.groupBy("group", "token").agg(
        F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.bool_and("core").alias("closed"))
        .where("lo < hi AND NOT closed").select("group", "token", "n"), "shared")
    useful = spread_join(tokens, shared.select("group", "token", F.col("n").alias("often")), ["group", "token"], shared)
    mine = Window.partitionBy("sig")
    pos = F.col("size") - F.count(F.lit(1)).over(mine) + F.row_number().over(mine.orderBy("often", "token")) - 1
    return useful.withColumn("pos", pos).where("pos <= size - need").select("group", "token", "sig", "n", "size", "e", "pos", "core", "comp")


def _salted(seed: int):
    return lambda token: F.xxhash64(token, F.lit(seed))


def _centred(differ: DataFrame) -> DataFrame:
    """Differences from the tokens that most members of a group have, instead of from its pivot."""
    often = (differ.where(F.col("members") >= CENTRED).select("group", "members", F.explode("delta").alias("token"))
             .groupBy("group", "token").agg(F.count(F.lit(1)).alias("n"), F.first("members").alias("members"))
             .where("2 * n > members"))
    # at most twice as many tokens as a member's difference has in the mean
    centre = materialize(often.groupBy("group").agg(F.collect_list("token").alias("shift"), F.first("members").alias("n")), "centres")
    moved = spread_join(differ, centre.select("group", "shift"), ["group"], centre, "left")
    shift = F.coalesce("shift", F.array().cast("array<long>"))
    return materialize(moved.withColumn("delta", F.concat(F.array_except("delta", shift), F.array_except(shift, F.col("delta")))).drop("shift"), "centred")


def _inside(groups: DataFrame, texts: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Components (id, root) of what is linked within the groups.

    Sets differ by at most |dx| + |dy|, their differences from the centre, and are linked if they differ by
    at most (1 - t) / (1 + t) of n + m. With e = |d| - (1 - t) / (1 + t) n (here times 100 + percent) that holds
    if the e's sum up to 0 or less; else the differences share at least half the sum, rounded up.
    """
    of = groups.select(F.col("root").alias("group"), F.col("id").alias("sig"))
    of = materialize(of.union(of.select("group", F.col("group").alias("sig")).distinct()), "of")
    sizes = materialize(of.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sized = spread_join(of, sizes.select("group", F.col("n").alias("members")), ["group"], sizes)
    x = _sets_of(texts, classes, sized, k, ["group", "members"])
    pivot = _sets_of(texts, classes, sizes.select(F.col("group").alias("sig")), k).select(
        F.col("sig").alias("group"), F.col("tokens").alias("pivot"))
    differ = spread_join(x, pivot, ["group"], sizes, key_rows=SET_ROWS).mapInArrow(
        _differences, "group long, sig long, members long, n long, delta array<long>")
    differ = _centred(materialize(differ.dropDuplicates(["sig"]), "differences")).withColumn(
        "e", (100 + percent) * F.size("delta").cast("long") - (100 - percent) * F.col("n"))

    least = materialize(differ.groupBy("group").agg(
        F.min(F.struct("e", "sig")).alias("l"), F.max("e").alias("worst"), F.count(F.lit(1)).alias("n"))
        .select("group", F.col("l.e").alias("e0"), F.col("l.sig").alias("sig0"), "worst", "n"), "least")
    told = spread_join(differ.select("group", "sig", "e"), least.select("group", "e0", "sig0"), ["group"], least)
    edges = materialize(told.where("e + e0 <= 0 AND sig <> sig0").select(F.col("sig").alias("a"), F.col("sig0").alias("b")), "near")
    # groups with open sets
    unsure = least.where("worst + e0 > 0")
    held = materialize(spread_join(differ, unsure.select("group", "e0", "sig0"), ["group"], unsure).withColumn(
        "core", F.col("e") + F.col("e0") <= 0), "held")
    if held.isEmpty():
        return components(edges)

    # each open set tests the set of least difference, and those that share the least hash of their differences
    tries = F.array(*(F.array_min(F.transform("delta", _salted(i))) for i in range(TRIES)))
    keyed = held.where("size(delta) > 0").select("group", "sig", "e", "core", F.posexplode(tries).alias("way", "key"))
    heads = materialize(keyed.groupBy("group", "way", "key").agg(
        F.min(F.struct("e", "sig")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "group", "way", "key", F.col("h.sig").alias("head"), "n"), "heads")
    similar = spread_join(keyed, heads.select("group", "way", "key", "head"), ["group", "way", "key"], heads).where(
        "NOT core AND sig <> head").select(F.col("sig").alias("a"), F.col("head").alias("b"))
    tests = held.where("NOT core AND sig <> sig0").select(F.col("sig").alias("a"), F.col("sig0").alias("b")).union(similar)
    found = _tested(materialize(tests.distinct(), "tests"), held, percent)
    roots = materialize(components(edges.union(found)), "contracted")

    # what is still apart
    named = roots.select(F.col("id").alias("sig"), "root")
    held = materialize(held.join(named, "sig", "left").withColumn("comp", F.coalesce("root", "sig")).drop("root"), "apart")
    places = materialize(_places(held, percent), "places")
    other = places.select("group", "token", *(F.col(c).alias(f"{c}2") for c in ("sig", "n", "size", "e", "pos", "core", "comp")))
    # sets whose differences differ much in size are that far apart themselves
    two = 2 * (100 + percent)
    met = places.join(other, ["group", "token"]).where(
        f"sig < sig2 AND comp <> comp2 AND NOT (core AND core2) AND e + e2 > 0 AND 100 * n >= {percent} * n2 AND 100 * n2 >= {percent} * n AND "
        f"(100 + {percent}) * abs(size - size2) <= (100 - {percent}) * (n + n2) AND 1 + least(size - pos - 1, size2 - pos2 - 1) >= ceil((e + e2) / {two})")
    pairs, seen = observed(met.select(F.col("sig").alias("a"), F.col("sig2").alias("b")).distinct(), "inner", n=F.count(F.lit(1)))
    return merged(roots, materialize(_tested(pairs, held, percent), "inside")) if seen["n"] else roots


def jaccard_groups(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, component_key, text_id), one per row of docs (doc_id, text).

    Links join texts whose sets of `shingle` consecutive words overlap in at least `percent` hundredths
    of their union; component_id is the least doc_id reachable. A text with fewer words is one shingle;
    a null or empty text has none and is its own component. Equal sets are one class, compared once; repeated
    rows are rows of one class. Other columns of docs are not read. Hashes have 64 bits.
    """
    with Temporary(docs.sparkSession) as tables:
        return tables.keep(_groups(docs, shingle, percent), "groups")


def _groups(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    run, schema = _profile(shingle)
    profile = materialize(texts.withColumn("text_id", text_id()).mapInArrow(run, schema), "profile")
    rows = profile.where("n IS NOT NULL")
    order = _sketch(profile.where("buckets IS NOT NULL").select(F.explode("buckets").alias("x")).select(
        F.shiftright("x", 40).alias("b"), F.col("x").bitwiseAND(F.lit((1 << 40) - 1)).alias("n")))
    classes = materialize(rows.where("n > 0").groupBy("sig").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_id")).alias("rep"), F.first("bands").alias("bands"), F.first("mins").alias("mins"),
        F.count(F.lit(1)).alias("rows")), "classes")

    # prefixes: the tokens that different sets have in common there
    run, schema = _prefixes(shingle, percent, spark.sparkContext.broadcast(order))
    prefixes = materialize(texts.mapInArrow(run, schema), "prefixes")
    # one shuffle by token serves the count and the join
    places = prefixes.select("sig", "n", F.posexplode("tokens").alias("pos", "token")).repartition("token")
    shared = (places.groupBy("token").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi"))
              .where("lo <> hi").select("token"))
    entries = materialize(places.join(shared, "token").distinct(), "entries")

    # groups: sets that meet in a band are compared with the band's first; a set unites the groups of all these
    room = f"100 * n >= {percent} * (n + 1)"
    banded = classes.where(room).select("sig", "mins", F.explode("bands").alias("band"))
    heads = materialize(banded.groupBy("band").agg(F.min(F.struct("sig", "mins")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "band", F.col("h.sig").alias("head"), F.col("h.mins").alias("head_mins"), "n"), "heads")
    same = F.size(F.filter(F.zip_with("mins", "head_mins", lambda x, y: x == y), lambda x: x))
    meets = spread_join(banded, heads.select("band", "head", "head_mins"), ["band"], heads).where(
        (F.col("sig") != F.col("head")) & (100 * same >= max(percent - APART, 20) * BANDS * ROWS))
    groups = materialize(components(meets.select(F.col("sig").alias("b"), F.col("head").alias("a"))), "grouped")
    roots = materialize(_inside(groups, texts, classes, shingle, percent), "roots")

    # the matrix of tokens and groups, queried by every set in it
    member = entries.join(groups.withColumnRenamed("id", "sig"), "sig", "left").withColumn(
        "group", F.coalesce("root", "sig")).drop("root")
    member = member.join(roots.select(F.col("id").alias("sig"), F.col("root").alias("comp")), "sig", "left").withColumn(
        "comp", F.coalesce("comp", "sig"))
    member = member.repartition("token")
    several = member.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi")
    member = materialize(member.join(several.select("token"), "token"), "members")
    matrix = member.groupBy("token", "group").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("place"))
    other = matrix.select("token", F.col("group").alias("other"), "least", "most", "place")
    bound = (f"other < `group` AND 100 * most >= {percent} * n AND 100 * n >= {percent} * least AND "
             f"(100 + {percent}) * (1 + least(n - pos - 1, most - place - 1)) >= {percent} * (n + least)")
    opened = member.join(other, "token").where(bound).select("token", "sig", "n", "pos", "comp", "other")
    inside = member.select("token", F.col("group").alias("other"), F.col("sig").alias("b"), F.col("n").alias("m"),
                           F.col("pos").alias("pos_b"), F.col("comp").alias("comp_b"))
    pairs = materialize(opened.join(inside, ["token", "other"]).where(
        f"comp <> comp_b AND 100 * m >= {percent} * n AND 100 * n >= {percent} * m AND "
        f"(100 + {percent}) * (1 + least(n - pos - 1, m - pos_b - 1)) >= {percent} * (n + m)").select(
        F.col("sig").alias("a"), "b").distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    links = _verified(pairs, materialize(_sets_of(texts, classes, wanted, shingle), "sets"), percent)
    roots = merged(roots, materialize(links, "links"))

    joined = classes.select("sig", "doc_id", "rows").join(roots.withColumnRenamed("id", "sig"), "sig", "left")
    joined = materialize(joined.select("sig", "doc_id", "rows", F.coalesce("root", "sig").alias("root")), "joined")
    least = materialize(joined.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")), "components")
    label = materialize(spread_join(joined, least.select("root", "component_id"), ["root"], least).select(
        "sig", "component_id", "root", F.col("rows").alias("n")), "label")
    full = rows.where("n > 0").select("doc_id", "text_id", F.col("n").alias("n_shingles"), "sig")
    full = spread_join(full, label.select("sig", "component_id", "root"), ["sig"], label)
    names = ["doc_id", "n_shingles", "component_id", "component_key", "text_id"]
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                      F.lit(None).cast("long").alias("component_key"), "text_id")
    return full.withColumnRenamed("root", "component_key").select(names).union(none.select(names))


def first_of_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group: the least doc_id, then text hash. Rows without words all stay.

    Of a row repeated as a whole one stays. Columns of other names stay as they are.
    """
    groups = jaccard_groups(docs, shingle, percent).where("n_shingles > 0")
    first = groups.groupBy("component_key").agg(F.min(F.struct("doc_id", "text_id")).alias("f")).select(
        F.col("f.doc_id").alias("_first_id"), F.col("f.text_id").alias("_first_text"))
    first = materialize(first, "firsts")
    # equal ids and texts are one row here, of one component
    rows = materialize(groups.groupBy("doc_id", "text_id").agg(F.count(F.lit(1)).alias("n")), "rows")
    met = F.col("doc_id").eqNullSafe(F.col("_first_id")) & (F.col("text_id") == F.col("_first_text"))
    kept = without(docs, materialize(rows.join(first, met, "left_anti").select("doc_id", "text_id"), "dropped"))
    copies = materialize(rows.where("n > 1").join(first, met, "left_semi").select("doc_id", "text_id"), "copies")
    if copies.isEmpty():
        return kept
    # whole rows repeated, under one id: one of each
    mine = F.broadcast(copies) if copies.count() <= MOST_BROADCAST else copies
    mine = mine.select(F.col("doc_id").alias("_copy_id"), F.col("text_id").alias("_copy_text"))
    met = F.col("doc_id").eqNullSafe(F.col("_copy_id")) & (text_id() == F.col("_copy_text"))
    return without(kept, copies).unionByName(kept.join(mine, met, "left_semi").dropDuplicates(["doc_id", "text"]))
