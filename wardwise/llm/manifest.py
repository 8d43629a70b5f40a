"""Merkle dataset manifest: a tree of fan-out 8 per language, a tree over their roots, and proofs by a recursive query.

Leaves are placed by a range partitioning on (lang, doc_id) and running counts of the partitions, so no language
has to fit one task. Every level is built from the one below by one grouping of at most FAN neighbours and
stored as parent-linked rows: a node, its children's digests in order, and its place in its own parent. The climb is
one recursive query over these rows. It starts at the runs of leaves, one row for the up to FAN leaves that have
all higher siblings in common, and at each level appends the siblings to the proof and folds every leaf's
digest, as found now, with them. Nodes near the root, which all climbs meet, are stored once per lane of LANE
runs, so that no join key has more rows than a lane.

Digests are 32 bytes in tables and hex text wherever they are hashed.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise.session import Temporary, materialize

FAN = 8
#: Runs of leaves that share one copy of the nodes above them.
LANE = 64
#: Tables with a row per language or per partition are broadcast up to so many rows (of some 100 bytes).
MOST_BROADCAST = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(digests: Column) -> Column:
    """H of digests in binary, which are hashed as hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def leaf_digest(**fields: Column) -> Column:
    """H of FIELDS, each `-` if null, else its UTF-8 byte count, `:` and its value; fields replace columns."""
    def part(name: str) -> Column:
        value = fields.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, FIELDS)), 256))


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, _UPPER, _LOWER)


@dataclass
class Manifest:
    """`runs`: neighbouring leaves; `nodes`: what stands above them; `trees`: one row per language.

    runs (tree, run, members array<struct(slot, doc_id, leaf, found)>, digests, single, up_*); nodes (tree, level, pos, lane_tree,
    lane, digests, up_*), digests being the children's in order and up_* the parent's key and the place
    in it; trees (tree, lang, n, n_runs, subroot). root is None where there are no leaves.
    """

    runs: DataFrame
    nodes: DataFrame | None
    trees: DataFrame
    root: bytes | None
    n_trees: int


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MOST_BROADCAST else df


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(leaves with tree and pos, trees, their number); trees number the languages bytewise, null first."""
    tie = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 16))  # equal rows may be many
    order = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("_tie")]
    laid = materialize(leaves.withColumn("_tie", tie).repartitionByRange(*order).sortWithinPartitions(*order)
                       .drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "laid")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition
    shift = laid.groupBy(part.alias("_part")).count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    shift = materialize(shift, "shift")
    placed = laid.join(F.broadcast(shift), part == F.col("_part")).withColumn("_row", F.col("_shift") + row)
    # a row per language
    trees = placed.groupBy("lang").agg(F.min("_row").alias("start"), F.count(F.lit(1)).alias("n")).withColumn(
        "tree", (F.row_number().over(Window.orderBy("start")) - 1).cast("long"))
    trees = materialize(trees.withColumn("n_runs", F.ceil(F.col("n") / FAN).cast("long")), "trees")
    n_trees = trees.count()
    side = _small(trees.select(F.col("lang").alias("_lang"), "tree", "start", "n"), n_trees)
    out = placed.join(side, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "tree", (F.col("_row") - F.col("start")).alias("pos"), "n", "doc_id", "leaf", "found")
    return out, trees, n_trees


def _joined(children: Column) -> Column:
    return F.aggregate(children, F.lit(b""), lambda a, x: F.concat(a, x))


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """Levels (tree, pos, digests, node, n) above nodes (tree, pos, node, n), until every tree has one node."""
    out, below = [], nodes
    while not (several := below.where("n > 1")).isEmpty():
        above = several.groupBy("tree", F.floor(F.col("pos") / FAN).alias("pos")).agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("c"))
        above = above.select("tree", "pos", F.ceil(F.col("n") / FAN).cast("long").alias("n"), _joined(F.col("c.node")).alias("digests"))
        below = materialize(above.withColumn("node", hashed(F.col("digests"))), "level")
        out.append(below)
    return out


def _linked(rows: DataFrame, level: int, several: bool) -> DataFrame:
    """up_*: the next level of the tree; from its only node, if there are several trees, the tree of trees (-1)."""
    own, top = F.col("n") > 1, F.lit(several)
    at = F.col("run" if "run" in rows.columns else "pos")
    pick = lambda inside, over: F.when(own, inside).when(top & (F.col("tree") >= 0), over).cast("long")
    return rows.withColumns({
        "up_tree": pick(F.col("tree"), F.lit(-1)), "up_level": pick(F.lit(level + 1), F.lit(1)),
        "up_pos": pick(F.floor(at / FAN), F.floor(F.col("tree") / FAN)),
        "up_slot": pick(at % FAN, F.col("tree") % FAN)})


def build(leaves: DataFrame) -> Manifest:
    """The manifest of leaves (doc_id, lang, leaf, found), digests in binary; found is what a check reads now.

    Leaves of one language ascend by doc_id, null first, then by digest. Repeated rows are leaves of their own.
    """
    placed, trees, n_trees = _placed(leaves.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "leaf", "found"))
    runs = placed.groupBy("tree", F.floor(F.col("pos") / FAN).alias("run")).agg(
        F.first("n").alias("n_leaves"), F.sort_array(F.collect_list(F.struct(
            F.col("pos").alias("slot"), "doc_id", "leaf", "found"))).alias("members"))
    single = F.col("n_leaves") == 1  # a language's only leaf is its root, unhashed
    runs = runs.withColumns({"single": single, "digests": _joined(F.col("members.leaf")),
                             "n": F.ceil(F.col("n_leaves") / FAN).cast("long")})
    runs = materialize(_linked(runs.withColumn("node", F.when(single, F.col("digests")).otherwise(hashed(F.col("digests")))),
                               1, n_trees > 1), "runs")
    first = runs.select("tree", F.col("run").alias("pos"), "node", "n")
    levels = _levels(first)
    subroots = reduce(DataFrame.unionByName, [x.where("n = 1").select("tree", F.col("node").alias("subroot")) for x in [first, *levels]])
    trees = materialize(trees.join(subroots, "tree").select("tree", "lang", "n", "n_runs", "subroot"), "subroots")
    if not n_trees:
        return Manifest(runs, None, trees, None, 0)

    span = lambda low, width, most: F.explode(F.sequence(low, F.least(low + (width - 1), most - 1)))
    stored = []
    for i, rows in enumerate(levels):
        size = trees.select(F.col("tree").alias("_tree"), "n_runs")
        linked = _linked(rows, i + 2, n_trees > 1).join(_small(size, n_trees), F.col("tree") == F.col("_tree"))
        lanes = F.ceil(F.col("n_runs") / LANE).cast("long")
        first_lane = F.floor(F.col("pos") * FAN ** (i + 1) / LANE).cast("long")
        stored.append(linked.withColumns({"level": F.lit(i + 2).cast("long"), "lane_tree": F.col("tree")}).withColumn(
            "lane", span(first_lane, max(1, FAN ** (i + 1) // LANE), lanes)))
    top = trees.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("node"),
                       F.lit(n_trees).cast("long").alias("n"))
    upper = _levels(top)
    for i, rows in enumerate(upper):
        over = _linked(rows, i + 1, False).withColumns({"level": F.lit(i + 1).cast("long")}).withColumn(
            "lane_tree", span(F.col("pos") * FAN ** (i + 1), FAN ** (i + 1), F.lit(n_trees).cast("long")))
        size = trees.select(F.col("tree").alias("_tree"), "n_runs")
        stored.append(over.join(_small(size, n_trees), F.col("lane_tree") == F.col("_tree")).withColumn(
            "lane", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n_runs") / LANE).cast("long") - 1))))
    names = ["tree", "level", "pos", "lane_tree", "lane", "digests", "up_tree", "up_level", "up_pos", "up_slot"]
    nodes = materialize(reduce(DataFrame.unionByName, [x.select(*names) for x in stored]), "nodes") if stored else None
    root = (upper[-1] if upper else trees.select(F.col("subroot").alias("node"))).select("node").first()[0]
    return Manifest(runs, nodes, trees, bytes(root), n_trees)


def _left(digests: Column, slot: Column) -> Column:
    return F.substring(digests, F.lit(1), (32 * slot).cast("int"))


def _right(digests: Column, slot: Column) -> Column:
    return F.substring(digests, (32 * slot + 33).cast("int"), F.lit(32 * FAN))


def _folded(digests: Column, slot: Column, own: Column) -> Column:
    return hashed(F.concat(_left(digests, slot), own, _right(digests, slot)))


@contextmanager
def _unlimited(spark: SparkSession):
    """Spark stops a recursion at a million rows by default; levels keep their limit."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_CLIMB = """
WITH RECURSIVE climb(lane_tree, lane, run, up_tree, up_level, up_pos, up_slot, proof, folded) AS (
  SELECT lane_tree, lane, run, up_tree, up_level, up_pos, up_slot, proof, folded FROM {starts}
  UNION ALL
  SELECT c.lane_tree, c.lane, c.run, p.up_tree, p.up_level, p.up_pos, p.up_slot,
         concat(c.proof, substring(p.digests, 1, CAST(32 * c.up_slot AS INT)),
                substring(p.digests, CAST(32 * c.up_slot + 33 AS INT), {most})),
         transform(c.folded, d -> unhex(sha2(lower(hex(concat(
             substring(p.digests, 1, CAST(32 * c.up_slot AS INT)), d,
             substring(p.digests, CAST(32 * c.up_slot + 33 AS INT), {most})))), 256)))
  FROM climb c JOIN {nodes} p
    ON c.up_tree = p.tree AND c.up_level = p.level AND c.up_pos = p.pos AND c.lane_tree = p.lane_tree AND c.lane = p.lane
)
SELECT lane_tree, run, proof, folded FROM climb WHERE up_tree IS NULL
"""


def climb(manifest: Manifest) -> DataFrame:
    """Rows (doc_id, lang, leaf, subroot, root, proof, folded_root, verified), one per leaf.

    proof is the siblings' digests in binary, level by level and left to right; folded_root the root that
    found and the siblings give; all other digests are lowercase hex. verified is their equality.
    """
    spark = manifest.runs.sparkSession
    slot = lambda m: m["slot"] % FAN
    starts = manifest.runs.withColumns({
        "lane_tree": F.col("tree"), "lane": F.floor(F.col("run") / LANE).cast("long"), "proof": F.lit(b""),
        "folded": F.when(F.col("single"), F.col("members.found")).otherwise(F.transform(
            "members", lambda m: _folded(F.col("digests"), slot(m), m["found"])))})
    if manifest.nodes is None:
        done = starts.select("lane_tree", F.col("run").alias("_run"), "proof", "folded")
    else:
        views = {"starts": starts, "nodes": manifest.nodes}
        names = {k: f"manifest_{k}_{id(manifest):x}" for k in views}
        for k, df in views.items():
            df.createOrReplaceTempView(names[k])
        try:
            with _unlimited(spark):
                done = materialize(spark.sql(_CLIMB.format(most=32 * FAN, **names)).withColumnRenamed("run", "_run"), "climbed")
        finally:
            for name in names.values():
                spark.catalog.dropTempView(name)
    hexed = lambda c: F.lower(F.hex(c))
    subs = _small(manifest.trees.select(F.col("tree").alias("_tree"), "lang", "subroot"), manifest.n_trees)
    one = manifest.runs.join(done, (F.col("tree") == F.col("lane_tree")) & (F.col("run") == F.col("_run"))).select(
        "tree", "digests", "proof", F.posexplode(F.arrays_zip("members", "folded")).alias("_i", "m"))
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    m, at = F.col("m.members"), F.col("_i")
    return one.join(subs, F.col("tree") == F.col("_tree")).select(
        m["doc_id"].alias("doc_id"), "lang", hexed(m["leaf"]).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.concat(_left(F.col("digests"), at), _right(F.col("digests"), at), F.col("proof")).alias("proof"),
        hexed(F.col("m.folded")).alias("folded_root"), (hexed(F.col("m.folded")) == root).alias("verified"))


def verify(docs: DataFrame, found_text: Column | None = None) -> DataFrame:
    """Manifest of docs (FIELDS; other columns are ignored) and proof of every row: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    found_text is the text that a check reads now, by default the text itself. Null fields are told apart from
    empty ones; a null lang is a tree of its own, the first; rows of a null doc_id come first in theirs. Repeated
    rows are leaves of their own, next to one another. An empty table gives no rows. No text is held beyond
    its row.
    """
    with Temporary(docs.sparkSession) as tables:
        leaf = leaf_digest()
        found = leaf if found_text is None else F.when(found_text.eqNullSafe(F.col("text")), leaf).otherwise(leaf_digest(text=found_text))
        leaves = docs.select(*FIELDS).select("doc_id", "lang", leaf.alias("leaf"), found.alias("found"))
        return tables.keep(climb(build(leaves)).select(
            "doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
            "folded_root", "verified"), "verified")
