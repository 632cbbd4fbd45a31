"""A Merkle manifest of a table: digests, inclusion proofs and their verification (operator 11).

Leaves are digests of rows. Every tree (one per language) takes its leaves in ascending order of id; ``RUN`` consecutive
nodes become the digest of their joined hexadecimal text until one is left, the subroot. The subroots, in order of
language, become the root the same way.

Checkpoint and recompute: only the leaves and every ``LEVELS``-th level above them are written. A node of a written level
covers an aligned subtree of ``SPAN`` nodes of the level below. Extracting proofs takes one row per aligned subtree, builds
its missing levels anew from the written nodes, hands every node its siblings and drops the levels again. The siblings
above a subtree come down as one row per subtree, so no row of the table meets more than its own subtree.

Texts are read once and don't travel; only digests are shuffled. Rows are numbered by range partition: rank inside it,
plus offsets from one row per partition and tree, so a tree with most of the rows is still spread.

Defined cases: a null field is "-", an empty text "0:"; a null language has a tree of its own, before all others; rows
without id come first; rows that repeat an id are ordered by their digests, equal rows are leaves each; a lone leaf is
its own subroot and has an empty proof inside its tree; an empty table has no root and no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.base import saved

RUN, LEVELS = 8, 3
SPAN = RUN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ABOVE = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """Length in bytes and value, or "-"."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    """The digest of a row, with other values in the place of some fields."""
    return digest(F.concat(*[field(changed.get(f, F.col(f))) for f in FIELDS]))


@dataclass(frozen=True)
class Manifest:
    """Written levels: ``levels[0]`` are the leaves, with what is carried beside them, ``levels[k]`` the nodes ``LEVELS * k`` above.

    Columns of all: tree, pos, n (nodes of this level in the tree), digest. ``trees`` is the manifest of the subroots,
    whose leaves carry the name of their tree; it is None in the manifest of the subroots itself.
    """

    levels: tuple[DataFrame, ...]
    trees: Manifest | None

    @property
    def subroots(self) -> DataFrame:
        return self.levels[-1].select("tree", F.col("digest").alias("subroot"))

    @property
    def root(self) -> DataFrame:
        """One row, none for an empty table."""
        return (self.trees or self).levels[-1].select(F.col("digest").alias("root"))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds pos, the place of a row in its tree, and n, the rows of the tree. ``rows`` has to be a written table."""
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    at = saved(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-ordered").withColumn("_part", F.shiftright("_at", 33))
    sizes = at.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy("tree").orderBy("_part")
    offsets = saved(sizes.select(
        "tree", "_part", (F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("n"),
    ), "merkle-offsets")
    return at.join(offsets, ["tree", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _rise(n: Column) -> Column:
    """Levels between a written one of n nodes and the next: all, or as many as leave one node."""
    level = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        level = F.when(n <= RUN**k, F.lit(k)).otherwise(level)
    return level


def _raised(nodes: Column) -> Column:
    """The level above ``nodes``, which begin at a whole run."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / RUN).cast("int"))
    return F.transform(runs, lambda i: digest(F.concat_ws("", F.slice(nodes, i * RUN + 1, RUN))))


def _subtrees(level: DataFrame, carried: list[str]) -> DataFrame:
    """A row per aligned subtree: its nodes in order, the levels between, and the node above it."""
    held = F.struct("pos", "digest", *carried)
    rows = level.groupBy("tree", F.expr(f"pos div {SPAN}").alias("up")).agg(F.sort_array(F.collect_list(held)).alias("_held"), F.first("n").alias("n"))
    rows = rows.withColumn("_l0", F.transform("_held", lambda x: x["digest"])).withColumn("_rise", _rise(F.col("n")))
    for k in range(LEVELS):
        rows = rows.withColumn(f"_l{k + 1}", _raised(F.col(f"_l{k}")))
    top = F.element_at(F.element_at(F.array(*[F.col(f"_l{k}") for k in range(LEVELS + 1)]), F.col("_rise") + 1), 1)
    return rows.withColumn("_top", top)


def _built(leaves: DataFrame) -> tuple[DataFrame, ...]:
    most, levels = leaves.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0], [leaves]
    while most > 1:
        up = _subtrees(levels[-1], []).select("tree", F.col("up").alias("pos"), F.ceil(F.col("n") / SPAN).alias("n"), F.col("_top").alias("digest"))
        levels.append(saved(up, "merkle-level"))
        most = -(-most // SPAN)
    return tuple(levels)


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> Manifest:
    """Digests of all rows of ``docs`` (doc_id, source, lang, n_chars, text) and the written levels above them.

    ``carried`` are further values of a row, found in the same pass and kept beside its leaf.
    """
    # The sign before a language keeps null apart and first, and the order bytewise.
    tree = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    rows = docs.select(tree.alias("tree"), F.col("doc_id"), leaf_of().alias("digest"), *[c.alias(n) for n, c in (carried or {}).items()])
    levels = _built(saved(_numbered(saved(rows, "merkle-leaves"), ["doc_id", "digest"]), "merkle-leaves"))
    tops = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    trees = _built(saved(_numbered(saved(tops, "merkle-subroots"), ["name"]), "merkle-subroots"))
    return Manifest(levels, Manifest(trees, None))


def _steps(i: Column) -> Column:
    """The siblings of node i of a subtree, left and right, in each level that is built anew."""
    steps = []
    for k in range(LEVELS):
        nodes, at = F.col(f"_l{k}"), F.floor(i / RUN**k).cast("int")
        steps.append(F.struct(
            F.concat_ws("", F.slice(nodes, at - at % RUN + 1, at % RUN)).alias("left"),
            F.concat_ws("", F.slice(nodes, at + 2, RUN - 1 - at % RUN)).alias("right"),
        ))
    return F.slice(F.array(*steps), 1, F.col("_rise"))


def _siblings(m: Manifest, above: DataFrame, needed: DataFrame | None, kept: list[str]) -> DataFrame:
    """Path of every needed leaf, from the top level down. ``above`` has a row per tree: pos 0, path, and ``kept``."""
    wanted: list[DataFrame | None] = [needed]
    for _ in m.levels[1:]:
        wanted.append(None if wanted[-1] is None else wanted[-1].select("tree", F.expr(f"pos div {SPAN}").alias("pos")).distinct())
    for k in reversed(range(len(m.levels) - 1)):
        level = m.levels[k]
        carried = [c for c in level.columns if c not in ("tree", "pos", "n", "digest")] if k == 0 else []
        if wanted[k + 1] is not None:
            level = level.withColumn("up", F.expr(f"pos div {SPAN}")).join(wanted[k + 1].withColumnRenamed("pos", "up"), ["tree", "up"], "left_semi")
        rows = _subtrees(level, carried).join(above.withColumnRenamed("pos", "up"), ["tree", "up"])
        found = F.transform("_held", lambda x, i: F.struct(x.alias("own"), F.concat(_steps(i), F.col("path")).alias("path")))
        rows = rows.select("tree", *kept, F.explode(found).alias("_f"))
        above = rows.select("tree", *kept, "_f.own.*", "_f.path")
        if wanted[k] is not None:
            above = above.join(wanted[k], ["tree", "pos"], "left_semi")
    return above


def proofs(m: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Every leaf, or those whose doc_id is in ``wanted``: doc_id, leaf, what was carried, subroot, root, and path.

    ``path`` lists the siblings from the leaf's run up to the root's, each level as joined text left and right of the way.
    With ``wanted`` only their aligned subtrees are built anew.
    """
    top = m.trees.levels[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast(_ABOVE).alias("path"), F.col("digest").alias("root"))
    if len(m.trees.levels) == 1:  # one subroot is the root
        top = m.trees.levels[0].select("name", "digest", F.array().cast(_ABOVE).alias("path"), F.col("digest").alias("root"))
    else:
        top = _siblings(m.trees, top, None, ["root"])
    trees = top.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")
    if len(m.levels) == 1:  # no tree has more than one leaf
        rows = m.levels[0].drop("n").join(trees, ["tree", "pos"])
        rows = rows if wanted is None else rows.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    else:
        needed = None if wanted is None else m.levels[0].join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").select("tree", "pos")
        rows = _siblings(m, trees, needed, ["subroot", "root"])
    return rows.drop("tree", "pos").withColumnRenamed("digest", "leaf")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"])))
