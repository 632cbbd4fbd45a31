"""Near duplicates by a set similarity join over chosen paths (operator 8).

Every document becomes the set of its hashed word shingles. Equal sets are one class at once; the rest works on one
row per class.

* A class has ``TREES`` x ``LEVELS`` minwise tokens. A tree branches its documents by one token after another: a node
  is the chain of tokens so far, and documents of similarity s stay together over k levels with probability s^k. A node
  is small when it holds at most ``LEAF`` documents and ``LEAF_SHINGLES`` shingles; larger ones branch again, each level
  as one aggregation and one join. Independent trees raise the recall: at similarity 0.85 one tree of four
  levels keeps a pair with 0.52, twelve with 0.9998.
* Small nodes are compared exhaustively: minwise sketches choose pairs (four standard deviations below the threshold),
  full sets confirm them. Pairs already joined by confirmed links are skipped, which keeps a node of many copies from
  writing a quadratic number of links. A node that is still large at the last level is cut into blocks, and every
  pair of blocks is compared: exact, at the cost of one copy of a document per block.
* The first trees find most groups; the others look only for links between different groups. Full sets are made only
  for documents that have a candidate partner.
* Links become connected components by alternating stars, in Spark, with a written table per step.

Defined cases: null, empty or blank texts have an empty set and no links; texts of fewer words than a shingle are one
shingle; rows that share a doc_id are one document for reachability; a row without doc_id has no component and is
kept; repeated rows each get a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from math import floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.base import mixed, saved

TREES, LEVELS, FIRST_TREES = 12, 4, 2
SKETCH = 64
LEAF, LEAF_SHINGLES = 256, 1 << 21
_FACTORS = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mixed(np.arange(1001, SKETCH + 1001, dtype=np.uint64))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and the six white space characters
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(b"%d:" % n + hashed.tobytes())], np.uint64)
    chain = hashed[:n - width + 1]
    for k in range(1, width):
        chain = mixed(chain) + hashed[k:n - width + 1 + k]
    return np.unique(mixed(chain))


def minwise(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 4096):
        np.minimum(least, (_FACTORS[:, None] * shingles[None, a:a + 4096] + _SHIFTS[:, None]).min(axis=1), out=least)
    return least


def _lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel()))


SKETCHES = "doc long, n long, digest binary, sketch binary, paths array<bigint>"


def _sketched(batches, width: int):
    for batch in batches:
        sizes, digests, sketches = [], [], []
        tokens = np.zeros((batch.num_rows, SKETCH), np.uint64)
        for i, text in enumerate(batch.column(1)):
            shingles = shingle_set(text.as_py(), width)
            sizes.append(len(shingles))
            digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            tokens[i] = minwise(shingles)
            sketches.append((tokens[i] >> np.uint64(40)).astype(np.uint8).tobytes())
        chosen = tokens[:, :TREES * LEVELS].reshape(-1, TREES, LEVELS)
        paths = np.zeros_like(chosen)
        node = np.broadcast_to(mixed(np.arange(77, 77 + TREES, dtype=np.uint64)), chosen.shape[:2])
        for level in range(LEVELS):
            node = mixed(node + chosen[:, :, level])
            paths[:, :, level] = node
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()), _lists(paths.reshape(len(sizes), -1).view(np.int64))],
            ["doc", "n", "digest", "sketch", "paths"],
        )


# Trees


def leaves(classes: DataFrame, first: int, last: int) -> DataFrame:
    """(leaf, doc, digest, n): every class in its leaf of each of the trees from ``first`` to before ``last``."""
    trees = F.transform(F.sequence(F.lit(first), F.lit(last - 1)), lambda t: F.slice("paths", t * LEVELS + 1, LEVELS))
    rows = saved(classes.select("doc", "digest", "n", F.explode(trees).alias("path")), "near-paths")
    open_, done = rows, None
    for level in range(LEVELS):
        at = open_.withColumn("leaf", F.get("path", F.lit(level)))
        sizes = at.groupBy("leaf").agg(F.count("*").alias("__c"), F.sum("n").alias("__s"))
        large = saved(sizes.where((F.col("__c") > LEAF) | (F.col("__s") > LEAF_SHINGLES)), "near-large")
        at = saved(at.join(large, "leaf", "left"), "near-level") if level + 1 < LEVELS else at.join(large, "leaf", "left")
        small = at.where(F.col("__c").isNull()).select("leaf", "doc", "digest", "n")
        done = small if done is None else done.unionByName(small)
        open_ = at.where(F.col("__c").isNotNull())
        if level + 1 < LEVELS:
            open_ = open_.drop("leaf", "__c", "__s")
    blocks = F.greatest(F.ceil(F.col("__c") / (LEAF // 2)), F.ceil(F.col("__s") / (LEAF_SHINGLES // 2))).cast("int")
    own = F.pmod(F.xxhash64("doc", "digest"), F.col("blocks")).cast("int")
    cut = open_.withColumn("blocks", blocks).withColumn("own", own)
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.xxhash64("leaf", F.least("own", other), F.greatest("own", other)))
    return done.unionByName(cut.select(F.explode(pairs).alias("leaf"), "doc", "digest", "n"))


def whole_groups(batches):
    """The rows, sorted by the first column, in tables that hold whole groups."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        leaf = table.column(0).to_numpy()
        cut = int(np.searchsorted(leaf, leaf[-1]))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None:
        yield held


def matches_needed(percent: int) -> int:
    s = percent / 100
    return max(1, floor(SKETCH * (s - 4 * sqrt(s * (1 - s) / SKETCH))))


def _alike(sketch: np.ndarray, n: np.ndarray, group: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of a small node whose sketches agree enough, of different groups and sizes that can meet the threshold."""
    same = np.zeros((len(n), len(n)), np.int16)
    for k in range(SKETCH):
        same += sketch[:, k, None] == sketch[None, :, k]
    sizes = 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
    return np.where(sizes & (group[:, None] != group[None, :]), same, 0)


def _sketch_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _partnered(batches, percent: int):
    """Of (leaf, doc, digest, n, group, sketch): the rows with a candidate partner in their leaf."""
    needed = matches_needed(percent)
    for table in whole_groups(batches):
        leaf = table.column(0).to_numpy()
        n, group = table.column(3).to_numpy(), table.column(4).to_numpy()
        sketch = _sketch_rows(table.column(5))
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
        sizes = np.diff(np.r_[starts, len(leaf)])
        hit = np.zeros(len(leaf), bool)
        two = starts[sizes == 2]
        low, high = np.minimum(n[two], n[two + 1]), np.maximum(n[two], n[two + 1])
        good = ((sketch[two] == sketch[two + 1]).sum(axis=1) >= needed) & (100 * low >= percent * high) & (group[two] != group[two + 1])
        hit[two[good]] = hit[two[good] + 1] = True
        for a, m in zip(starts[sizes > 2], sizes[sizes > 2]):
            hit[a:a + m] = (_alike(sketch[a:a + m], n[a:a + m], group[a:a + m], percent) >= needed).any(axis=1)
        yield from table.filter(pa.array(hit)).combine_chunks().to_batches() or [pa.RecordBatch.from_arrays([pa.array([], f.type) for f in table.schema], schema=table.schema)]


def common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _confirmed(batches, percent: int):
    """Of (leaf, doc, digest, n, group, sketch, shingles): links between documents, none within a group or already implied."""
    needed = matches_needed(percent)
    for table in whole_groups(batches):
        leaf, doc = table.column(0).to_numpy(), table.column(1).to_numpy()
        n, group = table.column(3).to_numpy(), table.column(4).to_numpy()
        sketch = _sketch_rows(table.column(5))
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
        left, right = [], []
        for a, b in zip(starts, np.r_[starts[1:], len(leaf)]):
            if b - a < 2:
                continue
            score = np.triu(_alike(sketch[a:b], n[a:b], group[a:b], percent))
            x, y = np.nonzero(score >= needed)
            order = np.argsort(-score[x, y], kind="stable")
            sets: dict[int, np.ndarray] = {}
            parent = {int(g): int(g) for g in group[a:b]}

            def root(g: int) -> int:
                while parent[g] != g:
                    parent[g] = g = parent[parent[g]]
                return g

            for i, j in zip(x[order].tolist(), y[order].tolist()):
                one, other = root(int(group[a + i])), root(int(group[a + j]))
                if one == other:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = np.frombuffer(table.column(6)[int(a) + k].as_py(), np.uint64)
                both = common(sets[i], sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[one] = other
                    left.append(int(doc[a + i]))
                    right.append(int(doc[a + j]))
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])


def _sets(batches, width: int):
    for batch in batches:
        sets = [shingle_set(t.as_py(), width).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())], ["doc", "digest", "shingles"])


def links(texts: DataFrame, classes: DataFrame, groups: DataFrame | None, first: int, last: int, width: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes of different groups found by the given trees."""
    known = classes.select("doc", "digest", "sketch")
    grouped = known.withColumn("group", F.col("doc")) if groups is None else known.join(groups, "doc", "left").withColumn("group", F.coalesce("group", "doc"))
    columns = "leaf long, doc long, digest binary, n long, group long, sketch binary"
    rows = leaves(classes, first, last).join(grouped, ["doc", "digest"]).select("leaf", "doc", "digest", "n", "group", "sketch")
    rows = saved(rows.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(lambda b: _partnered(b, percent), columns), "near-partnered")
    wanted = saved(rows.select("doc").distinct(), "near-wanted")
    sets = texts.join(wanted, "doc", "left_semi").mapInArrow(lambda b: _sets(b, width), "doc long, digest binary, shingles binary").dropDuplicates(["doc", "digest"])
    full = rows.join(sets, ["doc", "digest"]).select("leaf", "doc", "digest", "n", "group", "sketch", "shingles")
    return saved(full.repartition("leaf").sortWithinPartitions("leaf", "doc").mapInArrow(lambda b: _confirmed(b, percent), "a long, b long"), "near-links")


def components(edges: DataFrame) -> DataFrame:
    """(doc, group): group is the smallest document reachable, for every document with a link. Alternating large and small stars."""
    edges = saved(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "near-least")
        large = saved(both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "near-large-star")
        down = saved(large.groupBy("a").agg(F.min("b").alias("m")), "near-least")
        small = large.join(down, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        following = saved(small, "near-edges")
        # Stars only: every document names its root, and no root has one itself.
        moved = following.join(following.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        edges = following
        if not moved and not following.groupBy("a").count().where("count > 1").limit(1).count():
            return edges.select(F.col("a").alias("doc"), F.col("b").alias("group"))


def grouped(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, and kept (true for the smallest doc_id of a component)."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), "text")
    sketched = saved(texts.mapInArrow(lambda b: _sketched(b, width), SKETCHES), "near-sketches")
    linkable = sketched.where((F.col("n") > 0) & F.col("doc").isNotNull())
    classes = saved(linkable.groupBy("digest").agg(F.min("doc").alias("doc"), *[F.first(c).alias(c) for c in ("n", "sketch", "paths")]), "near-classes")
    texts = texts.where(F.col("doc").isNotNull())
    found = components(links(texts, classes, None, 0, FIRST_TREES, width, percent))
    more = links(texts, classes, found, FIRST_TREES, TREES, width, percent)
    groups = lambda df, c: df.join(found.select(F.col("doc").alias(c), F.col("group").alias(f"{c}g")), c, "left").withColumn(c, F.coalesce(f"{c}g", c)).drop(f"{c}g")
    merged = components(groups(groups(more, "a"), "b")).select(F.col("doc").alias("group"), F.col("group").alias("root"))
    of_doc = found.unionByName(found.select(F.col("group").alias("doc"), "group").distinct())
    of_doc = saved(
        of_doc.join(merged, "group", "left").select("doc", F.coalesce("root", "group").alias("root"))
        .unionByName(merged.select(F.col("group").alias("doc"), "root")).groupBy("doc").agg(F.min("root").alias("root")), "near-roots",
    )
    # Rows of one doc_id and several texts belong to the components of all their classes: one more round over those links.
    same = linkable.select("doc", "digest").distinct().join(classes.select("digest", F.col("doc").alias("rep")), "digest").join(of_doc.withColumnRenamed("doc", "rep"), "rep", "left").select("doc", F.coalesce("root", "rep").alias("root"))
    last = components(same.select(F.col("doc").alias("a"), F.col("root").alias("b"))).select("doc", F.col("group").alias("__root"))
    return sketched.join(last, "doc", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("__root", "doc")).otherwise(F.col("doc")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def kept_documents(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all columns; rows that repeat its doc_id stay only if their texts differ in set."""
    gone = grouped(documents, width, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return documents.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
