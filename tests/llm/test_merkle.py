"""The Merkle manifest against a plain recursive version."""

import hashlib
import zlib

import duckdb
import pytest
from helpers import AWKWARD, documents

from candlewright.llm import merkle, queries, sql

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n_chars, text)])


def climb(nodes):
    """Top of a tree, and per node its (left, right) siblings level by level."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for i in range(len(nodes)):
            run = i // 8 * 8
            for m in members[i]:
                paths[m].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 8])))
        members = [sum(members[a:a + 8], []) for a in range(0, len(nodes), 8)]
        nodes = [h(*nodes[a:a + 8]) for a in range(0, len(nodes), 8)]
    return nodes[0] if nodes else None, paths


def expected(rows):
    trees = {}
    for doc, text, lang, source, n in rows:
        trees.setdefault((lang is not None, (lang or "").encode()), []).append(((doc is not None, doc or 0), leaf(doc, source, lang, n, text), doc, text, lang, source, n))
    names = sorted(trees)
    tops = []
    for name in names:
        trees[name].sort(key=lambda r: r[:2])
        tops.append(climb([r[1] for r in trees[name]]))
    root, above = climb([t for t, _ in tops])
    out = []
    for name, (subroot, paths), last in zip(names, tops, above):
        for (_, own, doc, text, lang, source, n), path in zip(trees[name], paths):
            node = own
            if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
                node = leaf(doc, source, lang, n, None if text is None else text.translate(LOWER))
            for left, right in path + last:
                node = h(left, node, right)
            out.append((doc, own, subroot, root, h(*[a + b for a, b in path + last]), node, node == root))
    return sorted(out, key=str)


def found(spark, docs, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    return sorted(map(tuple, queries.op11_merkle(spark, str(tmp_path)).collect()), key=str), path


def full(rows):
    return [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]


def test_awkward_rows(spark, tmp_path):
    got, path = found(spark, documents(spark, AWKWARD), tmp_path)
    assert got == expected(full(AWKWARD))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(con.sql(sql.OP11).fetchall(), key=str) == got


def test_no_rows(spark, tmp_path):
    assert found(spark, documents(spark, AWKWARD[:1]).limit(0), tmp_path)[0] == []
    assert merkle.manifest(documents(spark, AWKWARD[:1]).limit(0)).root.collect() == []


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1], [8, 9], [512, 1], [513], [1100, 64, 65, 7, 3, 2, 1, 5, 4, 6]])
def test_tree_sizes(spark, tmp_path, sizes):
    rows = [(i * 7 % 5000, f"Text {i}", None if k == 1 else f"l{k}é", f"s{i % 3}") for k, size in enumerate(sizes) for i in range(size)]
    assert found(spark, documents(spark, rows), tmp_path)[0] == expected(full(rows))


def test_equal_rows_and_many_partitions(spark, tmp_path):
    rows = [(5, "Same", "en", "s")] * 700 + [(None, f"T{i % 3}", None, None) for i in range(90)]
    assert found(spark, documents(spark, rows).repartition(17), tmp_path)[0] == expected(full(rows))


def test_some_proofs(spark):
    rows = [(i, f"Text {i}", "en" if i % 5 else "fr", "s") for i in range(1500)]
    m = merkle.manifest(documents(spark, rows))
    all_of = {r["doc_id"]: r for r in merkle.proofs(m).collect()}
    asked = [3, 10, 777, 1499, 9999]
    some = merkle.proofs(m, spark.createDataFrame([(i,) for i in asked * 2], "doc_id long")).collect()
    assert sorted(r["doc_id"] for r in some) == asked[:-1]
    assert all(r == all_of[r["doc_id"]] for r in some)
    checked = merkle.proofs(m).select(merkle.folded(merkle.F.col("leaf"), merkle.F.col("path")) == merkle.F.col("root")).distinct().collect()
    assert [r[0] for r in checked] == [True]
    # Only leaves and every third level are written.
    assert [x.count() for x in m.levels] == [1500, 4, 2]
