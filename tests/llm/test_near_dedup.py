"""Near duplicates against all pairs of exact sets."""

import random
import re

import pytest
from helpers import AWKWARD, documents

from candlewright.llm import near_dedup


def plain(rows, width, percent):
    sets = []
    for d, t in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if w]
        sets.append((d, frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    usable = [(d, s) for d, s in sets if s and d is not None]
    for i, (a, s) in enumerate(usable):
        for b, t in usable[:i]:
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((str(d), len(s), str(root(d) if s and d is not None else d)) for d, s in sets)


def noisy(rng, words, share):
    return " ".join(rng.choice(VOCABULARY) if rng.random() < share else w for w in words)


VOCABULARY = [f"w{i}" for i in range(400)]


@pytest.mark.parametrize("leaf,width,percent", [(256, 3, 85), (8, 3, 85), (8, 5, 80)])
def test_all_pairs(spark, monkeypatch, leaf, width, percent):
    """A small leaf forces deep branching and, for the large group, blocks."""
    monkeypatch.setattr(near_dedup, "LEAF", leaf)
    rng = random.Random(leaf + width)
    bases = [[rng.choice(VOCABULARY) for _ in range(rng.randrange(3, 120))] for _ in range(60)]
    rows = [(i, noisy(rng, rng.choice(bases), rng.choice([0, 0.01, 0.02, 0.04]))) for i in range(400)]
    big = [rng.choice(VOCABULARY) for _ in range(150)]
    rows += [(1000 + i, noisy(rng, big, 0.02)) for i in range(120)] + [(3000 + i, "copy of the same thing " * 3) for i in range(50)]
    rows += [(r[0] + 5000 if r[0] else r[0], r[1]) for r in AWKWARD] + [(3, rows[3][1].upper()), (17, rows[40][1])]
    got = near_dedup.grouped(documents(spark, rows), width, percent).collect()
    expect = plain(rows, width, percent)
    assert sorted((str(r["doc_id"]), r["n_shingles"]) for r in got) == sorted((d, n) for d, n, _ in expect)
    # A doc_id with two texts is one document: compare components as the partition they make.
    ours, theirs = {}, {}
    for r in got:
        ours.setdefault(str(r["doc_id"]), set()).add(str(r["component_id"]))
    for d, _, c in expect:
        theirs.setdefault(d, set()).add(c)
    assert ours == theirs
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_keeps_columns_and_empty(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, "")]
    kept = near_dedup.kept_documents(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns and {r["doc_id"] for r in kept.collect()} == {1, 3, 4}
    assert near_dedup.grouped(documents(spark, rows).limit(0)).count() == 0


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["doc"]: r["group"] for r in near_dedup.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}
