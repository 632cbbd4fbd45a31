"""Lattices that are kept from batch to batch: nothing is built twice, and no result depends on what is kept."""

import numpy as np
import pytest

from candlewright.llm import pieces as P

TEXTS = ["onthere intheand\nthe thing.\nThe", "naïve \U0001f468 日本語 ▁ \x00\x01 the", "", "a" * 300 + " onthe", "  two  spaces ", "the thing.\nThe onthere"]
SEEDS = [P.row_seed(i, 0) for i in range(len(TEXTS))]


def drawn(v, k=3):
    return [[(ids.tolist(), round(log, 9), round(share, 9)) for ids, log, share in x] for x in P.segmentations(TEXTS, SEEDS, k, v)]


def test_no_lattice_of_a_short_word_is_built_twice(monkeypatch):
    v, built, arcs = P.Vocabulary(P.VOCABULARY), [], P._arcs
    monkeypatch.setattr(P, "_arcs", lambda words, *others: built.append(list(words)) or arcs(words, *others))
    first = drawn(v)
    assert drawn(v) == first
    assert "▁thing.\nThe" in built[0] and len(built[0]) == len(set(built[0]))
    assert [w for w in built[1] if len(w) <= 64] == []


@pytest.mark.parametrize("name, most", [("REMEMBERED", 0), ("REMEMBERED", 3), ("ROOM", 20)])
def test_what_is_kept_changes_no_result(monkeypatch, name, most):
    want = drawn(P.Vocabulary(P.VOCABULARY))
    v = P.Vocabulary(P.VOCABULARY)
    monkeypatch.setattr(P, name, most)
    assert drawn(v) == drawn(v) == want
    assert len(v.met) == v.kept[0] <= most and v.kept[2] <= P.ROOM
    assert [x for t in TEXTS for x in P.segmentations([t], [P.row_seed(9, 9)], 2, v)[0][:1] if v.decode(x[0]) != t] == []


def test_hashes_that_begin_alike():
    """Every piece is found by its hash, and a hash beside one isn't."""
    v = P.Vocabulary(P.VOCABULARY)
    hit, found = v.found(v.hashes[:-1])
    assert hit.tolist() == list(range(len(v.hashes) - 1)) and found.tolist() == v.hashed[:-1].tolist()
    beside = np.setdiff1d(np.r_[v.hashes[:-1] + np.uint64(1), v.hashes[:-1] - np.uint64(1), np.uint64(2**64 - 1)], v.hashes[:-1])
    assert len(v.found(beside)[0]) == 0
