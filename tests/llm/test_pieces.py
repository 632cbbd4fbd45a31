"""Segmentations against the enumeration of all of them."""

import math
from collections import Counter

import pytest
from helpers import AWKWARD, documents

from candlewright.llm import pieces as P

V = P.vocabulary(P.VOCABULARY)


def everything(text):
    """All segmentations of a text and their probabilities."""
    marked = P.MARK + text.replace(" ", P.MARK)
    index = {p: i for i, p in enumerate(V.pieces) if math.isfinite(V.log[i]) and i not in V.bytes_of}
    ways = {0: [((), 0.0)]}
    for end in range(1, len(marked) + 1):
        ways[end] = [(ids + (index[marked[a:end]],), w + V.log[index[marked[a:end]]]) for a in range(end) if marked[a:end] in index for ids, w in ways[a]]
    total = math.log(sum(math.exp(w) for _, w in ways[len(marked)]))
    return {ids: w - total for ids, w in ways[len(marked)]}


@pytest.mark.parametrize("text", ["the thing", "ab  c", "overtake", "a b a"])
def test_all_segmentations_in_the_end(text):
    truth = everything(text)
    drawn = P.segmentations([text, "x", text], [3, 4, 5], len(truth) + 3, V)
    for got in (drawn[0], drawn[2]):
        assert len(got) == len(truth) and {tuple(ids.tolist()) for ids, _, _ in got} == set(truth)
        assert all(math.isclose(log, truth[tuple(ids.tolist())], abs_tol=1e-9) for ids, log, _ in got)
        assert all(share == 1.0 for _, _, share in got)


def test_draws_without_replacement():
    """Ordered pairs come as often as drawing one, then another of the rest."""
    text, n = "onthe", 30000
    truth = {ids: math.exp(w) for ids, w in everything(text).items()}
    pairs = Counter(tuple(tuple(ids.tolist()) for ids, _, _ in got) for got in P.segmentations([text] * n, [P.row_seed(i, 0) for i in range(n)], 2, V))
    checked = 0
    for a in truth:
        for b in truth:
            expect = 0 if a == b else n * truth[a] * truth[b] / (1 - truth[a])
            if expect > 30 or a == b:
                checked += 1
                assert abs(pairs[a, b] - expect) < 5 * math.sqrt(expect) + 1e-9, (a, b)
    assert checked > 10


def test_inclusion_scores_are_unbiased():
    """Weights over inclusion add up to one in the mean."""
    text, n = "onthere", 8000
    sums = [sum(math.exp(log) / share for _, log, share in got) for got in P.segmentations([text] * n, [P.row_seed(i, 1) for i in range(n)], 3, V)]
    assert abs(sum(sums) / n - 1) < 0.03


def test_long_text_branches_where_it_should():
    """The search stops early; with no early stop it finds the same."""
    text = "onthere intheand " * 400
    seeds = [P.row_seed(i, 2) for i in range(30)]
    short = P.segmentations([text] * 30, seeds, 3, V)
    old, P.HIGHEST = P.HIGHEST, 1e9
    try:
        long = P.segmentations([text] * 30, seeds, 3, V)
    finally:
        P.HIGHEST = old
    assert [[(i.tolist(), a, b) for i, a, b in x] for x in short] == [[(i.tolist(), a, b) for i, a, b in x] for x in long]


def test_round_trip_and_batches(spark, monkeypatch):
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(["▁", "▁▁ x", " ", "   a", "a   ", "\t\r\n\x0b", "日本語 텍스트 \U0001f468‍\U0001f469", "ﬀ́​", "\x00\x01", "﷐￿"])]
    got = P.encoded(documents(spark, rows), k=3)
    kept = {(r["doc_id"], r["sample"], tuple(r["ids"])) for r in got.collect()}
    assert all(r["round_trip"] for r in got.collect())
    texts = {}
    for d, t in ((r[0], r[1]) for r in rows):
        texts.setdefault(d, set()).add(t or "")
    back = P.decoded(got).collect()
    assert all(r["text"] in texts[r["doc_id"]] for r in back)
    by = Counter(r["doc_id"] for r in back)
    assert by[1] == by[2] == 1 and by[9] == 6 and by[5] == 3
    monkeypatch.setattr(P, "BATCH_CHARS", 1)
    assert {(r["doc_id"], r["sample"], tuple(r["ids"])) for r in P.encoded(documents(spark, rows).repartition(1), k=3).collect()} == kept
    assert P.encoded(documents(spark, rows).limit(0)).count() == 0
