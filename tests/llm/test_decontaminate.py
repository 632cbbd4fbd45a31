"""Leaks against Smith-Waterman of every document with every item."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, documents

from candlewright.llm import decontaminate as D

WORDS = ["the", "of", "and"] * 6 + [f"word{i}" for i in range(80)]


def plain_score(item, text):
    """The textbook recurrence."""
    best = 0
    above = [0] * (len(text) + 1)
    for x in item:
        row = [0]
        for j, y in enumerate(text):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment_is_the_textbook_one():
    rng = random.Random(4)
    for _ in range(60):
        item, text = ([rng.randrange(5) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        score, a, b = D.align(np.array(item), np.array(text))
        assert score == plain_score(item, text)
        assert score == 0 or plain_score(item, text[a:b]) == score


def edited(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else [rng.choice(WORDS)] if x < 2 * share / 3 else [w, rng.choice(WORDS)] if x < share else [w]
    return out


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_CHARS", block)
    rng = random.Random(9)
    say = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(i, say(rng.randrange(14, 50))) for i in range(12)] + [(20, None), (21, []), (22, ["the", "of"]), (None, say(20))]
    bench = spark.createDataFrame([(i, w and " ".join(w), 1) for i, w in items], "item_id long, text string, doc_id long")
    rows = []
    for d in range(120):
        body = say(rng.randrange(0, 90))
        if d % 3 == 0:
            item = rng.choice([w for i, w in items if w and len(w) > 5])
            body[len(body) // 2:len(body) // 2] = edited(rng, item, rng.choice([0, .1, .2, .3]))
        rows.append((d, ". ".join([" ".join(body).upper()])))
    rows += [(r[0] + 500 if r[0] else r[0], r[1]) for r in AWKWARD]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in D.leaks(documents(spark, rows), bench).collect()}
    expect = {}
    for d, t in rows:
        for i, w in items:
            if w and len(w) >= D.MIN_WORDS and len(t or "") < 5000:
                s = plain_score(w, D.words_of(t)) / (2 * len(w))
                if s >= D.THRESHOLD:
                    expect[d, i] = s
    assert got == expect and len(expect) > 25


def test_spans_and_common_leak(spark):
    """An item copied into most documents is found in all of them."""
    rng = random.Random(1)
    item = [f"q{i}" for i in range(20)]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    rows = [(d, " ".join([f"x{rng.randrange(999)}" for _ in range(30)] + (item if d % 4 else []) + ["end"])) for d in range(400)]
    got = D.leaks(documents(spark, rows), bench).collect()
    assert {r["doc_id"] for r in got} == {d for d in range(400) if d % 4} and {(r["first_word"], r["end_word"]) for r in got} == {(30, 50)}
    clean = D.clean_documents(documents(spark, rows), bench)
    assert clean.count() == 100 and clean.columns == documents(spark, rows[:1]).columns


def test_empty(spark):
    docs = documents(spark, [(1, "a b c d e f g h")])
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert D.leaks(docs.limit(0), bench).count() == 0 and D.leaks(docs, bench.limit(0)).count() == 0 and D.leaks(docs, bench).count() == 1


@pytest.mark.parametrize("edit", ["every fifth replaced", "every third replaced", "one put after every second"])
def test_edited_beside_exact(spark, edit):
    """An exact copy in the corpus doesn't hide an edited one, nor does an edit that leaves no three words in a row."""
    item = [f"w{i}" for i in range(40)]
    copy = {
        "every fifth replaced": [f"y{i}" if i % 5 == 4 else w for i, w in enumerate(item)],
        "every third replaced": [f"y{i}" if i % 3 == 2 else w for i, w in enumerate(item)],
        "one put after every second": [x for i, w in enumerate(item) for x in ([w, f"y{i}"] if i % 2 else [w])],
    }[edit]
    around = lambda ws: " ".join([f"a{i}" for i in range(30)] + ws + [f"b{i}" for i in range(30)])
    rows = [(1, around(item)), (2, around(copy)), (3, around([]))]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r["similarity"] for r in D.leaks(documents(spark, rows), bench).collect()}
    assert got == {1: 1.0, 2: plain_score(item, copy) / 80} and got[2] >= D.THRESHOLD


def test_hits_in_parts(spark, monkeypatch):
    """Long texts with many hits are cut in halves; nothing is lost at the cut."""
    rng = random.Random(6)
    item = [rng.choice(WORDS[:24]) for _ in range(20)]
    block = D.Block([(1, item)], D.THRESHOLD)
    for _ in range(20):
        text = [rng.choice(WORDS[:24]) for _ in range(600)]
        text[at:at + 20] = edited(rng, item, 0.2) if (at := rng.randrange(600)) else item
        coded = block.coded(text)
        best = []
        for hits in (1 << 20, 1):
            monkeypatch.setattr(D, "HITS", hits)
            best.append(max((D.align(block.words[0], coded[a:b])[0] for a, b in block.windows(coded)[0]), default=0))
        assert best[0] == best[1] == (score if (score := plain_score(item, text)) >= 20 else best[0])


def test_short_and_unspaced_items(spark):
    """Each item with what is a copy of it and what is not."""
    cases = {
        1: ("Is it late?", ["Q: is it late? Yes.", "one\nIs it late\ntwo"], ["is it late in the day", "it is late"]),
        2: ("Paris", ["The town: Paris.", "paris"], ["we saw Paris and Rome"]),
        3: ("one of the most wanted", ["it is one of the most wanted things"], ["one of the least known", "the most wanted man"]),
        4: ("he came as soon as possible", ["and he came as soon as possible too"], ["as soon as it rained", "do it as soon as possible"]),
        5: ("wood fire makes the old house warm tonight", ["a wood fire makes the old house very warm tonight"], ["the old house stood there", "a wood fire makes smoke"]),
        6: ("我们明天早上在学校门口见面然后一起去图书馆", ["他说我们明天早上在学校门口碰面然后一起去图书馆。", "我们明天早上在学校门口见面然后一起去图书馆"], ["我们明天早上在家里", "他们一起去图书馆看书"]),
        7: ("东京都", ["在哪里？东京都。"], ["他住在东京都内"]),
        8: ("これはとても古い本です", ["「これはとても古い本です」と言った"], ["これはとても新しい本です"]),
    }
    assert D.words_of("ab 東京 é2") == ["ab", "東", "京", "é2"]
    bench = spark.createDataFrame([(i, c[0]) for i, c in cases.items()], "item_id long, text string")
    rows = [(100 * i + j, t) for i, (_, yes, no) in cases.items() for j, t in enumerate(yes + [None, ""] + no)]
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(documents(spark, rows), bench).collect()}
    assert got == {(100 * i + j, i) for i, (_, yes, _) in cases.items() for j in range(len(yes))}


def test_clean_rows_keep_their_ids(spark):
    """A leak takes its own row only, not others without an id or with the same one."""
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(None, item), (None, "a clean text"), (None, None), (5, f"so {item} then"), (5, "another clean text"), (6, "")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = D.clean_documents(documents(spark, rows), bench)
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted((str(a), str(b)) for a, b in rows if item not in (b or ""))
    assert kept.columns == documents(spark, rows).columns
