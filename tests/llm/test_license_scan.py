"""The licence classifier on texts that it wasn't trained on, and places of what it finds."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, documents

from candlewright.llm import license_scan as S

WORDS = [a + b for a in ("ther", "on", "ing", "sta", "mel") for b in ("and", "ou", "ti", "re", "blen")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return S.fit([S.words_of(prose(rng, rng.randrange(2, 40))) for _ in range(600)])


def test_features_are_those_of_each_paragraph():
    paragraphs = [["a"], ["b", "c"], ["d", "e", "f", "d"], ["a"]]
    buckets, sizes = S.features(paragraphs)
    assert sizes.tolist() == [1, 3, 9, 1]
    parts = np.split(buckets, np.cumsum(sizes)[:-1])
    assert all(sorted(x) == sorted(S.features([p])[0]) for x, p in zip(parts, paragraphs))


def test_held_out_accuracy(model):
    rng = random.Random(8)
    right = []
    for family, texts in S.TEMPLATES.items():
        for t in texts:
            for _ in range(6):
                words = S.words_of(prose(rng, rng.randrange(0, 6)) + " " + t + " " + prose(rng, rng.randrange(0, 6)))
                right.append(S.CLASSES[int(model.probabilities([words])[0].argmax())] == family)
    ordinary = model.probabilities([S.words_of(prose(rng, rng.randrange(1, 60))) for _ in range(300)])
    assert np.mean(right) > 0.93
    assert np.mean(ordinary.argmax(axis=1) == S.CLASSES.index(S.ORDINARY)) > 0.99


def test_calibration(model):
    """Of templates that it hasn't seen, it is right about as often as it says; of those it has seen, at least so."""
    paragraphs, labels, held = S.examples([S.words_of(prose(random.Random(3), 20)) for _ in range(200)], seed=77)
    first = S.trained([S.features([p])[0] for p, h in zip(paragraphs, held) if not h], labels[~held])
    first.temperature = model.temperature
    p = first.probabilities([x for x, h in zip(paragraphs, held) if h])
    assert abs(p.max(axis=1).mean() - (p.argmax(axis=1) == labels[held]).mean()) < 0.15
    p = model.probabilities(paragraphs)
    assert (p.argmax(axis=1) == labels).mean() > max(0.9, p.max(axis=1).mean() - 0.02)


def test_notices_and_places(spark, model):
    rng = random.Random(4)
    rows = [(100 + i, f"{prose(rng, 30)}\n{t}\n{prose(rng, 9)}") for i, t in enumerate(["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Thandou License.", prose(rng, 8)])]
    docs = documents(spark, rows + AWKWARD)
    text = dict(rows)
    got = {r["doc_id"]: r for r in S.notices(docs, model).where("doc_id >= 100").collect()}
    assert {d: r["family"] for d, r in got.items()} == {100: "mit", 101: "cc-by-nc", 102: "unknown"}
    assert all(text[d][r["start"]:r["end"]] == text[d].split("\n")[1] and r["paragraph"] == 1 for d, r in got.items())
    assert S.notices(docs.limit(0), model).count() == 0 and S.notices(docs).where("doc_id = 100").count() == 1


def test_notices_within_long_lines(spark, model):
    """Whatever the number of words around it, a notice is found at its place; lines without one give no row."""
    rng = random.Random(11)
    flat = lambda n: prose(rng, n).rstrip(".").lower()
    rows, expect = [], {}
    for family, texts in S.TEMPLATES.items():
        for t in texts[:4]:
            for around in (40, 80, 200):
                before = rng.randrange(0, around)
                line = f"{flat(before)} {t} {flat(around - before)}" if before else f"{t} {flat(around)}"
                expect[100 + len(rows)] = (family, line.index(t), line.index(t) + len(t))
                rows.append((100 + len(rows), line))
    plain = [(10_000 + i, flat(300)) for i in range(100)]
    found: dict = {}
    for r in S.notices(documents(spark, rows + plain), model).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert not [d for d in found if d >= 10_000]
    placed = [any(r["start"] < end and start < r["end"] for r in found.get(d, [])) for d, (_, start, end) in expect.items()]
    right = [any(r["family"] == f for r in found.get(d, [])) for d, (f, _, _) in expect.items()]
    assert np.mean(placed) > 0.95 and np.mean(right) > 0.9
    wide = [r for d in expect for r in found.get(d, []) if not (r["start"] < expect[d][2] and expect[d][1] < r["end"])]
    assert len(wide) < 0.05 * len(rows)


def test_windows_cover_every_word(model):
    rng = random.Random(2)
    for n in (1, 7, 8, 9, 23, 24, 25, 36, 37, 48, 49, 200):
        line = " ".join(f"w{i}," for i in range(n))
        words, windows = S.windows_of(line)
        assert {i for a, b, _, _ in windows for i in range(a, b)} == set(range(n)) and words == S.words_of(line)
        assert all(S.words_of(line[start:end]) == words[a:b] for a, b, start, end in windows)
        at = rng.randrange(max(1, n - 11))
        assert any(a <= at and min(n, at + 12) <= b for a, b, _, _ in windows)
        fast = model.of_windows(words, *(np.array(x) for x in list(zip(*windows))[:2]))
        assert np.allclose(fast, model.probabilities([words[a:b] for a, b, _, _ in windows]), atol=1e-4)
    assert S.windows_of("") == S.windows_of(" .,") == ([], [])


def test_new_wordings_are_licence_text(model):
    """Sentences of known licences that are no template read like licence text, everyday sentences don't."""
    new = [
        "This program is free software: you can redistribute it under GPLv3 or later.", "This package is made available under the MIT licence.", "This file is part of a program released under the Apache License.",
        "Permission to copy, modify and distribute this software is hereby granted without fee.", "The content is licensed under a Creative Commons licence.", "The software is provided as is, without any warranty.",
    ]
    everyday = ["He showed a license to the officer in the park.", "He gave her permission to go to the office.", "The warranty of the car had ended.", "The public park is open to all."]
    of = lambda ts: model.probabilities([S.words_of(t) for t in ts])[:, S.CLASSES.index(S.ORDINARY)]
    assert (of(new) < 0.5).all(), of(new)
    assert (of(everyday) > 0.5).all(), of(everyday)


def test_sample_is_bounded_and_without_licence_language(spark, monkeypatch):
    monkeypatch.setattr(S, "MAX_ORDINARY", 50)
    rng = random.Random(3)
    rows = [(i, "\n".join(prose(rng, 12) for _ in range(10)) + "\nLicensed under the MIT License.\n" + "the same line in every document of it") for i in range(200)]
    sample = S.ordinary_sample(documents(spark, rows))
    assert 15 <= len(sample) <= 100 and not any("mit" in w for w in sample) and len({tuple(w) for w in sample}) == len(sample)


def test_odd_texts_are_no_notices(spark, model):
    """Unknown words, repeated words, tables and symbols."""
    odd = ["the " * 300, "zzyx " * 12, "besten, " * 40, "qwx vbn | zxc ghj | rty fgh", "Osrañ.", "*** ### word$$$ other%%%", "1 2 3 4 5 6 7 8 9", "ж щ ю"]
    assert S.notices(documents(spark, list(enumerate(odd))), model).count() == 0
