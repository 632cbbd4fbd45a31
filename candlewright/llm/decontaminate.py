"""Copies of benchmark items in documents, exact, edited or paraphrased (operator 4).

1. The seeds of an item are its pairs of words at most two apart. Where two of them stand at most two apart in a document
   as well, they are a hit. An alignment of M words whose errors cost E scores 2 M - E; each of its M - 1 steps that is
   no hit costs 2 or more, so a score of R takes at least R / 2 - 1 hits, all within 3 n - R words for an item of n.
2. Every stretch with that many hits is aligned with the item by Smith-Waterman on words (match 2, mismatch -1, gap -1).
   The score over that of a perfect copy is the similarity; from ``THRESHOLD`` on it is a leak. The hits only spare
   alignments that can't reach the threshold: what is found is what aligning all documents with all items would find.

Items are taken in blocks of at most about ``BLOCK_CHARS`` characters, so what is sent to the tasks is bounded; every
block meets all documents, and texts are never shuffled. Memory per task: one document, one block, and one row of
an alignment.

Words are runs of word characters; in scripts without spaces every character is a word, of half the weight of another.
An item of fewer than ``MIN_WORDS`` words (by weight) is a leak only where it stands alone, as whole lines or sentences.
From there on an alignment also has to score as much as ``LEAST_WORDS`` words, or all of a shorter item: no phrase of
three words makes a leak.

Defined cases: null or empty texts hold no item; items without words match nothing; equal items each get their rows; repeated documents give repeated rows; a document without id keeps a null id; empty tables give
an empty result; other columns are not read. ``clean_documents`` judges rows by id and text: rows that share an id, or
have none, each go by their own text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm.base import row_key, saved

MIN_WORDS, LEAST_WORDS = 5, 6
MATCH, MISS, GAP = 2, -1, 1
THRESHOLD = 0.5
BLOCK_CHARS = 8 << 20
NEAR = (1, 2)  # how far apart the words of a seed stand
HITS = 1 << 20  # looked at together
WORD = re.compile(r"\w+")
#: Thai, Lao, Burmese, Khmer, kana, Han.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
CHARACTER = re.compile(f"[{UNSPACED}]")
WORD_OR_CHARACTER = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+")
#: What a line or sentence ends with.
EDGE = re.compile("[\n\r\x0b\x0c\x85\u2028\u2029.!?:;|…。！？：；｡।]")


def pattern_of(low: str) -> re.Pattern:
    return WORD if low.isascii() or not CHARACTER.search(low) else WORD_OR_CHARACTER


def words_of(text: str | None) -> list[str]:
    low = (text or "").lower()
    return pattern_of(low).findall(low)


def weight(words: list[str]) -> float:
    return len(words) - sum(len(w) == 1 and bool(CHARACTER.match(w)) for w in words) / 2


def standing_alone(text: str, size: int, starts: list[int]) -> int | None:
    """The first of the word places at which ``size`` words fill whole lines or sentences of a text."""
    low = text.lower()
    spans = [m.span() for m in pattern_of(low).finditer(low)]
    for at in starts:
        before = at == 0 or EDGE.search(low, spans[at - 1][1], spans[at][0])
        after = at + size == len(spans) or EDGE.search(low, spans[at + size - 1][1], spans[at + size][0])
        if before and after:
            return at
    return None


def _best(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment, and where it ends in item and window."""
    row, here, left = np.zeros(len(window) + 1, np.int32), np.empty(len(window), np.int32), np.empty(len(window), np.int32)
    slope, best = GAP * np.arange(len(window), dtype=np.int32), (0, 0, 0)
    for i, word in enumerate(item.tolist()):
        np.multiply(window == word, np.int32(MATCH - MISS), out=here)
        here += row[:-1]
        here += np.int32(MISS)
        np.subtract(row[1:], np.int32(GAP), out=left)
        np.maximum(here, left, out=here)
        np.maximum(here, 0, out=here)
        here += slope
        np.maximum.accumulate(here, out=left)
        np.subtract(left, slope, out=row[1:])
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i + 1, j)
    return best


def align(item: np.ndarray, window: np.ndarray, least: float = 0) -> tuple[int, int, int]:
    """Smith-Waterman: score, and the span of the window that the best alignment covers; no span below ``least``."""
    score, i, j = _best(item, window)
    if score < least:
        return score, j, j
    _, _, back = _best(item[:i][::-1], window[:j][::-1])
    return score, j - back, j


class Block:
    """Items with their seeds, sent to every task."""

    def __init__(self, items: list[tuple[int | None, list[str]]], threshold: float):
        self.vocabulary: dict[str, int] = {}
        self.ids = [i for i, _ in items]
        self.words = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for _, ws in items]
        sizes, weights = np.array([len(ws) for ws in self.words], np.int64), np.array([weight(ws) for _, ws in items])
        least = np.minimum(MATCH * sizes, MATCH * LEAST_WORDS * sizes / np.maximum(weights, 1))
        self.least = np.maximum(MATCH * threshold * sizes, least) - 1e-6
        score = self.least
        self.short: dict[int, list[int]] = defaultdict(list)  # items that have to stand alone, by their first word
        for k in np.flatnonzero(weights < MIN_WORDS).tolist():
            self.short[int(self.words[k][0])].append(k)
        self.hits = np.maximum(1, np.ceil(score / MATCH - 1)).astype(np.int64)  # hits that a leak has at least, per item
        self.span = np.ceil(3 * sizes - score).astype(np.int64)  # words of a document that a leak covers at most
        pairs = [np.stack([self.key(ws[:-d], ws[d:]), np.full(len(ws) - d, k)]) for k, ws in enumerate(self.words) if weights[k] >= MIN_WORDS for d in NEAR]
        seeds = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1), axis=1)
        self.keys, self.first, self.times = np.unique(seeds[0], return_index=True, return_counts=True)
        self.owners = seeds[1]

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(np.int64) << 32 | b

    def coded(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))

    def alone(self, coded: np.ndarray, text: str) -> list[tuple[int, int]]:
        """(item, place) of short items that stand alone in the text."""
        found = []
        for word in set(self.short).intersection(coded.tolist()) if self.short else ():
            at = np.flatnonzero(coded == word)
            for k in self.short[word]:
                item = self.words[k]
                here = at[at <= len(coded) - len(item)]
                for i in range(1, len(item)):
                    here = here[coded[here + i] == item[i]]
                if len(here) and (place := standing_alone(text, len(item), here.tolist())) is not None:
                    found.append((k, place))
        return found

    def windows(self, coded: np.ndarray, begin: int = 0) -> dict[int, list[list[int]]]:
        """Per item that may have a copy in the document: the stretches in which it would lie."""
        found: dict[int, list[list[int]]] = defaultdict(list)
        known = np.flatnonzero(coded >= 0)
        if not len(self.keys) or len(known) < 2:
            return found
        at, which = [], []
        for step in NEAR:  # among known words a partner is at most ``step`` further
            a, b = known[:-step], known[step:]
            for far in NEAR[step - 1:]:
                here = a[b - a == far]
                key = self.key(coded[here], coded[here + far])
                seed = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[seed] == key
                at.append(here[hit])
                which.append(seed[hit])
        place, seed = np.concatenate(at), np.concatenate(which)
        if not len(place):
            return found
        times = self.times[seed]
        total, reach = int(times.sum()), int(self.span.max())
        if total > HITS and len(coded) > 4 * reach:  # halves that share what one copy can cover
            half = len(coded) // 2
            for part, start in ((coded[:half + reach], begin), (coded[half:], begin + half)):
                for k, spans in self.windows(part, start).items():
                    found[k] += spans
            return found
        owner = self.owners[np.repeat(self.first[seed] - (np.cumsum(times) - times), times) + np.arange(total)]
        both = np.sort(owner * (len(coded) + 1) + np.repeat(place, times))
        both = both[np.append(True, both[1:] != both[:-1])]  # by item and place, each place once
        owner, place = np.divmod(both, len(coded) + 1)
        last = np.arange(len(owner)) + self.hits[owner] - 1
        inside = np.flatnonzero(last < len(owner))
        last = last[inside]
        inside, last = (x[(owner[last] == owner[inside]) & (place[last] - place[inside] < self.span[owner[inside]])] for x in (inside, last))
        for k, p, q in zip(owner[inside].tolist(), place[inside].tolist(), place[last].tolist()):
            span = int(self.span[k])
            a, b = begin + max(0, q + 1 - span), begin + min(len(coded), p + span)
            spans = found[k]
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        return found


LEAKS = "doc_id long, item_id long, similarity double, first_word int, end_word int"
KEYED = f"{LEAKS}, row string"


def _leaks(batches, block, threshold: float):
    block = block.value
    for batch in batches:
        rows = []
        for doc, text, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            words = words_of(text.as_py())
            coded = block.coded(words)
            rows += [(doc, block.ids[k], 1.0, at, at + len(block.words[k]), key) for k, at in block.alone(coded, text.as_py() or "")]
            for k, spans in block.windows(coded).items():
                item = block.words[k]
                best = max((align(item, coded[a:b], block.least[k]) + (a,) for a, b in spans), key=lambda x: x[0])
                similarity = best[0] / (MATCH * len(item))
                if similarity >= threshold and best[0] >= block.least[k]:
                    rows.append((doc, block.ids[k], similarity, best[3] + best[1], best[3] + best[2], key))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [f.split()[0] for f in KEYED.split(", ")])


def leaks(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, end_word) of every copy, the words counted as ``words_of`` cuts them."""
    return _found(documents, benchmark, threshold, F.lit(None).cast("string")).drop("row")


def _found(documents: DataFrame, benchmark: DataFrame, threshold: float, key: Column) -> DataFrame:
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key.alias("row"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    blocks = max(1, ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / BLOCK_CHARS))
    found = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about BLOCK_CHARS characters
        block = sorted(((r["item_id"], ws) for r in rows if (ws := words_of(r["text"]))), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        ready = spark.sparkContext.broadcast(Block(block, threshold))
        part = saved(texts.mapInArrow(lambda x, s=ready: _leaks(x, s, threshold), KEYED), "leaks")
        found = part if found is None else found.unionAll(part)
    return found


def clean_documents(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that hold no copy of an item; rows of one id, or of none, go one by one."""
    bad = _found(documents, benchmark, threshold, row_key("doc_id", "text")).select(F.col("row").alias("__leaked")).distinct()
    return documents.withColumn("__row", row_key("doc_id", "text")).join(bad, F.col("__row") == F.col("__leaked"), "left_anti").drop("__row")
