"""What a task holds of its lines and lattices does not grow with the size of a batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from candlewright.llm import line_dedup, pieces


class Held:
    value = np.zeros((1 << 20) // 8, np.uint8)


def test_lines_of_a_batch_are_worked_on_in_pieces():
    text = "\n".join(f"a line of some thirty letters {i}" for i in range(40))
    batch = pa.RecordBatch.from_arrays([pa.array(range(8000), pa.int64()), pa.array([text] * 8000)], ["doc_id", "text"])
    for step in (lambda: line_dedup._suspects([batch], Held, 1 << 20, 20), lambda: line_dedup._parted([batch], 1, Held, 1 << 20, 20, False)):
        tracemalloc.start()
        rows = sum(b.num_rows for b in step())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows in (0, 8000) and peak < 12e6


def test_bits_in_blocks_are_the_bits(monkeypatch):
    hashes = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    want = line_dedup.bit_positions(hashes, 1 << 20)
    monkeypatch.setattr(line_dedup, "BLOCK", 7)
    assert (line_dedup.bit_positions(hashes, 1 << 20) == want).all() and len(np.unique(want)) > 2900


def test_remembered_lattices_are_bytes_and_say_the_same():
    texts = ["the quick brown fox jumps over the lazy dog", "über allen Gipfeln ist Ruh", ""]
    v = pieces.Vocabulary(pieces.VOCABULARY)
    say = lambda: [(i.tolist(), log, share) for x in pieces.segmentations(texts, [1, 2, 3], 3, v) for i, log, share in x]
    first = say()
    assert v.met and all(isinstance(x, bytes) for pair in v.met.values() for x in pair) and say() == first
