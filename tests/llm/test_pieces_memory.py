"""What a task of segmentations holds at once, and that the search for pieces loses none."""

import tracemalloc

import numpy as np
import pyarrow as pa

from candlewright.llm import pieces as P


def batch(n, words):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x:x}é" for x in rng.integers(0, 1 << 40, words)) for _ in range(n)]
    return pa.record_batch([pa.array(range(n), pa.int64()), pa.array(texts)], ["doc_id", "text"])


def test_memory_of_many_texts(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 0)
    found = batch(200, 800)
    P.vocabulary(P.VOCABULARY)
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in P._encoded([found], 2, 0, P.VOCABULARY)) == 400
        assert tracemalloc.get_traced_memory()[1] < 200e6
    finally:
        tracemalloc.stop()


def test_every_piece_of_a_word_is_an_arc(monkeypatch):
    v = P.Vocabulary(P.VOCABULARY)
    words = list(dict.fromkeys(P.words_of("international characterisation of the Überraschung 上海 naïve aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa http://www.example.com/ \n\n")))
    lattice = P.Lattice(words, v)
    got = sorted(zip(lattice.start.tolist(), lattice.end.tolist(), lattice.piece[:].tolist()))
    plain = {p: i for i, p in enumerate(v.pieces) if np.isfinite(v.log[i]) and i not in v.bytes_of}
    want = []
    for k, w in enumerate(words):
        first = int(lattice.first[lattice.word[k]])
        want += [(first + a, first + b, plain[w[a:b]]) for a in range(len(w)) for b in range(a + 1, len(w) + 1) if w[a:b] in plain]
    assert [g for g in got if g[2] < P.BYTES] == sorted(want)
