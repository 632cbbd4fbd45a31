"""The alignment of two tokenizers against whole encodings, and the laws of fragments."""

import hashlib
import random
from collections import Counter
from functools import reduce

import public_tokenizers
import sentencepiece
from helpers import AWKWARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlewright.llm import alignment, queries
from candlewright.llm.alignment import Fragment, compose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
BYTE_OF = {c: b for b, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
BYTE_OF |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if chr(b) not in BYTE_OF)}


def tokens(text):
    """(id, bytes) of both tokenizers over the whole text; empty where the text has no tokens."""
    if not text:
        return [], []
    a = [(i, bytes(BYTE_OF[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()) for i in B.encode(text) for p in [B.id_to_piece(i)]]
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def groups(text):
    a, b = tokens(text)
    out, i, k, at_a, at_b = [], 0, 0, 0, 0
    while i < len(a):
        mine, theirs = [], []
        while not mine or not theirs or at_a != at_b:
            if at_b < at_a:
                theirs.append(b[k][0])
                at_b, k = at_b + len(b[k][1]), k + 1
            else:
                mine.append(a[i][0])
                at_a, i = at_a + len(a[i][1]), i + 1
        out.append((mine, theirs))
    return len(a), len(b), out


def text_of(found):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)


def expected(rows):
    all_groups = [groups(r[1]) for r in rows]
    counts = Counter((a[-1], b[-1]) for _, _, g in all_groups for a, b in g)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for row, (n_a, n_b, g) in zip(rows, all_groups):
        links = [(a[-1], b[-1]) for a, b in g]
        out.append((row[0], n_a, n_b, len(g), len(g), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text_of(g).encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def query(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_alignment(spark, str(tmp_path))
    assert dict(got.dtypes) == dict(zip(COLUMNS, ["bigint"] * 7 + ["string"]))
    return sorted(map(tuple, got.select(*COLUMNS).collect()), key=str)


SIGNS = st.sampled_from(list("abé '1.,　 \t\n\r\x1c\x85\x00▁<|>中") + ["  ", " a", " word", "naïve ", "<|endoftext|>", "<s>", "\U0001f600", " 2024", "ing "])
TEXTS = st.lists(SIGNS, max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_whole_texts(texts):
    for text, (n_a, n_b, n, found, links) in zip(texts, alignment.aligner(*PATHS).whole(texts)):
        assert (n_a, n_b, n, found) == (*groups(text)[:2], len(groups(text)[2]), text_of(groups(text)[2]))
        assert len(links) == 4 * n


@settings(max_examples=300, deadline=None)
@given(TEXTS.filter(bool), st.integers(1, 30), st.integers(1, 12), st.randoms())
def test_ranges_combine_in_any_bracketing(text, chunk, window, rnd):
    parts = list(alignment.ranges(text, chunk, window))
    made = [alignment.aligner(*PATHS).part(*p) for p in parts]
    found = alignment.closed(reduce(compose, made))
    assert found[:4] == (*groups(text)[:2], len(groups(text)[2]), text_of(groups(text)[2]))
    while len(made) > 1:
        i = rnd.randrange(len(made) - 1)
        made[i:i + 2] = [compose(made[i], made[i + 1])]
    assert alignment.closed(made[0]) == found


LIST = st.lists(st.integers(0, 9).map(str), max_size=3).map(",".join)
FRAGMENTS = st.one_of(
    st.builds(lambda a, b: Fragment(n_a=len(a), head_a=a, head_b=b), LIST, LIST),
    st.builds(lambda a, b, g, c, d, ok: Fragment(ok, True, 3, 4, len(g), a, b, ";".join(g), c, d, b"12345678"), LIST, LIST, st.lists(st.just("1|2"), max_size=3), LIST, LIST, st.booleans()),
)


@given(FRAGMENTS, FRAGMENTS, FRAGMENTS)
def test_fragments_are_a_monoid(f, g, h):
    assert compose(compose(f, g), h) == compose(f, compose(g, h))
    assert compose(f, Fragment()) == f == compose(Fragment(), f)


def test_generations_of_segments(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 40)
    mine = alignment.Aligner(*PATHS)
    for i in range(12):
        texts = [sentence(30, i) + " the same words again ▁ x", sentence(30, i // 3)]
        for text, got in zip(texts, mine.whole(texts)):
            assert got[:4] == (*groups(text)[:2], len(groups(text)[2]), text_of(groups(text)[2]))
    assert len(mine.known) < 200


def test_bounds_lie_inside_words():
    parts = list(alignment.ranges(sentence(500, 1), 99, 20))
    made = [alignment.aligner(*PATHS).part(*p) for p in parts]
    assert len(parts) > 20 and any(f.tail_a or f.tail_b for f in made)
    # A stretch without joints stays whole and is encoded once.
    parts = list(alignment.ranges("a b " + "x" * 5000 + " c d", 99, 20))
    assert sum(len(p) for p, _, _ in parts) < 5200


def sentence(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("abcdeéio", k=rnd.randint(1, 9))) + rnd.choice(["", "", ",", ".\n"]) for _ in range(n))


def test_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "FREQUENT", 50)  # most pairs take the join
    rows = AWKWARD + [(100 + i, sentence(40, i % 17)) for i in range(60)] + [(200, "<|endoftext|> plain </s> text"), (201, "x" * 70000 + " end")]
    rows += [(300 + i, sentence(9000 * i, i)) for i in range(1, 4)]
    assert query(spark, tmp_path, documents(spark, rows)) == expected(rows)
    texts = {r["doc_id"]: r["groups"] for r in alignment.aligned(documents(spark, rows[-4:]), *PATHS).collect()}
    assert texts == {r[0]: text_of(groups(r[1])[2]) for r in rows[-4:]}


def test_no_rows(spark, tmp_path):
    assert query(spark, tmp_path, documents(spark, AWKWARD).limit(0)) == []


def test_no_tokens_at_all(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "▁")]
    assert query(spark, tmp_path, documents(spark, rows)) == expected(rows)
