"""The token archive against encoding the same texts one by one, and its files read by plain zstandard."""

import io
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from helpers import AWKWARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlewright.llm import queries, segments, token_store

FILE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(FILE)


def whole(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    """doc_id, start, n, crc in order; rows that repeat an id have distinct texts of any order, so only sums are compared."""
    return {(r[0], len(whole(r[1])) + 1, zlib.crc32(np.array(whole(r[1]) + [2], "<u4").tobytes())) for r in rows}


ALPHABET = st.sampled_from(list("ab '1.,é　 \t\n\r\x1c\x85\x00<|>中") + ["  ", " a", "'s ", " 's", "<|endoftext|>", "word ", "\U0001f600"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=6))
def test_segments_give_the_ids_of_the_whole_text(texts):
    encode = token_store.encoder(FILE)
    assert [token_store.ids_of(x) for x in encode(texts)] == [whole(t) for t in texts]
    assert all(" ".join(segments.segments(t)) == t for t in texts)


def test_memory_begins_anew(monkeypatch):
    monkeypatch.setattr(segments, "REMEMBERED", 100)
    encode = token_store.Encoder(FILE)
    for i in range(5):
        text = f"one two three{i} four " * 30
        assert token_store.ids_of(encode([text])[0]) == whole(text)
    assert encode.held < 1000


def test_query(spark, tmp_path):
    rows = AWKWARD + [(100 + i, f"Text {i} with <|endoftext|> inside, and words" * (i % 7)) for i in range(40)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_token_store(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got} == expected(rows) and len(got) == len(rows)
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == list(np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1])
    ids = [r["doc_id"] for r in ordered]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_no_rows(spark, tmp_path):
    documents(spark, AWKWARD).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op12_token_store(spark, str(tmp_path)).collect() == []


def words(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("abcdefghij", k=5)) for _ in range(n))


def test_only_requested_frames_are_opened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "FRAME_IDS", 500)
    monkeypatch.setattr(token_store, "ROLL_DOCS", 20)
    texts = {i: words(30 + (5000 if i == 33 else 0), i) for i in range(60)}
    ids = {i: np.array(whole(t) + [2], "<u4").tobytes() for i, t in texts.items()}
    path = str(tmp_path / "a.zst")
    writer = token_store.Writer(open(path, "wb"))
    for i in ids:
        writer.add(i, ids[i])
    writer.close()
    # A frame holds whole documents; the long one has frames of its own.
    assert max(f[1] for f in writer.frames) <= 2000 and len(writer.frames) > 20
    with token_store.file_system(path)[0].open_input_file(path) as opened:
        reader = token_store.Reader(opened)
        table = reader.documents()
        places = np.r_[0, np.cumsum(table["n"])].astype(int)
        assert table["doc_id"].tolist() == list(range(60))
        assert reader.opened == []
        assert reader.ids(places[40], int(table["n"][40])) == ids[40] and len(reader.opened) == 1
        assert reader.ids(places[33], int(table["n"][33])) == ids[33]
        assert len(reader.opened) == 1 + -(-len(ids[33]) // 2000)
    # Any zstandard reader passes over the tables and checks the frames.
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(path, "rb").read()), read_across_frames=True).read()
    assert plain == b"".join(ids.values())


def test_some_documents(spark, tmp_path):
    texts = {i: words(20, i) for i in range(500)}
    folder = f"file:{tmp_path}/tokens"
    manifest = token_store.write_tokens(documents(spark, list(texts.items())).repartition(5), folder, FILE)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == 500
    files = {r["file"] for r in manifest.collect()}
    # A file of an attempt that didn't count.
    stray = f"{tmp_path}/tokens/tokens-000000-00000-99999.zst"
    open(stray, "wb").write(b"half a file")
    asked = [3, 77, 78, 499, 1000]
    some = token_store.read_documents(spark, folder, spark.createDataFrame([(i,) for i in asked + [3]], "doc_id int")).collect()
    everything = {r["doc_id"]: r for r in token_store.read_tokens(spark, folder).collect()}
    assert sorted(r["doc_id"] for r in some) == asked[:-1] and len(everything) == 500
    assert all(r == everything[r["doc_id"]] for r in some)
    assert all(token_store.ids_of(r["ids"]) == whole(texts[i]) + [2] for i, r in everything.items())
    assert {f for f in os.listdir(f"{tmp_path}/tokens") if f.endswith(".zst")} == files | {os.path.basename(stray)}


@pytest.mark.parametrize("place", [10, -5, -30])
def test_broken_files(tmp_path, place):
    path = str(tmp_path / "a.zst")
    writer = token_store.Writer(open(path, "wb"))
    writer.add(1, np.arange(3000, dtype="<u4").tobytes())
    writer.close()
    data = bytearray(open(path, "rb").read())
    data[place] ^= 0x55
    open(path, "wb").write(data)
    with pytest.raises((ValueError, zstandard.ZstdError)), token_store.file_system(path)[0].open_input_file(path) as opened:
        reader = token_store.Reader(opened)
        reader.documents()
        reader.ids(0, 3000)
