"""Token ids of documents in compressed files that can be read document by document (operator 12).

A file is a row of independent zstandard frames of ids (unsigned 32-bit, little-endian), a skippable frame with the table
of its documents, and a seek table in the public seekable format: compressed size, content size and checksum (low half of
XXH64) per frame. Each frame also carries zstandard's own checksum. A frame holds whole documents, up to ``FRAME_IDS`` ids;
only a longer document runs over several frames of its own. So a reader of some documents finds their frames in the two
tables and decompresses nothing else.

Texts are range-partitioned by document id and encoded in the task that writes them, so ids are never shuffled. A task
writes under names of its own attempt and hands on a row per document. Spark commits these rows as the index; files that it
doesn't name (of lost or doubled attempts) don't count. The manifest has one row per file, with the ids before it.

Memory: a few MB of texts, one frame, and the document table of the open file, which is bounded by ``ROLL_DOCS``.

Defined cases: a null or empty text has the end id only; rows without id come first; rows that repeat an id are ordered by
a hash of the text and by the text; the text of a special token becomes that token, as the tokenizer has it; an empty table
gives an archive without files; other columns are not read. A broken frame or table raises.
"""

from __future__ import annotations

import struct
import uuid
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewright.llm import segments as S
from candlewright.llm.warc import file_system
from candlewright.session import shared_folder

END_ID = 2
FRAME_IDS = 1 << 16
ROLL_BYTES, ROLL_DOCS = 256 << 20, 1 << 20
BATCH_CHARS = 1 << 21
LEVEL = 3
# Fixed values of the public formats: skippable frames, seek table and its footer.
DOCUMENT_FRAME, SEEK_FRAME, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80
INDEX = "file string, doc_id long, place long, n_tokens long"
DOCUMENTS = "doc_id long, start long, ids binary"
_TABLE = np.dtype([("doc_id", "<i8"), ("known", "<u1"), ("n", "<u8")])


class Encoder:
    """Ids of texts as bytes, by way of segments met before."""

    def __init__(self, path: str):
        self.model, self.known, self.held = S.ByteLevel(path, specials_as_text=False), {}, 0

    def _fresh(self, found: set[str]) -> None:
        for run in S.runs(found):
            text = " " + " ".join(run)
            ids = np.array(self.model.encode([text])[0], "<u4")
            ends = (S.ends_in(run, text.encode(), self.model.lengths[ids]) * 4).tolist()
            data, begin = ids.tobytes(), 0
            for s, end in zip(run, ends):
                self.known[s] = data[begin:end]
                begin = end
            self.held += len(text) + 60 * len(run)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.held > S.REMEMBERED:
            self.known, self.held = {}, 0
        whole = [any(x in t for x in self.model.specials) for t in texts]
        cut = [[t] if w else S.segments(t) for t, w in zip(texts, whole)]
        firsts = [np.array(ids, "<u4").tobytes() for ids in self.model.encode([c.pop(0) for c in cut])]
        self._fresh(set().union(*cut).difference(self.known))
        of = self.known.__getitem__
        return [first + b"".join(map(of, c)) for first, c in zip(firsts, cut)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# Files


def _skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


class Writer:
    """One file; frames go out as they fill."""

    def __init__(self, stream):
        self.stream, self.pack = stream, zstandard.ZstdCompressor(LEVEL, write_checksum=True, write_content_size=True)
        self.frames, self.documents, self.buffer, self.size = [], [], bytearray(), 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        limit = 4 * FRAME_IDS
        self.documents.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        if self.buffer and len(self.buffer) + len(ids) > limit:
            self._frame()
        for a in range(0, len(ids), limit):
            self.buffer += ids[a:a + limit]
            if len(self.buffer) >= limit:
                self._frame()

    def _put(self, data: bytes, content: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)
        self.frames.append((len(data), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def _frame(self) -> None:
        content = bytes(self.buffer)
        self._put(self.pack.compress(content), content)
        self.buffer.clear()

    def close(self) -> None:
        if self.buffer:
            self._frame()
        self._put(_skippable(DOCUMENT_FRAME, self.pack.compress(np.array(self.documents, _TABLE).tobytes())), b"")
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEKABLE)
        self.stream.write(_skippable(SEEK_FRAME, table))
        self.stream.close()


class Reader:
    """Random access to one file."""

    def __init__(self, file):
        self.file, size = file, file.size()
        self.unpack = zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        table = self._at(size - 9 - 12 * n - 8, 8 + 12 * n)
        if magic != SEEKABLE or flags != WITH_CHECKSUMS or struct.unpack("<II", table[:8]) != (SEEK_FRAME, 12 * n + 9):
            raise ValueError("no seek table")
        frames = np.frombuffer(table[8:], "<u4").reshape(n, 3).astype(np.int64)
        self.places = np.r_[0, np.cumsum(frames[:, 0])].tolist()
        if self.places[-1] != size - 9 - 12 * n - 8:
            raise ValueError("the seek table doesn't add up to the file")
        self.starts = (np.r_[0, np.cumsum(frames[:-1, 1])] // 4).tolist()  # ids before each frame, and all ids
        self.sums, self.opened, self.last = frames[:, 2].tolist(), [], (-1, b"")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            content = self.unpack.decompress(self._at(self.places[k], self.places[k + 1] - self.places[k]))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            self.last = k, content
            self.opened.append(k)
        return self.last[1]

    def ids(self, place: int, n: int) -> bytes:
        """Bytes of ``n`` ids from ``place`` on."""
        k, parts = bisect_right(self.starts, place) - 1, []
        end = place + n
        while place < end:
            stop = min(end, self.starts[k + 1])
            parts.append(self.frame(k)[4 * (place - self.starts[k]):4 * (stop - self.starts[k])])
            place, k = stop, k + 1
        return b"".join(parts)

    def documents(self) -> np.ndarray:
        """(doc_id, known, n) of all documents in order."""
        data = self._at(self.places[-2], self.places[-1] - self.places[-2])
        if struct.unpack("<I", data[:4])[0] != DOCUMENT_FRAME:
            raise ValueError("no document table")
        return np.frombuffer(self.unpack.decompress(data[8:]), _TABLE)


# Writing


def _pieces(batches):
    """Ids and texts in order, about ``BATCH_CHARS`` characters at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= BATCH_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _write(batches, folder: str, vocabulary: str):
    context = TaskContext.get()
    fs, path = file_system(folder)
    end, n_files, out, place, rows = END_ID.to_bytes(4, "little"), 0, None, 0, []

    def closed():
        out.close()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in INDEX.split(", ")])

    for ids, texts in _pieces(batches):
        for doc_id, data in zip(ids, encoder(vocabulary)(texts)):
            if out is None:
                file = f"tokens-{context.partitionId():06d}-{n_files:05d}-{context.taskAttemptId()}.zst"
                out, n_files, place, rows = Writer(fs.open_output_stream(f"{path}/{file}", compression=None)), n_files + 1, 0, []
            out.add(doc_id, data + end)
            rows.append((file, doc_id, place, len(data) // 4 + 1))
            place += len(data) // 4 + 1
            if out.size >= ROLL_BYTES or len(rows) >= ROLL_DOCS:
                yield closed()
                out = None
    if out is not None:
        yield closed()


def write_tokens(docs: DataFrame, folder: str, vocabulary: str) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id, text) below ``folder``; returns the manifest: file, n_docs, n_ids, base, first_doc, last_doc."""
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    ordered.mapInArrow(lambda b: _write(b, folder, vocabulary), INDEX).write.parquet(f"{folder}/_index")
    spark = docs.sparkSession
    files = spark.read.schema(INDEX).parquet(f"{folder}/_index").groupBy("file").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_ids"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    # One row per file of up to ROLL_BYTES; their names are in the order of the documents.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{folder}/_manifest")
    return manifest_of(spark, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("file string, n_docs long, n_ids long, first_doc long, last_doc long, base long").parquet(f"{folder}/_manifest")


# Reading


def _rows(ids: list, starts: list, data: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(data, pa.binary())], [f.split()[0] for f in DOCUMENTS.split(", ")])


def _flushed(found):
    rows, size = [], 0
    for row in found:
        rows.append(row)
        size += len(row[2]) + 64
        if size >= 8 << 20:
            yield _rows(*map(list, zip(*rows)))
            rows, size = [], 0
    if rows:
        yield _rows(*map(list, zip(*rows)))


def _read_files(batches, folder: str):
    fs, path = file_system(folder)

    def found():
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{path}/{file}") as opened:
                    reader, place = Reader(opened), 0
                    for doc_id, known, n in reader.documents().tolist():
                        yield doc_id if known else None, base + place, reader.ids(place, n)
                        place += n

    return _flushed(found())


def _read_places(batches, folder: str):
    fs, path = file_system(folder)

    def found():
        current, opened, reader = None, None, None
        for batch in batches:
            for file, base, place, n, doc_id in zip(*(c.to_pylist() for c in batch.columns)):
                if file != current:
                    if opened is not None:
                        opened.close()
                    current, opened = file, fs.open_input_file(f"{path}/{file}")
                    reader = Reader(opened)
                yield doc_id, base + place, reader.ids(place, n)
        if opened is not None:
            opened.close()

    return _flushed(found())


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """All documents: doc_id, start (ids before it), ids (unsigned 32-bit, little-endian)."""
    files = manifest_of(spark, folder).select("file", "base")
    return files.repartitionByRange(max(1, min(files.count(), 100_000)), "file").mapInArrow(lambda b: _read_files(b, folder), DOCUMENTS)


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """As ``read_tokens``, for the documents whose doc_id is in ``wanted``; only their frames are decompressed."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/_index")
    some = index.join(wanted.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi").join(manifest_of(spark, folder).select("file", "base"), "file")
    ordered = some.select("file", "base", "place", "n_tokens", "doc_id").repartition("file").sortWithinPartitions("file", "place")
    return ordered.mapInArrow(lambda b: _read_places(b, folder), DOCUMENTS)


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/llm/tokens-{uuid.uuid4().hex}"
