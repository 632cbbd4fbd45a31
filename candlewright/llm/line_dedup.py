"""Lines that many documents share, dropped everywhere but in one document (operator 5).

1. Every task hashes the keys of its lines and sends the bits of two Bloom filters, segment by segment: the filter
   of keys seen, and that of keys seen twice. Segments are merged bit by bit; a bit set by two tasks is seen twice.
2. The merged filter of twice-seen keys, at most ``MAX_FILTER_BITS`` in size whatever the input, goes to all tasks.
   Only lines that it suspects are shuffled, with their full keys: these are counted exactly, in partial counts first.
3. A key of enough documents keeps its lines in the largest ``doc_id`` that holds it. The suspected lines, distinct and
   written, meet the shared keys in a join that adaptive execution may split, so a line that half of the documents hold
   is not one task.
4. Documents without a suspected line never leave the task that reads them; the others are joined with their lost lines.

Filters have no false negatives, so the result is exact. Beyond the size bound they suspect more lines; more rows are
then counted exactly, and the result stays the same.

Defined cases: a null or empty text is one empty line; rows that share a doc_id are one document, each row keeps its
own lines; a row without doc_id is neither counted nor changed; lines shorter than ``min_chars`` stay; an empty table
gives an empty result; all columns of the input are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright.llm.base import mixed, saved

WHITE = " \t\n\x0b\x0c\r"
SEGMENT_BITS = 1 << 16
PROBES = 3
BITS_PER_LINE, CHARS_PER_LINE = 12, 40
#: The bound of what is sent to every task: 256 MiB.
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 20, 1 << 31
CHUNK = 1 << 20
#: Hashes whose bits are worked out together, and documents whose lines are.
BLOCK, ROWS = 1 << 16, 512


def line_key(line: str, min_chars: int) -> bytes | None:
    """The key of a line that is long enough, else None. Bytes are lower-cased in ASCII only."""
    if len(line) < min_chars or len(line := line.strip(WHITE)) < min_chars:
        return None
    return line.encode().lower()


def keys_of(text: str | None, min_chars: int) -> list[bytes]:
    return list({k for x in (text or "").split("\n") if (k := line_key(x, min_chars)) is not None})


def bit_positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One row of positions per hash."""
    out = np.empty((len(hashes), PROBES), np.int64)
    for a in range(0, len(hashes), BLOCK):
        some = hashes[a:a + BLOCK]
        with np.errstate(over="ignore"):
            other = mixed(some) | np.uint64(1)
            steps = some[:, None] + other[:, None] * np.arange(PROBES, dtype=np.uint64)[None, :]
        out[a:a + BLOCK] = mixed(steps) & np.uint64(bits - 1)
    return out


def _pieces_of(batches) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of ``ROWS`` rows, so that the lines of few documents are held at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _segments(positions: np.ndarray, twice: bool) -> Iterator[tuple[int, bool, bytes]]:
    positions = np.unique(positions)
    segment = positions // SEGMENT_BITS
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if len(segment) else []
    offsets = (positions % SEGMENT_BITS).astype(np.uint16)
    for a, b in zip(starts, np.r_[starts[1:], len(segment)] if len(segment) else []):
        yield int(segment[a]), twice, offsets[a:b].tobytes()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


FILTER_SCHEMA = pa.schema([("segment", pa.int32()), ("twice", pa.bool_()), ("offsets", pa.binary())])


def _task_filters(batches, bits: int, min_chars: int):
    def flush(hashes: list[np.ndarray]):
        seen, times = np.unique(np.concatenate(hashes), return_counts=True)
        at = bit_positions(seen, bits)
        for positions, twice in ((at, False), (at[times > 1], True)):
            rows: list[tuple] = []
            for row in _segments(positions.ravel(), twice):
                rows.append(row)
                if len(rows) == 4096:
                    yield _rows(rows, FILTER_SCHEMA)
                    rows = []
            if rows:
                yield _rows(rows, FILTER_SCHEMA)

    hashes: list[np.ndarray] = []
    held = 0
    for batch in _pieces_of(batches):
        for text in batch.column(0):
            found = keys_of(text.as_py(), min_chars)
            if found:
                hashes.append(_hashes(found))
                held += len(found)
            if held >= CHUNK:
                yield from flush(hashes)
                hashes, held = [], 0
        if hashes:
            hashes = [np.concatenate(hashes)]
    if hashes:
        yield from flush(hashes)


def _merged(batches):
    """Rows come sorted by segment."""
    at, once, twice = None, None, None
    out: list[tuple] = []
    for batch in batches:
        for segment, again, offsets in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if segment != at:
                if at is not None and twice.any():
                    out.append((at, np.packbits(twice).tobytes()))
                at, once, twice = segment, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
            bits = np.frombuffer(offsets, np.uint16)
            if again:
                twice[bits] = True
            else:
                twice[bits[once[bits]]] = True
                once[bits] = True
        if len(out) > 256:
            yield _rows(out, pa.schema([("segment", pa.int32()), ("bits", pa.binary())]))
            out = []
    if at is not None and twice.any():
        out.append((at, np.packbits(twice).tobytes()))
    yield _rows(out, pa.schema([("segment", pa.int32()), ("bits", pa.binary())]))


def filter_bits(documents: DataFrame) -> int:
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    wanted = 1 << math.ceil(math.log2(max(chars / CHARS_PER_LINE * BITS_PER_LINE, 1)))
    return min(max(wanted, MIN_FILTER_BITS), MAX_FILTER_BITS)


def twice_seen(documents: DataFrame, bits: int, min_chars: int = 20) -> np.ndarray:
    """The bitmap of keys that may stand in two rows or more; at most ``MAX_FILTER_BITS`` / 8 bytes."""
    parts = documents.select("text").mapInArrow(lambda b: _task_filters(b, bits, min_chars), "segment int, twice boolean, offsets binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment int, bits binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    width = SEGMENT_BITS // 8
    for row in merged.toLocalIterator():
        bitmap[row["segment"] * width:(row["segment"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def _suspects(batches, bitmap, bits: int, min_chars: int):
    for batch in _pieces_of(batches):
        owners: list[int] = []
        keys: list[bytes] = []
        for i, text in enumerate(batch.column(1)):
            found = keys_of(text.as_py(), min_chars)
            keys += found
            owners += [i] * len(found)
        at = bit_positions(_hashes(keys), bits)
        hit = np.flatnonzero(((bitmap.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)) if keys else []
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array([owners[i] for i in hit], pa.int64())), pa.array([keys[i] for i in hit], pa.binary())], ["doc_id", "line_key"]
        )


def shared_lines(documents: DataFrame, min_chars: int = 20, min_documents: int = 3) -> DataFrame:
    """(doc_id, line_key) of all lines to drop."""
    bits = filter_bits(documents)
    return _shared(documents, documents.sparkSession.sparkContext.broadcast(twice_seen(documents, bits, min_chars)), bits, min_chars, min_documents)


def _shared(documents: DataFrame, bitmap, bits: int, min_chars: int, min_documents: int) -> DataFrame:
    rows = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(lambda b: _suspects(b, bitmap, bits, min_chars), "doc_id long, line_key binary")
    suspects = saved(found.distinct(), "line-suspects")  # by document and line: no hot key; written, so a hot line can be split
    counted = suspects.groupBy("line_key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    shared = saved(counted.where(F.col("n") >= min_documents).select("line_key", "keeper"), "line-shared")
    return saved(suspects.join(shared, "line_key").where(F.col("doc_id") != F.col("keeper")).select("doc_id", "line_key"), "line-lost")


def _parted(batches, text_at: int, bitmap, bits: int, min_chars: int, suspected: bool):
    """The rows with a suspected line, or the others."""
    for batch in _pieces_of(batches):
        texts = batch.column(text_at)
        hashes, counts = [np.zeros(0, np.uint64)], np.zeros(batch.num_rows, np.int64)
        for i, text in enumerate(texts):
            found = keys_of(text.as_py(), min_chars)
            hashes.append(_hashes(found))
            counts[i] = len(found)
        at = bit_positions(np.concatenate(hashes), bits)
        hit = ((bitmap.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
        chosen = np.zeros(batch.num_rows, bool)
        chosen[np.repeat(np.arange(batch.num_rows), counts)[hit]] = True
        yield batch.filter(pa.array(chosen if suspected else ~chosen))


def _stripped(batches, text_at: int, drop_at: int, min_chars: int):
    for batch in _pieces_of(batches):
        columns = batch.columns
        texts, counts, gone = [], [], []
        for text, drop in zip(columns[text_at], columns[drop_at]):
            text, lost = text.as_py(), 0
            total = (text or "").count("\n") + 1
            if drop.is_valid:
                unwanted = set(drop.as_py())
                kept = [x for x in (text or "").split("\n") if line_key(x, min_chars) not in unwanted]
                lost = total - len(kept)
                text = "\n".join(kept) if lost else text
            texts.append(text)
            counts.append(total)
            gone.append(lost)
        columns = [pa.array(texts, columns[text_at].type) if i == text_at else c for i, c in enumerate(columns) if i != drop_at]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], [f"c{i}" for i in range(len(columns) + 2)])


def deduplicated(documents: DataFrame, min_chars: int = 20, min_documents: int = 3) -> DataFrame:
    """The documents with their columns, shared lines taken out of ``text``, and __n_lines (before) and __n_dropped."""
    bits = filter_bits(documents)
    bitmap = documents.sparkSession.sparkContext.broadcast(twice_seen(documents, bits, min_chars))
    lost = _shared(documents, bitmap, bits, min_chars, min_documents).groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_list("line_key").alias("__drop"))
    text_at, drop_at = documents.columns.index("text"), len(documents.columns)
    part = lambda suspected: documents.mapInArrow(lambda b: _parted(b, text_at, bitmap, bits, min_chars, suspected), documents.schema)
    joined = part(True).join(lost, F.col("doc_id").cast("long") == F.col("__doc"), "left").drop("__doc")
    rows = joined.unionAll(part(False).withColumn("__drop", F.lit(None).cast("array<binary>")))
    fields = [T.StructField(f.name, f.dataType) for f in documents.schema] + [T.StructField("__n_lines", T.LongType()), T.StructField("__n_dropped", T.LongType())]
    return rows.mapInArrow(lambda b: _stripped(b, text_at, drop_at, min_chars), T.StructType(fields))
