"""Sharded WARC archives: a deterministic writer and a reader (operator 1).

* Shards are ranges of page ids, cut so that each has about ``SHARD_BYTES`` of payload. The cuts come from a histogram of
  at most ``BINS`` ranges of ids (and 256 ranges of digests for pages without id), so they follow from the rows alone,
  not from partitions or settings. A task writes the records of its shards in order of page id and digest into gzip
  files, one member per record, and begins a new file when the compressed size passes ``roll_bytes``.
* Headers and digests are made anew from the payload. Payloads of at least ``MIN_REVISIT`` bytes are written once: the
  page with the smallest id is the response, others revisit it. Which pages those are is found on (page id, digest)
  alone; the payloads are shuffled once. The notes about revisits travel to the same shards as their pages.
* A record is named by page id, digest and copy, so a revisit refers to the record that holds its own payload.
* A task writes under temporary names that hold its attempt, and hands on what it wrote. The manifest, a table that
  Spark commits, names the files of the attempts that counted; only they are renamed, and readers go by the manifest.

Memory: one record per task, plus a read buffer. A page id that repeats with more than a shard's worth of payloads is one
shard. Files go through ``pyarrow.fs``, so the folder may be on any file system that it knows.

Defined cases: a null html is an empty payload; a null or empty url leaves out the target; a page without id is always
a response; rows that repeat id and payload are written each, the first as response if no smaller id holds the payload;
an empty table gives an archive without files; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm.base import saved
from candlewright.session import shared_folder

MIN_REVISIT = 100
ROLL_BYTES = 64 << 20
SHARD_BYTES, BINS = 64 << 20, 1 << 16
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, temporary string, n_records long, n_bytes long, sha256 string, first_page long, last_page long"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


# Records


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'page:{page_id}:{digest}:{copy}'.encode()).digest()[:16])}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member; no time of writing in it, so that equal input gives equal bytes."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + b"\r\n") + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, copy: int, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or, where ``refers_to`` is given, a revisit without it."""
    kind = "response" if refers_to is None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest, copy)), ("WARC-Date", date)]
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    if url:
        headers.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Page-ID", str(refers_to))]
    headers += [("WARC-Payload-Digest", "sha256:" + digest), ("WARC-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record(headers, http if refers_to is not None else http + payload)


def members(stream) -> Iterator[bytes]:
    """The content of one gzip member after another."""
    unpacker, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(unpacker.decompress(chunk))
            if not unpacker.eof:
                break
            yield b"".join(parts)
            chunk, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends within a record")


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block; raises if a length or digest doesn't hold."""
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(headers["Content-Length"])]
    if first != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError(f"broken record {headers.get('WARC-Record-ID')}")
    return headers, block


# Writing


class _Shard:
    """The files of one shard."""

    def __init__(self, folder: str, part: int, attempt: int, roll_bytes: int, date: str):
        self.fs, self.folder = file_system(folder)
        self.part, self.attempt, self.roll_bytes, self.date = part, attempt, roll_bytes, date
        self.n_files, self.stream, self.done = 0, None, []
        self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)

    def write(self, page_id: int | None, data: bytes) -> None:
        if self.stream is None:
            self.file = f"pages-{self.part:05d}-{self.n_files:05d}.warc.gz"
            self.temporary = f"_temporary/{self.file}.{self.attempt}"
            self.stream, self.size, self.count, self.sum, self.first = self.fs.open_output_stream(f"{self.folder}/{self.temporary}", compression=None), 0, 0, hashlib.sha256(), page_id
            self.n_files += 1
            info = f"software: candlewright\r\nformat: WARC File Format 1.1\r\nfilename: {self.file}\r\n".encode()
            self._put(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, "", self.part << 20 | self.n_files)), ("WARC-Date", self.date), ("WARC-Filename", self.file), ("Content-Type", "application/warc-fields")], info))
        self._put(data)
        self.count, self.last = self.count + 1, page_id
        if self.size >= self.roll_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sum.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None
            self.done.append((self.file, self.temporary, self.count, self.size, self.sum.hexdigest(), self.first, self.last))


def _write(batches, folder: str, roll_bytes: int, date: str):
    """Rows come sorted by shard, page_id and digest, with the note (tag 0) of a page and digest before its payloads."""
    attempt, done = TaskContext.get().taskAttemptId(), []
    shard, current, head, copy = None, None, None, 0
    for batch in batches:
        for number, page_id, digest, tag, refers_to, url, html in zip(*batch.columns):
            number, page_id, digest = number.as_py(), page_id.as_py(), digest.as_py()
            if shard is None or number != shard.part:
                if shard is not None:
                    shard.close()
                    done += shard.done
                shard, current = _Shard(folder, number, attempt, roll_bytes, date), None
            if (page_id, digest) != current:
                current, head, copy = (page_id, digest), None, 0
            if tag.as_py() == 0:
                head = refers_to.as_py()
                continue
            payload = bytes(html.as_buffer() or b"") if html.is_valid else b""
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of page {page_id} changed on its way")
            first = head == page_id and copy == 0
            shard.write(page_id, page_record(page_id, url.as_py(), payload, digest, copy, None if first else head, date))
            copy += 1
    if shard is not None:
        shard.close()
        done += shard.done
    columns = list(zip(*done)) or [()] * 7
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], [f.split()[0] for f in MANIFEST.split(", ")])


def _commit(batches, folder: str):
    """Renaming can be done again: a file that is in place counts as renamed."""
    fs, path = file_system(folder)
    for batch in batches:
        for file, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if fs.get_file_info(f"{path}/{file}").type == pafs.FileType.NotFound:
                fs.move(f"{path}/{temporary}", f"{path}/{file}")
        yield batch


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of all pages whose payload stands in several rows. Payloads don't leave their task."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    thin = pages.where(F.col("page_id").isNotNull() & (F.octet_length(payload) >= MIN_REVISIT)).select(F.col("page_id").cast("long").alias("page_id"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    thin = saved(thin, "warc-digests")
    heads = thin.groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("refers_to")).where(F.col("n") > 1)
    # The written table lets a digest that many pages share be split over tasks in the join.
    return thin.join(saved(heads.drop("n"), "warc-heads"), "digest").distinct()


def shards(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[Callable[[Column, Column], Column], int]:
    """The number of a row's shard, out of its page id and payload digest, and how many shards there are."""
    low, high = pages.agg(F.min(F.col("page_id").cast("long")), F.max(F.col("page_id").cast("long"))).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // BINS))

    def bin_of(page_id: Column, digest: Column) -> Column:
        of_digest = F.conv(F.substring(digest, 1, 2), 16, 10).cast("long") - 256  # before all ids
        by_width = F.floor((page_id.cast("decimal(38,0)") - F.lit(low or 0).cast("decimal(38,0)")) / F.lit(width).cast("decimal(38,0)")).cast("long")
        return F.when(page_id.isNull(), of_digest).otherwise(by_width)

    digest = F.when(F.col("page_id").isNull(), F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256))
    sizes = pages.groupBy(bin_of(F.col("page_id").cast("long"), digest).alias("bin")).agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 64).alias("size"))
    starts, filled = [], shard_bytes
    for r in sorted(sizes.collect()):  # at most BINS + 256 rows
        if filled >= shard_bytes:
            starts.append(r["bin"])
            filled = 0
        filled += r["size"]
    if not starts:
        return lambda page_id, digest: F.lit(0), 1
    bounds = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")

    def shard_of(page_id: Column, digest: Column) -> Column:
        """How many shards begin at or before the bin, less one: found by halving the list of bounds."""
        steps = F.sequence(F.lit(len(starts).bit_length() - 1), F.lit(0), F.lit(-1))
        at = bin_of(page_id, digest)
        further = lambda a, k: a + F.call_function("shiftleft", F.lit(1), k)
        return F.aggregate(steps, F.lit(0), lambda a, k: F.when((further(a, k) <= len(starts)) & (F.get(bounds, further(a, k) - 1) <= at), further(a, k)).otherwise(a)) - 1

    return shard_of, len(starts)


def write_archive(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, date: str = "2000-01-01T00:00:00Z", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) below ``folder`` and returns the manifest, a row per file."""
    none = F.lit(None)
    shard_of, n_shards = shards(pages, shard_bytes)
    notes = revisits(pages).select("page_id", "digest", F.lit(0).alias("tag"), "refers_to", none.cast("string").alias("url"), none.cast("string").alias("html"))
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), digest.alias("digest"), F.lit(1).alias("tag"), none.cast("long").alias("refers_to"), "url", "html")
    placed = notes.unionAll(rows).select(shard_of(F.col("page_id"), F.col("digest")).alias("shard"), "page_id", "digest", "tag", "refers_to", "url", "html")
    ordered = placed.repartition(n_shards, "shard").sortWithinPartitions("shard", "page_id", "digest", "tag", "url")
    written = saved(ordered.mapInArrow(lambda b: _write(b, folder, roll_bytes, date), MANIFEST), "warc-written")
    written.repartition(max(1, min(written.count(), 10_000)), "file").mapInArrow(lambda b: _commit(b, folder), MANIFEST).write.parquet(f"{folder}/_manifest")
    fs, path = file_system(folder)
    if fs.get_file_info(f"{path}/_temporary").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{path}/_temporary")
    return pages.sparkSession.read.parquet(f"{folder}/_manifest")


# Reading

RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _read(batches, folder: str, with_payload: bool):
    fs, path = file_system(folder)
    rows, held = [], 0
    number = lambda x: None if x is None else int(x)

    def flush():
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [f.split()[0] for f in RECORDS.split(", ")])

    for batch in batches:
        for file in batch.column(0).to_pylist():
            with fs.open_input_stream(f"{path}/{file}", compression=None) as stream:
                for headers, block in map(parsed, members(stream)):
                    kind = headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    length = int(headers["WARC-Payload-Length"])
                    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} doesn't match its digest")
                    keeps = payload if with_payload and kind == "response" else None
                    rows.append((number(headers.get("WARC-Page-ID")), headers.get("WARC-Target-URI"), kind, length, digest, number(headers.get("WARC-Refers-To-Page-ID")), keeps))
                    held += len(keeps or b"") + 200
                    if held > 16 << 20:
                        yield flush()
                        rows, held = [], 0
    yield flush()


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files in the manifest; a revisit has no payload of its own."""
    manifest = spark.read.parquet(f"{folder}/_manifest").select("file")
    return manifest.repartition(max(1, min(manifest.count(), 100_000)), "file").mapInArrow(lambda b: _read(b, folder, with_payload), RECORDS)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/llm/warc-{uuid.uuid4().hex}"
