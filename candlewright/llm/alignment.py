"""Alignment of two tokenizers over the same texts (operator 13).

A text is encoded by a byte-level vocabulary (A) and by a vocabulary of pieces (B). Byte offsets where tokens of both end
cut the tokens into groups; a group closes with a link between its last two tokens.

Fragments: what a byte range knows is an open prefix (tokens up to and with the first common end), closed groups, and an
open suffix. A token belongs to the range in which it ends. ``compose`` joins the fragments of two neighbouring ranges; it
is associative, with the empty fragment as identity, so fragments may be combined in any bracketing. Texts beyond
``CHUNK`` characters are cut into ranges that are encoded in different tasks and combined in a tree, ``FAN`` at a time.
A range is encoded from the last safe joint before it to the first one after it (see ``segments``); where there is no joint
near a bound, the bound moves on to the next, so no stretch is encoded more than twice. Shorter texts are one fragment.

Counts of pairs cover the whole corpus. The commonest ones, ``FREQUENT`` at most, chosen by a histogram of counts, are
looked up in the tasks; all others are joined in Spark, so no link is left out.

Defined cases: a null or empty text, or one that B doesn't give back byte for byte (a mark U+2581 in it, for one), has no
tokens; the texts of special tokens are plain text; repeated rows are aligned and counted each; a null id stays null; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm import segments as S
from candlewright.llm.base import saved

CHUNK, WINDOW, FAN = 1 << 15, 1 << 10, 8
FREQUENT = 1 << 18
BATCH_CHARS = 1 << 18
#: Segments up to this length go through the faster library for A.
SHORT = 1000
#: Segments kept by a worker in each of two generations: those not met for a generation are forgotten.
REMEMBERED = 70_000
MARK = "▁"
#: Links are pairs of unsigned 16-bit ids; vocabularies up to 65,536 ids.
LINK = np.dtype("<u2")
_JOINT = re.compile(r"(?<=\S) (?=\S)")


class Fragment(NamedTuple):
    """Ids are decimal and joined by commas; ``groups`` as in the result; ``links`` are pairs of ids."""

    ok: bool = True
    matched: bool = False  # a common end lies in the range; without one all tokens are in the head
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0  # in ``groups``
    head_a: str = ""
    head_b: str = ""
    groups: str = ""
    tail_a: str = ""
    tail_b: str = ""
    links: bytes = b""


FIELDS = """ok boolean, matched boolean, n_a long, n_b long, n_groups long, head_a string, head_b string, groups string,
tail_a string, tail_b string, links binary"""


def _joined(sign: str, *parts: str) -> str:
    return sign.join(p for p in parts if p)


def compose(f: Fragment, g: Fragment) -> Fragment:
    """The fragment of both ranges together."""
    both = dict(ok=f.ok and g.ok, n_a=f.n_a + g.n_a, n_b=f.n_b + g.n_b, links=f.links + g.links)
    if not f.matched:
        return g._replace(head_a=_joined(",", f.head_a, g.head_a), head_b=_joined(",", f.head_b, g.head_b), **both)
    if not g.matched:
        return f._replace(tail_a=_joined(",", f.tail_a, g.head_a), tail_b=_joined(",", f.tail_b, g.head_b), **both)
    bridge = f"{_joined(',', f.tail_a, g.head_a)}|{_joined(',', f.tail_b, g.head_b)}"
    return f._replace(groups=_joined(";", f.groups, bridge, g.groups), n_groups=f.n_groups + 1 + g.n_groups, tail_a=g.tail_a, tail_b=g.tail_b, **both)


def closed(f: Fragment) -> tuple[int, int, int, str, bytes]:
    """(n_a, n_b, n_groups, groups, links) of a whole text."""
    if not f.ok or not f.matched:
        return 0, 0, 0, "", b""
    if f.tail_a or f.tail_b:
        raise ValueError("the tokens don't end together")
    return f.n_a, f.n_b, f.n_groups + 1, _joined(";", f"{f.head_a}|{f.head_b}", f.groups), f.links


def fragment(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray, low: int, high: int) -> Fragment:
    """The tokens that end after ``low`` and not after ``high``."""
    (ids_a, ends_a), (ids_b, ends_b) = ((ids[slice(*np.searchsorted(ends, [low, high], "right"))], ends[slice(*np.searchsorted(ends, [low, high], "right"))]) for ids, ends in ((ids_a, ends_a), (ids_b, ends_b)))
    a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    if not len(at_a):
        return Fragment(n_a=len(a), n_b=len(b), head_a=",".join(a), head_b=",".join(b))
    cuts_a, cuts_b = (at_a + 1).tolist(), (at_b + 1).tolist()
    groups = Aligner._named(a, b, cuts_a, cuts_b)
    links = np.stack([ids_a[at_a], ids_b[at_b]], axis=1).astype(LINK).tobytes()
    return Fragment(True, True, len(a), len(b), len(groups), ",".join(a[:cuts_a[0]]), ",".join(b[:cuts_b[0]]), ";".join(groups), ",".join(a[cuts_a[-1]:]), ",".join(b[cuts_b[-1]:]), links)


class Aligner:
    """Both tokenizers, and the segments met before: per segment a number, by which its groups, links and counts are kept."""

    def __init__(self, path_a: str, path_b: str):
        self.path_a, self.fast = path_a, S.as_ranks(path_a)
        self.bytes_a = [self.fast.decode_single_token_bytes(i) for i in range(self.fast.n_vocab)] if self.fast else self.slow.bytes
        self.lengths_a = np.fromiter(map(len, self.bytes_a), np.int64, len(self.bytes_a))
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        self.lengths_b = np.fromiter(map(len, self.bytes_b), np.int64, size)
        self.text_a, self.text_b = list(map(str, range(len(self.bytes_a)))), list(map(str, range(size)))
        if any(MARK in self.b.id_to_piece(i).lstrip(MARK) for i in range(size)):
            raise ValueError("pieces run across word marks: texts can't be cut at them")
        if max(size, len(self.bytes_a)) > 1 << 16:
            raise ValueError("a vocabulary has more than 65,536 ids")
        self.known: dict[str, int] = {}
        self.groups, self.links, self.counts = [], [], np.zeros((3, 0), np.int32)
        self._turn()

    def _turn(self) -> None:
        """Begin a new generation; what is met again comes over from the one before."""
        self.before = self.known, self.groups, self.links, self.counts
        self.known: dict[str, int] = {}  # -1: B doesn't give the segment back
        self.groups: list[str] = []
        self.links: list[bytes] = []
        self.counts = np.zeros((3, 1 << 16), np.int32)  # tokens of A, of B, groups

    def _numbers(self, n: int) -> range:
        """Numbers for so many more segments."""
        first = len(self.groups)
        while first + n > self.counts.shape[1]:
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)], axis=1)
        return range(first, first + n)

    def _recalled(self, found: set[str]) -> None:
        known, groups, links, counts = self.before
        again = [s for s in found if s in known]
        good = [s for s in again if known[s] >= 0]
        numbers, old = self._numbers(len(good)), [known[s] for s in good]
        self.counts[:, numbers.start:numbers.stop] = counts[:, old]
        self.groups += map(groups.__getitem__, old)
        self.links += map(links.__getitem__, old)
        self.known.update(dict.fromkeys(again, -1))
        self.known.update(zip(good, numbers))

    @cached_property
    def slow(self) -> S.ByteLevel:
        return S.ByteLevel(self.path_a, specials_as_text=True)

    def encode(self, text: str, longest: int) -> tuple[bytes, np.ndarray, np.ndarray] | None:
        """Space + text in bytes, and the ids of both; None where B doesn't give it back. ``longest``: of its segments."""
        whole, ids_b = (" " + text).encode(), self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != whole:
            return None
        ids_a = self.fast.encode_ordinary(" " + text) if self.fast and longest <= SHORT else self.slow.encode([" " + text])[0]
        ids_a = np.array(ids_a, np.int64)
        if self.lengths_a[ids_a].sum() != len(whole):
            raise ValueError("the byte-level tokens don't add up to the text")
        return whole, ids_a, np.array(ids_b, np.int64)

    def _align(self, run: list[str]) -> None:
        encoded = self.encode(" ".join(run), max(map(len, run)))
        if encoded is None:
            if len(run) == 1:
                self.known[run[0]] = -1
            else:
                for s in run:
                    self._align([s])
            return
        whole, ids_a, ids_b = encoded
        lengths_a, lengths_b = self.lengths_a[ids_a], self.lengths_b[ids_b]
        upto_a, upto_b = S.ends_in(run, whole, lengths_a), S.ends_in(run, whole, lengths_b)
        _, at_a, at_b = np.intersect1d(np.cumsum(lengths_a), np.cumsum(lengths_b), assume_unique=True, return_indices=True)
        links = np.stack([ids_a[at_a], ids_b[at_b]], axis=1).astype(LINK).tobytes()
        a, b = list(map(self.text_a.__getitem__, ids_a.tolist())), list(map(self.text_b.__getitem__, ids_b.tolist()))
        groups = self._named(a, b, [0, *(at_a + 1).tolist()], [0, *(at_b + 1).tolist()])
        upto_g = np.searchsorted(at_a, upto_a)  # the joint ends a group of both
        numbers = self._numbers(len(run))
        self.counts[:, numbers.start:numbers.stop] = [np.diff(x, prepend=0) for x in (upto_a, upto_b, upto_g)]
        self.known.update(zip(run, numbers))
        g = 0
        for h in upto_g.tolist():
            self.groups.append(";".join(groups[g:h]) if h - g > 1 else groups[g])
            self.links.append(links[4 * g:4 * h])
            g = h

    @staticmethod
    def _named(a: list[str], b: list[str], cuts_a: list[int], cuts_b: list[int]) -> list[str]:
        return [(a[i] if j - i == 1 else ",".join(a[i:j])) + "|" + (b[k] if m - k == 1 else ",".join(b[k:m])) for i, j, k, m in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:])]

    def of(self, texts: list[str]) -> list[list[int]]:
        """The numbers of the segments of each text, every one with the space before it."""
        if len(self.known) > REMEMBERED:
            self._turn()
        cut = [S.segments(t) for t in texts]
        fresh = set().union(*cut).difference(self.known)
        self._recalled(fresh)
        for run in S.runs(fresh.difference(self.known)):
            self._align(run)
        return [list(map(self.known.__getitem__, c)) for c in cut]

    def whole(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """``closed`` of whole texts."""
        out = []
        for text, found in zip(texts, self.of(texts)):
            if not text or -1 in found:
                out.append((0, 0, 0, "", b""))
                continue
            counts = self.counts[:, found].sum(axis=1, dtype=np.int64).tolist()
            out.append((*counts, ";".join(map(self.groups.__getitem__, found)), b"".join(map(self.links.__getitem__, found))))
        return out

    def part(self, text: str, low: int, high: int) -> Fragment:
        """The fragment of a byte range of the text, a space before it included."""
        encoded = self.encode(text, max(map(len, S.segments(text))))
        if encoded is None:
            return Fragment(ok=False)
        _, ids_a, ids_b = encoded
        return fragment(ids_a, np.cumsum(self.lengths_a[ids_a]), ids_b, np.cumsum(self.lengths_b[ids_b]), low, high)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def ranges(text: str, chunk: int | None = None, window: int | None = None) -> Iterator[tuple[str, int, int]]:
    """Cuts space + text: per range the text to encode (without the space before it) and the bounds of the range in it, in bytes."""
    chunk, window = chunk or CHUNK, window or WINDOW
    whole, begin = " " + text, 0
    before = 0  # the last joint up to begin
    while begin < len(whole):
        bound, first, after = begin + chunk, None, None
        if bound < len(whole):
            near = [m.start() for m in _JOINT.finditer(whole, max(bound - window, begin + 1), min(bound + window, len(whole)))]
            first = max((j for j in near if j <= bound), default=None)
            after = min((j for j in near if j >= bound), default=None)
            if first is None or after is None:
                found = _JOINT.search(whole, bound)
                bound = first = after = found.start() if found else len(whole)
        if bound >= len(whole):
            bound = first = after = len(whole)
        low = len(whole[before:begin].encode())
        yield whole[before + 1:after], low, low + len(whole[begin:bound].encode())
        begin, before = bound, first


# Spark


def _sliced(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches. Arrow's pool keeps what was freed; it is given back, as it would add up to a third of a worker's memory."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)
            pa.default_memory_pool().release_unused()


def _batches(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches of up to 256 rows and about ``BATCH_CHARS`` characters; texts become Python strings part by part."""
    for batch in _sliced(batches, 256):
        texts, begin, size = [t or "" for t in batch.column(text).to_pylist()], 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BATCH_CHARS or i == len(texts) - 1:
                yield batch.slice(begin, i + 1 - begin), texts[begin:i + 1]
                begin, size = i + 1, 0


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())


def _digested(row: tuple, digest: bool) -> tuple:
    return (*row[:3], hashlib.sha256(row[3].encode()).hexdigest() if row[3] else "", row[4]) if digest else row


def _whole(batches, paths: tuple[str, str], digest: bool):
    for batch, texts in _batches(batches, "text"):
        columns = zip(*(_digested(x, digest) for x in aligner(*paths).whole(texts)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, _KINDS)]], ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])


def _cut(batches):
    for batch in batches:
        for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
            for k, (part, low, high) in enumerate(ranges(text.as_py())):
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((row.as_py(), pa.int64()), (k, pa.int64()), (doc_id.as_py(), pa.int64()), (part, pa.string()), (low, pa.int64()), (high, pa.int64()))], ["row", "k", "doc_id", "part", "low", "high"])


_FRAGMENT_KINDS = (pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary())


def _parts(batches, paths: tuple[str, str]):
    for batch, texts in _batches(batches, "part"):
        made = [aligner(*paths).part(t, low, high) for t, low, high in zip(texts, batch.column("low").to_pylist(), batch.column("high").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "k", "doc_id")] + [pa.array(c, t) for c, t in zip(zip(*made), _FRAGMENT_KINDS)], ["row", "k", "doc_id", *Fragment._fields])


def _fragments(rows: pa.RecordBatch | pa.Table) -> Iterator[Fragment]:
    return (Fragment(*r) for r in zip(*(rows.column(c).to_pylist() for c in Fragment._fields)))


def _composed(rows: pa.Table) -> pa.Table:
    """Neighbouring fragments of one text as one."""
    rows = rows.sort_by("k")
    made = reduce(compose, _fragments(rows))
    first = rows.slice(0, 1)
    own = [first.column("row"), pa.array([first.column("k")[0].as_py() // FAN]), first.column("doc_id")]
    return pa.Table.from_arrays(own + [pa.array([x], t) for x, t in zip(made, _FRAGMENT_KINDS)], ["row", "k", "doc_id", *Fragment._fields])


def _closed(batches, digest: bool):
    for batch in _sliced(batches, 16):
        columns = zip(*(_digested(x, digest) for x in map(closed, _fragments(batch))))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, _KINDS)]], ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, groups ("a1,a2|b1;a3|b2,b3"), and links (pairs of ids, binary).

    With ``digest`` groups is the SHA-256 of that text, or "" where there is none, made where the text is made.
    """
    paths = path_a, path_b
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    short = rows.where(~long).mapInArrow(lambda b: _whole(b, paths, digest), ALIGNED)
    parts = rows.where(long).withColumn("row", F.monotonically_increasing_id()).mapInArrow(_cut, "row long, k long, doc_id long, part string, low long, high long")
    # Written once: from here on a row's number stands, and its ranges lie in any task.
    spread = saved(parts.repartition("row", "k"), "alignment-ranges")
    fragments = spread.mapInArrow(lambda b: _parts(b, paths), f"row long, k long, doc_id long, {FIELDS}")
    most = spread.agg(F.max("k")).first()[0] or 0
    while most > 0:
        fragments = fragments.groupBy("row", F.expr(f"k div {FAN}").alias("up")).applyInArrow(_composed, fragments.schema)
        most //= FAN
    return short.unionByName(fragments.mapInArrow(lambda b: _closed(b, digest), ALIGNED))


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A code per link, a in the upper half, and the number of links per row."""
    data = [x or b"" for x in column.to_pylist()]
    pairs = np.frombuffer(b"".join(data), LINK).astype(np.int64).reshape(-1, 2)
    return pairs[:, 0] << 32 | pairs[:, 1], np.fromiter(map(len, data), np.int64, len(data)) // 4


def _pairs(batches):
    aligner.cache_clear()  # a worker of the stage before doesn't need its memory of segments any more
    for batch in _sliced(batches, 1000):
        codes, n = np.unique(_codes(batch.column("links"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], ["pair", "n"])


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best) of all linked pairs; ``best`` where no other pair of the same B id has more links."""
    counted = saved(rows.select("links").mapInArrow(_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    top = counted.select(b, "n").groupBy("b").agg(F.max("n").alias("top"))
    return saved(counted.withColumn("b", b).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "alignment-pairs")


def _frequent(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs above the least power of two that not more than ``FREQUENT`` pairs reach."""
    sizes = {r[0]: r[1] for r in pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()}
    power, total = 63, 0
    while power > 0 and total + sizes.get(power - 1, 0) <= FREQUENT:
        power -= 1
        total += sizes.get(power, 0)
    common = pairs.where(F.col("n") >= 2**power).select("pair", "n", F.col("best").cast("long")).toArrow().sort_by("pair")
    return tuple(common.column(i).to_numpy() for i in range(3))


def _looked_up(batches, shared, others: list[str]):
    codes, n, best = shared.value
    aligner.cache_clear()
    for batch in _sliced(batches, 1000):
        found, sizes = _codes(batch.column("links"))
        at = np.minimum(np.searchsorted(codes, found), max(len(codes) - 1, 0))
        hit = codes[at] == found if len(codes) else np.zeros(len(found), bool)
        bounds = np.r_[0, np.cumsum(sizes)]
        sums = [np.r_[0, np.cumsum(np.where(hit, x[at] if len(codes) else 0, 0))][bounds] for x in (n, best)]
        left = np.r_[0, np.cumsum(~hit)][bounds].astype(np.int32)
        rare = pa.ListArray.from_arrays(pa.array(left), pa.array(found[~hit]))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(sizes), *[pa.array(np.diff(s)) for s in sums], rare], [*others, "n_links", "_sum", "_best", "_rare"])


def linked(rows: DataFrame) -> DataFrame:
    """``rows`` with n_links, count_sum (corpus-wide counts of the pairs of its links) and n_best in the place of links. ``rows`` should be a written table."""
    pairs = pair_counts(rows)
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(pairs))
    others = [c for c in rows.columns if c != "links"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "links")
    known = rows.mapInArrow(lambda b: _looked_up(b, shared, others), f"{fields}, n_links long, _sum long, _best long, _rare array<long>")
    known = saved(known.withColumn("_row", F.monotonically_increasing_id()), "alignment-known")
    rest = known.select("_row", F.explode("_rare").alias("pair")).join(pairs, "pair").groupBy("_row").agg(F.sum("n").alias("_more"), F.sum(F.col("best").cast("long")).alias("_more_best"))
    total = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).cast("long")
    return known.join(rest, "_row", "left").select(*others, "n_links", total("_best", "_more_best").alias("n_best"), total("_sum", "_more").alias("count_sum"))
