"""Secrets in texts, with credentials of several parts linked to each other (operator 7).

One pass over the texts finds strong spans (assignments, access keys, long hexadecimal runs) and weak candidates: values
that look like an account identifier, an opaque secret or an endpoint. A weak candidate alone means nothing. The
candidates, few and small, are then joined as intervals within a scope: parts of one document whose starts lie at most
``SCOPE`` code points apart. A weak candidate is reported only when the parts that complete it stand in its scope.

Defined cases: a null text is an empty one; a document without spans gets a row with no spans; repeated rows each get
their row; rows that share an id but not their text are apart; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCOPE = 300

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Any access key, hexadecimal run or weak value lies within such a run; weak values are its parts between signs of equality.
LONG = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
VALUE = re.compile(r"([A-Za-z0-9+/_-]{16,})(?:={1,2}(?![A-Za-z0-9+/_-]))?")
IDENTIFIER = re.compile(r"(?=[0-9]*[A-Z])(?=[A-Z]*[0-9])[A-Z0-9]{16,}")
OPAQUE = re.compile(r"(?=[^0-9]*[0-9])(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])[A-Za-z0-9+/_-]{24,}={0,2}")
NAMED = re.compile(r"""(?:client|account|access|tenant|user|project)[_-]?(?:key[_-]?)?(?:id|name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{4,})""", re.I | re.A)
ENDPOINT = re.compile(r"""[a-z][a-z0-9+]{1,12}://[^\x00-\x20"'<>]+|\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:amazonaws\.com|internal|local)\b(?::[0-9]+)?""")
WORDS = ("passw", "secret", "token", "apikey", "api_key")

#: In the order in which spans of one start are listed, and what part of a credential each can be.
KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
STRONG = KINDS[:3]
PART = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "opaque": "secret", "endpoint": "endpoint"}


def parts_of(text: str) -> list[tuple[str, int, int]]:
    """All strong spans and weak candidates; a candidate that overlaps a strong span is part of it."""
    low = text.lower()
    found: list[tuple[str, int, int]] = []
    if any(w in low for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    weak: list[tuple[str, int, int]] = []
    for run in LONG.finditer(text):
        a, b = run.span()
        found += [("access", *m.span()) for m in ACCESS.finditer(text, a, b)]
        found += [("hex", *m.span()) for m in HEX.finditer(text, a, b)]
        for part in VALUE.finditer(text, a, b):
            if m := IDENTIFIER.fullmatch(text, *part.span(1)):
                weak.append(("identifier", *m.span()))
            elif m := OPAQUE.fullmatch(text, *part.span()):
                weak.append(("opaque", *m.span()))
    if "id" in low or "name" in low:
        weak += [("identifier", *m.span(1)) for m in NAMED.finditer(text)]
    if "://" in low or ".amazonaws.com" in low or ".internal" in low or ".local" in low:
        weak += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    if not weak:
        return found
    taken = sorted(x[1:] for x in found)
    ends: list[int] = []
    for _, e in taken:
        ends.append(max(e, ends[-1] if ends else e))
    starts = [s for s, _ in taken]
    for kind, a, b in dict.fromkeys(weak):
        i = bisect_left(starts, b)  # strong spans that begin before the candidate ends
        if not i or ends[i - 1] <= a:
            found.append((kind, a, b))
    return found


PARTS = "doc_id long, key long, kind string, start int, end int"


def _scan(batches):
    for batch in batches:
        ids, keys, kinds, starts, ends = [], [], [], [], []
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = value.as_py() or ""
            key = xxhash.xxh3_64_intdigest(text) - (1 << 63)
            for kind, a, b in [(None, None, None), *parts_of(text)]:
                ids.append(doc)
                keys.append(key)
                kinds.append(kind)
                starts.append(a)
                ends.append(b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            ["doc_id", "key", "kind", "start", "end"],
        )


def parts(documents: DataFrame) -> DataFrame:
    """A row per part, and a row without kind for every row of the input."""
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan, PARTS)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Adds, per part, the start of the nearest identifier, secret and endpoint before and after it within its scope, and ``reported``.

    The join of intervals is a range window: every part meets the parts of its scope without any pair being written.
    """
    of = {p: F.when(F.col("kind").isin([k for k in KINDS if PART[k] == p]), F.col("start")) for p in ("identifier", "secret", "endpoint")}
    around = Window.partitionBy("doc_id", "key").orderBy("start")
    before, after = around.rangeBetween(-scope, 0), around.rangeBetween(0, scope)
    near = found.withColumns({f"{p}_before": F.max(c).over(before) for p, c in of.items()} | {f"{p}_after": F.min(c).over(after) for p, c in of.items()})
    has = {p: F.coalesce(f"{p}_before", f"{p}_after").isNotNull() for p in of}
    complete = (
        F.when(F.col("kind") == "identifier", has["secret"]).when(F.col("kind") == "opaque", has["identifier"] | has["endpoint"])
        .when(F.col("kind") == "endpoint", has["identifier"] & has["secret"])
    )
    return near.withColumn("reported", F.col("kind").isin(*STRONG) | F.coalesce(complete, F.lit(False)))


def scanned(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of the input: doc_id, and ``spans``, an array of (start, kind number, kind, end), strong and linked ones in order."""
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct("start", place.alias("place"), "kind", "end")
    per_text = linked(parts(documents), scope).groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_set(F.when(F.col("kind").isNotNull() & F.col("reported"), span))).alias("spans"), F.count(F.when(F.col("kind").isNull(), 1)).alias("copies")
    )
    return per_text.select("doc_id", "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
