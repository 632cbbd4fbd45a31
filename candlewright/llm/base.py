"""What the operators share: tables in the shared folder, and texts as numpy arrays."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.session import shared_folder

#: White space of all contracts: space, and the five characters from tab to carriage return.
SPACE = "[\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def row_key(*columns: str) -> Column:
    """128 bits of the content of some columns: tells rows apart that share an id, or have none. Null and empty differ."""
    value = lambda c: F.col(c).cast("string")
    return F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-")) for c in columns]))


_27, _30, _31 = np.uint64(27), np.uint64(30), np.uint64(31)
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of an array of unsigned 64-bit words (the finaliser of splitmix64), for hashing and counter-based random numbers."""
    x = (x ^ (x >> _30)) * _FIRST
    x = (x ^ (x >> _27)) * _SECOND
    return x ^ (x >> _31)
