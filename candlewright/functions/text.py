"""Decimal rounding of doubles by their exact binary value, ties to the even digit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2**27 + 1 halves a double into two exactly multipliable parts


def _units(size: Column, digits: int) -> Column:
    """The non-negative double in whole units of the last digit.

    The double times twice the scale is compared with the odd number at the tie; both halves of the
    product are exact, so the side of the tie is certain.
    """
    scale = 10.0 ** digits
    below = F.floor(size * scale)
    head = size * _SPLITTER - (size * _SPLITTER - size)
    tail = size - head
    side = (head * (2 * scale) - (below * 2 + 1).cast("double")) + tail * (2 * scale)
    return F.when(side > 0, below + 1).when(side < 0, below).otherwise(below + below % 2)


def round_exact(x: Column, digits: int) -> Column:
    size = _units(F.abs(x), digits).cast("double") / (10.0 ** digits)
    return F.when(x < 0, -size).otherwise(size)


def fixed(x: Column, digits: int) -> Column:
    """Text with ``digits`` decimals."""
    units = _units(F.abs(x), digits)
    sign = F.when(x < 0, "-").otherwise("")
    if digits == 0:
        return F.concat(sign, units.cast("string"))
    base = F.lit(10**digits).cast("bigint")
    part = F.lpad((units % base).cast("string"), digits, "0")
    return F.concat(sign, F.floor(units / base).cast("string"), F.lit("."), part)
