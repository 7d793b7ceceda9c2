"""Column expressions shared by the layers: hashes, finiteness, change detection, period comparison."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The serialisation under the record hashes.
HASH_DELIMITER = "||"
HASH_NULL = "<NULL>"


def payload_hash(columns: Iterable[str]) -> Column:
    """SHA-256 (hex) over the columns' text, in the given order."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL)) for c in columns]
    return F.sha2(F.concat_ws(HASH_DELIMITER, *texts), 256)


def is_finite(column: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite; never null."""
    return F.coalesce(~F.isnan(column) & (F.abs(column) < F.lit(float("inf"))), F.lit(False))


def materially_changed(columns: Iterable[str], old: str, new: str) -> Column:
    """True where any column differs null-safely between the two aliases (NaN equals NaN, -0.0 equals 0.0)."""
    same = (F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in columns)
    return ~reduce(lambda a, b: a & b, same)


def absolute_change(current: Column, previous: Column) -> Column:
    """Null without a previous value."""
    return current - previous


def relative_change(current: Column, previous: Column) -> Column:
    """Fraction of the previous magnitude; 0 to 0 is 0.0, 0 to anything else undefined (null)."""
    return F.when(previous != 0.0, (current - previous) / F.abs(previous)).when(
        (previous == 0.0) & (current == 0.0), F.lit(0.0)
    )


def direction(change: Column, previous: Column) -> Column:
    """up, down or neutral; null without a previous value."""
    return F.when(
        previous.isNotNull(), F.when(change > 0.0, "up").when(change < 0.0, "down").otherwise("neutral")
    )
