"""White space of every Unicode kind, and the quarter notations found in the data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every code point with the Unicode property White_Space, and the four separators that Python's strip also takes.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
FIRST_YEAR, LAST_YEAR = 2015, 2024
QUARTERS = 4 * (LAST_YEAR - FIRST_YEAR + 1)


def trimmed(column: Column) -> Column:
    """Without surrounding white space of any Unicode kind; null stays null.

    Text that begins and ends with a visible ASCII character, nearly all of it, skips the search for white space.
    """
    visible = [F.ascii(c).between(33, 126) for c in (column, F.substring(column, -1, 1))]
    return F.when(visible[0] & visible[1], column).otherwise(F.btrim(column, F.lit(WHITE_SPACE)))


def identifier(column: Column) -> Column:
    """Trimmed text, or null where nothing is left."""
    return F.nullif(trimmed(column), F.lit(""))


def _by_name(period: Column) -> Column:
    """Uses its argument once: an expression that is used often is evaluated as often in filters and branches."""
    names = (f"{y}Q{q}" for y in range(FIRST_YEAR, LAST_YEAR + 1) for q in range(1, 5))
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in zip(names, range(QUARTERS), strict=True) for x in pair)), period)


def quarter_index(column: Column) -> Column:
    """Quarters since the first one for a trimmed YYYYQn inside the known years, else null."""
    return _by_name(trimmed(column))


def readable_quarter_index(column: Column) -> Column:
    """quarter_index that also reads q or T for Q, another separator, the quarter first and full-width digits."""
    period = trimmed(column)
    narrow = F.upper(F.translate(period, "０１２３４５６７８９", "0123456789"))
    either = F.regexp_replace(narrow, "^(?:([0-9]{4})[-/ ]?[QT]?([1-4])|[QT]([1-4])[-/ ]([0-9]{4}))\\z", "$1$4Q$2$3")
    return F.coalesce(_by_name(period), _by_name(either))
