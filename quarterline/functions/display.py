"""Text for people: in plain Python for the few rows of a page, and the same as column expressions for whole tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value.
NOT_AVAILABLE = "N/A"


def display_value(value, null_text: str = NOT_AVAILABLE) -> str:
    return null_text if value is None else str(value)


def display_number(value) -> str:
    """Thousands separated, two decimals."""
    return display_value(None if value is None else format(float(value), ",.2f"))


def display_percentage(value) -> str:
    """A fraction as signed per cent with one decimal."""
    return display_value(None if value is None else format(float(value) * 100, "+,.1f") + "%")


def shown_value(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(NOT_AVAILABLE))


def _formatted(column: Column, decimals: int) -> Column:
    """format_number() agrees with Python but for what is no number, and beyond 2^53, where it has zeros after the digits
    that tell a double from its neighbours."""
    odd = F.when(F.isnan(column), "nan").when(column == float("inf"), "inf").when(column == float("-inf"), "-inf")
    return F.coalesce(odd, F.format_number(column, decimals))


def shown_number(column: Column) -> Column:
    return F.coalesce(_formatted(column, 2), F.lit(NOT_AVAILABLE))


def shown_percentage(column: Column) -> Column:
    text = _formatted(column * 100, 1)
    return F.coalesce(F.concat(F.when(text.startswith("-"), "").otherwise("+"), text, F.lit("%")), F.lit(NOT_AVAILABLE))
