"""Ordered validation of observations: the first rule that fails names the rejection."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.expr import is_finite
from quarterline.schema import KEYS

# The quarter notation and the reasons in their order of precedence.
PERIOD_PATTERN = r"^\d{4}Q[1-4]$"
REJECTION_REASONS = (
    "missing_observation_id",
    "missing_company_id",
    "missing_metric_id",
    "missing_period_id",
    "invalid_period_id",
    "invalid_value",
    "invalid_ingested_at",
)


def normalize(df: DataFrame) -> DataFrame:
    """The six observation columns, ids without surrounding blanks (U+0020), unreadable numbers and stamps null."""
    stamp = F.col("ingested_at")
    if dict(df.dtypes)["ingested_at"] == "string":
        stamp = F.try_to_timestamp(stamp)
    return df.select(
        *(F.trim(F.col(k).cast("string")).alias(k) for k in KEYS),
        F.col("value").try_cast("double").alias("value"),
        stamp.cast("timestamp").alias("ingested_at"),
    )


def _failures() -> list[Column]:
    absent = [F.coalesce(F.length(k) == 0, F.lit(True)) for k in KEYS]
    return [
        *absent,
        ~F.col("period_id").rlike(PERIOD_PATTERN),
        ~is_finite(F.col("value")),
        F.col("ingested_at").isNull(),
    ]


def rejection_reason() -> Column:
    """Name of the first rule that a normalized row breaks, null for a valid row."""
    return F.coalesce(*(F.when(bad, reason) for reason, bad in zip(REJECTION_REASONS, _failures(), strict=True)))


def classify(df: DataFrame) -> DataFrame:
    return normalize(df).withColumn("rejection_reason", rejection_reason())


def valid_rows(df: DataFrame) -> DataFrame:
    return classify(df).where("rejection_reason IS NULL").drop("rejection_reason")


def rejected_by_reason(df: DataFrame) -> DataFrame:
    """Rows per reason; only reasons that occur."""
    rejected = classify(df).where("rejection_reason IS NOT NULL")
    return rejected.groupBy("rejection_reason").agg(F.count("*").alias("rejected_rows"))


def classify_rejection_reason(row: dict) -> str | None:
    """The same rules for one Python row.

    Kept differences to the column version: every kind of white space is stripped, digits of any script pass the
    quarter pattern, only int and float count as numbers, and a stamp is judged by being there.
    """

    def text(name: str) -> str:
        return "" if (x := row.get(name)) is None else str(x).strip()

    for name in KEYS:
        if not text(name):
            return f"missing_{name}"
    if re.match(PERIOD_PATTERN, text("period_id")) is None:
        return "invalid_period_id"
    value = row.get("value")
    if not isinstance(value, (int, float)) or not math.isfinite(value):
        return "invalid_value"
    return "invalid_ingested_at" if row.get("ingested_at") is None else None
