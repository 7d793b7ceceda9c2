"""Column contracts of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ("observation_id", "company_id", "metric_id", "period_id")
OBSERVATION_COLUMNS = (*KEYS, "value", "ingested_at")

#: Columns whose change makes a stored observation an update; stamps are not among them.
OBSERVATION_MATERIAL = ("company_id", "metric_id", "period_id", "value")
#: What a mart row says; the hash covers exactly these.
MART_PAYLOAD = (
    "current_period_id",
    "current_value",
    "previous_period_id",
    "previous_value",
    "change_value",
    "change_pct",
    "direction",
)
MART_KEYS = ("company_id", "metric_id")
MART_MATERIAL = (*MART_PAYLOAD, "gold_record_hash")

BRONZE_SCHEMA = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS]
    + [T.StructField("value", T.DoubleType()), T.StructField("ingested_at", T.TimestampType())]
)
SILVER_COLUMNS = (*OBSERVATION_COLUMNS, "silver_record_hash", "silver_normalized_at")
MART_COLUMNS = (*MART_KEYS, *MART_PAYLOAD, "gold_record_hash", "computed_at")


def require_columns(available, required, what: str) -> None:
    """Raise ValueError naming every missing column, sorted."""
    if missing := sorted(set(required) - set(available)):
        raise ValueError(f"{what}: {', '.join(missing)}")
