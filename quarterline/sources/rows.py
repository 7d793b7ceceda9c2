"""Observation batches from Python rows or a JSON array file, typed by declaration rather than inference."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.schema import KEYS, OBSERVATION_COLUMNS, require_columns

_RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*KEYS, "value", "ingested_at")]
    + [T.StructField("_stamp", T.TimestampType())]
)


def read_json_array(path: str) -> list[dict]:
    """The objects of one UTF-8 file that holds a JSON array; ValueError for anything else."""
    with open(path, encoding="utf-8") as file:
        match json.load(file):
            case [*objects]:
                return objects
            case other:
                raise ValueError(f"{path} holds no JSON array but a {type(other).__name__}")


def observations(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """The six observation columns of a batch; extra ones are left out.

    Numbers or stamps that can't be read become null, so that validation can name them. ingested_at defaults to the
    current time only where no row has that key. A batch without rows, or without one of the other columns, raises
    ValueError.
    """
    batch = list(rows)
    if not batch:
        raise ValueError("rows must contain at least one observation")
    names = {name for row in batch for name in row}
    require_columns({*names, "ingested_at"}, OBSERVATION_COLUMNS, "Missing required columns")

    def text(x):
        return None if x is None else repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    def raw(row: dict) -> tuple:
        stamp = row.get("ingested_at")
        is_time = isinstance(stamp, datetime)
        ids = (None if (x := row.get(k)) is None else str(x) for k in KEYS)
        return (*ids, text(row.get("value")), None if is_time or stamp is None else str(stamp), stamp if is_time else None)

    made = spark.createDataFrame([raw(r) for r in batch], _RAW)
    if "ingested_at" not in names:
        return typed(made.drop("_stamp", "ingested_at"))
    return typed(made.withColumn("ingested_at", F.coalesce("_stamp", F.try_to_timestamp("ingested_at"))))


def typed(raw: DataFrame) -> DataFrame:
    """The six observation columns of a frame of any size: ids as text, value a number, ingested_at a stamp; what can't
    be read is null. Without a column ingested_at every row has the current time."""
    require_columns({*raw.columns, "ingested_at"}, OBSERVATION_COLUMNS, "Missing required columns")
    stamp = F.current_timestamp()
    if "ingested_at" in raw.columns:
        stamp = F.col("ingested_at")
        stamp = F.try_to_timestamp(stamp) if dict(raw.dtypes)["ingested_at"] == "string" else stamp.cast("timestamp")
    ids = (F.col(k).cast("string").alias(k) for k in KEYS)
    return raw.select(*ids, F.col("value").try_cast("double").alias("value"), stamp.alias("ingested_at"))
