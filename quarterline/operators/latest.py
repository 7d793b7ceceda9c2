"""Top-1 per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.expr import payload_hash
from quarterline.schema import OBSERVATION_MATERIAL


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Null keys form one group, as in a window.

    row_number() = 1 plans as a partial and a final WindowGroupLimit, so a hot key is cut to one row per map task
    before the shuffle.
    """
    rank = "_rank"
    while rank in df.columns:
        rank += "_"
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) == 1).drop(rank)


def latest_observations(df: DataFrame, hash_column: str) -> DataFrame:
    """One row per observation_id: latest ingested_at (null last), then greatest record hash; adds the hash."""
    hashed = df.withColumn(hash_column, payload_hash(OBSERVATION_MATERIAL))
    return keep_latest(hashed, ["observation_id"], [F.desc_nulls_last("ingested_at"), F.desc(hash_column)])
