"""Latest quarter of each company and metric against its previous available quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.expr import absolute_change, direction, payload_hash, relative_change
from quarterline.operators.latest import keep_latest
from quarterline.schema import MART_KEYS, MART_PAYLOAD


def same_period_winner(silver: DataFrame) -> DataFrame:
    """One row per company, metric and quarter: latest stamp, then greatest observation_id."""
    order = [F.desc_nulls_last("ingested_at"), F.desc_nulls_last("observation_id")]
    return keep_latest(silver, [*MART_KEYS, "period_id"], order)


def compare_periods(silver: DataFrame) -> DataFrame:
    """Keys, payload and gold_record_hash; keys with a null part are dropped.

    The winning row already holds the current value, so no self-join is needed. Two exchanges: the first is cut to one
    row per key, quarter and map task by the partial group limit, which a hot key needs; the second carries one row
    per key and quarter.
    """
    rows = silver.select("observation_id", *MART_KEYS, "period_id", "value", "ingested_at")
    keyed = rows.where(" AND ".join(f"{k} IS NOT NULL" for k in MART_KEYS))
    winners = same_period_winner(keyed)
    # The notation sorts as text the way its year and quarter sort as numbers.
    newest_first = Window.partitionBy(*MART_KEYS).orderBy(F.desc_nulls_last("period_id"))
    current, previous, change = F.col("current_value"), F.col("previous_value"), F.col("change_value")
    compared = (
        winners.select(
            *MART_KEYS,
            F.col("period_id").alias("current_period_id"),
            F.col("value").alias("current_value"),
            F.lead("period_id").over(newest_first).alias("previous_period_id"),
            F.lead("value").over(newest_first).alias("previous_value"),
            F.row_number().over(newest_first).alias("_place"),
        )
        .where("_place = 1")
        .withColumn("change_value", absolute_change(current, previous))
        .withColumn("change_pct", relative_change(current, previous))
        .withColumn("direction", direction(change, previous))
    )
    return compared.select(*MART_KEYS, *MART_PAYLOAD, payload_hash(MART_PAYLOAD).alias("gold_record_hash"))
