"""The three loads. Those that can delete take table names only, so a filtered frame can never cause deletes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterline.operators import quality
from quarterline.operators.compare import compare_periods
from quarterline.operators.latest import latest_observations
from quarterline.schema import MART_COLUMNS, MART_KEYS, MART_MATERIAL, OBSERVATION_COLUMNS, OBSERVATION_MATERIAL, SILVER_COLUMNS
from quarterline.sources import rows as row_source
from quarterline.sources import store


# The names of the results and of their fields.
@dataclass(frozen=True)
class BronzeLoadResult:
    bronze_object: str
    input_rows: int
    batch_rows_after_dedup: int
    inserted_rows: int
    updated_rows: int
    final_row_count: int


@dataclass(frozen=True)
class SilverLoadResult:
    silver_object: str
    bronze_input_rows: int
    bronze_structurally_valid_rows: int
    bronze_rejected_rows_total: int
    bronze_rejected_rows_by_reason: dict[str, int]
    silver_batch_rows_after_dedup: int
    inserted_rows: int
    updated_rows: int
    silver_deleted_rows: int
    silver_final_row_count: int
    bronze_distinct_valid_observation_ids: int
    reconciliation_delta: int


@dataclass(frozen=True)
class GoldLoadResult:
    gold_object: str
    silver_input_rows: int
    silver_distinct_company_metric_keys: int
    gold_batch_rows: int
    inserted_rows: int
    updated_rows: int
    deleted_rows: int
    gold_final_row_count: int
    reconciliation_delta: int


def load_bronze_observations(spark: SparkSession, rows: Iterable[dict], bronze_object: str) -> BronzeLoadResult:
    """Upsert one batch: latest row per id, stored rows change only where a material column does, nothing is deleted."""
    return load_bronze_frame(spark, row_source.observations(spark, rows), bronze_object)


def load_bronze_frame(spark: SparkSession, batch: DataFrame, bronze_object: str) -> BronzeLoadResult:
    """The same for a batch that is a frame already, of any size. What is counted is observed while it is written."""
    given, kept = Observation(), Observation()
    rows = batch.select(*OBSERVATION_COLUMNS).observe(given, F.count("*").alias("n"))
    source = latest_observations(rows, "_hash").select(*OBSERVATION_COLUMNS).observe(kept, F.count("*").alias("n"))
    commit = store.synchronize(spark, bronze_object, source, ["observation_id"], OBSERVATION_MATERIAL, delete_missing=False)
    return BronzeLoadResult(bronze_object, store.observed(given).get("n", 0), store.observed(kept).get("n", 0), commit.inserted_rows, commit.updated_rows, commit.final_rows)


def load_silver_observations(spark: SparkSession, bronze_object: str, silver_object: str) -> SilverLoadResult:
    """Synchronise with the valid rows of the whole Bronze relation; ids that are gone or invalid are deleted. Bronze is
    read once: the action that writes counts what it rejects and what it keeps."""
    bronze = store.read_table(spark, bronze_object, OBSERVATION_COLUMNS, "Bronze source")
    judged, kept, reason = Observation(), Observation(), F.col("rejection_reason")
    counted = [F.count_if(reason == name).alias(name) for name in quality.REJECTION_REASONS]
    classified = quality.classify(bronze).observe(judged, F.count_if(reason.isNull()).alias("valid"), *counted)
    latest = latest_observations(classified.where(reason.isNull()).drop("rejection_reason"), "silver_record_hash")
    source = latest.observe(kept, F.count("*").alias("ids")).withColumn("silver_normalized_at", F.current_timestamp()).select(*SILVER_COLUMNS)
    commit = store.synchronize(spark, silver_object, source, ["observation_id"], OBSERVATION_MATERIAL, delete_missing=True)
    by_reason = {name: n for name, n in store.observed(judged).items() if n}
    valid, ids = by_reason.pop("valid", 0), store.observed(kept).get("ids", 0)
    rejected = sum(by_reason.values())
    return SilverLoadResult(
        silver_object, valid + rejected, valid, rejected, by_reason, ids, commit.inserted_rows, commit.updated_rows,
        commit.deleted_rows, commit.final_rows, ids, commit.final_rows - ids,
    )


def load_gold_observations(spark: SparkSession, silver_object: str, gold_object: str) -> GoldLoadResult:
    """Synchronise the mart with the whole Silver table, which must be one that this engine manages."""
    if spark.catalog.tableExists(silver_object):
        store.guard_snapshot_table(spark, silver_object, "Silver source")
    given, kept = Observation(), Observation()
    silver = store.read_table(spark, silver_object, OBSERVATION_COLUMNS, "Silver source").observe(given, F.count("*").alias("rows"))
    # The mart has one row per key.
    mart = compare_periods(silver).observe(kept, F.count("*").alias("keys"))
    source = mart.withColumn("computed_at", F.current_timestamp()).select(*MART_COLUMNS)
    commit = store.synchronize(spark, gold_object, source, MART_KEYS, MART_MATERIAL, delete_missing=True)
    keys = store.observed(kept).get("keys", 0)
    return GoldLoadResult(
        gold_object, store.observed(given).get("rows", 0), keys, keys, commit.inserted_rows, commit.updated_rows, commit.deleted_rows,
        commit.final_rows, commit.final_rows - keys,
    )
