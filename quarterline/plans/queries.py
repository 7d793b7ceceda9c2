"""The registered queries of the core: each takes (spark, folder of Parquet tables) and returns a DataFrame."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.functions.display import shown_number, shown_percentage, shown_value
from quarterline.functions.text import trimmed
from quarterline.operators import lateness, profile, quality, snapshot_diff, spikes, sync
from quarterline.operators.compare import compare_periods, same_period_winner
from quarterline.operators.latest import latest_observations
from quarterline.plans import layers, serving
from quarterline.schema import KEYS, MART_COLUMNS, MART_KEYS, MART_MATERIAL, MART_PAYLOAD, OBSERVATION_COLUMNS, OBSERVATION_MATERIAL, SILVER_COLUMNS
from quarterline.sources import files, store
from quarterline.sources import rows as row_source
from quarterline.sources.tables import table
from quarterline.streaming import dedup

HOT_COMPANY = "C00000007"
_MART = (*MART_KEYS, *MART_PAYLOAD, "gold_record_hash")


def _bronze(spark: SparkSession, at: str) -> DataFrame:
    return table(spark, at, "slice4_bronze")


def _zoneless(df: DataFrame) -> DataFrame:
    """Stamps as they stand in the files, whatever the session's zone."""
    return df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def bronze_latest(spark, at):
    return _zoneless(latest_observations(_bronze(spark, at).select(*OBSERVATION_COLUMNS), "record_hash"))


def silver_classified(spark, at):
    return _zoneless(quality.classify(_bronze(spark, at)))


def silver_rejected_by_reason(spark, at):
    return quality.rejected_by_reason(_bronze(spark, at))


def _silver(spark, at) -> DataFrame:
    return latest_observations(quality.valid_rows(_bronze(spark, at)), "silver_record_hash")


def silver_snapshot(spark, at):
    return _zoneless(_silver(spark, at))


def silver_counters(spark, at):
    valid = F.col("rejection_reason").isNull()
    return quality.classify(_bronze(spark, at)).agg(
        F.count("*").alias("bronze_input_rows"),
        F.count_if(valid).alias("bronze_structurally_valid_rows"),
        F.count_if(~valid).alias("bronze_rejected_rows_total"),
        F.count_distinct(F.when(valid, F.col("observation_id"))).alias("bronze_distinct_valid_observation_ids"),
    )


def _old_silver(spark, at) -> DataFrame:
    return table(spark, at, "slice4_silver").select(*OBSERVATION_COLUMNS, "silver_record_hash")


def _silver_plan(spark, at, delete_missing: bool) -> DataFrame:
    new = _zoneless(_silver(spark, at))
    return sync.plan_changes(_old_silver(spark, at), new, ["observation_id"], OBSERVATION_MATERIAL, delete_missing)


def upsert_actions(spark, at):
    return _silver_plan(spark, at, False).select("observation_id", F.col("_action").alias("action"))


def sync_actions(spark, at):
    return _silver_plan(spark, at, True).select("observation_id", F.col("_action").alias("action"))


def sync_result(spark, at):
    return sync.apply_changes(_silver_plan(spark, at, True))


def sync_metrics(spark, at):
    return _silver_plan(spark, at, True).agg(*sync.change_counts())


def silver_inserted(spark, at):
    return _silver(spark, at).join(_old_silver(spark, at), "observation_id", "left_anti").select("observation_id")


def silver_orphans(spark, at):
    return _old_silver(spark, at).join(_silver(spark, at), "observation_id", "left_anti").select("observation_id")


def gold_same_period(spark, at):
    return same_period_winner(_old_silver(spark, at)).drop("silver_record_hash")


def gold_snapshot(spark, at):
    return compare_periods(_old_silver(spark, at))


def gold_sync_actions(spark, at):
    old = table(spark, at, "slice4_gold").select(*_MART)
    plan = sync.plan_changes(old, compare_periods(_silver(spark, at)), MART_KEYS, MART_MATERIAL, True)
    return plan.select(*_MART, F.col("_action").alias("action"))


def serving_companies(spark, at):
    return serving.companies(table(spark, at, "slice4_gold"))


def serving_metrics(spark, at):
    return serving.metrics(table(spark, at, "slice4_gold"), HOT_COMPANY)


def serving_comparison(spark, at):
    return serving.comparison(table(spark, at, "slice4_gold"), HOT_COMPANY)


def display_rows(spark, at):
    """The view model of every mart row."""
    shown = {"change_pct": shown_percentage} | dict.fromkeys(("current_value", "previous_value", "change_value"), shown_number)
    return table(spark, at, "slice4_gold").select(*(shown.get(c, shown_value)(F.col(c)).alias(c) for c in serving.COMPARISON_COLUMNS))


@contextmanager
def _tables(spark):
    """Names for three tables, which are gone afterwards."""
    run = uuid.uuid4().hex
    names = [f"ql_{layer}_{run}" for layer in ("bronze", "silver", "gold")]
    try:
        yield names
    finally:
        for name in names:
            store.drop(spark, name)


def pipeline_bronze_silver_gold(spark, at):
    """Bronze, Silver and mart tables built through the store, then the mart without its audit stamp."""
    with _tables(spark) as (bronze, silver, gold):
        layers.load_bronze_frame(spark, _bronze(spark, at), bronze)
        layers.load_silver_observations(spark, bronze, silver)
        layers.load_gold_observations(spark, silver, gold)
        return files.kept(spark.table(gold).select(*_MART), "mart")


def _existing(spark, at, names) -> None:
    """Tables as they stood before: the old Silver rows as Bronze and as Silver, and the old mart."""
    bronze, silver, gold = names
    old = table(spark, at, "slice4_silver").withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    stamped = old.withColumn("silver_normalized_at", F.current_timestamp()).select(*SILVER_COLUMNS)
    mart = table(spark, at, "slice4_gold").withColumn("computed_at", F.current_timestamp()).select(*MART_COLUMNS)
    for name, frame, keys, material in (
        (bronze, old.select(*OBSERVATION_COLUMNS), ["observation_id"], OBSERVATION_MATERIAL),
        (silver, stamped, ["observation_id"], OBSERVATION_MATERIAL), (gold, mart, MART_KEYS, MART_MATERIAL),
    ):
        store.synchronize(spark, name, frame, keys, material, delete_missing=True)


def layer_counters(spark, at):
    """What the loads count when they meet tables that exist, and when they are run again: layer, counter, n."""
    found = []

    def told(layer: str, result) -> None:
        for name, n in asdict(result).items():
            if isinstance(n, dict):
                found.extend((layer, reason, k) for reason, k in n.items())
            elif not isinstance(n, str):
                found.append((layer, name, n))

    with _tables(spark) as names:
        _existing(spark, at, names)
        bronze, silver, gold = names
        told("bronze", layers.load_bronze_frame(spark, _bronze(spark, at), bronze))
        for again in ("", "_rerun"):
            told(f"silver{again}", layers.load_silver_observations(spark, bronze, silver))
            told(f"gold{again}", layers.load_gold_observations(spark, silver, gold))
    return spark.createDataFrame(found, "layer string, counter string, n long")


def commit_history(spark, at):
    """The mart's commits after a load onto the old one and a run that changes nothing, each with the rows of its
    version as they can still be read."""
    with _tables(spark) as names:
        _existing(spark, at, names)
        bronze, silver, gold = names
        layers.load_bronze_frame(spark, _bronze(spark, at), bronze)
        for _ in range(2):
            layers.load_silver_observations(spark, bronze, silver)
            layers.load_gold_observations(spark, silver, gold)
        commits = [(*asdict(c).values(), store.read_version(spark, gold, c.version).count()) for c in store.history(spark, gold)]
    return spark.createDataFrame(commits, "version long, operation string, inserted_rows long, updated_rows long, deleted_rows long, final_rows long, rows_read long")


def merged_mart(spark, at):
    """The mart after a load onto tables that exist: rows without a material change keep what they had."""
    with _tables(spark) as names:
        _existing(spark, at, names)
        bronze, silver, gold = names
        layers.load_bronze_frame(spark, _bronze(spark, at), bronze)
        layers.load_silver_observations(spark, bronze, silver)
        layers.load_gold_observations(spark, silver, gold)
        return files.kept(spark.table(gold).select(*_MART), "mart")


def ingested_text(spark, at):
    """Bronze as text, some of it unreadable: where the company is missing the value says n/a, where the metric is, the
    stamp does."""
    raw = _bronze(spark, at).select(
        *KEYS,
        F.when(F.col("company_id").isNull(), "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("metric_id").isNull(), "soon").otherwise(F.col("ingested_at").cast("string")).alias("ingested_at"),
    )
    return _zoneless(row_source.typed(raw))


def _quarter(stamp) -> F.Column:
    return F.concat(F.year(stamp).cast("string"), F.lit("Q"), F.quarter(stamp).cast("string"))


def lineitem_gold(spark, at):
    """The mart over order lines: a supplier's mean price per return flag and quarter shipped."""
    lines = table(spark, at, "lineitem")
    rows = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("observation_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("company_id"), F.col("l_returnflag").alias("metric_id"),
        _quarter(F.col("l_shipdate")).alias("period_id"), F.col("l_extendedprice").alias("value"),
        F.col("l_shipdate").alias("ingested_at"),
    )
    return compare_periods(quality.valid_rows(rows)).drop("gold_record_hash")


def events_gold(spark, at):
    """The mart over events: a user's latest value per event type and quarter."""
    rows = table(spark, at, "events").select(
        F.col("event_id").cast("string").alias("observation_id"), F.col("user_id").cast("string").alias("company_id"),
        F.col("event_type").alias("metric_id"), _quarter(F.col("ts")).alias("period_id"), "value", F.col("ts").alias("ingested_at"),
    )
    return compare_periods(quality.valid_rows(rows)).drop("gold_record_hash")


def p1_found(spark, at):
    return profile.departing_columns(profile.counted(_bronze(spark, at))).select("batch_id", "column_name")


def p1_profile(spark, at):
    return profile.column_profiles(profile.counted(_bronze(spark, at)))


def p1_maintained(spark, at):
    """The profiles after the store saw more than arrivals: the newest loads of all feeds are withdrawn, what is left is
    folded, and they are delivered again."""
    rows = _bronze(spark, at)
    counts = profile.counted(rows)
    newest = rows.agg(F.max(F.regexp_extract("batch_id", "-([0-9]+)\\z", 1).try_cast("int"))).first()[0]
    late = rows.where(F.regexp_extract("batch_id", "-([0-9]+)\\z", 1).try_cast("int") == newest)
    for r in late.select("batch_id").distinct().collect():
        counts.withdraw(r["batch_id"])
    counts.compact()
    counts.apply_loads(late)
    return profile.column_profiles(counts)


def p2_found(spark, at):
    return snapshot_diff.snapshot_changes(table(spark, at, "slice4_snapshots"))


def p3_found(spark, at):
    return spikes.implausible_rows(_bronze(spark, at), table(spark, at, "metric_catalog"))


def p3_limits(spark, at):
    return spikes.beyond_limits(_bronze(spark, at), table(spark, at, "metric_catalog"))


def p4_found(spark, at):
    return lateness.late_rows(_bronze(spark, at))


def p4_periods(spark, at):
    return lateness.period_aggregates(_bronze(spark, at))


def p4_resumed(spark, at):
    """The same, with the newest load number added later to what was kept of the others."""
    rows = _bronze(spark, at)
    number = F.regexp_extract("batch_id", "-([0-9]+)\\z", 1).try_cast("int")
    newest = rows.agg(F.max(number)).first()[0]
    kept = files.scratch(spark, "periods")
    lateness.PeriodStore(spark, kept).add(rows.where(number < newest))
    return lateness.period_aggregates(rows.where(number == newest), lateness.PeriodStore(spark, kept))


def p5_found(spark, at):
    return dedup.superfluous_copies(_bronze(spark, at))


def p5_kept(spark, at):
    """The table without superfluous copies; rows without an identifier stay."""
    rows = _bronze(spark, at)
    kept = rows.join(dedup.superfluous_copies(rows), "row_id", "left_anti")
    return kept.select("row_id", trimmed(F.col("observation_id")).alias("observation_id"), "value")


QUERIES = {
    f.__name__: f
    for f in (
        bronze_latest, silver_classified, silver_rejected_by_reason, silver_snapshot, silver_counters, upsert_actions,
        sync_actions, sync_result, sync_metrics, silver_inserted, silver_orphans, gold_same_period, gold_snapshot,
        gold_sync_actions, serving_companies, serving_metrics, serving_comparison, display_rows,
        pipeline_bronze_silver_gold, layer_counters, commit_history, merged_mart, ingested_text, lineitem_gold, events_gold, p1_found, p1_profile, p1_maintained, p2_found, p3_found, p3_limits, p4_found, p4_periods, p4_resumed, p5_found, p5_kept,
    )
}
