"""Plan of an upsert or a full-snapshot synchronisation as one full outer join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.functions.expr import materially_changed

INSERT, UPDATE, DELETE, KEEP = "I", "U", "D", "N"


def plan_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], material: Sequence[str], delete_missing: bool
) -> DataFrame:
    """Every row of either side once, with _action: I(nsert), U(pdate), D(elete) or N(othing).

    Keys match by plain equality, so a null key never matches: its source row is an insert, its target row is kept
    (upsert) or deleted (synchronisation). An update takes every column of the source, an unchanged row keeps the
    target's, stamps included. Rows marked D carry the target's values. Columns are those of the target.
    """
    columns = target.columns
    t = target.select(*columns, F.lit(True).alias("_in_target")).alias("t")
    s = source.select(*columns, F.lit(True).alias("_in_source")).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    action = (
        F.when(F.col("_in_target").isNull(), INSERT)
        .when(F.col("_in_source").isNull(), DELETE if delete_missing else KEEP)
        .when(materially_changed(material, "t", "s"), UPDATE)
        .otherwise(KEEP)
    )
    joined = t.join(s, on, "full_outer").withColumn("_action", action)
    take = F.col("_action").isin(INSERT, UPDATE)
    return joined.select(
        *(F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns), "_action"
    )


def apply_changes(plan: DataFrame) -> DataFrame:
    """The target after the plan."""
    return plan.where(F.col("_action") != DELETE).drop("_action")


def change_counts() -> list:
    """Aggregates over a plan; usable in observe() as well as in agg()."""
    named = (("inserted_rows", INSERT), ("updated_rows", UPDATE), ("deleted_rows", DELETE))
    return [F.count_if(F.col("_action") == code).alias(name) for name, code in named]
