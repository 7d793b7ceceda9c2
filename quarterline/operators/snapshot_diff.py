"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.text import identifier
from quarterline.operators.latest import keep_latest

#: A list of snapshots beyond this is joined rather than broadcast.
MOST_BROADCAST_SNAPSHOTS = 100_000


def canonical_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """128-bit hash of the columns' canonical texts: null differs from everything, NaN equals NaN, -0.0 equals 0.0."""
    types = dict(df.dtypes)

    def text(c: str) -> Column:
        # Adding 0.0 turns -0.0 into 0.0. A double's text identifies it exactly.
        x = F.col(c) + F.lit(0.0) if types[c] in ("double", "float") else F.col(c)
        return F.coalesce(F.concat(F.lit("="), x.cast("string")), F.lit("null"))

    framed = (F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in map(text, columns))
    return F.unhex(F.md5(reduce(F.concat, framed)))


def snapshot_changes(
    snapshots: DataFrame,
    key: str = "observation_id",
    compared: Sequence[str] = ("value", "period_id"),
    snapshot: str = "snapshot_id",
    stamp: str = "ingested_at",
) -> DataFrame:
    """snapshot_id (the later one), the trimmed key and change_kind: added, removed or changed.

    Of a key listed more than once in a snapshot, the row with the latest stamp counts (null last), on a tie the one
    with the greatest hash. Null and blank keys and null snapshot numbers are no records. The first snapshot yields
    nothing; neither does an empty table. Other columns are never read.

    One exchange by (snapshot, key) serves the choice of the latest row on both sides, and the later side of the join
    keeps its partitioning and order; the earlier side takes one more, by (next snapshot, key). A key has as many rows as there are snapshots, so the join can't be skewed;
    repeated listings are cut before their exchange by the partial group limit.
    """
    rows = snapshots.select(
        F.col(snapshot).alias("at"), identifier(F.col(key)).alias("id"), F.col(stamp).alias("stamp"),
        canonical_hash(snapshots, compared).alias("hash"),
    ).where("at IS NOT NULL AND id IS NOT NULL")
    latest = keep_latest(rows, ["at", "id"], [F.desc_nulls_last("stamp"), F.desc("hash")]).drop("stamp")
    numbers = snapshots.select(F.col(snapshot).alias("at")).where("at IS NOT NULL").distinct()
    known = sorted(r["at"] for r in numbers.collect())
    pairs = snapshots.sparkSession.createDataFrame(list(zip(known, known[1:], strict=False)), "at int, next int")
    if len(known) <= MOST_BROADCAST_SNAPSHOTS:
        pairs = F.broadcast(pairs)
    earlier = latest.join(pairs, "at").select(F.col("next").alias("at"), "id", F.col("hash").alias("before"))
    later = latest.withColumnRenamed("hash", "after")
    first = F.lit(known[0] if known else None).cast("int")
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed")
    return (
        earlier.join(later, ["at", "id"], "full_outer")
        .where(~F.col("before").eqNullSafe(F.col("after")) & (F.col("at") != first))
        .select(
            F.col("at").cast("int").alias("snapshot_id"), F.col("id").alias("observation_id"),
            kind.otherwise("changed").alias("change_kind"),
        )
    )
