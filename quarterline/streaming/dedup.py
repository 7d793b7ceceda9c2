"""Exactly one copy of every message that was delivered at least once.

The state of seen identifiers is keyed by identifier and holds the copy kept so far. An epoch merges its rows with what
is known of their identifiers and writes a delta: a new entry for every identifier that arrived, in a folder for the
year it was last seen in, and the epoch's output. Nothing that was written is written again: the newest entry of an
identifier is the greatest, older ones are passed over. Once the event-time watermark says that a year has expired, its
folders leave the hot state, which every epoch merges, for the archive, in which only identifiers are looked up that
the hot state doesn't know.

An epoch writes under a name of its own, and one small commit file, created in one step and by one writer only, makes
state and output valid together. An epoch that died before is run anew, one that is committed is never run again, and a
writer that comes second throws its folder away.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.functions.text import identifier
from quarterline.sources import files

EXPIRY_DAYS = 365
#: Loads of so many consecutive numbers form one epoch of the batch drive.
LOADS_PER_EPOCH = 7
_SANE = "'2015-01-01'", "'2027-01-01'"
_EPOCH = "_epoch"
_MESSAGE = "row_id long, id string, stamp timestamp_ntz"
_STATE = "id string, stamp timestamp_ntz, row_id long, seen timestamp_ntz"


@dataclass(frozen=True)
class Epoch:
    number: int
    watermark: str | None
    hot: list[str]
    archive: list[str]
    output: list[str]


def messages(bronze: DataFrame, *also: str) -> DataFrame:
    """row_id, id (trimmed) and stamp of the rows that have an identifier, and more of their columns."""
    rows = bronze.select(*also, "row_id", identifier(F.col("observation_id")).alias("id"), F.col("ingested_at").cast("timestamp_ntz").alias("stamp"))
    return rows.where("id IS NOT NULL")


def event_time(stamp):
    """The stamp where it is possible at all; impossible ones must not move the watermark."""
    return F.when((stamp >= F.expr(f"timestamp_ntz {_SANE[0]}")) & (stamp < F.expr(f"timestamp_ntz {_SANE[1]}")), stamp)


def watermark_of(rows: DataFrame) -> str | None:
    """A high quantile of the event times rather than their maximum, which a single wrong stamp would set."""
    day = F.unix_date(event_time(F.col("stamp")).cast("date"))
    found = rows.agg(F.date_from_unix_date(F.percentile_approx(day, 0.95)).cast("string")).first()[0]
    return found


class SeenStore:
    """State, archive and output of one deduplication under one folder of the shared file system."""

    def __init__(self, spark: SparkSession, root: str, expiry_days: int = EXPIRY_DAYS) -> None:
        self.spark, self.root, self.expiry_days = spark, root.rstrip("/"), expiry_days

    def last(self) -> Epoch | None:
        done = [n for n in files.names(self.spark, f"{self.root}/commits") if n.endswith(".json")]
        return Epoch(**json.loads(files.read_text(self.spark, f"{self.root}/commits/{done[-1]}"))) if done else None

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        if paths:
            return self.spark.read.schema(schema).parquet(*paths)
        return self.spark.createDataFrame([], schema)

    def process(self, rows: DataFrame, number: int, watermark: str | None = None) -> bool:
        """Run one epoch over row_id, id, stamp; False, and nothing done, if it is committed already.

        Skew: a hot identifier is reduced map-side before its exchange, and the copies to put out are found by row_id,
        not by identifier, so no task ever holds the rows of one identifier.
        """
        before = self.last()
        if before and before.number >= number:
            return False
        spark, folder = self.spark, f"{self.root}/epoch-{number:08d}-{uuid.uuid4().hex}"
        mark = max(filter(None, [watermark or watermark_of(rows), before and before.watermark]), default=None)
        known = self._read(before.hot if before else [], _STATE)
        if before and before.archive:
            # Only identifiers that the hot state doesn't know need the archive; once each, however often they came.
            asked = rows.select("id").distinct().join(known.select("id"), "id", "left_anti")
            known = known.union(self._read(before.archive, _STATE).join(asked, "id", "left_semi"))
        copy = F.struct(F.col("stamp"), (-F.col("row_id")).alias("order"))
        seen = F.coalesce(event_time(F.col("stamp")), F.lit(mark).cast("timestamp_ntz"))
        merged = (
            rows.select("id", "row_id", "stamp", seen.alias("seen"), F.lit(False).alias("old"))
            .unionByName(known.withColumn("old", F.lit(True)))
            .groupBy("id")
            .agg(
                F.max(copy).alias("best"), F.max(F.when(F.col("old"), copy)).alias("kept"),
                F.max("seen").alias("seen"), F.bool_or(~F.col("old")).alias("arrived"),
            )
            .where("arrived")
        )
        merged.select(
            "id", F.col("best.stamp").alias("stamp"), (-F.col("best.order")).alias("row_id"), "seen",
            F.when(F.col("best.order") != F.col("kept.order"), -F.col("kept.order")).alias("displaced"), F.year("seen").alias("year"),
        ).write.partitionBy("year").parquet(f"{folder}/state")
        years = files.names(spark, f"{folder}/state")
        mine = [f"{folder}/state/{y}" for y in years if y.startswith("year=")]
        arrived = self._read(mine, f"{_STATE}, displaced long")
        extra = rows.select("row_id").join(arrived.select("row_id"), "row_id", "left_anti")
        displaced = arrived.where("displaced IS NOT NULL").select(F.col("displaced").alias("row_id"))
        extra.union(displaced).write.parquet(f"{folder}/output")
        # Folders move from hot to archive by name only.
        limit = str(date.fromisoformat(mark) - timedelta(days=self.expiry_days)) if mark else ""
        hot, cold = [*(before.hot if before else []), *mine], [*(before.archive if before else [])]
        gone = [f for f in hot if (y := f.rpartition("year=")[2]).isdigit() and f"{y}-12-31" < limit]
        done = Epoch(number, mark, [f for f in hot if f not in gone], cold + gone, [*(before.output if before else []), f"{folder}/output"])
        if not files.write_text(spark, f"{self.root}/commits/{number:08d}.json", json.dumps(asdict(done))):
            files.delete(spark, folder)
            return False
        return True

    def superfluous(self) -> DataFrame:
        """row_id of every row that isn't kept, over all committed epochs."""
        done = self.last()
        return self._read(done.output if done else [], "row_id long")


def superfluous_copies(bronze: DataFrame, loads_per_epoch: int = LOADS_PER_EPOCH) -> DataFrame:
    """Replay the loads in their order, a fixed number of them per epoch; row_id of every superfluous row.

    Kept is, per trimmed observation_id, the row with the latest ingested_at (null last), on a tie the smallest row_id.
    Null and blank identifiers identify nothing and are never superfluous. Rows without a load come first.

    The messages are sorted into epochs in one pass, so that each epoch reads its own only.
    """
    spark = bronze.sparkSession
    number = F.coalesce(F.regexp_extract("batch_id", "-([0-9]+)\\z", 1).try_cast("int"), F.lit(0))
    inbox = files.scratch(spark, "inbox")
    epoch = F.floor(number / loads_per_epoch).alias("epoch")
    messages(bronze.withColumn(_EPOCH, epoch), _EPOCH).write.partitionBy(_EPOCH).parquet(inbox)
    store = SeenStore(spark, files.scratch(spark, "seen"))
    found = (n.rpartition("=")[2] for n in files.names(spark, inbox))
    for k in sorted(int(n) for n in found if n.isdigit()):
        store.process(spark.read.schema(_MESSAGE).parquet(f"{inbox}/{_EPOCH}={k}"), k + 1)
    return store.superfluous()


def deduplicate_stream(stream: DataFrame, store: SeenStore, checkpoint: str, **trigger):
    """The same over a streaming frame of bronze rows; the query's checkpoint and the store's commits stay in step,
    as a batch that is replayed after a failure has the number of its committed epoch."""

    def epoch(batch: DataFrame, number: int) -> None:
        store.process(messages(batch), number + 1)

    return stream.writeStream.foreachBatch(epoch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
