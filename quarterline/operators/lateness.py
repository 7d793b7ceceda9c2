"""Aggregates per quarter by event time that late rows correct up to a cut-off, and the rows that were late.

Event time is the quarter, arrival is ingested_at; lateness is the arrival minus the first instant after the quarter.
Finger B-trees decide. One over all quarters takes the arrivals in their order and evicts a quarter when an arrival
says that its cut-off has passed: what it refuses was too late, what it takes behind its finger of open quarters was a
correction. One per series holds the earliest arrival of each quarter and answers which rows were overtaken. One takes
the loads in their order and holds the aggregates; it is kept from load to load.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.functions.expr import is_finite
from quarterline.functions.text import FIRST_YEAR, QUARTERS, identifier, quarter_index
from quarterline.functions.exact import as_double, in_common, scale_of, units_of
from quarterline.operators.finger_tree import COUNT, EARLIEST, PAIR, FingerTree
from quarterline.operators.whole_groups import group_numbers, whole_groups
from quarterline.sources import files

LATE_DAYS, CUT_OFF_DAYS = 45, 200
_DAY = 86_400_000_000
_SERIES = ("company", "metric")
#: Arrivals from the first stamp on and before the second take part.
FIRST_STAMP, END_STAMP = "2015-01-01", "2027-01-01"


def _day(year: int, month: int) -> int:
    return (date(year, month, 1) - date(1970, 1, 1)).days


#: Day after each quarter.
_ENDS = [_day(FIRST_YEAR + q // 4, 3 * (q % 4) + 1) for q in range(1, QUARTERS + 1)]


def participants(bronze: DataFrame) -> DataFrame:
    """row_id, company, metric (null where blank), quarter, arrived in microseconds, day, value, batch_id.

    A quarter closes on the first instant of a day, and what arrives on that very instant is still in time; so a day
    is counted from one tick after its first instant to the first instant of the next.

    Rows whose quarter can't be read or whose stamp is missing or impossible are left out.
    """
    stamp = F.col("ingested_at").cast("timestamp_ntz")
    sane = (stamp >= F.lit(FIRST_STAMP).cast("timestamp_ntz")) & (stamp < F.lit(END_STAMP).cast("timestamp_ntz"))
    arrived = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), stamp)
    rows = bronze.where(sane).select(
        "row_id", "batch_id", "value", identifier(F.col("company_id")).alias("company"),
        identifier(F.col("metric_id")).alias("metric"), quarter_index(F.col("period_id")).alias("quarter"), arrived.alias("arrived"),
    )
    return rows.where("quarter IS NOT NULL").withColumn("day", F.expr(f"CAST((arrived - 1) DIV {_DAY} AS INT)"))


def _standing(cells: pd.DataFrame) -> pd.DataFrame:
    """quarter, day and kind of the arrivals that were late or too late.

    The tree takes the arrivals day by day. Each day moves its watermark: quarters whose cut-off has passed are evicted
    in bulk, and rows of these are refused from then on. Of those it takes, rows behind the first quarter that is still
    awaited correct what was reported already.
    """
    tree, out = FingerTree(COUNT), []
    for day, rows in cells.groupby("day", sort=True):
        tree.cut(bisect_right(_ENDS, int(day) - CUT_OFF_DAYS))
        awaited = bisect_right(_ENDS, int(day) - LATE_DAYS)
        for quarter, n in zip(rows["quarter"].tolist(), rows["n"].tolist(), strict=True):
            if not tree.insert(quarter, n):
                out.append((quarter, day, "too_late"))
            elif quarter < awaited:
                out.append((quarter, day, "late"))
    return pd.DataFrame(out, columns=["quarter", "day", "kind"])


def standing(rows: DataFrame) -> DataFrame:
    """quarter, day and kind (late or too_late) of participants.

    The one task gets a count per quarter and day, at most 40 times some 4,400 whatever the rows; so much is the bound
    of the result, too.
    """
    cells = rows.groupBy("quarter", "day").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    return cells.groupBy("all").applyInPandas(_standing, "quarter int, day int, kind string")


def _overtaken_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per series and quarter: the earliest arrival of any later quarter, where some row of the node came after it.

    Input is clustered by series and has one row per node. Each series has a tree, which takes the quarters as they
    first arrived.
    """
    for batch in whole_groups(batches, _SERIES):
        series = group_numbers(batch, _SERIES)
        quarter, first, last = (batch[c].to_numpy() for c in ("quarter", "first", "last"))
        order = np.lexsort((first, series))
        begins = np.flatnonzero(np.diff(series[order], prepend=-1))
        times, arrivals = quarter[order].tolist(), first[order].tolist()
        overtaker = np.full((int(series[-1]) + 1, QUARTERS), EARLIEST.identity, np.uint64)
        for tree, (a, b) in enumerate(zip(begins.tolist(), [*begins[1:].tolist(), len(order)], strict=True)):
            if b - a > 1:
                seen = FingerTree(EARLIEST)
                for k in range(a, b):
                    seen.insert(times[k], arrivals[k])
                for time, earliest in seen.later():
                    overtaker[tree, time] = earliest
        before = overtaker[series, quarter]
        hit = before < last.astype(np.uint64)
        yield batch.loc[hit, ["company", "metric", "quarter"]].assign(overtaker=before[hit].astype(np.int64))


def late_rows(bronze: DataFrame) -> DataFrame:
    """row_id and kind: late, too_late, overtaken; a row may have two kinds, each delivered row is judged by itself.

    Arrivals are first reduced map-side, per series and quarter and per quarter and day, so a hot series sends few rows
    to the trees. What they answer meets the rows in one pass: standing per quarter and day, bounded and broadcast, and
    the series' quarters with an overtaken row, written first so that Spark knows their size and broadcasts them only
    if it is small.
    """
    rows = participants(bronze)
    nodes = (
        rows.where("company IS NOT NULL AND metric IS NOT NULL")
        .groupBy("company", "metric", "quarter")
        .agg(F.min("arrived").alias("first"), F.max("arrived").alias("last"))
        .repartition("company", "metric")
        .sortWithinPartitions("company", "metric", "quarter")
        .mapInPandas(_overtaken_nodes, "company string, metric string, quarter int, overtaker long")
    )
    judged = rows.select("row_id", "company", "metric", "quarter", "day", "arrived")
    judged = judged.join(F.broadcast(standing(rows)), ["quarter", "day"], "left")
    judged = judged.join(files.kept(nodes, "overtaken"), ["company", "metric", "quarter"], "left")
    kinds = F.array_compact(F.array("kind", F.when(F.col("overtaker") < F.col("arrived"), F.lit("overtaken"))))
    return judged.select("row_id", F.explode(kinds).alias("kind"))


def _watermark(high: np.ndarray, n: np.ndarray) -> int:
    """The day by which nearly all of a load's rows had arrived; a few stamps far ahead don't move it."""
    order = np.argsort(high, kind="stable")
    return int(high[order][np.searchsorted(n[order].cumsum(), 0.95 * n.sum())])


class Totals:
    """Count and sum of every quarter as loads come one after the other; knows nothing of those to come.

    The arrivals seen so far move the watermark, and quarters whose cut-off that has passed are evicted: their
    aggregates are closed and leave the tree. A row in time by its own arrival that a later load brings for a closed
    quarter corrects the closed aggregate.
    """

    def __init__(self) -> None:
        self.tree = FingerTree(PAIR)
        self.closed: dict[int, tuple[int, int]] = {}
        self.corrected = [0] * QUARTERS
        self.seen: int | None = None

    def state(self) -> dict:
        """All that the next load needs."""
        entries = lambda pairs: [[q, n, str(total)] for q, (n, total) in pairs]
        return {"live": entries(self.tree.items()), "closed": entries(self.closed.items()), "corrected": self.corrected, "cut_off": self.tree.cut_off, "seen": self.seen}

    @classmethod
    def resumed(cls, state: dict) -> Totals:
        self = cls()
        if state["cut_off"] is not None:
            self.tree.cut(state["cut_off"])
        for q, n, total in state["live"]:
            self.tree.insert(q, (n, int(total)))
        self.closed = {q: (n, int(total)) for q, n, total in state["closed"]}
        self.corrected, self.seen = list(state["corrected"]), state["seen"]
        return self

    def add(self, load: int, rows: pd.DataFrame) -> list[tuple]:
        """One load; load, quarter, n, total, late and later of every quarter as of it."""
        parts = zip(*(rows[c].tolist() for c in ("quarter", "scale", "n", "total", "late")), strict=True)
        for quarter, scale, n, total, late in parts:
            part = (n, in_common(int(total), scale))
            if not self.tree.insert(quarter, part):
                self.closed[quarter] = PAIR.plus(self.closed.get(quarter, PAIR.identity), part)
            self.corrected[quarter] += late
        all_of, later, following = dict(self.tree.items()), dict(self.tree.later()), self.tree.total()[0]
        for quarter in sorted(self.closed, reverse=True):
            all_of[quarter], later[quarter] = self.closed[quarter], (following, 0)
            following += self.closed[quarter][0]
        out = [(load, q, n, as_double(total), self.corrected[q], later[q][0]) for q, (n, total) in sorted(all_of.items())]
        high = _watermark(rows["high"].to_numpy(), rows["n"].to_numpy())
        self.seen = high if self.seen is None else max(self.seen, high)
        self.closed |= dict(self.tree.cut(bisect_right(_ENDS, self.seen - CUT_OFF_DAYS)))
        return out


_TOTALS = "load_number int, quarter int, n long, total double, late long, later long"


class PeriodStore:
    """Totals that outlive a process: each load commits its rows and the state after it as one file, created in one
    step, from which the next load goes on."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> list[dict]:
        names = [n for n in files.names(self.spark, f"{self.root}/commits") if n.endswith(".json")]
        return [json.loads(files.read_text(self.spark, f"{self.root}/commits/{n}")) for n in names]

    def add(self, bronze: DataFrame) -> None:
        """The loads of the rows, in the order of their numbers. ValueError for a load that isn't later than those
        already there. What reaches the driver are sums per load number, quarter and scale of the values, a table
        bounded by loads times quarters whatever the rows."""
        deltas = _deltas(bronze).toPandas()
        done = self._commits()
        last, totals = (done[-1]["load"], Totals.resumed(done[-1]["state"])) if done else (-1, Totals())
        if len(deltas) and deltas["load_number"].min() <= last:
            raise ValueError(f"loads up to {last} are closed")
        for load, rows in deltas.groupby("load_number", sort=True):
            out = totals.add(int(load), rows)
            commit = json.dumps({"load": int(load), "rows": out, "state": totals.state()})
            if not files.write_text(self.spark, f"{self.root}/commits/{int(load):010d}.json", commit):
                raise RuntimeError(f"load {load} was added by another writer")

    def totals(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(r) for c in self._commits() for r in c["rows"]], _TOTALS)


def _deltas(bronze: DataFrame) -> DataFrame:
    """Per load number, quarter and scale of the values: n, total (in units of the scale, as text), late, high (the day
    by which nearly all had arrived). Rows that the tree of arrivals refuses are left out."""
    number = F.regexp_extract("batch_id", "-([0-9]+)\\z", 1).try_cast("int")
    rows = participants(bronze)
    taken = rows.where(is_finite(F.col("value"))).join(F.broadcast(standing(rows)), ["quarter", "day"], "left")
    return (
        taken.where("kind IS DISTINCT FROM 'too_late'")
        .withColumn("load_number", number)
        .where("load_number IS NOT NULL")
        .withColumn("scale", scale_of(F.col("value")))
        .groupBy("load_number", "quarter", "scale")
        .agg(
            F.count("*").alias("n"), F.sum(units_of(F.col("value"), F.col("scale"))).cast("string").alias("total"),
            F.count_if(F.col("kind") == "late").alias("late"), F.percentile_approx("day", 0.95).alias("high"),
        )
    )


def period_aggregates(bronze: DataFrame, store: PeriodStore | None = None) -> DataFrame:
    """Per load number and quarter: value_count, value_sum (of finite values: the double nearest to the exact sum,
    infinite beyond the largest), late_count (how many of them were corrections) and later_count (values of later
    quarters seen so far), as of that load.

    Loads of all feeds with the same number form one step; rows without a load take no part. With a store the loads are
    added to what it holds, and the result covers all of it; without one a new store takes them.
    """
    spark = bronze.sparkSession
    store = store or PeriodStore(spark, files.scratch(spark, "periods"))
    store.add(bronze)
    period = F.concat((F.lit(FIRST_YEAR) + F.floor(F.col("quarter") / 4)).cast("string"), F.lit("Q"), (F.col("quarter") % 4 + 1).cast("string"))
    return store.totals().select(
        "load_number", period.alias("period_id"), F.col("n").alias("value_count"), F.col("total").alias("value_sum"),
        F.col("late").alias("late_count"), F.col("later").alias("later_count"),
    )
