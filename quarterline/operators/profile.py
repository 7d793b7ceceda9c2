"""Column profiles per load from maintained value-count tables, and the loads whose columns depart from their feed.

The value-count table of a column says how often each value occurs in each load. It is persistent and changes only by
signed deltas, one for each load: +1 per row of a load that arrives, -1 per row of one that is withdrawn. Profiles (nulls, distinct
values, range, violations, entropy) are exact aggregates of the maintained counts, so no load is read again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.functions.expr import is_finite
from quarterline.functions.text import quarter_index, trimmed
from quarterline.sources import files

COLUMNS = ("period_id", "value", "ingested_at")
_KIND = {"period_id": "string", "value": "double", "ingested_at": "timestamp_ntz"}
_DAY = 86_400_000_000


class ValueCounts:
    """Counts of (load, value) per column under one folder.

    Every change is a signed delta: a folder of its own, written first, and then a commit, a small file with the next
    free number, that makes it count in all columns at once. Deltas add up in any order, so a writer that finds its
    number taken by another takes the next one. compact() folds what is committed into a base; deltas committed
    meanwhile stay beside it.
    """

    def __init__(self, spark: SparkSession, root: str, load: str = "batch_id", columns: Sequence[str] = COLUMNS) -> None:
        self.spark, self.root, self.load, self.columns = spark, root.rstrip("/"), load, columns
        self._known: dict[str, dict] = {}

    def _commits(self) -> list[dict]:
        """What was committed, in order; commits never change, so each is read once."""
        names = [n for n in files.names(self.spark, f"{self.root}/commits") if n.endswith(".json")]
        for n in names:
            if n not in self._known:
                self._known[n] = json.loads(files.read_text(self.spark, f"{self.root}/commits/{n}"))
        return [self._known[n] for n in names]

    def _commit(self, **what) -> None:
        number = max((int(n[:8]) for n in self._known), default=-1) + 1
        while not files.write_text(self.spark, f"{self.root}/commits/{number:08d}.json", json.dumps(what)):
            number += 1
        self._known[f"{number:08d}.json"] = what

    def _counts(self, rows: DataFrame, column: str) -> DataFrame:
        """load, key, n; reduced map-side before the exchange."""
        value = F.col(column).cast(_KIND.get(column, dict(rows.dtypes)[column]))
        return rows.select(F.col(self.load).alias("load"), value.alias("key")).groupBy("load", "key").agg(F.count("*").alias("n"))

    def apply(self, rows: DataFrame, sign: int = 1) -> None:
        """Add (or with -1 withdraw) any rows, as one delta."""
        delta = f"{self.root}/delta-{uuid.uuid4().hex}"
        for c in self.columns:
            self._counts(rows, c).write.parquet(f"{delta}/{c}/all")
        self._commit(sign=sign, delta=delta, part="all")

    def apply_loads(self, rows: DataFrame) -> None:
        """Add every load of the rows as a delta of its own, committed one after the other by number and name.

        One pass per column writes the deltas of all loads; a load far larger than others is written by several tasks.
        """
        # One row per load.
        loads = sorted((r["load"] for r in rows.select(F.col(self.load).alias("load")).distinct().collect()), key=_by_number)
        if not loads:
            return
        delta, places = f"{self.root}/delta-{uuid.uuid4().hex}", {load: k for k, load in enumerate(loads)}
        named = F.create_map(*(F.lit(x) for load, k in places.items() if load is not None for x in (load, k)), F.lit("\0"), F.lit(-1))
        slot = F.coalesce(F.try_element_at(named, F.col("load")), F.lit(places.get(None, -1)))
        for c in self.columns:
            self._counts(rows, c).withColumn("slot", slot).hint("rebalance", "slot").write.partitionBy("slot").parquet(f"{delta}/{c}")
        for load, k in places.items():
            self._commit(sign=1, delta=delta, part=f"slot={k}", load=load)

    def withdraw(self, load: str | None) -> None:
        """Take back a load: its deltas count once more, with the opposite sign."""
        applied: Counter = Counter()
        for c in self._commits():
            if "load" in c and c["load"] == load:
                applied[c["delta"], c["part"]] += c["sign"]
        for (delta, part), sign in applied.items():
            if sign:
                self._commit(sign=-sign, delta=delta, part=part, load=load)

    def compact(self) -> None:
        """Fold all committed deltas into a new base."""
        upto, base = len(self._commits()), f"{self.root}/base-{uuid.uuid4().hex}"
        for c in self.columns:
            self._read(c, upto).write.parquet(f"{base}/{c}")
        self._commit(base=base, upto=upto)

    def read(self, column: str) -> DataFrame:
        """load, key, n with n other than 0."""
        return self._read(column, len(self._commits()))

    def _read(self, column: str, upto: int) -> DataFrame:
        commits = self._commits()[:upto]
        bases = [c for c in commits if "base" in c]
        folded = bases[-1]["upto"] if bases else 0
        paths: dict[int, list[str]] = {1: [f"{bases[-1]['base']}/{column}"] if bases else [], -1: []}
        for c in commits[folded:]:
            if "delta" in c:
                paths[c["sign"]].append(f"{c['delta']}/{column}/{c['part']}")
        if not any(paths.values()):
            return self.spark.createDataFrame([], f"load string, key {_KIND.get(column, 'string')}, n long")
        parts = [self.spark.read.parquet(*p).select("load", "key", (F.col("n") * sign).alias("n")) for sign, p in paths.items() if p]
        if bases and len(paths[1]) == 1 and not paths[-1]:
            return parts[0]
        return reduce(DataFrame.union, parts).groupBy("load", "key").agg(F.sum("n").alias("n")).where("n <> 0")


def _by_number(load: str | None) -> tuple[int, str]:
    number = re.search(r"-([0-9]+)\Z", load or "")
    return int(number[1]) if number else -1, load or ""


def counted(bronze: DataFrame) -> ValueCounts:
    """A new store to which every load was applied as a delta, folded once."""
    counts = ValueCounts(bronze.sparkSession, files.scratch(bronze.sparkSession, "counts"))
    counts.apply_loads(bronze)
    counts.compact()
    return counts


def _micros(stamp: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), stamp)


def _violates(column: str) -> Column:
    key = F.col("key")
    if column == "period_id":
        return key.isNotNull() & ~trimmed(key).rlike("^[0-9]{4}Q[1-4]\\z")
    if column == "value":
        return key.isNotNull() & ~F.isnan(key) & ~is_finite(key)
    return key.isNotNull() & ~key.between(F.lit("2015-01-01").cast("timestamp_ntz"), F.lit("2026-12-31 23:59:59.999999").cast("timestamp_ntz"))


def column_profiles(counts: ValueCounts) -> DataFrame:
    """One row per load and column: row_count, null_count, nan_count, distinct_count (without null, NaN being one
    value), violation_count (not YYYYQn, infinite, impossible stamp), low and high (finite values; stamps in
    microseconds; null for text) and entropy in bits over all values, null included, to six decimals."""
    parts = []
    for c in counts.columns:
        n, key = F.col("n"), F.col("key")
        number = {"value": F.when(is_finite(key), key), "ingested_at": _micros(key).cast("double")}.get(c) if c != "period_id" else F.lit(None).cast("double")
        nan = F.isnan(key) if c == "value" else F.lit(False)
        bits = F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)
        parts.append(
            counts.read(c).groupBy("load").agg(
                F.sum("n").alias("row_count"),
                F.coalesce(F.sum(F.when(key.isNull(), n)), F.lit(0)).alias("null_count"),
                F.coalesce(F.sum(F.when(nan, n)), F.lit(0)).alias("nan_count"),
                F.count("key").alias("distinct_count"),
                F.coalesce(F.sum(F.when(_violates(c), n)), F.lit(0)).alias("violation_count"),
                F.min(number).alias("low"), F.max(number).alias("high"), F.round(bits, 6).alias("entropy"),
            ).select(F.col("load").alias("batch_id"), F.lit(c).alias("column_name"), "*").drop("load")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class DepartureRules:
    """least_share: share of a load's rows that must lie elsewhere than in the feed's other loads. beyond: how many
    usual deviations of the feed's own differences that must be, too. heavy: share of a load's rows from which a single
    value counts as dominating. fewest: loads that a feed needs."""

    least_share: float = 0.15
    beyond: float = 6.0
    heavy: float = 0.05
    fewest: int = 4


def _facets(column: str) -> dict[str, Column]:
    """What is compared between loads, as small integers per value."""
    key = F.col("key")
    if column == "period_id":
        state = F.when(key.isNull(), 0).when(F.length(trimmed(key)) == 0, 1).when(_violates("period_id"), 2).otherwise(3)
        return {"state": state, "place": quarter_index(key)}
    if column == "value":
        finite = is_finite(key)
        size = F.abs(key)
        digits = F.translate(F.substring_index(size.cast("string"), "E", 1), ".", "")
        length = F.length(F.btrim(digits, F.lit("0")))
        decimals = F.length(F.rtrim(F.substring_index(F.round(size % 1, 6).cast("decimal(8,6)").cast("string"), ".", -1), F.lit("0")))
        return {
            "state": F.when(key.isNull(), 0).when(F.isnan(key), 1).when(~finite, 2).otherwise(3),
            "size": F.when(finite, F.when(size == 0, F.lit(-99)).otherwise(F.floor(2 * F.log10(size)))),
            "sign": F.when(finite, F.signum(key)),
            "digits": F.when(finite, F.least(length, F.lit(8))),
            "decimals": F.when(finite & (size < 1e12), decimals),
        }
    micros = _micros(key)
    return {
        "state": F.when(key.isNull(), 0).otherwise(3),
        "place": F.year(key) * 12 + F.month(key),
        "hour": F.hour(key),
        "grain": F.when(micros % _DAY == 0, 0).when(micros % 60_000_000 == 0, 1).when(micros % 1_000_000 == 0, 2)
        .when(micros % 1000 == 0, 3).when(F.floor(micros / 1_000_000) % 86_400 == 0, 4).otherwise(5),
    }


def _histogram(counts: ValueCounts, column: str) -> DataFrame:
    """Rows per load and combination of facets, a table whose size doesn't follow the rows; and beside it, with the
    facets null, how many values occur n times in a load, which grows by the root of the rows at most."""
    facets = {k: v.cast("int") for k, v in _facets(column).items()}
    read = counts.read(column)
    placed = read.select("load", "n", *(v.alias(k) for k, v in facets.items())).groupBy("load", *facets).agg(F.sum("n").alias("n"))
    key = F.col("key")
    missing = key.isNull() | F.isnan(key) if column == "value" else key.isNull()
    times = read.where("n > 0").groupBy("load", "n", missing.alias("missing")).agg(F.count("*").alias("values"))
    return placed.unionByName(times, allowMissingColumns=True)


def distinct_share(n: np.ndarray, values: np.ndarray, rows: int) -> float:
    """How varied so many rows drawn from a load are expected to be: 0 if all are equal, 1 if all differ. `values` of
    its values occur `n` times. Exact and without bias, so that loads of different sizes can be compared."""
    total = int((n * values).sum())
    # Of a value's n rows none is drawn; past `reach` that is as good as impossible.
    reach = int(min(n.max(), total - rows, 50 * total // rows + 1))
    none = np.append(np.exp(np.append(0.0, np.cumsum(np.log1p(-rows / (total - np.arange(reach)))))), 0.0)
    seen = (values * (1 - none[np.minimum(n, reach + 1)])).sum()
    return float((seen - 1) / (rows - 1))


def evenness(n: np.ndarray, values: np.ndarray) -> float:
    """Entropy of a load's values over the most that so many different values can have; 1 for a single one. It falls
    when a few values take over, and unlike the entropy itself it hardly depends on the number of rows."""
    total, distinct = float((n * values).sum()), float(values.sum())
    if distinct < 2:
        return 1.0
    bits = np.log2(total) - (n * values * np.log2(n)).sum() / total
    return float(np.clip(bits / np.log2(distinct), 0.0, 1.0))


def _distances(shares: np.ndarray) -> np.ndarray:
    """Half the absolute difference of each load's distribution from the median distribution of the others."""
    out = np.zeros(len(shares))
    for k in range(len(shares)):
        usual = np.median(np.delete(shares, k, axis=0), axis=0)
        total = usual.sum()
        out[k] = 0.5 * np.abs(shares[k] - (usual / total if total > 0 else usual)).sum()
    return out


def _expected_place(place: pd.Series, n: pd.Series, load: pd.Series, number: pd.Series, per_load: float) -> pd.Series:
    """Where on the calendar each load's values should lie, from the medians of the feed's other loads."""
    frame = pd.DataFrame({"place": place, "n": n, "load": load, "number": number}).dropna().sort_values("place")
    middle = {}
    for k, g in frame.groupby("load"):
        at = np.searchsorted(g["n"].cumsum().to_numpy(), g["n"].sum() / 2)
        middle[k] = g["place"].iloc[min(at, len(g) - 1)] - per_load * g["number"].iloc[0]
    return pd.Series({k: np.median([m for j, m in middle.items() if j != k] or [middle[k]]) for k in middle})


def _varieties(times: pd.DataFrame, loads: np.ndarray, rules: DepartureRules, calendar: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Loads, their shares of two kinds and their rows: for rows of dominating values and others, then (without null and
    NaN) for the evenness of values that don't follow the calendar, and for the variety of 2, 8, 32 ... rows, each among the loads that have so
    many."""
    each = {load: g for load, g in times.groupby("load")}
    heavy, present = np.zeros(len(loads)), []
    rows = np.array([(each[load]["n"] * each[load]["values"]).sum() if load in each else 0 for load in loads])
    for k, load in enumerate(loads):
        g = each.get(load, times[:0])
        heavy[k] = (g["n"] * g["values"])[g["n"] >= rules.heavy * rows[k]].sum() / max(rows[k], 1)
        g = g[~g["missing"].astype(bool)]
        present.append((g["n"].to_numpy(np.int64), g["values"].to_numpy(np.int64)))
    size = np.array([int((n * v).sum()) for n, v in present])
    out, draw = [(loads, heavy, rows)], 2
    several = size >= 2
    if not calendar and several.sum() >= rules.fewest:
        out.append((loads[several], np.array([evenness(*p) for p, ok in zip(present, several) if ok]), size[several]))
    while np.sum(size >= draw) >= rules.fewest:
        enough = size >= draw
        share = np.array([distinct_share(*p, draw) for p, ok in zip(present, enough) if ok])
        out.append((loads[enough], share, size[enough]))
        draw *= 4
    return [(names, np.stack([share, 1 - share], axis=1), n) for names, share, n in out]


def _departures(rules: DepartureRules, facets: list[str], column: str):
    per_load = {"period_id": 2.0, "ingested_at": 6.0}.get(column, 0.0)

    def judge(feed: pd.DataFrame) -> pd.DataFrame:
        loads = np.sort(feed["load"].unique())
        found: dict[str, float] = {}
        if len(loads) >= rules.fewest:
            times = feed[feed["values"].notna()]
            feed = feed[feed["values"].isna()].copy()
            total = feed.groupby("load")["n"].sum()
            if "place" in facets:
                usual = _expected_place(feed["place"], feed["n"], feed["load"], feed["number"], per_load)
                offset = (feed["place"] - feed["number"] * per_load - feed["load"].map(usual)) / per_load
                # In loads: far before, about a year late, around its own time, ahead of time, far ahead.
                feed["place"] = np.where(offset.isna(), np.nan, np.digitize(offset.fillna(0), [-4, -1.6, 1.6, 4]))
            edges = {loads[0], loads[-1]}
            tables = []
            for facet in facets:
                table = feed.assign(bin=feed[facet].fillna(-1000)).pivot_table(index="load", columns="bin", values="n", aggfunc="sum", fill_value=0).reindex(loads, fill_value=0)
                shares = table.to_numpy(float) / np.maximum(table.to_numpy().sum(axis=1, keepdims=True), 1)
                tables.append((facet == "place", loads, shares, total.reindex(loads).to_numpy()))
            tables += [(column != "value", *t) for t in _varieties(times, loads, rules, column != "value")]
            for calendar, judged, shares, rows in tables:
                distance = _distances(shares)
                noise = np.sqrt(2 * shares * np.maximum(1 - shares, 0) / np.pi / np.maximum(rows[:, None], 1)).sum(axis=1)
                centre = np.median(distance)
                spread = 1.4826 * np.median(np.abs(distance - centre))
                for k, load in enumerate(judged):
                    # The calendar alone lets the first and the last load hold few quarters or days.
                    if load in edges and calendar:
                        continue
                    if distance[k] > max(rules.least_share, centre + rules.beyond * spread) + noise[k]:
                        found[load] = max(found.get(load, 0.0), distance[k])
        out = pd.DataFrame([(load, column, share) for load, share in found.items()], columns=["batch_id", "column_name", "share"])
        return out.astype({"batch_id": object, "column_name": object, "share": float})

    return judge


def departing_columns(counts: ValueCounts, rules: DepartureRules | None = None) -> DataFrame:
    """batch_id, column_name and share, for each load and column that departs from the feed's other loads.

    Loads are named feed-number. Null loads and other names form no feed and never depart. Each facet of a column (null
    and NaN, notation, place on the load's calendar, size, sign, digits, decimals, time of day, precision, dominating
    values) is compared by the share of rows that lie elsewhere than in the other loads, and its variety by the share of
    different values that equally many rows of each load are expected to hold. What a feed's task receives is the table
    of facet combinations, bounded by loads times combinations whatever the rows, and how many values occur how often in
    a load, at most the root of twice its rows.
    """
    rules, out = rules or DepartureRules(), None
    for c in counts.columns:
        facets = list(_facets(c))
        histogram = _histogram(counts, c).select(
            "*", F.regexp_extract("load", "^(.*)-[0-9]+\\z", 1).alias("feed"), F.regexp_extract("load", "-([0-9]+)\\z", 1).try_cast("int").alias("number"),
        ).where("number IS NOT NULL")
        part = histogram.groupBy("feed").applyInPandas(_departures(rules, facets, c), "batch_id string, column_name string, share double")
        out = part if out is None else out.unionByName(part)
    return out
