"""Documents into numbered containers of every kind.

Only the histogram of lengths, bounded by the capacities, reaches the driver; the plan made of it comes back as
intervals of ranks per length, and every item finds its container from its length and its rank among items of that
length. Ranks are counted in salted groups, so a length that very many items share is never in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.patterns import pack
from quarterline.llm.tokens import VOCABULARIES, token_counts
from quarterline.sources import files

GROUPS = 1024
#: Bounds of what the driver gathers and broadcasts, checked: capacities altogether and intervals of the plan.
MOST_CAPACITY, MOST_INTERVALS = 4_000_000, 4_000_000


def _kinds(containers: DataFrame) -> list[tuple[str, int]]:
    """Kinds and capacities, few by nature and checked."""
    kinds = (
        containers.where("container_kind IS NOT NULL AND capacity_tokens >= 1")
        .groupBy("container_kind")
        .agg(F.max("capacity_tokens").cast("long").alias("capacity"))
    )
    listed = kinds.agg(F.collect_list(F.struct("container_kind", "capacity")).alias("kinds"), F.sum("capacity").alias("all")).first()
    if (listed["all"] or 0) > MOST_CAPACITY:
        raise ValueError(f"capacities add up to more than {MOST_CAPACITY}")
    return [(r["container_kind"], r["capacity"]) for r in listed["kinds"]]


def _of_every_kind(sizes: DataFrame, kinds: list[tuple[str, int]]) -> DataFrame:
    """kind, capacity, doc_id, n_tokens: each document that has tokens meets every kind by definition."""
    every = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(c).cast("long").alias("capacity")) for k, c in kinds))
    every = every.cast("array<struct<kind:string,capacity:bigint>>")
    return sizes.where("n_tokens > 0").select(F.inline(every), "doc_id", "n_tokens")


def pieces(sizes: DataFrame, containers: DataFrame) -> DataFrame:
    """kind, capacity, doc_id, start, length: documents that fit are one piece, longer ones full pieces and a rest.

    A document of n tokens has ceil(n / capacity) pieces; one of no tokens has none. Kinds without a capacity of at
    least 1 are left out; of a kind listed twice the larger capacity counts.
    """
    n, capacity = F.col("n_tokens"), F.col("capacity")
    each = _of_every_kind(sizes, _kinds(containers))
    starts = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / capacity)), lambda k: k * capacity)
    cut = each.select("kind", "capacity", "doc_id", "n_tokens", F.explode(starts).alias("start"))
    return cut.select("kind", "capacity", "doc_id", "start", F.least(capacity, n - F.col("start")).alias("length"))


def _plan(histogram: pd.DataFrame) -> pd.DataFrame:
    """Per kind and length, intervals of ranks [first, end) that go to containers from `container` on, `per` to each, and
    whether the pattern was fitted."""
    out = []
    for kind, rows in histogram.groupby("kind", sort=True):
        capacity = int(rows["capacity"].iloc[0])
        counts = np.zeros(capacity + 1, np.int64)
        counts[rows["length"].to_numpy()] = rows["n"].to_numpy()
        next_rank, container = np.zeros(capacity + 1, np.int64), 1
        for p in pack(counts, capacity):
            for length, per in p.lengths:
                out.append((kind, length, int(next_rank[length]), container, per, p.fitted, p.repeats))
                next_rank[length] += per * p.repeats
            container += p.repeats
    return pd.DataFrame(out, columns=["kind", "length", "first", "container", "per", "fitted", "repeats"])


def containers_of(documents: DataFrame, containers: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """container_kind, container_no (from 1 per kind), doc_id, start_token, end_token (exclusive).

    Every token of every document is in exactly one container of each kind, no container exceeds its capacity, and a
    document is split only where it exceeds it. Documents without tokens (null, empty) appear nowhere.
    """
    return _packed(documents, containers, vocabularies)[0]


def _packed(documents: DataFrame, containers: DataFrame, vocabularies: str) -> tuple[DataFrame, DataFrame, pd.DataFrame]:
    """The packing, the documents' sizes that it was made for, and its plan."""
    spark = documents.sparkSession
    counted_tokens = files.kept(token_counts(documents, vocabularies), "sizes")
    items = pieces(counted_tokens, containers)
    counted = items.groupBy("kind", "capacity", "length").agg(F.count("*").alias("n")).toPandas()
    plan = _plan(counted)
    if len(plan) > MOST_INTERVALS:
        raise ValueError(f"the plan has more than {MOST_INTERVALS} intervals")
    group = F.pmod(F.xxhash64("doc_id", "start"), F.lit(GROUPS)).cast("int")
    grouped = items.withColumn("group", group)
    sizes = grouped.groupBy("kind", "length", "group").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("kind", "length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("kind", "length", "group", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("kind", "length", "group").orderBy("doc_id", "start")) - 1
    ranked = grouped.withColumn("within", within).join(offsets, ["kind", "length", "group"]).select(
        "kind", "doc_id", "start", "length", (F.col("offset") + F.col("within")).alias("rank")
    )
    shared = spark.sparkContext.broadcast({k: {c: g[c].to_numpy() for c in ("length", "first", "container", "per")} for k, g in _by_place(plan)})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for kind, rows in batch.groupby("kind", sort=False):
                p = shared.value[kind]
                length, rank = rows["length"].to_numpy(), rows["rank"].to_numpy()
                # Intervals lie in order of (length, first): the last one that begins at or before the item's place.
                keys = p["length"].astype(np.int64) << 40 | p["first"]
                at = np.searchsorted(keys, length.astype(np.int64) << 40 | rank, side="right") - 1
                number = p["container"][at] + (rank - p["first"][at]) // p["per"][at]
                yield pd.DataFrame({
                    "container_kind": kind, "container_no": number, "doc_id": rows["doc_id"].to_numpy(),
                    "start_token": rows["start"].to_numpy(), "end_token": (rows["start"] + rows["length"]).to_numpy(),
                })

    packed = ranked.mapInPandas(place, "container_kind string, container_no long, doc_id long, start_token long, end_token long")
    return packed, counted_tokens, plan


def _by_place(plan: pd.DataFrame):
    return plan.sort_values(["kind", "length", "first"]).groupby("kind", sort=False)


def fill_of(documents: DataFrame, containers: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """container_kind, capacity_tokens, containers, least (containers that so many tokens need at least), tokens, fill
    (share of the room used), fitted (share of the containers that come from fitted patterns), both to six decimals."""
    packed, _, plan = _packed(documents, containers, vocabularies)
    used = packed.groupBy("container_kind").agg(
        F.count_distinct("container_no").alias("containers"), F.sum(F.col("end_token") - F.col("start_token")).alias("tokens")
    )
    # One row per kind.
    by_fit = plan.drop_duplicates(["kind", "container"]).assign(mine=lambda p: p["repeats"] * p["fitted"]).groupby("kind")["mine"].sum()
    shares = documents.sparkSession.createDataFrame([(k, int(n)) for k, n in by_fit.items()], "container_kind string, from_fit long")
    kinds = containers.groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    return used.join(kinds, "container_kind").join(shares, "container_kind").select(
        "container_kind", "capacity_tokens", "containers", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least"), "tokens",
        F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("fill"),
        F.round(F.col("from_fit") / F.col("containers"), 6).alias("fitted"),
    )


def conditions_of(documents: DataFrame, containers: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """container_kind, capacity_tokens, and how many containers are overfull, how many documents that fit were split, and
    of how many the pieces don't hold every token once: all zero if the packing is right."""
    packed, sizes, _ = _packed(documents, containers, vocabularies)
    kinds = containers.where("container_kind IS NOT NULL AND capacity_tokens >= 1").groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    room = packed.groupBy("container_kind", "container_no").agg(F.sum(F.col("end_token") - F.col("start_token")).alias("used"))
    overfull = room.join(kinds, "container_kind").where("used > capacity_tokens").groupBy("container_kind").agg(F.count("*").alias("overfull"))
    asked = _of_every_kind(sizes, _kinds(containers)).withColumnsRenamed({"kind": "container_kind", "capacity": "room"})
    held = packed.groupBy("container_kind", "doc_id").agg(
        F.count("*").alias("pieces"), F.sum(F.col("end_token") - F.col("start_token")).alias("held"),
        F.min("start_token").alias("low"), F.max("end_token").alias("high"), F.count_distinct("start_token").alias("starts"),
    )
    whole = F.expr("low <=> 0 AND high <=> n_tokens AND held <=> n_tokens AND starts <=> pieces")
    per_document = asked.join(held, ["container_kind", "doc_id"], "left").groupBy("container_kind").agg(
        F.count_if(F.expr("n_tokens <= room AND pieces > 1")).alias("split"), F.count_if(~whole).alias("misplaced")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = kinds.join(overfull, "container_kind", "left").join(per_document, "container_kind", "left")
    return out.select("container_kind", "capacity_tokens", zero("overfull"), zero("split"), zero("misplaced"))
