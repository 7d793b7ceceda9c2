import math
import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest

from quarterline.operators.profile import ValueCounts, column_profiles, counted, departing_columns, distinct_share, evenness
from quarterline.sources import files


def profiles(counts):
    return {(r["batch_id"], r["column_name"]): r for r in column_profiles(counts).collect()}


def test_exact_metrics(bronze):
    t = datetime(2023, 1, 1)
    rows = [("o", None, None, p, v, s) for p, v, s in [("2023Q1", 1.0, t), ("2023Q1", -0.0, t), (None, 0.0, None), ("x", math.nan, datetime(1970, 1, 1)), (" 2023Q1", None, t), ("", math.inf, t)]]
    found = profiles(counted(bronze(rows)))
    period, value, stamp = (found["f000-001", c] for c in ("period_id", "value", "ingested_at"))
    assert (period["row_count"], period["null_count"], period["distinct_count"], period["violation_count"]) == (6, 1, 4, 2)
    assert (value["null_count"], value["nan_count"], value["distinct_count"], value["violation_count"], value["low"], value["high"]) == (1, 1, 4, 1, 0.0, 1.0)
    assert (stamp["null_count"], stamp["distinct_count"], stamp["violation_count"]) == (1, 2, 1)
    n = Counter(r[3] for r in rows)
    assert period["entropy"] == round(-sum(k / 6 * math.log2(k / 6) for k in n.values()), 6)


def test_signed_deltas(spark, bronze):
    a = bronze([("o", None, None, "2023Q1", 1.0, None, "f-001"), ("o", None, None, "2023Q1", 1.0, None, "f-002")])
    b = bronze([("o", None, None, "2023Q2", 2.0, None, "f-001")])
    counts = ValueCounts(spark, files.scratch(spark, "counts"))
    assert counts.read("value").count() == 0
    counts.apply(a)
    counts.apply(b)
    both = profiles(counts)["f-001", "value"]
    assert (both["row_count"], both["distinct_count"]) == (2, 2)
    counts.apply(b, -1)
    counts.compact()
    assert profiles(counts)["f-001", "value"]["distinct_count"] == 1
    counts.apply(a.where("batch_id = 'f-001'"), -1)
    assert {k[0] for k in profiles(counts)} == {"f-002"}


def test_loads_are_deltas_of_their_own(spark, bronze):
    rows = bronze([("o", None, None, "2023Q1", float(k % 3), None, load) for k, load in enumerate(["f-002", "f-010", None, "odd", "f-002", "g-001"])])
    counts = ValueCounts(spark, files.scratch(spark, "counts"))
    counts.apply_loads(rows)
    once = sorted(map(tuple, column_profiles(counts).collect()), key=str)
    assert [c["load"] for c in counts._commits()] == [None, "odd", "g-001", "f-002", "f-010"]
    counts.withdraw("f-002")
    counts.withdraw(None)
    counts.withdraw(None)  # nothing is left to take back
    assert {r["batch_id"] for r in column_profiles(counts).collect()} == {"odd", "g-001", "f-010"}
    counts.compact()
    counts.withdraw("odd")
    assert {r["batch_id"] for r in column_profiles(counts).collect()} == {"g-001", "f-010"}
    for load in ("f-002", None, "odd"):
        counts.apply_loads(rows.where("batch_id = 'f-002'" if load == "f-002" else "batch_id IS NULL" if load is None else "batch_id = 'odd'"))
    assert sorted(map(tuple, column_profiles(counts).collect()), key=str) == once
    # Another reader of the same folder, after a fold, sees the same.
    counts.compact()
    assert sorted(map(tuple, column_profiles(ValueCounts(spark, counts.root)).collect()), key=str) == once


def test_racing_writers_lose_nothing(spark, bronze):
    root = files.scratch(spark, "counts")
    one, other = ValueCounts(spark, root), ValueCounts(spark, root)
    a, b = (bronze([("o", None, None, "2023Q1", 1.0, None, load)] * 2) for load in ("f-001", "f-002"))
    one.apply_loads(a)
    upto = len(one._commits())
    other.apply_loads(b)  # between what a fold has read and its commit
    base = f"{root}/base-late"
    for c in one.columns:
        one._read(c, upto).write.parquet(f"{base}/{c}")
    one._commit(base=base, upto=upto)
    assert {(r["batch_id"], r["row_count"]) for r in column_profiles(other).collect()} == {("f-001", 2), ("f-002", 2)}


def test_evenness():
    one, eight = np.array([1]), np.array([8])
    assert evenness(one, eight) == evenness(eight, one) == evenness(eight, eight) == 1.0
    shares = np.array([5, 1, 1, 1]) / 8
    assert math.isclose(evenness(np.array([5, 1]), np.array([1, 3])), -(shares * np.log2(shares)).sum() / 2)


def feed(loads=8, per=400, spoil=None):
    rng, rows = random.Random(1), []
    for load in range(1, loads + 1):
        begin = datetime(2015, 1, 1) + timedelta(days=182.6 * load)
        for _ in range(per):
            stamp = begin + timedelta(seconds=rng.random() * 180 * 86400)
            quarter = (stamp.year * 4 + (stamp.month - 1) // 3) - 1
            r = ["o", "C", "m", f"{quarter // 4}Q{quarter % 4 + 1}", round(rng.lognormvariate(6, 2), 2), stamp, f"f000-{load:03d}"]
            if spoil:
                spoil(load, rng, r)
            rows.append(tuple(r))
    return rows


def departing(df):
    return sorted((r["batch_id"], r["column_name"]) for r in departing_columns(counted(df)).collect())


def test_nothing_departs_from_an_even_feed(bronze):
    assert departing(bronze(feed())) == []


def test_kinds_of_departure(bronze):
    def spoil(load, rng, r):
        if rng.random() < 0.35:
            if load == 2:
                r[3] = r[3].replace("Q", "-T")
            if load == 3:
                r[4] = math.nan
            if load == 4:
                r[5] = datetime(2099, 12, 31)
            if load == 5:
                r[4] = round(r[4] * 1000, 2)
            if load == 6:
                r[3] = None
            if load == 7:
                r[5] = r[5].replace(hour=0, minute=0, second=0, microsecond=0)

    assert departing(bronze(feed(spoil=spoil))) == [
        ("f000-002", "period_id"), ("f000-003", "value"), ("f000-004", "ingested_at"), ("f000-005", "value"), ("f000-006", "period_id"), ("f000-007", "ingested_at"),
    ]


def test_what_is_usual_for_a_feed_and_odd_names(bronze):
    def spoil(load, rng, r):
        if rng.random() < 0.3:
            r[4] = None
        if load == 8 and rng.random() < 0.9:
            r[6] = rng.choice([None, "nameless", "g-001"])

    assert departing(bronze(feed(spoil=spoil))) == []
    assert departing(bronze([])) == [] and column_profiles(counted(bronze([]))).count() == 0


@pytest.mark.parametrize("column, many", [(4, 60), (5, 60)])
def test_loss_of_variety_below_the_dominating_share(bronze, column, many):
    pool = [r[column] for r in feed() if r[6] == "f000-005"][:many]

    def spoil(load, rng, r):
        if load == 5:
            r[column] = rng.choice(pool)

    assert departing(bronze(feed(spoil=spoil))) == [("f000-005", "value" if column == 4 else "ingested_at")]


@pytest.mark.parametrize("per", [400, 600])
def test_dominating_values_are_judged_alike_at_any_size(bronze, per):
    turn = iter(range(10**6))

    def spoil(load, rng, r):
        r[4] = float(100 + next(turn) % (15 if load == 5 else 40))

    assert departing(bronze(feed(per=per, spoil=spoil))) == [("f000-005", "value")]


def test_the_number_of_rows_is_no_loss_of_variety(bronze):
    rng = random.Random(3)
    rows = feed(per=200, spoil=lambda load, rng, r: r.__setitem__(4, float(rng.randrange(100, 400))))
    more = [(*r[:4], float(rng.randrange(100, 400)), *r[5:]) for r in feed(per=4000) if r[6] == "f000-004"]
    assert departing(bronze(rows + more)) == []


def test_distinct_share_is_the_mean_over_all_draws():
    from itertools import combinations

    load = [1, 1, 1, 2, 2, 3, 4]
    for rows in (2, 4, 7):
        mean = np.mean([len(set(c)) for c in combinations(load, rows)])
        assert math.isclose(distinct_share(np.array([1, 2, 3]), np.array([2, 1, 1]), rows), (mean - 1) / (rows - 1))
