import json
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterline.operators.lateness import PeriodStore, late_rows, period_aggregates
from quarterline.sources import files


def end_of(period):
    year, quarter = int(period[:4]), int(period[5])
    return datetime(year + quarter // 4, quarter % 4 * 3 + 1, 1)


def found(df):
    return sorted((r["row_id"], r["kind"]) for r in late_rows(df).collect())


def test_limits_are_exact(bronze):
    end, tick = end_of("2023Q4"), timedelta(microseconds=1)
    stamps = [end - tick, end + timedelta(days=45), end + timedelta(days=45) + tick, end + timedelta(days=200), end + timedelta(days=200) + tick]
    df = bronze([(str(k), None, None, "2023Q4", 1.0, s) for k, s in enumerate(stamps)])
    assert found(df) == [(3, "late"), (4, "late"), (5, "too_late")]


def test_who_takes_part(bronze):
    late = datetime(2024, 3, 1)
    rows = [(None, "C", "m", p, None, s) for p, s in [
        (" 2023Q4\t", late), ("2023q4", late), ("2014Q4", late), ("2025Q1", datetime(2026, 12, 31)), ("２０２３Q4", late), (None, late),
        ("2023Q4", None), ("2023Q4", datetime(2027, 1, 1)), ("2015Q1", datetime(2014, 12, 31, 23, 59, 59)), ("2024Q4", datetime(2026, 12, 31)),
    ]]
    assert found(bronze(rows)) == [(1, "late"), (10, "too_late")]


def test_overtaken_needs_a_series_and_a_strictly_earlier_stamp(bronze):
    a, b = datetime(2023, 5, 1), datetime(2023, 5, 2)
    rows = [
        ("1", "C", "m", "2022Q4", 1.0, b), ("2", "C", "m", "2023Q1", 1.0, a),  # 1 is overtaken
        ("3", "D", "m", "2022Q4", 1.0, a), ("4", "D", "m", "2023Q1", 1.0, a),  # a tie isn't
        ("5", " ", "m", "2022Q4", 1.0, b), ("6", " ", "m", "2023Q1", 1.0, a),  # no series
        ("7", " C", "m ", "2022Q4", 1.0, b),  # the same series
        ("8", "c", "m", "2022Q4", 1.0, b),  # letter case counts
    ]
    assert [i for i, kind in found(bronze(rows)) if kind == "overtaken"] == [1, 7]


def test_empty_and_clashing_columns(bronze):
    assert found(bronze([])) == [] and period_aggregates(bronze([])).count() == 0
    df = bronze([("1", "C", "m", "2022Q4", 1.0, datetime(2023, 5, 2))])
    for name in ("company", "metric", "quarter", "arrived", "lateness", "first", "kind"):
        df = df.withColumn(name, df["value"])
    assert found(df) == [(1, "late")]


PERIODS = ["2022Q4", "2023Q1", "2023Q2", "2023Q3", "bad", None]
STAMPS = st.one_of(st.none(), st.integers(0, 700).map(lambda d: datetime(2023, 1, 1) + timedelta(days=d)))
ROWS = st.lists(st.tuples(st.just("o"), st.sampled_from(["C", "D", "", None]), st.sampled_from(["m", None]), st.sampled_from(PERIODS), st.sampled_from([1.0, 2.5, None, float("nan"), float("inf")]), STAMPS), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_against_brute_force(bronze, rows):
    ok = [(k, r) for k, r in enumerate(rows, 1) if r[3] in PERIODS[:4] and r[5]]
    expected = []
    for k, r in ok:
        lateness = r[5] - end_of(r[3])
        if lateness > timedelta(days=200):
            expected.append((k, "too_late"))
        elif lateness > timedelta(days=45):
            expected.append((k, "late"))
        if r[1] and r[2] and any(q[1:3] == r[1:3] and q[3] > r[3] and q[5] < r[5] for _, q in ok):
            expected.append((k, "overtaken"))
    assert found(bronze(rows)) == sorted(expected)


def test_aggregates_are_corrected_until_the_cut_off(bronze):
    end = end_of("2023Q1")
    rows = [
        ("1", "C", "m", "2023Q1", 1.25, end + timedelta(days=10), "f000-001"), ("2", "C", "m", "2023Q2", 7.0, end + timedelta(days=100), "f000-001"),
        ("3", "C", "m", "2023Q1", 2.0, end + timedelta(days=60), "f001-002"), ("4", "C", "m", "2023Q1", 9.0, end + timedelta(days=300), "f000-003"),
        ("5", "C", "m", "2023Q1", float("nan"), end, "f000-003"), ("6", "C", "m", "2023Q1", 4.0, end, "f000-003"), ("7", "C", "m", "2023Q1", 4.0, end, "nameless"),
    ]
    out = {(r["load_number"], r["period_id"]): tuple(r)[2:] for r in period_aggregates(bronze(rows)).collect()}
    assert out == {
        (1, "2023Q1"): (1, 1.25, 0, 1), (1, "2023Q2"): (1, 7.0, 0, 0), (2, "2023Q1"): (2, 3.25, 1, 1), (2, "2023Q2"): (1, 7.0, 0, 0),
        (3, "2023Q1"): (3, 7.25, 1, 1), (3, "2023Q2"): (1, 7.0, 0, 0),
    }


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(0, 39), st.integers(0, 245), st.integers(-9, 9)), max_size=40))
def test_totals_with_eviction_against_lists(rows):
    """Rows are (load, quarter, days after the quarter, value); later loads mostly arrive later, but need not."""
    import pandas as pd

    from quarterline.operators import lateness as module

    taken = [(load, q, module._ENDS[q] + d, v, d > 45) for load, q, d, v in rows if d <= 200]
    deltas = pd.DataFrame(
        [(load, q, 0, 1, str(v << 53), int(late), day) for load, q, day, v, late in taken],
        columns=["load_number", "quarter", "scale", "n", "total", "late", "high"],
    )
    deltas = deltas.astype({"load_number": int, "quarter": int, "scale": int, "n": int, "late": int, "high": int})
    totals, found = module.Totals(), set()
    for load, mine in deltas.groupby("load_number", sort=True):
        totals = module.Totals.resumed(json.loads(json.dumps(totals.state())))  # as if every load were another process
        found |= set(totals.add(load, mine))
    expected = set()
    for load in {t[0] for t in taken}:
        seen = [t for t in taken if t[0] <= load]
        for q in {t[1] for t in seen}:
            mine = [t for t in seen if t[1] == q]
            expected.add((load, q, len(mine), float(sum(t[3] for t in mine)), sum(t[4] for t in mine), sum(t[1] > q for t in seen)))
    assert found == expected


def sums(df):
    return [r["value_sum"] for r in period_aggregates(df).collect()]


def test_sums_are_exact_for_any_finite_values(bronze):
    import math

    def at_end(values):
        return bronze([(str(k), "C", "m", "2023Q1", v, end_of("2023Q1")) for k, v in enumerate(values)])

    for values in ([0.00004] * 1000, [1e27, 1.0, -1e27, 0.1], [5e-324, 1e-310, -1e-300], [1.7e308, -1.6e308, 3.25], [2.0**k for k in range(-40, 41)], [0.1] * 10, [-0.0]):
        assert sums(at_end(values)) == [math.fsum(values)]
    assert sums(at_end([1.7e308, 1.7e308])) == [math.inf]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=300))
def test_sums_against_another_exact_sum(bronze, values):
    import math

    assert sums(bronze([(str(k), "C", "m", "2023Q1", v, end_of("2023Q1")) for k, v in enumerate(values)])) == [math.fsum(values)]


def test_totals_are_kept_between_loads(spark, bronze):
    end = end_of("2023Q1")
    rows = [
        ("1", "C", "m", "2023Q1", 1.25, end + timedelta(days=10), "f-001"), ("2", "C", "m", "2023Q1", 2.0, end + timedelta(days=60), "g-002"),
        ("3", "C", "m", "2024Q1", 5.0, end_of("2024Q1"), "f-003"), ("4", "C", "m", "2023Q1", 4.0, end, "f-004"), ("5", "C", "m", "2023Q1", 9.0, end + timedelta(days=201), "f-004"),
    ]
    df, at = bronze(rows), files.scratch(spark, "periods")
    once = sorted(map(tuple, period_aggregates(df).collect()))
    for part in ("f-001", "g-002", "f-003"):
        PeriodStore(spark, at).add(df.where(f"batch_id = '{part}'"))
    assert PeriodStore(spark, at)._commits()[-1]["state"]["live"] == [[36, 1, str(5 << 53 + 8 * 135)]]  # 2023Q1 was evicted
    resumed = period_aggregates(df.where("batch_id = 'f-004'"), PeriodStore(spark, at))
    assert sorted(map(tuple, resumed.collect())) == once and (4, "2023Q1", 3, 7.25, 1, 1) in once
    with pytest.raises(ValueError, match="closed"):
        PeriodStore(spark, at).add(df.where("batch_id = 'g-002'"))
