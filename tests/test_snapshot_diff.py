from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterline.operators.snapshot_diff import snapshot_changes

SCHEMA = "snapshot_id int, observation_id string, value double, period_id string, ingested_at timestamp_ntz"
NAN = float("nan")


def found(spark, rows):
    return sorted((r["snapshot_id"], r["observation_id"], r["change_kind"]) for r in snapshot_changes(spark.createDataFrame(rows, SCHEMA)).collect())


def test_kinds_over_a_gap_in_the_numbers(spark):
    rows = [(1, "a", 1.0, "p", None), (1, "b", 1.0, "p", None), (4, "a", 1.0, "q", None), (4, "c", 1.0, "p", None), (9, "c", 1.0, "p", datetime(2024, 1, 1))]
    assert found(spark, rows) == [(4, "a", "changed"), (4, "b", "removed"), (4, "c", "added"), (9, "a", "removed")]


@pytest.mark.parametrize(
    ("before", "after", "changed"),
    [(None, None, 0), (NAN, NAN, 0), (-0.0, 0.0, 0), (None, NAN, 1), (None, 0.0, 1), (1.0, 1.0 + 2**-52, 1), (1e300, 1e300, 0), (float("inf"), float("-inf"), 1), (5e-324, 0.0, 1)],
)
def test_values(spark, before, after, changed):
    assert len(found(spark, [(1, "a", before, "p", None), (2, "a", after, "p", None)])) == changed


def test_ids_stamps_and_repeats(spark):
    t = [datetime(2024, 1, k) for k in (1, 2, 3)]
    rows = [
        (1, " a ", 1.0, "p", t[0]), (2, "a\xa0", 1.0, "p", t[1]),  # padding and stamps alone are no change
        (1, "b", 1.0, "p", t[1]), (1, "b", 5.0, "p", t[0]), (1, "b", 7.0, "p", None), (2, "b", 1.0, "p", t[2]),  # the latest counts, null comes last
        (1, None, 1.0, "p", t[0]), (1, " ", 1.0, "p", t[0]), (None, "x", 1.0, "p", t[0]), (2, "A", 1.0, "p", t[0]), (2, "A", 1.0, "p", t[0]),
    ]
    assert found(spark, rows) == [(2, "A", "added")]


def test_a_tie_of_stamps_has_one_result(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, "a", 1.0, "p", t), (2, "a", 1.0, "p", t), (2, "a", 2.0, "p", t)]
    assert found(spark, rows) == found(spark, rows[::-1])


def test_empty_single_and_clashing_columns(spark):
    assert found(spark, []) == [] and found(spark, [(3, "a", 1.0, "p", None)]) == []
    df = spark.createDataFrame([(1, "a", 1.0, "p", None), (2, "b", 1.0, "p", None)], SCHEMA)
    for name in ("at", "id", "hash", "next", "before", "after", "stamp"):
        df = df.withColumn(name, df["value"])
    assert snapshot_changes(df).count() == 2


VALUE = st.sampled_from([None, NAN, 0.0, 1.0, 1.5])
ROWS = st.lists(st.tuples(st.sampled_from([1, 2, 5]), st.sampled_from(["a", " a", "b", "c", None]), VALUE, st.sampled_from(["p", "q", None]), st.integers(1, 28).map(lambda d: datetime(2024, 1, d))), max_size=25, unique_by=lambda r: (r[0], (r[1] or "").strip(), r[4]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_against_dictionaries(spark, rows):
    states = {}
    for s, i, v, p, t in sorted(rows, key=lambda r: r[4]):
        states.setdefault(s, {})
        if i and i.strip():
            states[s][i.strip()] = (repr(v), p)
    expected, order = [], sorted(states)
    for a, b in zip(order, order[1:], strict=False):
        for i in states[a].keys() | states[b].keys():
            x, y = states[a].get(i), states[b].get(i)
            if x != y:
                expected.append((b, i, "added" if x is None else "removed" if y is None else "changed"))
    assert found(spark, rows) == sorted(expected)


def test_each_snapshot_is_shuffled_once_for_the_choice(spark):
    df = snapshot_changes(spark.createDataFrame([(1, "a", 1.0, "p", None), (2, "b", 1.0, "p", None)], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
