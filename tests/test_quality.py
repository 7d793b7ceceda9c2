import math
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterline.operators.quality import REJECTION_REASONS, classify, classify_rejection_reason, rejected_by_reason, valid_rows

T = datetime(2026, 1, 1)
GOOD = ("o", "C", "m", "2026Q2", 1.0, T)
CASES = [
    (GOOD, None),
    (("  ", None, "", "bad", math.nan, None), "missing_observation_id"),
    ((None, "C", "m", "2026Q2", 1.0, T), "missing_observation_id"),
    (("o", " ", "m", "2026Q2", 1.0, T), "missing_company_id"),
    (("o", "C", "", "2026Q2", 1.0, T), "missing_metric_id"),
    (("o", "C", "m", "", 1.0, T), "missing_period_id"),
    (("o", "C", "m", "2026-T2", 1.0, T), "invalid_period_id"),
    (("o", "C", "m", "2026Q5", 1.0, T), "invalid_period_id"),
    (("o", "C", "m", " 2026Q2 ", 1.0, T), None),
    (("o", "C", "m", "2026Q2\n", 1.0, T), None),
    (("o", "C", "m", "2026Q2", math.nan, T), "invalid_value"),
    (("o", "C", "m", "2026Q2", math.inf, T), "invalid_value"),
    (("o", "C", "m", "2026Q2", -math.inf, T), "invalid_value"),
    (("o", "C", "m", "2026Q2", None, T), "invalid_value"),
    (("o", "C", "m", "2026Q2", 1.0, None), "invalid_ingested_at"),
]


@pytest.mark.parametrize(("row", "reason"), CASES)
def test_first_failure_names_the_rejection(bronze, row, reason):
    assert classify(bronze([row])).first()["rejection_reason"] == reason


@pytest.mark.parametrize(("row", "reason"), CASES)
def test_python_twin(row, reason):
    names = ("observation_id", "company_id", "metric_id", "period_id", "value", "ingested_at")
    assert classify_rejection_reason(dict(zip(names, row, strict=True))) == reason


def test_kept_differences_of_the_twin(bronze):
    tab = ("\t", "C", "m", "2026Q2", 1.0, T)
    wide = ("o", "C", "m", "２０２６Q2", 1.0, T)
    assert [r["rejection_reason"] for r in classify(bronze([tab, wide])).collect()] == [None, "invalid_period_id"]
    names = ("observation_id", "company_id", "metric_id", "period_id", "value", "ingested_at")
    twin = lambda r: classify_rejection_reason(dict(zip(names, r, strict=True)))
    assert [twin(tab), twin(wide)] == ["missing_observation_id", None]
    assert twin(("o", "C", "m", "2026Q2", "1.0", T)) == "invalid_value"
    assert twin(("o", "C", "m", "2026Q2", True, "no time")) is None


def test_by_reason_lists_what_occurs(bronze):
    df = bronze([row for row, _ in CASES])
    found = {r["rejection_reason"]: r["rejected_rows"] for r in rejected_by_reason(df).collect()}
    assert sum(found.values()) == sum(1 for _, r in CASES if r) and set(found) <= set(REJECTION_REASONS)
    assert valid_rows(df).count() == sum(1 for _, r in CASES if not r)
    assert rejected_by_reason(bronze([GOOD])).count() == 0


def test_text_columns_never_raise(spark):
    df = spark.createDataFrame([("o", "C", "m", "2026Q2", "abc", "nope"), ("o", "C", "m", "2026Q2", "1.5", "nope")], "observation_id string, company_id string, metric_id string, period_id string, value string, ingested_at string")
    assert [r["rejection_reason"] for r in classify(df).collect()] == ["invalid_value", "invalid_ingested_at"]


TEXT = st.one_of(st.none(), st.sampled_from(["", " ", "x", " y "]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXT, TEXT, TEXT, st.sampled_from([None, "", "2026Q1", "2026", " 2026Q4"]), st.one_of(st.none(), st.floats()), st.sampled_from([None, T])), min_size=1, max_size=20))
def test_twin_agrees_on_plain_rows(bronze, rows):
    names = ("observation_id", "company_id", "metric_id", "period_id", "value", "ingested_at")
    ours = [r["rejection_reason"] for r in classify(bronze(rows)).collect()]
    assert ours == [classify_rejection_reason(dict(zip(names, r, strict=True))) for r in rows]
