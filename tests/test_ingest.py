from datetime import UTC, datetime

import pytest

from quarterline.sources.rows import observations, read_json_array

FULL = {"observation_id": "o1", "company_id": "C", "metric_id": "m", "period_id": "2025Q4", "value": 1.5, "ingested_at": "2026-01-01T00:00:00+00:00"}


def test_no_rows(spark):
    with pytest.raises(ValueError, match="at least one"):
        observations(spark, [])


def test_missing_columns_are_named_in_order(spark):
    with pytest.raises(ValueError, match="Missing required columns: company_id, value"):
        observations(spark, [{k: v for k, v in FULL.items() if k not in ("value", "company_id")}])


def test_missing_stamp_column_defaults_to_now(spark):
    row = observations(spark, [{k: v for k, v in FULL.items() if k != "ingested_at"}]).first()
    assert abs((row["ingested_at"] - datetime.now(UTC).replace(tzinfo=None)).total_seconds()) < 3600


def test_a_stamp_missing_in_one_row_is_null(spark):
    rows = observations(spark, [FULL, {k: v for k, v in FULL.items() if k != "ingested_at"}]).collect()
    assert [r["ingested_at"] is None for r in rows] == [False, True]


def test_mixed_and_malformed_values(spark):
    values = [1, 2.5, "abc", "7.25", None, True, float("nan")]
    rows = observations(spark, [FULL | {"value": v, "extra": 1} for v in values]).collect()
    assert [r["value"] for r in rows[:6]] == [1.0, 2.5, None, 7.25, None, None]
    assert rows[6]["value"] != rows[6]["value"]


def test_malformed_stamp_is_null_and_datetimes_pass(spark):
    rows = observations(spark, [FULL | {"ingested_at": "nope"}, FULL | {"ingested_at": datetime(2026, 5, 1)}, FULL]).collect()
    assert [r["ingested_at"] for r in rows] == [None, datetime(2026, 5, 1), datetime(2026, 1, 1)]


def test_all_null_column_and_numeric_id(spark):
    row = observations(spark, [FULL | {"company_id": None, "metric_id": 7}]).first()
    assert (row["company_id"], row["metric_id"]) == (None, "7")


def test_json_must_be_an_array(tmp_path):
    (tmp_path / "a.json").write_text('[{"a": "ä"}]', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"a": 1}')
    assert read_json_array(str(tmp_path / "a.json")) == [{"a": "ä"}]
    with pytest.raises(ValueError, match="JSON array"):
        read_json_array(str(tmp_path / "b.json"))
