import json

import pytest
from pyspark.sql import functions as F

from quarterline import cli
from quarterline.functions.display import display_number, display_percentage, display_value, shown_number, shown_percentage, shown_value
from quarterline.plans import serving


def config(monkeypatch, catalog="spark_catalog", schema="default", table="mart"):
    for name, value in zip(serving.SETTINGS.values(), (catalog, schema, table), strict=True):
        monkeypatch.setenv(name, value)
    return serving.GoldConfig.from_environment()


def test_settings(monkeypatch):
    assert config(monkeypatch).qualified_table == "`spark_catalog`.`default`.`mart`"
    with pytest.raises(ValueError, match="Invalid trusted Gold identifier for gold_table"):
        config(monkeypatch, table="gold; DROP TABLE other")
    with pytest.raises(ValueError, match="Missing Gold configuration: catalog, schema"):
        config(monkeypatch, catalog="", schema="")


def test_questions_to_a_mart_built_by_the_cli(spark, names, monkeypatch, tmp_path, capsys):
    rows = [
        {"observation_id": f"{c}-{m}-{p}", "company_id": c, "metric_id": m, "period_id": p, "value": v, "ingested_at": "2026-01-01T00:00:00+00:00"}
        for c, m, p, v in [("B", "revenue", "2026Q2", 120.0), ("B", "revenue", "2025Q4", 100.0), ("B", "margin", "2026Q2", 20.0), ("A'x", "margin", "2026Q2", 1.0)]
    ]
    (tmp_path / "rows.json").write_text(json.dumps(rows))
    common = ["--catalog", "x", "--schema", "y"]
    objects = [a for layer, name in zip(("bronze", "silver", "gold"), names, strict=True) for a in (f"--{layer}-object", name)]
    cli.run_all([*common, *objects, "--input-mode", "fixture", "--input-fixture-path", str(tmp_path / "rows.json")])
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [x["layer"] for x in lines] == ["bronze", "silver", "gold"] and {x["status"] for x in lines} == {"success"}
    assert lines[2]["metrics"]["inserted_rows"] == 3
    c = config(monkeypatch, table=names[2])
    assert serving.fetch_companies(spark, c) == ["A'x", "B"]
    assert serving.fetch_company_metrics(spark, c, "B") == ["margin", "revenue"]
    assert serving.fetch_company_metrics(spark, c, "B' OR '1'='1") == []
    found = serving.fetch_comparison(spark, c, "B", "revenue")
    assert len(found) == 1 and set(found[0]) == set(serving.COMPARISON_COLUMNS)
    shown = serving.formatted_rows(serving.fetch_comparison(spark, c, "B"))
    assert [r["change_pct"] for r in shown] == ["N/A", "+20.0%"] and shown[1]["current_value"] == "120.00"


def test_answers_are_kept_for_a_while(monkeypatch):
    asked, now = [], [0.0]
    for name in ("fetch_companies", "fetch_company_metrics", "fetch_comparison"):
        monkeypatch.setattr(serving, name, lambda *a: asked.append(a[2:]) or [len(asked)])
    mart = serving.CachedMart(None, None, clock=lambda: now[0])
    assert mart.companies() == mart.companies() == [1] and mart.metrics("B") == [2] and mart.metrics("A") == [3]
    assert mart.comparison("B") == [4] and mart.comparison("B", "m") == [5] and mart.comparison("B") == [4]
    now[0] = 60.0
    assert mart.companies() == [6]


@pytest.mark.parametrize(
    ("shown", "text"),
    [(display_value(None), "N/A"), (display_value(None, "-"), "-"), (display_value("x"), "x"), (display_number(120), "120.00"), (display_number(1234.5), "1,234.50"),
     (display_number(None), "N/A"), (display_percentage(0.0), "+0.0%"), (display_percentage(0.2), "+20.0%"), (display_percentage(-0.1), "-10.0%"), (display_percentage(None), "N/A")],
)
def test_texts(shown, text):
    assert shown == text


def test_cli_errors(tmp_path):
    common = ["--catalog", "x", "--schema", "y", "--bronze-object", "b", "--input-mode"]
    with pytest.raises(ValueError, match="fixture"):
        cli.bronze([*common, "fixture"])
    with pytest.raises(SystemExit):
        cli.bronze([*common, "stream"])
    (tmp_path / "o.json").write_text("{}")
    with pytest.raises(ValueError, match="JSON array"):
        cli.bronze([*common, "fixture", "--input-fixture-path", str(tmp_path / "o.json")])
    with pytest.raises(ValueError, match="does not exist"):
        cli.silver(["--catalog", "x", "--schema", "y", "--bronze-object", "no_such", "--silver-object", "s"])


def test_columns_show_what_the_page_shows(spark):
    import random

    rng = random.Random(1)
    values = [None, 0.0, -0.0, 0.005, -0.004, 0.125, 2.675, 1e15 + 0.5, -1234567.895, 0.0005, -0.0005, 0.00049, float("nan"), float("inf"), float("-inf"), -1e-300]
    values += [rng.choice([-1, 1]) * round(10 ** rng.uniform(-4, 12), rng.randint(0, 6)) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shown = df.select("v", shown_number(df.v).alias("n"), shown_percentage(df.v).alias("p"), shown_value(df.v.cast("string")).alias("t")).collect()
    assert [(r["n"], r["p"]) for r in shown] == [(display_number(v), display_percentage(v)) for v in values]
    assert shown[0]["t"] == display_value(None)
    # Beyond 2^53 the columns have zeros after the digits that tell a double from its neighbours.
    assert spark.range(1).select(shown_percentage(F.lit(1e22))).first()[0] == "+1,000,000,000,000,000,000,000,000.0%"
