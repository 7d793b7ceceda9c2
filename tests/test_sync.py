import math

from pyspark.sql import functions as F

from quarterline.operators.sync import apply_changes, change_counts, plan_changes

SCHEMA = "k string, v double, at int"


def plan(spark, target, source, delete):
    return plan_changes(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["k"], ["v"], delete)


TARGET = [("a", 1.0, 1), ("b", 1.0, 9), ("c", 1.0, 1), (None, 1.0, 1), ("n", math.nan, 1), ("z", 0.0, 1)]
SOURCE = [("a", 1.0, 5), ("b", 2.0, 5), ("d", 1.0, 5), (None, 1.0, 5), ("n", math.nan, 5), ("z", -0.0, 5)]


def test_upsert(spark):
    df = plan(spark, TARGET, SOURCE, False)
    rows = sorted(((r["k"] or "", r["at"], r["_action"]) for r in df.collect()))
    assert rows == [("", 1, "N"), ("", 5, "I"), ("a", 1, "N"), ("b", 5, "U"), ("c", 1, "N"), ("d", 5, "I"), ("n", 1, "N"), ("z", 1, "N")]
    assert df.agg(*change_counts()).first().asDict() == {"inserted_rows": 2, "updated_rows": 1, "deleted_rows": 0}


def test_synchronisation(spark):
    df = plan(spark, TARGET, SOURCE, True)
    assert df.agg(*change_counts()).first().asDict() == {"inserted_rows": 2, "updated_rows": 1, "deleted_rows": 2}
    assert sorted(r["k"] or "" for r in apply_changes(df).collect()) == ["", "a", "b", "d", "n", "z"]


def test_empty_sides(spark):
    assert plan(spark, [], SOURCE, True).where("_action = 'I'").count() == len(SOURCE)
    assert apply_changes(plan(spark, TARGET, [], True)).count() == 0
    assert apply_changes(plan(spark, TARGET, [], False)).count() == len(TARGET)


def test_one_join(spark):
    text = plan(spark, TARGET, SOURCE, True).agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 1
