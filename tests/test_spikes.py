import math

import numpy as np
import pytest

from quarterline.operators.control_chart import ChartRules, judge_spikes, representative, stuck_runs
from quarterline.operators.spikes import implausible_rows


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame([("share", 0.0, 1.0), ("money", None, None), ("count", 0.0, None)], "metric_code string, lower_limit double, upper_limit double")


def name(k):
    return f"{2015 + k // 4}Q{k % 4 + 1}"


def series(values, company="C", metric="money"):
    return [("o", company, metric, name(k), v, None) for k, v in enumerate(values) if v is not None]


def wave(n=32, seed=0, level=1000.0, noise=0.03, season=0.0, growth=0.0):
    rng = np.random.default_rng(seed)
    return [float(level * (1 + growth) ** k * (1 + season * ((k % 4) - 1.5)) * (1 + noise * rng.standard_normal())) for k in range(n)]


def flagged(bronze, catalog, rows):
    return sorted(r["row_id"] for r in implausible_rows(bronze(rows), catalog).collect())


def test_limits_and_infinity(bronze, catalog):
    rows = [
        ("o", None, "share", None, 1.0, None), ("o", None, "share@s01", "x", 1.01, None), ("o", "C", " share ", "2015Q1", -0.01, None), ("o", None, None, None, math.inf, None),
        ("o", None, "unknown", None, -math.inf, None), ("o", "C", "count", "2015Q1", -1.0, None), ("o", "C", "share", "2015Q1", math.nan, None), ("o", "C", "share", "2015Q1", None, None),
        ("o", "C", "money", "2015Q1", -1e18, None), ("o", "C", "Share", "2015Q1", 7.0, None),
    ]
    assert flagged(bronze, catalog, rows) == [2, 3, 4, 5, 6]


def test_spikes_and_their_copies(bronze, catalog):
    values = wave()
    values[9], values[20], values[21] = 30_000.0, 2500.0, -2000.0
    rows = series(values)
    rows += [rows[9], ("o", " C ", "money\t", "2017-T2", 30_000.0, None), ("o", "C", "money", name(9), values[8], None)]
    assert flagged(bronze, catalog, rows) == [10, 21, 22, 33, 34]


@pytest.mark.parametrize("shape", [{}, {"growth": 0.05}, {"season": 0.2}, {"noise": 0.1}, {"level": -500.0}])
def test_what_is_normal(bronze, catalog, shape):
    step = wave(seed=3)
    step[16:] = [v * 1.8 for v in step[16:]]
    repeats = [100.0] * 12 + [120.0] * 10 + [118.0] * 10
    zeros = [v if k % 3 else 0.0 for k, v in enumerate(wave(seed=5, noise=0.3))]
    rows = series(wave(seed=1, **shape)) + series(step, "D") + series(repeats, "E") + series(zeros, "F") + series([1.0, 500.0, 2.0], "G")
    assert flagged(bronze, catalog, rows) == []


def test_a_lasting_excursion_is_a_level(bronze, catalog):
    values = wave(seed=2)
    values[10:14] = [v * 3 for v in values[10:14]]
    assert flagged(bronze, catalog, series(values)) == []


def test_runs(bronze, catalog):
    six, five = wave(seed=7), wave(seed=8)
    six[10:16], five[10:15] = [950.0] * 6, [950.0] * 5
    six[12] = None  # not reported; the run goes on with the next
    six[16] = 950.0
    rows = series(six)
    rows += [("o", "C", "money", name(13), 951.0, None)] + series(five, "D")
    found = flagged(bronze, catalog, rows)
    assert found == [k + 1 for k, r in enumerate(rows) if r[1] == "C" and r[4] == 950.0] and len(found) == 6


def test_a_frequent_value_may_repeat(bronze, catalog):
    values = [0.0 if k in (1, 4, 7, 20, 23, 29) or 10 <= k < 16 else v for k, v in enumerate(wave(seed=5, noise=0.3))]
    assert flagged(bronze, catalog, series(values)) == []


def test_no_series_no_quarter_nothing(bronze, catalog):
    values = wave()
    values[9] = 30_000.0
    nameless = [("o", None, *r[2:]) for r in series(values)] + [("o", r[1], r[2], "1900Q1", r[4], None) for r in series(values)]
    assert flagged(bronze, catalog, nameless) == [] and flagged(bronze, catalog, []) == []


def test_clashing_columns_and_repeated_metrics(spark, bronze, catalog):
    values = wave()
    values[9] = 30_000.0
    df = bronze(series(values))
    for c in ("company", "metric", "quarter", "code", "low", "high", "stuck", "least", "lower"):
        df = df.withColumn(c, df["value"])
    assert [r["row_id"] for r in implausible_rows(df, catalog.union(catalog)).collect()] == [10]


def test_charts_of_a_batch_are_independent():
    rules = ChartRules()
    x = np.array([wave(40, seed=k) for k in range(5)])
    x[2, 11] *= 20
    together, alone = judge_spikes(x, rules), [judge_spikes(x[k : k + 1], rules) for k in range(5)]
    for k in range(5):
        assert np.array_equal(together.low[k], alone[k].low[0]) and np.array_equal(together.high[k], alone[k].high[0])
    assert stuck_runs(x[None], x, rules).shape == x.shape and len(judge_spikes(x[:0], rules).low) == 0


def test_a_run_goes_on_through_a_quarter_with_many_values(bronze, catalog):
    values = wave(seed=7)
    values[10:16] = [950.0] * 6
    rows = series(values)
    around = [("o", "C", "money", name(12), v, None) for v in (940.0, 960.0, 945.0)]
    rows = around[:2] + rows + [around[2], ("o", "C", "money", name(12), 955.0, None)]
    assert flagged(bronze, catalog, rows) == [k + 1 for k, r in enumerate(rows) if r[4] == 950.0]


def test_any_number_of_runs_in_a_series_that_otherwise_changes(bronze, catalog):
    values = wave(40, seed=7)
    for k, begin in enumerate((3, 15, 28)):
        values[begin : begin + 6] = [950.0 + k] * 6
    assert flagged(bronze, catalog, series(values)) == [b + k + 1 for b in (3, 15, 28) for k in range(6)]


@pytest.mark.parametrize("seed", [11, 12, 13])
@pytest.mark.parametrize("n", [28, 40])
def test_limits_lie_eight_true_deviations_away(seed, n):
    """Simulated series of known deviation: what is left over from the predictions contains theirs, which is taken off."""
    rules, rng = ChartRules(), np.random.default_rng(seed)
    x = np.exp(rng.uniform(5, 9, (800, 1)) + rng.uniform(-0.01, 0.03, (800, 1)) * np.arange(n) + 0.03 * rng.standard_normal((800, n)))
    judged = judge_spikes(x, rules)
    there = np.isfinite(judged.high)
    low, high = judged.low[there], judged.high[there]
    assert there.mean() > 0.9 and 0.93 < np.mean((high - low) / (high + low)) / rules.limit / 0.03 < 1.12


@pytest.mark.parametrize("seed", [21, 22])
def test_planted_slips_are_found_and_little_else(seed):
    rules, rng, n = ChartRules(), np.random.default_rng(seed), 40
    season = 0.05 * rng.standard_normal((600, 4))[:, np.arange(n) % 4]
    x = np.exp(rng.uniform(5, 9, (600, 1)) + season + 0.03 * rng.standard_normal((600, n)))
    at = rng.integers(2, n - 2, 600)
    every = np.arange(600)
    planted = rng.random(600) < 0.5
    x[every, at] *= np.where(planted, np.where(rng.random(600) < 0.5, 1.6, 0.5), 1)
    judged = judge_spikes(x, rules)
    hit = (x < judged.low) | (x > judged.high)
    assert hit[every, at][planted].mean() > 0.9
    hit[every[planted], at[planted]] = False
    assert hit.mean() < 0.002


def test_the_value_nearest_to_the_level_stands_for_a_period():
    value, starts = np.array([1.0, 5.0, 9.0, 4.0, 6.0, 7.0, 2.0]), np.array([0, 3, 6])
    assert representative(value, starts, np.array([9.0, 7.0, 2.0]), np.array([5.5, 5.0, np.nan])).tolist() == [5.0, 4.0, 2.0]


def test_a_correction_among_many_reports_of_a_quarter_counts(bronze, catalog):
    values = wave(seed=4)
    slips = [values[9] * k for k in (20.0, 0.01, 35.0, 0.02)]
    rows = series(values)
    around = [("o", "C", "money", name(9), v, None) for v in slips]
    # The right value is neither the least, the most, the first nor the last of its quarter.
    rows = around[:2] + rows + around[2:]
    assert flagged(bronze, catalog, rows) == [k + 1 for k, r in enumerate(rows) if r[4] in slips]


def test_rows_without_a_number_or_with_the_same_one(bronze, catalog):
    from pyspark.sql import functions as F

    values = wave()
    values[9] = 30_000.0
    df = bronze(series(values) + series([v * 1.001 for v in values]))
    found = lambda x: sorted((r["row_id"] for r in implausible_rows(x, catalog).collect()), key=str)
    assert found(df) == [10, 42]
    assert found(df.withColumn("row_id", F.when(F.col("row_id") > 5, F.col("row_id")))) == [10, 42]
    assert found(df.withColumn("row_id", F.lit(7).cast("long"))) == [7, 7]
    assert found(df.withColumn("row_id", F.lit(None).cast("long"))) == [None, None]
