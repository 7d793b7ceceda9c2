"""Measurements that can't be right: beyond physical limits, out of keeping with their series, or standing still."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.functions.expr import is_finite
from quarterline.functions.text import QUARTERS, identifier, readable_quarter_index
from quarterline.operators.control_chart import ChartRules, judge_spikes, level_around, representative, stuck_values
from quarterline.operators.whole_groups import group_numbers, whole_groups
from quarterline.sources import files

_SERIES = ("company", "metric")
_NODE = (*_SERIES, "quarter")


def _charted(rules: ChartRules):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for entries in whole_groups(batches, _SERIES):
            # One row per value; a quarter's rows follow one another.
            starts = np.flatnonzero(np.diff(group_numbers(entries, _NODE), prepend=-1))
            value, last = entries["value"].to_numpy(), entries["last"].to_numpy()
            node = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(entries))))
            nodes = entries.iloc[starts][list(_NODE)].reset_index(drop=True)
            nodes["least"], nodes["most"] = np.minimum.reduceat(value, starts), np.maximum.reduceat(value, starts)
            series, quarter = group_numbers(nodes, _SERIES), nodes["quarter"].to_numpy()
            # Rows without a number or with the same one leave a choice; any value serves.
            newest, here = nodes["least"].to_numpy(copy=True), last == np.maximum.reduceat(last, starts)[node]
            newest[node[here]] = value[here]
            x = np.full((int(series[-1]) + 1, QUARTERS), np.nan)
            x[series, quarter] = newest
            x[series, quarter] = representative(value, starts, newest, level_around(x)[series, quarter])
            judged, still = judge_spikes(x, rules), stuck_values((series * QUARTERS + quarter)[node], value, x, rules)
            low, high, stuck = (m[series, quarter] for m in (judged.low, judged.high, still))
            bad = (nodes["least"].to_numpy() < low) | (nodes["most"].to_numpy() > high) | ~np.isnan(stuck)
            yield nodes.loc[bad, list(_NODE)].assign(low=low[bad], high=high[bad], stuck=pd.array(stuck[bad], dtype="Float64"))

    return run


def _rows(bronze: DataFrame) -> DataFrame:
    metric = identifier(F.col("metric_id"))
    return bronze.where("value IS NOT NULL AND NOT isnan(value)").select(
        "row_id", "value", identifier(F.col("company_id")).alias("company"), metric.alias("metric"),
        readable_quarter_index(F.col("period_id")).alias("quarter"), F.substring_index(metric, "@", 1).alias("code"),
    )


def _limits(catalog: DataFrame) -> DataFrame:
    named = catalog.select(F.col("metric_code").alias("code"), F.col("lower_limit").alias("lower"), F.col("upper_limit").alias("upper"))
    return named.dropDuplicates(["code"])


def _impossible():
    value = F.col("value")
    return ~is_finite(value) | F.coalesce((value < F.col("lower")) | (value > F.col("upper")), F.lit(False))


def beyond_limits(bronze: DataFrame, catalog: DataFrame) -> DataFrame:
    """row_id of the rows whose value is infinite or beyond the limits of its metric."""
    return _rows(bronze).join(_limits(catalog), "code", "left").where(_impossible()).select("row_id")


def implausible_rows(bronze: DataFrame, catalog: DataFrame, rules: ChartRules | None = None) -> DataFrame:
    """row_id of every delivered row, copies included, whose value is implausible.

    Infinite values and values beyond the metric's limits always are, whatever else the row lacks. The others are judged
    by the chart of their series (trimmed company and metric): a row needs both, and a quarter that can be read, in
    whatever notation. Null and NaN values are never implausible; an unknown metric has no limits; a series with too
    few values is not charted.

    A series' rows are reduced map-side to the different values of each quarter, so copies don't reach one task in
    numbers. Runs are sought in all of them, and the chart takes that of a quarter's values which lies nearest to the
    level around it. Charts return only quarters that hold an implausible value; those are written first, so that Spark knows their
    size and broadcasts them only if it is small, and then meet the rows in one pass together with the limits.
    """
    rules = rules or ChartRules()
    rows = _rows(bronze)
    charted = rows.where(is_finite(F.col("value")) & F.expr(" AND ".join(f"{k} IS NOT NULL" for k in _NODE)))
    nodes = (
        charted.groupBy(*_NODE, "value")
        .agg(F.max("row_id").alias("last"))
        .repartition(*_SERIES)
        .sortWithinPartitions(*_NODE, "value")
        .mapInPandas(_charted(rules), "company string, metric string, quarter int, low double, high double, stuck double")
    )
    value = F.col("value")
    out = (value < F.col("low")) | (value > F.col("high")) | (value == F.col("stuck"))
    judged = rows.join(_limits(catalog), "code", "left").join(files.kept(nodes, "charts"), list(_NODE), "left")
    return judged.where(_impossible() | F.coalesce(out, F.lit(False))).select("row_id")
