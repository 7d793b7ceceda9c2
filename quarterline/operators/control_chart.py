"""Robust exponentially weighted control charts, many series at once.

Every series is a row of a matrix over a common sequence of periods, with NaN where nothing was reported; one NumPy
step advances all charts by one period. A chart predicts each value from those before it, clips a suspected value
before it updates mean and scale, and counts how long values stay out of control: a departure that lasts is a new
level, which the chart then adopts. Charts run forward and backward, so that a level change, seen from both sides, is
within control for one of them, while a spike is out of control for both.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEASON = 4


@dataclass(frozen=True)
class ChartRules:
    """limit: departure from the prediction in usual deviations that is out of control. longest: successive reported
    values that a spike may last. stuck: successive reported values that make a run. moving: share of successive values
    that must differ in a series whose runs are suspicious; frequent: share of the other values from which a
    run's value is none; least_changes: changes
    that such a series must have; few_runs: long runs that it may have though they fill most of it. fewest: reported values that a series needs to be judged. weight: of
    a new value in the mean; memory: weight of the old scale in the new one. clip: departure in scales beyond which a value counts no further; twice that is out of
    control. gate: departure from either prediction alone. least_usual: usual deviation of a proportional series that
    hardly varies, as a share of its level."""

    limit: float = 8.0
    longest: int = 2
    stuck: int = 6
    moving: float = 0.8
    fewest: int = 8
    weight: float = 0.3
    memory: float = 0.95
    clip: float = 2.5
    gate: float = 4.0
    least_usual: float = 0.005
    frequent: float = 0.1
    least_changes: int = 3
    few_runs: int = 2


def _median(x: np.ndarray, axis: int = 1) -> np.ndarray:
    """nanmedian without its warning for empty rows."""
    with np.errstate(all="ignore"):
        order = np.sort(x, axis=axis)  # NaN last
        n = np.sum(~np.isnan(x), axis=axis)
        low, high = np.maximum((n - 1) // 2, 0), np.maximum(n // 2, 0)
        take = lambda k: np.take_along_axis(order, np.expand_dims(np.minimum(k, x.shape[axis] - 1), axis), axis).squeeze(axis)
        return np.where(n > 0, (take(low) + take(high)) / 2, np.nan)


def _neighbour_level(x: np.ndarray, reach: int) -> np.ndarray:
    """Median of the values within reach on both sides, the value itself included."""
    n, t = x.shape
    padded = np.full((n, t + 2 * reach), np.nan)
    padded[:, reach : reach + t] = x
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1, axis=1)
    return _median(windows.reshape(n * t, -1)).reshape(n, t)


def seasonal_profile(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Usual difference of each value's season from the level around it, from the other years only, so that a value
    doesn't explain itself; zero where a season was hardly ever reported. And how many years each was taken from."""
    n, t = x.shape
    years_used = np.zeros((n, t))
    difference = x - _neighbour_level(x, SEASON)
    profile, centre = np.zeros((n, t)), np.zeros(n)
    for s in range(SEASON):
        own = difference[:, s::SEASON]
        seen = np.sum(~np.isnan(own), axis=1)
        centre += np.where(seen >= 3, _median(own), 0.0) / SEASON
        years = own.shape[1]
        for y in range(years):
            others = own.copy()
            others[:, y] = np.nan
            there = seen - ~np.isnan(own[:, y])
            profile[:, s + SEASON * y] = np.where(there >= 2, _median(others), 0.0)
            years_used[:, s + SEASON * y] = np.where(there >= 2, there, 0)
    return np.where(np.isnan(profile), 0.0, profile) - centre[:, None], years_used


def predictions(x: np.ndarray, scale: np.ndarray, rules: ChartRules) -> tuple[np.ndarray, np.ndarray]:
    """What the values before it lead one to expect at each period, NaN before the first one; and the chart's scale
    there.

    Values of a departure that lasted too long for a spike are expected at its own mean, the first of them included.
    """
    n, t = x.shape
    mean = np.full(n, np.nan)
    spread = scale.copy()
    out_for = np.zeros(n, int)  # length of the current run out of control, signed
    outside = np.full(n, np.nan)  # mean of that run
    expected, scales = np.full((n, t), np.nan), np.zeros((n, t))
    recent = np.full((n, rules.longest + 1), -1)  # periods of the current run, newest first
    every = np.arange(n)
    for k in range(t):
        value, known = x[:, k], ~np.isnan(x[:, k])
        fresh = known & np.isnan(mean)
        expected[:, k], scales[:, k] = mean, spread
        residual = np.where(known & ~fresh, value - mean, 0.0)
        bound = rules.clip * spread
        side = np.where(known & (np.abs(residual) > 2 * bound), np.sign(residual), 0).astype(int)
        goes_on = (side != 0) & (np.sign(out_for) == side)
        out_for = np.where(known, np.where(side == 0, 0, np.where(goes_on, out_for + side, side)), out_for)
        outside = np.where(goes_on, outside + (value - outside) / np.maximum(np.abs(out_for), 1), np.where(side != 0, value, outside))
        adopt = known & (np.abs(out_for) > rules.longest)
        recent = np.where((side != 0)[:, None], np.concatenate([np.full((n, 1), k), recent[:, :-1]], axis=1), recent)
        for j in range(rules.longest + 1):
            expected[every[adopt], recent[adopt, j]] = outside[adopt]
        clipped = np.clip(residual, -bound, bound)
        step = np.where(side != 0, 0.0, rules.weight * clipped)
        mean = np.where(fresh, value, np.where(adopt, outside, np.where(known, mean + step, mean)))
        calm = known & ~fresh & (side == 0)
        spread = np.where(calm, np.maximum(rules.memory * spread + (1 - rules.memory) * 1.25 * np.abs(clipped), 0.5 * scale), spread)
        out_for = np.where(adopt, 0, out_for)
    return expected, scales


@dataclass
class Judged:
    """Per series and period: the interval of values in keeping with the series (infinite where nothing is judged), and
    how many usual deviations the representative value lies outside its predictions."""

    low: np.ndarray
    high: np.ndarray
    score: np.ndarray


def prediction_variance(years: np.ndarray, rules: ChartRules) -> np.ndarray:
    """Variance of a period's prediction in units of the values' own, which what is left over contains besides theirs.

    An exponentially weighted mean of weight w has w / (2 - w), the middle of two independent ones half of that; a
    season that is the median of so many other years adds pi / 2 over their number.
    """
    w = rules.weight
    return w / (2 - w) / 2 + np.where(years > 0, np.pi / 2 / np.maximum(years, 1), 0.0)


def _both_ways(y: np.ndarray, rules: ChartRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower and the upper of the predictions from before and from after, NaN where either is missing; and the
    variance of such a prediction."""
    profile, years = seasonal_profile(y)
    flat = y - profile
    scale = 1.4826 * _median(np.abs(flat - _neighbour_level(flat, 2)))
    start = np.where(scale > 0, 1.3 * scale, np.inf)
    ahead, _ = predictions(flat, start, rules)
    back = predictions(flat[:, ::-1], start, rules)[0][:, ::-1]
    return np.minimum(ahead, back) + profile, np.maximum(ahead, back) + profile, prediction_variance(years, rules)


def _last_reported(x: np.ndarray) -> np.ndarray:
    """At each period the newest value reported before it."""
    t = x.shape[1]
    place = np.where(np.isnan(x), -1, np.arange(t))
    before = np.concatenate([np.full((len(x), 1), -1), np.maximum.accumulate(place, axis=1)[:, :-1]], axis=1)
    return np.where(before >= 0, np.take_along_axis(x, np.maximum(before, 0), axis=1), np.nan)


def _differs_from_previous(x: np.ndarray) -> np.ndarray:
    """Where a value was reported that isn't that of the period reported before; a run counts once."""
    return ~np.isnan(x) & (x != _last_reported(x))


def stuck_runs(candidates: np.ndarray, x: np.ndarray, rules: ChartRules) -> np.ndarray:
    """stuck_values of (values, series, periods), what was reported in each period, NaN where nothing was."""
    flat = candidates.reshape(len(candidates), -1)
    return stuck_values(np.nonzero(~np.isnan(flat))[1], flat[~np.isnan(flat)], x, rules)


def stuck_values(cell: np.ndarray, value: np.ndarray, x: np.ndarray, rules: ChartRules) -> np.ndarray:
    """The value that stands still at each series and period, NaN where none does.

    value: everything that was reported in each cell (series times periods plus period); x: the representative value. A
    run goes on while any value of the next reported period is its own. Runs count, more than a few only if they fill
    less than half of it, in a series that outside of them differs from its previous value in at least the share `moving` of the reported periods.
    """
    n, t = x.shape
    ordinal = np.where(np.isnan(x), -1, np.cumsum(~np.isnan(x), axis=1))
    entry = np.unique(np.rec.fromarrays([cell // t, value, ordinal.reshape(-1)[cell], cell], names="s,v,o,c"))
    still = np.full(n * t, np.nan)
    if len(entry):
        joins = (entry.s[1:] == entry.s[:-1]) & (entry.v[1:] == entry.v[:-1]) & (entry.o[1:] == entry.o[:-1] + 1)
        run = np.concatenate([[0], np.cumsum(~joins)])
        long = np.bincount(run)[run] >= rules.stuck
        still[entry.c[long]] = entry.v[long]
    still = still.reshape(n, t)
    outside = ~np.isnan(x) & np.isnan(still) & ~np.isnan(_last_reported(x))
    changes = np.sum(outside & (x != _last_reported(x)), axis=1)
    # A value that is frequent in the rest of the series, too, may well come six times in a row.
    some = np.flatnonzero(~np.isnan(still).all(axis=1))
    elsewhere = ((x[some][:, :, None] == still[some][:, None, :]) & outside[some][:, :, None]).sum(axis=1)
    usual = elsewhere > rules.frequent * outside[some].sum(axis=1, keepdims=True)
    still[some] = np.where(usual, np.nan, still[some])
    begins = ~np.isnan(still) & (still != _last_reported(still))
    apart = np.sum(outside, axis=1)
    moving = changes >= np.maximum(rules.moving * apart, rules.least_changes)
    # More runs than a few are an exception only in a series that mostly moves; others stand still by nature.
    moving &= (np.sum(begins, axis=1) <= rules.few_runs) | (2 * apart >= np.sum(~np.isnan(x), axis=1))
    return np.where(moving[:, None], still, np.nan)


def level_around(x: np.ndarray) -> np.ndarray:
    """Median of a year before and after each period."""
    return _neighbour_level(x, SEASON)


def representative(value: np.ndarray, starts: np.ndarray, newest: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Of all values of a period the one nearest to the level around it, so that a corrected slip doesn't count; of two
    as near the lower one. value: sorted within each period, whose first ones are at `starts`; newest and level: one
    for each period, the newest value standing for a level that isn't known."""
    period = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(value))))
    gap = np.abs(value - np.where(np.isnan(level), newest, level)[period])
    nearest = np.flatnonzero(gap == np.minimum.reduceat(gap, starts)[period])
    return value[nearest[np.unique(period[nearest], return_index=True)[1]]]


def judge_spikes(x: np.ndarray, rules: ChartRules) -> Judged:
    """x holds one representative value per series and period, NaN where none.

    A series that keeps its sign varies in proportion to its level, so its chart runs over logarithms and its usual
    deviation is relative; any other series is charted as it is. Periods before the first and after the last prediction
    are not judged, nor are series with too few values or without any usual deviation.
    """
    if not len(x):
        return Judged(x, x, x)
    with np.errstate(all="ignore"):
        reported = np.sum(~np.isnan(x), axis=1)
        centre = _median(x)
        sign = np.where(centre < 0, -1.0, 1.0)[:, None]
        size = x * sign
        steady = (np.sum(size <= 0, axis=1) <= 0.15 * reported) & (centre != 0)
        floor = 0.01 * np.abs(centre)[:, None]
        y = np.where(steady[:, None], np.log(np.where(np.isnan(size), np.nan, np.maximum(size, floor))), x)
        least, most, uncertain = _both_ways(y, rules)
        least, most = (np.where(steady[:, None], np.exp(e), e) for e in (least, most))
        middle, z = (least + most) / 2, np.where(steady[:, None], size, x)
        unit = np.where(steady[:, None], middle, 1.0)
        away = np.abs(z - middle) / unit
        moved = _differs_from_previous(x)
        usual = 1.4826 * _median(np.where(moved, away, np.nan))
        usual = np.where(np.sum(moved, axis=1) >= rules.fewest, usual, 1.4826 * _median(away))
        usual /= np.sqrt(1 + _median(np.where(np.isnan(x), np.nan, uncertain)))
        usual = np.where(steady, np.fmax(usual, rules.least_usual), usual)
        usual = np.where((usual > 0) & (reported >= rules.fewest), usual, np.nan)[:, None] * unit
        # Out of control for both charts, and that far from what both together lead one to expect.
        low = np.minimum(least - rules.gate * usual, middle - rules.limit * usual)
        high = np.maximum(most + rules.gate * usual, middle + rules.limit * usual)
        score = np.minimum(np.abs(z - middle) / usual, rules.limit / rules.gate * np.maximum(least - z, z - most) / usual)
        flipped = steady[:, None] & (sign < 0)
        low, high = np.where(flipped, -high, low), np.where(flipped, -low, high)
    judged = ~np.isnan(low)
    return Judged(np.where(judged, low, -np.inf), np.where(judged, high, np.inf), np.where(judged & ~np.isnan(score), score, 0.0))
