import functools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterline.llm import packing
from quarterline.llm.patterns import fit_repeats, generate, pack


def check(counts, capacity):
    used, containers = np.zeros(capacity + 1, int), 0
    for p in pack(counts.copy(), capacity):
        assert p.repeats > 0 and sum(k * n for k, n in p.lengths) <= capacity
        for k, n in p.lengths:
            used[k] += n * p.repeats
        containers += p.repeats
    assert np.array_equal(used[1:], counts[1:])
    return containers


@settings(max_examples=150, deadline=None)
@given(capacity=st.integers(1, 60), items=st.lists(st.integers(1, 60), max_size=80))
def test_every_item_once_and_no_overflow(capacity, items):
    lengths = [min(i, capacity) for i in items]
    containers = check(np.bincount(lengths, minlength=capacity + 1), capacity)
    least = -(-sum(lengths) // capacity)
    # Of two containers that are at most half full the greedy packing would have made one.
    assert least <= containers <= max(2 * least, 1) or not items and containers == 0


@pytest.mark.parametrize("capacity", [512, 2048, 8192])
def test_little_room_is_unused(capacity):
    lengths = np.minimum(np.random.default_rng(0).lognormal(5.5, 1.1, 20_000).astype(int) + 1, capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    assert lengths.sum() / (check(counts, capacity) * capacity) > 0.995


def as_dicts(patterns):
    out = [{} for _ in range(patterns.size)]
    for p, length, n in zip(patterns.column.tolist(), patterns.length.tolist(), patterns.times.tolist(), strict=True):
        out[p][length] = n
    return out


@settings(max_examples=150, deadline=None)
@given(capacity=st.integers(2, 25), counts=st.lists(st.integers(0, 4), min_size=25, max_size=25), values=st.lists(st.integers(0, 9), min_size=26, max_size=26))
def test_generated_patterns_are_the_best(capacity, counts, values):
    """Against a search over all full patterns within the counts."""
    there = np.array([0, *counts])[: capacity + 1]
    value = np.array(values[: capacity + 1], float)

    @functools.cache
    def best(room, upto):
        """Greatest value of an exact filling from lengths up to one, none more often than it occurs."""
        if upto == 0:
            return 0.0 if room == 0 else -math.inf
        most = min(int(there[upto]), room // upto) if value[upto] > 0 else 0
        return max(k * value[upto] + best(room - k * upto, upto - 1) for k in range(most + 1))

    got = as_dicts(generate(value, there, capacity))
    for p in got:
        assert sum(k * n for k, n in p.items()) == capacity and all(n <= there[k] for k, n in p.items())
    firsts = [k for k in np.flatnonzero(there) if k <= capacity and best(capacity - int(k), capacity) > -math.inf]
    worth = sorted(value[k] + best(capacity - int(k), capacity) for k in firsts)
    # One per length, but for those whose best filling would need the length once more than it occurs.
    assert len(got) <= len(firsts)
    for p in got:
        w = sum(value[k] * n for k, n in p.items())
        assert any(math.isclose(w, x) for x in worth)


def test_patterns_fill_exactly_and_fit():
    counts = np.zeros(11, int)
    counts[[2, 3, 5, 7, 10]] = [40, 30, 20, 30, 5]
    patterns = generate(counts.astype(float), counts, 10)
    assert all(sum(k * n for k, n in p.items()) == 10 for p in as_dicts(patterns)) and patterns.size == 5
    x = fit_repeats(patterns, counts)
    assert (x >= 0).all()
    # At the least squares no pattern can gain by being used more.
    left = counts - patterns.used(x, 11)
    gradient = -patterns.gained(np.arange(11) * left)
    assert gradient.min() > -5 and np.abs(gradient[x > 1e-3]).max() < 5


@pytest.mark.parametrize("capacity", [512, 2048, 8192])
def test_most_containers_come_from_the_fit(capacity):
    lengths = np.minimum(np.random.default_rng(1).lognormal(5.5, 1.1, 20_000).astype(int) + 1, capacity)
    plan = pack(np.bincount(lengths, minlength=capacity + 1), capacity)
    assert sum(p.repeats for p in plan if p.fitted) > 0.8 * sum(p.repeats for p in plan)


def test_capacities_beyond_the_cells_of_the_search():
    lengths = np.minimum(np.random.default_rng(2).lognormal(7, 1.2, 3_000).astype(int) + 1, 20_000)
    assert lengths.sum() / (check(np.bincount(lengths, minlength=20_001), 20_000) * 20_000) > 0.98


def rows(spark, sizes, kinds):
    documents = spark.createDataFrame([(i, "a " * n if n else t, "k", 5) for i, (n, t) in enumerate(sizes)], "doc_id long, text string, kind string, start long")
    containers = spark.createDataFrame(kinds, "container_kind string, capacity_tokens int")
    found = packing.containers_of(documents, containers)
    return found.toPandas(), {i: n for i, n in enumerate(packing.token_counts(documents).orderBy("doc_id").toPandas()["n_tokens"])}, containers, found


def test_documents_into_containers(spark):
    rng = np.random.default_rng(1)
    sizes = [(int(n), None) for n in rng.integers(1, 90, 150)] + [(0, None), (0, ""), (700, None), (64, None), (64, None)] + [(7, None)] * 60
    frame, tokens, containers, found = rows(spark, sizes, [("small", 64), ("large", 300), ("large", 200), (None, 5), ("none", None), ("zero", 0)])
    assert set(frame["container_kind"]) == {"small", "large"}
    for kind, capacity in (("small", 64), ("large", 300)):
        mine = frame[frame["container_kind"] == kind].sort_values(["doc_id", "start_token"])
        mine = mine.assign(n=mine["end_token"] - mine["start_token"])
        filled = mine.groupby("container_no")["n"].sum()
        assert filled.max() <= capacity and sorted(filled.index) == list(range(1, len(filled) + 1))
        assert mine.groupby("doc_id")["n"].sum().to_dict() == {i: n for i, n in tokens.items() if n}
        assert (mine.groupby("doc_id")["end_token"].shift().fillna(0) == mine["start_token"]).all()
        assert all(c == -(-tokens[i] // capacity) for i, c in mine.groupby("doc_id").size().items())
        assert filled.sum() / (len(filled) * capacity) > 0.97
    documents = spark.createDataFrame([(i, "a " * n if n else t) for i, (n, t) in enumerate(sizes)], "doc_id long, text string")
    fill = {r["container_kind"]: r for r in packing.fill_of(documents, containers).collect()}
    assert fill["small"]["tokens"] == sum(tokens.values()) and fill["small"]["capacity_tokens"] == 64
    assert fill["small"]["least"] == -(-sum(tokens.values()) // 64) <= fill["small"]["containers"] and 0 < fill["small"]["fitted"] <= 1
    assert {tuple(r)[2:] for r in packing.conditions_of(documents, containers).collect()} == {(0, 0, 0)}


def test_empty_tables(spark):
    assert rows(spark, [], [("small", 64)])[0].empty
    assert rows(spark, [(5, None)], [])[0].empty
    assert rows(spark, [(0, None), (0, "")], [("small", 64)])[0].empty


def test_bounds_are_checked(spark, monkeypatch):
    monkeypatch.setattr(packing, "MOST_CAPACITY", 10)
    with pytest.raises(ValueError, match="capacities"):
        rows(spark, [(5, None)], [("small", 64)])
