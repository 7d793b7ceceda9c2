import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterline.operators.finger_tree import COUNT, EARLIEST, PAIR, FingerTree

TIMES = st.integers(0, 120)
STEPS = st.lists(st.one_of(st.tuples(st.just("insert"), TIMES, st.integers(-50, 50)), st.tuples(st.just("cut"), TIMES, st.none())), max_size=200)
FOLD = {id(COUNT): sum, id(EARLIEST): lambda v: min(v, default=EARLIEST.identity), id(PAIR): lambda v: (sum(a for a, _ in v), sum(b for _, b in v))}


def check_shape(tree):
    """Totals, keys, parents and fingers agree with what is below."""
    depths = set()

    def walk(node, depth):
        assert len(node.keys) == len(node.items) <= tree.most and node.keys == sorted(node.keys)
        assert node.total == tree._sum(node)
        if node.leaf:
            depths.add(depth)
            return [node]
        leaves = []
        for key, child in zip(node.keys, node.items, strict=True):
            assert child.parent is node and child.keys[0] == key
            leaves += walk(child, depth + 1)
        return leaves

    leaves = walk(tree.root, 0)
    assert tree.root.parent is None and len(depths) == 1
    assert tree.left is leaves[0] and tree.right is leaves[-1]


@pytest.mark.parametrize("monoid", [COUNT, EARLIEST, PAIR])
@settings(max_examples=80, deadline=None)
@given(steps=STEPS, most=st.sampled_from([4, 5, 8]))
def test_agrees_with_lists(monoid, steps, most):
    tree, kept, cut_off = FingerTree(monoid, most), [], None
    fold = FOLD[id(monoid)]
    for kind, time, value in steps:
        if kind == "insert":
            v = (value, 1) if monoid is PAIR else value
            assert tree.insert(time, v) == (cut_off is None or time >= cut_off)
            if cut_off is None or time >= cut_off:
                kept.append((time, v))
        else:
            gone = {k for k, _ in tree.cut(time)}
            assert gone == {k for k, _ in kept if k < time}
            cut_off = max(time, cut_off if cut_off is not None else time)
            kept = [x for x in kept if x[0] >= cut_off]
        check_shape(tree)
        assert tree.total() == fold([v for _, v in kept])
    for time in range(-1, 122):
        assert tree.at(time) == fold([v for k, v in kept if k == time])
        assert tree.after(time) == fold([v for k, v in kept if k > time])
    assert dict(tree.later()) == {t: fold([v for k, v in kept if k > t]) for t in {k for k, _ in kept}}
    inserted = [t for kind, t, _ in steps if kind == "insert"]
    assert tree.newest == (max(inserted) if inserted else None)


def test_height_grows_with_the_logarithm_and_evicted_nodes_are_gone():
    rng, tree = random.Random(2), FingerTree(COUNT)
    for time in rng.sample(range(20_000), 10_000):
        tree.insert(time, 1)
    height, node = 1, tree.root
    while not node.leaf:
        height, node = height + 1, node.items[0]
    assert height <= 7  # at least 4 entries a node
    assert len(tree.cut(19_000)) == 10_000 - tree.total()
    left, stack = 0, [tree.root]
    while stack:
        node = stack.pop()
        left += 1
        stack += [] if node.leaf else node.items
    assert left < tree.total() / 2
