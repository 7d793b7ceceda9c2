"""A finger B-tree of partial aggregates keyed by event time.

Leaves hold event times with the aggregate of what happened then, inner nodes the aggregate of what lies below them.
Two fingers point to the first and the last leaf. An insert starts at the finger nearer to its time and climbs only as
far as it must, so what arrives in order costs no search and what arrives late costs the logarithm of how late it is;
then one partial per level is brought up to date. A cut-off drops whole subtrees at once and mends only the nodes on
the boundary. What was cut off is gone from the tree, and inserts before the cut-off are refused.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

#: A node holds at most so many entries, and at least half of them but for the root and the boundary of a cut-off.
MOST = 16


@dataclass(frozen=True)
class Monoid:
    """An associative, commutative operation and its identity."""

    plus: Callable[[Any, Any], Any]
    identity: Any


COUNT = Monoid(lambda a, b: a + b, 0)
EARLIEST = Monoid(min, 1 << 63)
#: Componentwise sums of pairs.
PAIR = Monoid(lambda a, b: (a[0] + b[0], a[1] + b[1]), (0, 0))


class _Node:
    """keys: a leaf's times, or the first time below each child; items: partials, or the children; total: of all."""

    __slots__ = ("items", "keys", "leaf", "parent", "total")

    def __init__(self, leaf: bool, keys: list, items: list) -> None:
        self.leaf, self.keys, self.items, self.parent, self.total = leaf, keys, items, None, None
        if not leaf:
            for child in items:
                child.parent = self


class FingerTree:
    """cut_off: first time that isn't cut off (None before any cut); newest: latest time ever offered, refused or not."""

    def __init__(self, monoid: Monoid, most: int = MOST) -> None:
        self.monoid, self.most = monoid, most
        self._empty()
        self.cut_off = self.newest = None

    def _empty(self) -> None:
        self.root = self.left = self.right = _Node(True, [], [])
        self.root.total = self.monoid.identity

    def _sum(self, node: _Node) -> Any:
        plus, out = self.monoid.plus, self.monoid.identity
        for x in node.items if node.leaf else (c.total for c in node.items):
            out = plus(out, x)
        return out

    def _leaf(self, time) -> _Node:
        """The leaf where a time belongs, from the nearer finger: up until the subtree covers it, then down."""
        node = self.right
        if node.parent is None or time >= node.keys[0]:
            return node
        if time < self.left.keys[-1]:
            return self.left
        while node.parent is not None and time < node.keys[0]:
            node = node.parent
        while not node.leaf:
            node = node.items[max(bisect_right(node.keys, time) - 1, 0)]
        return node

    def insert(self, time, value) -> bool:
        """Add a value at any time; False, and nothing added, if that time is cut off already."""
        if self.newest is None or time > self.newest:
            self.newest = time
        if self.cut_off is not None and time < self.cut_off:
            return False
        plus, node = self.monoid.plus, self._leaf(time)
        at = bisect_left(node.keys, time)
        if at < len(node.keys) and node.keys[at] == time:
            node.items[at] = plus(node.items[at], value)
        else:
            node.keys.insert(at, time)
            node.items.insert(at, value)
            if at == 0:
                self._lower(node)
        up = node
        while up is not None:
            up.total = plus(up.total, value)
            up = up.parent
        while len(node.keys) > self.most:
            node = self._split(node)
        return True

    def _lower(self, node: _Node) -> None:
        """A node's first time changed: its ancestors' keys follow while it is their first."""
        while (parent := node.parent) is not None:
            at = parent.items.index(node)
            parent.keys[at] = node.keys[0]
            if at:
                return
            node = parent

    def _split(self, node: _Node) -> _Node:
        """Half of a node moves to a new right neighbour; returns the parent."""
        half = len(node.keys) // 2
        new = _Node(node.leaf, node.keys[half:], node.items[half:])
        del node.keys[half:], node.items[half:]
        node.total, new.total = self._sum(node), self._sum(new)
        if node is self.right:
            self.right = new
        if node.parent is None:
            self.root = _Node(False, [node.keys[0], new.keys[0]], [node, new])
            self.root.total = self.monoid.plus(node.total, new.total)
            return self.root
        parent = node.parent
        at = parent.items.index(node) + 1
        parent.keys.insert(at, new.keys[0])
        parent.items.insert(at, new)
        new.parent = parent
        return parent

    def total(self) -> Any:
        return self.root.total

    def at(self, time) -> Any:
        node = self._leaf(time)
        k = bisect_left(node.keys, time)
        return node.items[k] if k < len(node.keys) and node.keys[k] == time else self.monoid.identity

    def after(self, time) -> Any:
        """The aggregate of everything strictly later: right siblings on the way up."""
        plus, node = self.monoid.plus, self._leaf(time)
        out = self.monoid.identity
        for x in node.items[bisect_right(node.keys, time) :]:
            out = plus(out, x)
        while (parent := node.parent) is not None:
            for sibling in parent.items[parent.items.index(node) + 1 :]:
                out = plus(out, sibling.total)
            node = parent
        return out

    def items(self) -> Iterator[tuple[Any, Any]]:
        """Times and their aggregates, oldest first."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.leaf:
                yield from zip(node.keys, node.items, strict=True)
            else:
                stack.extend(reversed(node.items))

    def later(self) -> list[tuple[Any, Any]]:
        """Each time, newest first, and the aggregate of all later ones; one walk over the tree."""
        plus, out, seen = self.monoid.plus, [], self.monoid.identity
        for time, x in reversed(list(self.items())):
            out.append((time, seen))
            seen = plus(seen, x)
        return out

    def cut(self, time) -> list[tuple[Any, Any]]:
        """Evict everything before the time and refuse it from now on; the entries that went."""
        if self.cut_off is not None and time <= self.cut_off:
            return []
        self.cut_off, gone, node, path = time, [], self.root, []
        while node is not None:
            # Of an inner node all children but the last that begins before the time lie wholly before it.
            k = bisect_left(node.keys, time) if node.leaf else max(bisect_left(node.keys, time) - 1, 0)
            if node.leaf:
                gone += zip(node.keys[:k], node.items[:k], strict=True)
            else:
                for child in node.items[:k]:
                    gone += self._entries(child)
            del node.keys[:k], node.items[:k]
            path.append(node)
            node = None if node.leaf else node.items[0]
        self._mend(path)
        return gone

    @staticmethod
    def _entries(node: _Node) -> Iterator[tuple[Any, Any]]:
        if node.leaf:
            yield from zip(node.keys, node.items, strict=True)
        else:
            for child in node.items:
                yield from FingerTree._entries(child)

    def _mend(self, path: list[_Node]) -> None:
        """From the leaf up along the boundary: an emptied node goes, one less than half full joins its neighbour."""
        for node in reversed(path):
            parent = node.parent
            if parent is None:
                break
            if len(node.keys) < self.most // 2 and len(parent.items) > 1:
                neighbour = parent.items[1]
                neighbour.keys[:0], neighbour.items[:0] = node.keys, node.items
                if not node.leaf:
                    for child in node.items:
                        child.parent = neighbour
                del parent.keys[0], parent.items[0]
                node = neighbour
                if len(node.keys) > self.most:
                    node.total = self._sum(node)
                    parent.keys[0] = node.keys[0]
                    self._split(node)
            elif not node.keys:
                del parent.keys[0], parent.items[0]
                continue
            node.total = self._sum(node)
            parent.keys[0] = node.keys[0]
        root = self.root
        while not root.leaf and len(root.items) == 1:
            root = root.items[0]
        if not root.keys:
            self._empty()
            return
        root.parent, self.root = None, root
        root.total = self._sum(root)
        self.left = self.right = root
        while not self.left.leaf:
            self.left = self.left.items[0]
        while not self.right.leaf:
            self.right = self.right.items[-1]
