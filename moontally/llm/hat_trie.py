"""Counts of word-id sequences in a burst trie: hash-ordered containers under a shallow trie of ids.

A sequence is a row of 64-bit ids. A branch looks at one place of the rows and has children for ranges of ids; a child is
a container, which holds rows with counts, or a further branch. A container that grows beyond ``burst`` rows is split: into two ranges, or,
where one id has most of its rows, into that id with a branch of its own and what lies on both sides. Branches go down
``depth`` places, containers below them grow on. When the trie holds over ``most`` rows, its largest subtree within
half of that is taken out whole, as a run in the order of ids, and counting goes on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

Rows = tuple[np.ndarray, np.ndarray]

BURST = 1 << 16
MOST = 1 << 21
DEPTH = 3
_LAST = np.uint64(2**64 - 1)


def merged(rows: np.ndarray, counts: np.ndarray) -> Rows:
    """Distinct rows in order, with their summed counts."""
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[first], np.add.reduceat(counts[order], first)


class Container:
    def __init__(self, parts: list[Rows] = ()):
        self.parts = list(parts)
        self.size = sum(len(rows) for rows, _ in self.parts)
        self.settled = self.size  # rows when the parts were last merged

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((rows, counts))
        self.size += len(rows)

    def all(self) -> Rows:
        """The rows in order."""
        if len(self.parts) > 1:
            self.parts = [merged(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.size = len(self.parts[0][0])
        self.settled = self.size
        return self.parts[0]

    def runs(self) -> Iterator[Rows]:
        if self.size:
            yield self.all()


class Branch:
    def __init__(self, place: int, child: Container):
        self.place = place
        self.lows = np.zeros(1, dtype=np.uint64)
        self.children: list[Container | Branch] = [child]

    @property
    def size(self) -> int:
        return sum(child.size for child in self.children)

    def add(self, rows: np.ndarray, counts: np.ndarray, burst: int, depth: int) -> None:
        """Adds distinct rows that are in order."""
        cuts = np.append(np.searchsorted(rows[:, self.place], self.lows), len(rows))
        for i in reversed(np.flatnonzero(np.diff(cuts)).tolist()):  # from the end: a split moves later children only
            part = rows[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]]
            child = self.children[i]
            if isinstance(child, Branch):
                child.add(*part, burst, depth)
                continue
            child.add(*part)
            if child.size > burst and child.size > 2 * child.settled:
                child.all()
            if child.settled == child.size > burst:
                self.split(i, depth)

    def split(self, i: int, depth: int) -> None:
        """Splits a container: at its middle id, or around that id if it has half of the rows or more."""
        rows, counts = self.children[i].all()
        ids = rows[:, self.place]
        middle = ids[len(ids) // 2]
        a, b = (int(np.searchsorted(ids, middle, side=side)) for side in ("left", "right"))
        heavy = b - a >= len(ids) // 2
        if heavy and self.place + 1 >= min(depth, rows.shape[1]):
            return
        cuts = [(0, a, self.lows[i]), (a, b if heavy else len(ids), middle)] if a else [(0, b, middle)]
        if a and heavy or not a:
            cuts.append((b, len(ids), middle + np.uint64(middle < _LAST)))
        children = [Container([(rows[x:y], counts[x:y])]) for x, y, _ in cuts]
        if heavy:
            k = 1 if a else 0
            children[k] = Branch(self.place + 1, children[k])
            if middle == _LAST:  # no id stands behind it
                children, cuts = children[:-1], cuts[:-1]
        lows = [low for _, _, low in cuts]
        lows[0] = self.lows[i] if not heavy or a else lows[0]
        if lows[0] > self.lows[i]:
            children, lows = [Container(), *children], [self.lows[i], *lows]
        self.children[i : i + 1] = children
        self.lows = np.concatenate([self.lows[:i], np.array(lows, dtype=np.uint64), self.lows[i + 1 :]])

    def runs(self) -> Iterator[Rows]:
        for child in self.children:
            yield from child.runs()

    def take(self, most: int) -> Iterator[Rows]:
        """Takes out the largest subtree, going down while it holds over ``most`` rows."""
        i = max(range(len(self.children)), key=lambda k: self.children[k].size)
        child = self.children[i]
        if isinstance(child, Branch) and child.size > most:
            yield from child.take(most)
        else:
            self.children[i] = Container()
            yield from child.runs()


class HatTrie:
    """Counts rows of ``width`` ids."""

    def __init__(self, width: int, burst: int = BURST, most: int = MOST, depth: int = DEPTH):
        self.width, self.burst, self.most, self.depth = width, burst, most, depth
        self.root = Branch(0, Container())

    def add(self, rows: np.ndarray) -> Iterator[Rows]:
        """Counts rows; gives out the runs that had to go."""
        if len(rows):
            self.root.add(*merged(rows, np.ones(len(rows), dtype=np.int64)), self.burst, self.depth)
        while self.root.size > self.most:
            yield from self.root.take(self.most // 2)

    def finish(self) -> Iterator[Rows]:
        yield from self.root.runs()
        self.root = Branch(0, Container())
