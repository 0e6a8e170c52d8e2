"""Bin packing of many items of few lengths, planned on the histogram of lengths.

A plan never holds items. Items of one length are interchangeable and numbered 0, 1, ...;
bins filled alike are kept as one run of bin numbers. A rule says where a run of items of
one length goes, so a plan's size depends on the capacity and not on the number of items.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

import numpy as np

#: Item numbers take so many bits of a key, lengths the rest.
_NUMBER_BITS = 48


class RoomTree:
    """Segment tree over the room left in bins, 0 to ``capacity``: is there a bin with that room?"""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.filled = [0] * (2 * self.size)

    def change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.filled[node] += by
            node >>= 1

    def least(self, length: int) -> int | None:
        """The smallest room of at least ``length`` that some bin has."""
        node = length + self.size
        if self.filled[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node + (0 if self.filled[2 * node] else 1)
                return node - self.size
            node >>= 1
        return None


class Plan:
    """Rules that place runs of items into runs of bins."""

    def __init__(self, capacity: int, histogram: Mapping[int, int]):
        if any(not 0 < n <= capacity for n in histogram):
            raise ValueError("lengths must lie between 1 and the capacity")
        self.capacity = capacity
        self.left = {n: c for n, c in histogram.items() if c}
        self.taken: dict[int, int] = defaultdict(int)
        self.bins = 0
        self.rooms = RoomTree(capacity)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rules: list[tuple[int, int, int, int, int, int]] = []

    def open(self, count: int) -> tuple[int, int]:
        self.bins += count
        return self.bins - count, count

    def keep(self, room: int, first: int, count: int) -> None:
        """Offer ``count`` bins from ``first`` on, each with ``room``, to later items."""
        if room and count:
            self.runs[room].append((first, count))
            self.rooms.change(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self.rooms.change(room, -1)
        return self.runs[room].pop()

    def place(self, length: int, first: int, bins: int, room: int, each: int = 1) -> int:
        """Put ``each`` items of ``length`` into each of ``bins`` bins from ``first`` on; the room left."""
        for k in range(each):
            start = self.taken[length]
            self.rules.append((length, start, first, 1, self.capacity - room + k * length, 0))
            self.taken[length] += bins
            self.left[length] -= bins
        return room - each * length

    def stack(self, length: int, number: int, items: int, room: int) -> int:
        """Put ``items`` items of ``length`` into the one bin ``number``."""
        self.rules.append((length, self.taken[length], number, 0, self.capacity - room, length))
        self.taken[length] += items
        self.left[length] -= items
        return room - items * length

    def best_fit_decreasing(self) -> None:
        """Longest first, each into the fullest bin that takes it, else into a new one.

        A bin that is the best fit for an item stays so for equal items until they no longer fit.
        """
        for length in sorted((n for n, c in self.left.items() if c), reverse=True):
            while items := self.left[length]:
                room = self.rooms.least(length)
                if room is None:
                    room, (first, count) = self.capacity, self.open(-(-items // (self.capacity // length)))
                else:
                    first, count = self.take(room)
                each = room // length
                full = min(count, items // each)
                if full:
                    self.keep(self.place(length, first, full, room, each), first, full)
                if full < count and (rest := self.left[length]):
                    self.keep(self.stack(length, first + full, rest, room), first + full, 1)
                    full += 1
                if full < count:
                    self.keep(room, first + full, count - full)

    def table(self) -> np.ndarray:
        """Rules ordered by length and first item: length, first item, bin, bin step, offset, offset step."""
        return np.array(sorted(self.rules), np.int64).reshape(-1, 6)


def placed(rules: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of each item, given by its length and number."""
    at = np.searchsorted((rules[:, 0] << _NUMBER_BITS) + rules[:, 1], (lengths << _NUMBER_BITS) + numbers, "right") - 1
    rule = rules[at]
    step = numbers - rule[:, 1]
    return rule[:, 2] + step * rule[:, 3], rule[:, 4] + step * rule[:, 5]
