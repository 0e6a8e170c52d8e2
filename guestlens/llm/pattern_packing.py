"""Sequence packing by patterns: few-document length patterns fitted to the length histogram.

Lengths are rounded up to classes of ``step`` tokens. All patterns of one, two or three
classes that fill a sequence exactly are enumerated, their repeat counts are fitted to the
histogram by non-negative least squares, rounded down, and cut to the documents there are.
What is left over goes, longest first, into the fullest sequence that still takes it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from guestlens.llm.bins import Plan
from guestlens.llm.frames import stored
from guestlens.llm.pieces import assigned, histogram, token_pieces

CAPACITY = 4096
CLASS_STEP = 8
ROUNDS = 3000


def patterns(classes: np.ndarray, total: int) -> np.ndarray:
    """Every way to add up one, two or three of ``classes`` to ``total``; missing parts are 0."""
    classes = np.unique(classes)
    present = np.zeros(total + 1, bool)
    present[classes] = True
    out = []
    if present[total]:
        out.append(np.array([[total, 0, 0]]))
    for large in classes[::-1]:
        rest = total - large
        if rest <= 0:
            continue
        if rest <= large and present[rest]:
            out.append(np.array([[large, rest, 0]]))
        middle = classes[(classes <= large) & (classes < rest)]
        small = rest - middle
        good = (small <= middle) & present[small]
        if good.any():
            out.append(np.stack([np.full(good.sum(), large), middle[good], small[good]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fitted(found: np.ndarray, wanted: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring the documents used by the patterns near ``wanted``.

    Accelerated projected gradient on the least squares; a pattern has three entries at
    most, so products with the pattern matrix are gathers and bin counts.
    """
    if not len(found):
        return np.zeros(0)
    size = len(wanted)
    used = (found > 0).astype(float)
    used_by = lambda x: sum(np.bincount(found[:, k], x * used[:, k], size) for k in range(3))
    back = lambda r: sum(r[found[:, k]] * used[:, k] for k in range(3))
    probe = np.ones(len(found))
    for _ in range(30):
        probe = back(used_by(probe))
        top = np.linalg.norm(probe)
        probe /= top
    step = 1 / (1.05 * top)
    x = y = np.zeros(len(found))
    pace = 1.0
    for _ in range(rounds):
        after = np.maximum(y + step * back(wanted - used_by(y)), 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y = after + (pace - 1) / faster * (after - x)
        if np.abs(after - x).max() < 1e-3 * max(1.0, after.max()) / 100:
            return after
        x, pace = after, faster
    return x


def pattern_plan(lengths: dict[int, int], capacity: int = CAPACITY, step: int = CLASS_STEP) -> Plan:
    """The plan for a histogram of lengths: patterns first, then best fit for the rest."""
    plan = Plan(capacity, lengths)
    if not lengths:
        return plan
    total = capacity // step
    members: dict[int, list[int]] = {}
    wanted = np.zeros(total + 1)
    for length in sorted(lengths):
        kind = -(-length // step)
        if kind <= total:
            members.setdefault(kind, []).append(length)
            wanted[kind] += lengths[length]
    found = patterns(np.array(sorted(members), np.int64), total)
    repeats = np.floor(fitted(found, wanted) + 1e-6).astype(np.int64)
    for pattern, count in zip(found.tolist(), repeats.tolist(), strict=True):
        if count:
            _repeat(plan, [k for k in pattern if k], count, members)
    plan.best_fit_decreasing()
    return plan


def _repeat(plan: Plan, pattern: list[int], count: int, members: dict[int, list[int]]) -> None:
    """``count`` sequences of one pattern, or as many as there are documents for."""
    have = {k: sum(plan.left[n] for n in members[k]) for k in pattern}
    count = min(count, *(have[k] // pattern.count(k) for k in pattern))
    if not count:
        return
    runs = [(*plan.open(count), plan.capacity)]
    for kind in pattern:
        after = []
        for first, bins, room in runs:
            while bins:
                length = next(n for n in reversed(members[kind]) if plan.left[n])
                part = min(bins, plan.left[length])
                after.append((first, part, plan.place(length, first, part, room)))
                first, bins = first + part, bins - part
        runs = after
    for first, bins, room in runs:
        plan.keep(room, first, bins)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, step: int = CLASS_STEP) -> DataFrame:
    """Every piece of every document with its sequence: no id is dropped, padded or cut twice.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Sequences hold at
    most ``capacity`` ids and are filled from 0 without gaps. Null and empty texts are one end
    id; repeated rows are packed as often as they occur; an empty table gives no rows; other
    columns of ``docs`` are not read. Equal lengths are told apart by doc_id and piece; which of
    two wholly equal rows comes first does not matter.

    Only the histogram of lengths, at most ``capacity`` rows, reaches the driver.
    """
    pieces = stored(token_pieces(docs, path, capacity))
    return assigned(pieces, pattern_plan(histogram(pieces), capacity, step).table())
