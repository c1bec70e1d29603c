"""Alignment by bit vectors: a band or a column of the edit-distance table as one integer."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


def masks(pattern: Sequence[Hashable]) -> dict[Hashable, int]:
    """For each symbol the places of ``pattern`` at which it stands, as bits."""
    out: dict[Hashable, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def banded_distance(a: Sequence[Hashable], b: Sequence[Hashable], k: int) -> int | None:
    """Edit distance of ``a`` and ``b`` if it is at most ``k``, else None, from the cells within ``k`` of the main diagonal.

    Column j is held as the rows j - k to j + k, a bit each, and moves down a row with every column. up and down say where
    the distance grows or falls from a row to the next; free says which diagonal steps cost nothing. The distance is followed
    along the band's lowest diagonal and then back up the last column.
    """
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return None
    width = 2 * k + 1
    full, lowest = (1 << width) - 1, 1 << (width - 1)
    where = masks(a)
    up, down = full & ~((1 << k) - 1), (1 << k) - 1
    distance = k
    for j in range(1, m + 1):
        bits = where.get(b[j - 1], 0)
        match = (bits >> (j - k - 1) if j > k else bits << (k + 1 - j)) & full
        free = ((((match & up) + up) ^ up) | match | down) & full
        right_up, right_down = (down | ~(free | up)) & full, free & up
        if not free & lowest:
            distance += 1
        up = (right_down | ~((free >> 1) | right_up)) & full
        down = (free >> 1) & right_up
    for row in range(m + 2 * k, n + k, -1):
        bit = 1 << (row - m - 1)
        distance += bool(down & bit) - bool(up & bit)
    return distance if distance <= k else None


def best_occurrence(where: dict[Hashable, int], n: int, text: Sequence[Hashable]) -> tuple[int, int]:
    """The least edit distance of a pattern (its masks and length) to any part of ``text``, and the first place at which such a
    part ends."""
    full, last = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = full, 0, n
    best, end = n, 0
    for j, c in enumerate(text, 1):
        match = where.get(c, 0)
        free = ((((match & up) + up) ^ up) | match | down) & full
        right_up, right_down = (down | ~(free | up)) & full, free & up
        if right_up & last:
            distance += 1
        elif right_down & last:
            distance -= 1
        if distance < best:
            best, end = distance, j
        right_up, right_down = right_up << 1, right_down << 1
        up = (right_down | ~(free | right_up)) & full
        down = right_up & free & full
    return best, end
