import random

from mixwright.llm.align import banded_distance, best_occurrence, masks


def table(a, b, free_start=False):
    rows = [[0 if free_start else j for j in range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
        rows.append(row)
    return rows


def test_banded_distance_is_the_edit_distance_within_the_band():
    rng = random.Random(3)
    for _ in range(3000):
        a = [rng.randrange(3) for _ in range(rng.randrange(0, 14))]
        b = a[:] if rng.random() < 0.5 else [rng.randrange(3) for _ in range(rng.randrange(0, 14))]
        for _ in range(rng.randrange(0, 4)):
            if b:
                p = rng.randrange(len(b))
                b[p : p + rng.randrange(0, 2)] = [rng.randrange(3)] * rng.randrange(0, 3)
        k = rng.randrange(0, 9)
        d = table(a, b)[-1][-1]
        assert banded_distance(a, b, k) == (d if d <= k else None), (a, b, k, d)


def test_best_occurrence_is_the_least_over_all_parts():
    rng = random.Random(4)
    for _ in range(1500):
        a = [rng.randrange(3) for _ in range(rng.randrange(1, 10))]
        b = [rng.randrange(3) for _ in range(rng.randrange(0, 20))]
        last = table(a, b, free_start=True)[-1]
        best, end = best_occurrence(masks(a), len(a), b)
        assert best == min(last) and last[end] == best
