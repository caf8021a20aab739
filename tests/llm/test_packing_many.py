import random
from collections import Counter
from functools import lru_cache

import pytest

from pageloom.llm.packing import best_fit, fillings, lower_bound, pack


def bins(patterns, counts, capacity):
    held = Counter()
    for pattern, m in patterns:
        assert sum(s * n for s, n in pattern) <= capacity and m > 0
        for s, n in pattern:
            held[s] += n * m
    assert held == Counter(counts)
    return sum(m for _, m in patterns)


def fewest(counts, capacity):
    """By trying each way to fill the bin of the largest piece."""

    @lru_cache(None)
    def solve(left):
        if not left:
            return 0
        best = len(left)

        def fill(k, room, rest):
            nonlocal best
            best = min(best, 1 + solve(rest))
            for i in range(k, len(rest)):
                if rest[i] <= room and (i == k or rest[i] != rest[i - 1]):
                    fill(i, room - rest[i], rest[:i] + rest[i + 1 :])

        fill(0, capacity - left[0], left[1:])
        return best

    return solve(tuple(sorted(Counter(counts).elements(), reverse=True)))


def test_six_pieces_a_bin():
    counts = {171: 400, 170: 200}
    assert bins(best_fit(counts, 1024), counts, 1024) == 114
    assert bins(pack(counts, 1024), counts, 1024) == lower_bound(counts, 1024) == 100


@pytest.mark.parametrize("pieces", [7, 9, 12])
def test_more_pieces_a_bin(pieces):
    capacity = 1024
    low = capacity // pieces
    long = capacity - low * pieces
    counts = {low + 1: long * 30, low: (pieces - long) * 30}
    plain = bins(best_fit(counts, capacity), counts, capacity)
    assert bins(pack(counts, capacity), counts, capacity) == 30 < plain


def test_fillings_of_any_number():
    got = list(fillings({5: 3, 4: 3, 3: 3, 2: 3}, 15, 0))
    assert {len(f) for f in got} == {3, 4, 5, 6} and all(sum(f) == 15 for f in got) and len(set(got)) == len(got)
    assert (3, 2, 2, 2) not in list(fillings({3: 1, 2: 3, 1: 2}, 11, 2))  # ones still fit
    assert (3, 2, 2, 2, 1, 1) in list(fillings({3: 1, 2: 3, 1: 2}, 11, 2))


@pytest.mark.parametrize("seed", range(25))
def test_small_cases_are_solved(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([2, 3, 4, 5, 7]) for _ in range(rng.randint(8, 13)))
    capacity = rng.choice([13, 17, 23])
    assert bins(pack(counts, capacity), counts, capacity) == fewest(counts, capacity)
