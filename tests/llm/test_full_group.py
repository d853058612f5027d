"""Bin completion on groups of the size that production packs."""

import random

from playlens.llm import packing


def test_a_full_group_gets_better_than_best_fit():
    draw = random.Random(11)
    for low, high, gain in ((400, 1000, 100), (300, 1400, 5)):
        sizes = [draw.randint(low, high) for _ in range(packing.GROUP)]
        bins = packing.bin_completion(sizes, 2048)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 2048 for b in bins)
        assert packing.lower_bound(sizes, 2048) <= len(bins) <= len(packing.best_fit(sizes, 2048)) - gain


def test_fillings_have_any_number_of_pieces():
    left = packing._Left([100] * 9 + [51], 2048)
    assert packing.fillings(951, left, 0) == [(100,) * 9 + (51,)]
    assert left.counts[100] == 9 and left.present == 1 << 100 | 1 << 51
