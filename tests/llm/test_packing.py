"""The genetic algorithm earns its place: fewer bins than best-fit decreasing, or the lower bound, on lengths of real texts."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from fleetmart.llm import packing


@pytest.fixture(scope="module")
def groups():
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()
    sizes = [n for t in texts if (n := len(t or "") // 4 % 1024)]
    return [sizes[i : i + 3000] for i in range(0, len(sizes) - 3000, 3000)]


def best_of_islands(sizes, generations):
    """Two islands and two epochs, as the operator runs them."""
    found = [packing.evolve(sizes, 1024, [], seed, generations) for seed in (1, 2)]
    found = [packing.evolve(sizes, 1024, [found[i], found[1 - i]], seed, generations) for i, seed in enumerate((3, 4))]
    return min(found, key=lambda b: packing.fitness(sizes, 1024, b))


def test_every_group_beats_best_fit_or_is_at_the_bound(groups):
    gained = 0
    for sizes in groups:
        least = -(-sum(sizes) // 1024)
        plain = packing.packed(sizes, 1024, sorted(range(len(sizes)), key=lambda i: -sizes[i]))
        bins = best_of_islands(sizes, packing.GENERATIONS)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and max(sum(sizes[i] for i in b) for b in bins) <= 1024
        assert len(bins) < len(plain) or len(bins) == least
        gained += len(plain) - len(bins)
        assert len(best_of_islands(sizes, 0)) == len(plain)  # without generations there is nothing but best fit
    assert gained > 0


def test_local_search_keeps_pieces_and_gathers_room():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 100, 300).tolist()
        bins = packing.packed(sizes, 100, rng.permutation(300).tolist())
        after = packing.drained(sizes, 100, bins, rng)
        assert sorted(i for b in after for i in b) == list(range(300)) and all(after)
        assert max(sum(sizes[i] for i in b) for b in after) <= 100
        full = lambda found: sum(sum(sizes[i] for i in b) == 100 for b in found)
        assert full(after) >= full(bins) - packing.POOL
    assert packing.drained([5], 10, [[0]], rng) == [[0]]
