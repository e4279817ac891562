"""Groups of near-duplicate candidates in one task: the work follows what can be linked, not the square of the members."""

import time

import numpy as np
import pytest

from loomtab.llm import neardup


def unions(sets):
    """Components by comparing all pairs of plain sets."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    plain = [set(s.tolist()) for s in sets]
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(plain[i] & plain[j]) >= 75 * len(plain[i] | plain[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("seed", range(12))
def test_components_by_all_pairs(seed):
    rng = np.random.default_rng(seed)
    fresh = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    base, sets = fresh(40), []
    for _ in range(70):
        s = np.concatenate((rng.choice(base, rng.integers(1, 41), False), fresh(rng.integers(0, 12))))
        if sets and rng.random() < 0.4:
            s = sets[rng.integers(len(sets))].copy()
            s[rng.integers(len(s))] = fresh(1)[0]
        sets.append(np.unique(s))
    assert neardup.resolve_group(sets).tolist() == unions(sets)


@pytest.mark.parametrize("shared,own,linked", [(50, 50, False), (37, 63, False), (70, 30, False), (80, 10, True)])
def test_twenty_thousand_pages_of_a_template(shared, own, linked):
    """At the limit of a group's shingles: unlinked pages do not meet, and settled ones leave (it took minutes when all met all)."""
    rng = np.random.default_rng(1)
    template = rng.integers(0, 2**63, shared).astype(np.uint64)
    sets = [np.unique(np.concatenate((template, rng.integers(0, 2**63, own).astype(np.uint64)))) for _ in range(20_000)]
    began = time.process_time()
    root = neardup.resolve_group(sets)
    assert (root == (0 if linked else np.arange(20_000))).all() and time.process_time() - began < 60
