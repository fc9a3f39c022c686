from __future__ import annotations

import numpy as np
import pytest

from lumenloom.llm import grammar_store as gs


@pytest.mark.parametrize("top", [300, 1 << 32])
def test_pairs_are_numbered_as_a_plain_count_does(top):
    """Sorted with their places as one number where that fits, else apart: the same pairs and places."""
    r = np.random.default_rng(3)
    symbols = r.integers(0, 12, 4000).astype(np.uint32)
    symbols[symbols == 11] = min(top, 1 << 32) - 1
    at = np.arange(0, 3998, 3)
    places, which, new = gs._pairs(symbols, at, top)
    pairs = [(int(symbols[i]), int(symbols[i + 1])) for i in at]
    often = sorted({p for p in pairs if pairs.count(p) >= gs.LEAST})
    assert [tuple(p) for p in new.tolist()] == often and len(often) > 20
    want = {int(i): p for i, p in zip(at, pairs) if p in often}
    assert {int(i): often[k] for i, k in zip(places, which)} == want and len(places) == len(want)


@pytest.mark.parametrize("size", [0, 1])
def test_no_pairs(size):
    places, which, new = gs._pairs(np.ones(2, np.uint32), np.zeros(size, np.int64), 300)
    assert places.size == which.size == 0 and new.shape == (0, 2)


def test_runs_of_one_symbol_come_back():
    """Long runs, where every pair is as frequent as the next, become rules that expand to the same ids."""
    r = np.random.default_rng(4)
    ids = np.repeat(r.integers(1, 40, 3000), r.integers(1, 30, 3000)).astype(np.uint32)
    lengths = np.full(ids.size // 7, 7)
    lengths = np.append(lengths, ids.size - lengths.sum()) if ids.size % 7 else lengths
    made = gs.repair(ids, lengths, 50)
    assert made["symbols"].size < ids.size / 2
    assert (gs.expand(made["symbols"], made["left"], made["right"], 50) == ids).all()
    whole = np.where(made["symbols"] < 50, 1, made["expansions"][np.maximum(made["symbols"].astype(int) - 50, 0)])
    assert (np.add.reduceat(whole, np.cumsum(made["cuts"]) - made["cuts"]) == lengths).all()
