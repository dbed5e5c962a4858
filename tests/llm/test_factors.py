"""Longest previous factors against comparing all pairs of suffixes."""

import numpy as np
import pytest

from gridlark.llm import repeats


def plain(text, starts, owner):
    raw = text.tobytes()
    out = []
    for s, o in zip(starts, owner):
        best = 0
        for t, p in zip(starts, owner):
            if p < o:
                n = 0
                while n < repeats.DEPTH and raw[s + n] == raw[t + n]:
                    n += 1
                best = max(best, n)
        out.append(best)
    return np.array(out)


@pytest.mark.parametrize("seed,letters", [(0, 2), (1, 3), (2, 250), (3, 1), (4, 2)])
def test_factors(seed, letters):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, letters, 400).astype(np.uint8)
    # Passages that repeat, some with one changed byte.
    for to in (120, 200, 290):
        text[to : to + 70] = text[20:90]
    text[230] ^= 1
    starts = rng.permutation(350)[:200]
    owner = rng.integers(0, [3, 40, 5, 7, 200][seed], 200)
    found = repeats.longest_previous_factors(text, starts, owner)
    assert (found == plain(text, starts, owner)).all()
    assert (repeats.earlier_matches(text, starts, owner) == (found >= repeats.DEPTH)).all()


def test_no_suffixes_and_rising_owners():
    text = np.zeros(5000, np.uint8)
    assert len(repeats.longest_previous_factors(text, np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
    starts = np.arange(4900)
    for owner in (starts, starts[::-1], np.zeros(4900, np.int64)):
        found = repeats.longest_previous_factors(text, starts, owner)
        assert (found == np.where(owner > owner.min(), repeats.DEPTH, 0)).all()
