"""Made-up text for tests."""

import numpy as np


def prose(n, seed):
    """Text of its own words, ``n`` of them, that passes the quality rules."""
    common = "the of and to in is that it for was on be".split()
    chance = np.random.default_rng(seed)
    return " ".join(common[chance.integers(12)] if i % 3 == 0 else "".join(map(chr, chance.integers(97, 123, 6)))
                    for i in range(n)) + "."
