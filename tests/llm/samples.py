"""Texts for the tests of this folder."""

import random

WORDS = "the of and river stone cloud north green lamp seven window paper bread salt wind harbour".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice([".", ",", ""]) if i % 7 == 6 else "") for i in range(n))
