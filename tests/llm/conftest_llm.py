"""Helpers that the tests import."""

import random


def prose(seed, words: int) -> str:
    draw = random.Random(seed)
    parts = "ka lo mi re su ta no ve di po ra fe zu be".split()
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(words))
