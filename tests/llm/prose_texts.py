"""Invented texts for the tests of this folder."""

from __future__ import annotations

import random


def prose(words: int, seed: int) -> str:
    draw = random.Random(seed)
    stems = ["the", "of", "and", "tion", "ing", "er", "ha", "re", "est", "ly", "on", "at"]
    return " ".join("".join(draw.choice(stems) for _ in range(draw.randint(1, 4))) for _ in range(words))
