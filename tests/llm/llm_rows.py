"""Texts that the tests of all operators share."""

import random

WORDS = "alpha beta gamma delta omega river stone cloud maple tiger the and of to garden copper window".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(400)) for _ in range(words))


ODD = [
    (0, None),
    (1, ""),
    (2, " \t\n "),
    (3, "one"),
    (3, "one"),
    (4, "one  two"),
    (5, "one two"),
    (None, "one two"),
    (6, "ONE Two three, ünï 日本 😀 \x00 \x85\xa0 x"),
    (7, "long " * 30_000 + "end"),
    (8, prose(1, 60)),
    (9, prose(1, 60)),
    (9, None),
]
