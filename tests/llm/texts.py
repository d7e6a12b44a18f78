"""Invented words and prose for tests."""

VOWELS, OTHERS = "aeiou", "bcdfghklmnprstvz"


def word(rng):
    return "".join(rng.choice(OTHERS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))
