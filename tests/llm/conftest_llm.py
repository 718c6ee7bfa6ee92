"""Helpers shared by the tests of this folder."""


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}x{rng.randrange(7)}" for _ in range(n))
