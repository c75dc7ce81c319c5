import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Sentences of invented words, the same ones for the same seed."""

    def make(seed, n_words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("ae io nu re th st".split()) + rng.choice("lmnrst") for _ in range(rng.randint(1, 3))) for _ in range(n_words))

    return make
