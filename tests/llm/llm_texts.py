"""Made-up texts for the tests."""


def prose(seed: int, n: int) -> str:
    """``n`` made-up words, the same for the same seed."""
    import random

    rng = random.Random(seed)
    parts = ["ka", "ru", "ti", "mo", "sen", "dal", "vi", "por", "lux", "en"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))
