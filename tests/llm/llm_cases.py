"""Made texts for the tests of this folder."""

import random


def sentences(seed: int, n: int, words: int = 40, vocabulary: int = 12, copies: float = 0.4) -> list[str]:
    """Texts of a small vocabulary, many of them near copies of earlier ones."""
    rng = random.Random(seed)
    out: list[list[str]] = []
    for _ in range(n):
        if out and rng.random() < copies:
            text = list(rng.choice(out))
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"v{rng.randrange(vocabulary * 30)}"
        else:
            text = [f"v{rng.randrange(vocabulary * 30) if rng.random() < 0.8 else rng.randrange(3)}" for _ in range(rng.randrange(1, words))]
        out.append(text)
    return [rng.choice([" ", "\n", "  "]).join(x) for x in out]
