"""Random texts."""


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def near(rng, text, words, share):
    """A copy with a share of its words replaced."""
    return " ".join(rng.choice(words) if rng.random() < share else w for w in text.split(" "))
