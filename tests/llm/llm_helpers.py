"""Texts and a plain union-find that several tests use."""

import random

#: Rows that every operator must take: null, empty, blank, repeated, accented, very long, tied.
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


def text(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(words))


def odd_texts() -> list[str | None]:
    return [
        None, "", " \n\t ", "one", "ünï çødé 日本 😀", text(1, 60), text(1, 60), text(2, 300) + "\n" + text(2, 300),
        "same line\nsame line\n\nother", "a" * 5000, " " * 3000, text(3, 20_000), "Don't   stop\x0bnow",
        "<|endoftext|> spelled out",
    ]


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
