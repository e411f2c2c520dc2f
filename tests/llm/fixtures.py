"""Small tables with the cases every operator must bear, and brute-force helpers."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(words: int, seed: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def edited(text: str, every: int, seed: int) -> str:
    """The text with one word in ``every`` replaced."""
    rng, words = random.Random(seed), text.split(" ")
    for k in range(0, len(words), every):
        words[min(len(words) - 1, k + rng.randrange(every))] = f"edit{rng.randrange(10_000)}"
    return " ".join(words)


def awkward_texts() -> list[str | None]:
    """Null, empty, white space, one word, other scripts, exact and near copies, a very long text."""
    base = prose(300, 1)
    return [None, "", " \n\t ", "one", "One", "ÄÖ ÄÖ\x85next\xa0word", "日本語 のテキスト\r\nzeile  zwei drei",
            base, base, base.upper(), edited(base, 60, 2), edited(base, 60, 3), edited(base, 5, 4), prose(50_000, 5, 5000),
            "a a a a a a a a a a a a", "x\n" * 40, "🙂🙃 emoji 👩‍👩‍👧‍👦 end", "don't we'll it's 12345 67 !!! ... ###"]


def documents(spark, texts: list[str | None] | None = None):
    """Documents with awkward texts, null fields, a repeated row and a row without an id."""
    texts = awkward_texts() if texts is None else texts
    rows = [(k, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", None if t is None else len(t))
            for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[7], (None, "text without an id", None, "src1", None)], DOCS)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def smallest_reachable(nodes, links) -> dict:
    """Smallest node of every node's component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}
