"""Small tables and brute-force versions for the tests of this folder."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _spans string, size int"


def docs(spark, rows):
    """``rows``: (doc_id, text[, lang, source]); with columns whose names clash."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *(None,) * (4 - len(r)))
        full.append((doc_id, text, lang, source, len(text or ""), "clash", 7))
    return spark.createDataFrame(full, DOCS)


def words(n: int, seed: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def components(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
