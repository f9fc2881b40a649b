"""Plain versions of what the operators compute."""

from __future__ import annotations


def components(n: int, pairs) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(n)]


def rows(df, key):
    return {r[key]: r for r in df.collect()}


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **more):
    """Documents with ids 0, 1, ... of ``texts``; ids may be given as pairs."""
    data = [(t if isinstance(t, tuple) else (i, t)) + ("en", f"src{i % 3}", len((t[1] if isinstance(t, tuple) else t) or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, DOCS)
