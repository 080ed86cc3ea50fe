"""Small awkward tables for the tests of the llm operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, score string, kept string, removed string, bin string, row string, token string"
LABELS = "doc_id long, quality int, toxic int, text string"


def documents(spark, rows):
    """Documents with extra columns whose names clash with those the operators make."""
    full = [(i, t, lang, "s", len(t) if t is not None else None, "x", "y", None, "z", "b", "r", "t") for i, t, lang in rows]
    return spark.createDataFrame(full, DOCS)


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def awkward(spark, lang="en"):
    """Nulls, empty and very long texts, repeated rows, a null id."""
    long = " ".join(words(5, 30_000))
    rows = [(1, None, lang), (2, "", lang), (3, " \n\t ", None), (4, long, lang), (5, long, lang), (6, "One two", lang), (6, "One two", lang), (None, "null id", lang), (7, "ünï çødé €", lang)]
    return documents(spark, rows)


def as_dict(df, *values):
    return {r["doc_id"]: tuple(r[v] for v in values) for r in df.collect()}
