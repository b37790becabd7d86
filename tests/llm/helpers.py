"""Small inputs shared by the operator tests."""

from __future__ import annotations

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, ids=None, extra=""):
    """A documents table; ``extra`` adds clashing columns (name type, ...)."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}", None if t is None else len(t))
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    schema = DOC_SCHEMA + (", " + extra if extra else "")
    pad = (None,) * (extra.count(",") + 1 if extra else 0)
    return spark.createDataFrame([r + pad for r in rows], schema)


def pseudo_words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]
