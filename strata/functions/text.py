"""Delimited-text helpers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(text: Column, sep: str = ",") -> Column:
    """Split like ``String.split`` on the JVM: trailing empty strings are
    dropped (``"a,b,"`` → ``[a, b]``, ``",,"`` → ``[]``), leading and inner
    ones kept, and ``""`` gives ``[""]``. No trimming: ``"id, name"`` keeps
    ``" name"``."""
    pattern = re.escape(sep)
    stripped = F.regexp_replace(text, f"(?:{pattern})+$", "")
    return (F.when(text == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast("array<string>"))
             .otherwise(F.split(stripped, pattern)))


def parse_fields(line: Column, fields: Sequence[tuple[str, str]], sep: str = ",",
                 strict: bool = True) -> list[Column]:
    """Typed columns from one delimited line.

    ``strict`` casts with ANSI semantics (a bad number fails the job, as a
    strict per-line parser would); otherwise bad values become NULL.
    """
    parts = split_list(line, sep)
    out = []
    for i, (name, dtype) in enumerate(fields):
        raw = F.get(parts, i)
        typed = raw if dtype == "string" else (raw.cast(dtype) if strict else raw.try_cast(dtype))
        out.append(typed.alias(name))
    return out
