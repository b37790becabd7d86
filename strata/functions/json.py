"""JSON column functions (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_json_object(value: Column) -> Column:
    """True iff ``value`` parses as a JSON object.

    Uses the strict variant parser: truncated text, single quotes, bare keys and
    duplicate keys fail; arrays, scalars, ``null`` and empty text are not
    objects. NULL input gives NULL.
    """
    # A document that parses and opens with a brace is an object; cheaper than
    # asking for the variant's schema.
    is_object = F.try_parse_json(value).isNotNull() & value.rlike(r"^\s*\{")
    return F.when(value.isNotNull(), F.coalesce(is_object, F.lit(False)))


def parse(value: Column, schema: str, strict: bool = False) -> Column:
    """``from_json`` with a declared schema; ``strict`` fails the job on bad
    records (the parse-or-throw behaviour), otherwise bad records give NULL."""
    return F.from_json(value, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def path(value: Column, json_path: str) -> Column:
    """String at a JSON path such as ``$.common.mid``; NULL when absent."""
    return F.get_json_object(value, json_path)
