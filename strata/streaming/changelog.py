"""Unbounded two-stream joins with retractions, on Spark's keyed state.

Both streams travel as one, tagged by side, to ``transformWithState``: the state of a
key is one list of rows per side, in RocksDB. A micro-batch touches the keys of its
own rows only: new left rows meet all right rows of their key, and old left rows the
new right ones. For outer joins a row without a partner is emitted at once as
``+I (row, NULL)``; when its key's first partner arrives, that row is retracted
(``-D``). With a time to live Spark drops each row that long after it came.

Rows keep their types as struct columns. Rows with a NULL key match nothing and are
not kept; they are dealt over ``NULL_SALTS`` keys. A hot key of the side that a
``left`` or ``right`` join keeps (or of an inner join's left side) can be dealt over
``salts`` tasks: each of its rows goes to one of them, each row of the other side to
all. A full join knows no such side.

Every key that a batch touches costs several calls between the Python worker and the
state store, and every typed row its conversion, many times the join itself. With
``groups`` the keys are dealt over that many lists per side: a batch reads and appends
once per group, reads the groups of its own keys, and rows travel as JSON text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strata.streaming.state import pack, unpack

NULL_SALTS = 64
# Columns of grouped joins: types that JSON text keeps exactly, and keys that text tells apart.
GROUPED_KEYS = (T.IntegralType, T.StringType, T.DateType, T.DecimalType)
GROUPED_COLUMNS = (T.NumericType, T.StringType, T.DateType, T.BooleanType, T.TimestampType, T.TimestampNTZType)
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def tag_sides(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left",
              salts: int = 1, groups: int | None = None) -> DataFrame:
    """One stream of both sides: ``side, key, salt, l, r`` (the other side's struct NULL);
    with ``groups``, ``side, key, slot, row`` (slot: the key's group and salt; texts)."""
    if salts > 1 and how == "full":
        raise ValueError("a full join cannot be salted: both sides keep unmatched rows")
    ltype, rtype = left.schema.simpleString(), right.schema.simpleString()
    key_type = left.schema[left_key].dataType
    dealt = "R" if how == "right" else "L"
    if groups is not None:
        odd = [f.name for f in (*left.schema, *right.schema) if not isinstance(f.dataType, GROUPED_COLUMNS)]
        if odd or not isinstance(key_type, GROUPED_KEYS):
            raise ValueError(f"no grouped join on {key_type.simpleString()} or with columns {odd}")

    def side(df: DataFrame, name: str, key: str, l, r) -> DataFrame:
        row_hash, own = F.xxhash64(*df.columns), F.col(key).cast(key_type)
        one = F.pmod(row_hash, F.when(F.col(key).isNull(), NULL_SALTS).otherwise(salts))
        every = F.array(one) if name == dealt else F.when(F.col(key).isNull(), F.array(one)).otherwise(
            F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
        if groups is None:
            return df.select(F.lit(name).alias("side"), own.alias("key"),
                             F.explode(every).alias("salt"), l.alias("l"), r.alias("r"))
        # Rows of a NULL key meet nothing: any group will do.
        group = F.pmod(F.when(own.isNull(), row_hash).otherwise(F.xxhash64(own)), F.lit(groups))
        slots = F.transform(every, lambda salt: group * max(salts, NULL_SALTS) + salt)
        return df.select(F.lit(name).alias("side"), own.cast("string").alias("key"), F.explode(slots).alias("slot"),
                         F.to_json(F.struct(*df.columns), JSON).alias("row"))

    return side(left, "L", left_key, F.struct(*left.columns), F.lit(None).cast(rtype)).unionByName(
        side(right, "R", right_key, F.lit(None).cast(ltype), F.struct(*right.columns)))


def key_changes(how: str, held: bool, new: dict[str, list], old: dict[str, list]) -> Iterator[tuple]:
    """What a batch's new rows of one key change, given the rows of that key in the
    state: ``op``, left row, right row. ``held`` is False for the NULL key."""
    def pair(side: str, op: str, own, other) -> tuple:
        return (op, own, other) if side == "L" else (op, other, own)

    for side, other in (("L", "R"), ("R", "L")):
        padded = how in ("full", "left" if side == "L" else "right")
        partners = old[other] + new[other] if held else []
        for row in new[side]:
            if padded and not partners:
                yield pair(side, "+I", row, None)
            # Two new rows meet once, as partners of the left one.
            for partner in partners if side == "L" else old[other]:
                yield pair(side, "+I", row, partner)
        if padded and held and new[other] and not old[other]:
            for row in old[side]:
                yield pair(side, "-D", row, None)


class RetractingJoin(StatefulProcessor):
    def __init__(self, left: T.StructType, right: T.StructType, how: str, ttl_ms: int | None):
        self.kinds, self.how, self.ttl_ms = {"L": left, "R": right}, how, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = {side: handle.getListState(name, self.kinds[side], self.ttl_ms)
                     for side, name in (("L", "left_rows"), ("R", "right_rows"))}

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[str, list[tuple]] = {"L": [], "R": []}
        for row in rows:
            one = row.l if row.side == "L" else row.r
            # A struct column arrives as a dict or a Row; its fields keep their order.
            new[row.side].append(tuple(one.values() if isinstance(one, dict) else one))
        held = key[0] is not None
        # A side's old rows matter only where the other side has new ones.
        old = {side: list(self.rows[side].get()) if held and new[other] else []
               for side, other in (("L", "R"), ("R", "L"))}
        named = Row("op", *self.kinds["L"].names, *self.kinds["R"].names)
        for op, left, right in key_changes(self.how, held, new, old):
            yield named(op, *(left or (None,) * len(self.kinds["L"])), *(right or (None,) * len(self.kinds["R"])))
        for side in ("L", "R"):
            if held and new[side]:
                self.rows[side].appendList(new[side])

    def close(self) -> None:
        pass


class GroupedRetractingJoin(StatefulProcessor):
    """The same for a group of keys at once, on rows as texts."""

    def __init__(self, how: str, ttl_ms: int | None):
        self.how, self.ttl_ms = how, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = {side: handle.getListState(name, "packed BINARY", self.ttl_ms)
                     for side, name in (("L", "left_rows"), ("R", "right_rows"))}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new: dict[str, dict] = {"L": {}, "R": {}}
        for part in rows:
            for side, own, row in zip(part["side"], part["key"], part["row"], strict=True):
                new[side].setdefault(own, []).append(row)
        old: dict[str, dict] = {"L": {}, "R": {}}
        for side, other in (("L", "R"), ("R", "L")):
            met = new[other].keys() - {None}
            for own, several in unpack(self.rows[side]) if met else ():
                if own in met:
                    old[side].setdefault(own, []).extend(several)
        out = []
        for own in {**new["L"], **new["R"]}:
            out += key_changes(self.how, own is not None, *(
                {side: found[side].get(own, []) for side in ("L", "R")} for found in (new, old)))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["op", "l", "r"], dtype=object)
                out = []
        if out:
            yield pd.DataFrame(out, columns=["op", "l", "r"], dtype=object)
        for side in ("L", "R"):
            if kept := [(own, several) for own, several in new[side].items() if own is not None]:
                self.rows[side].appendValue(pack(kept))

    def close(self) -> None:
        pass


def changes(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left",
            ttl_s: float | None = None, salts: int = 1, groups: int | None = None) -> DataFrame:
    """The stream of changes (``op``, then the columns of both sides) of the join
    (inner, left, right, full) of two streams."""
    if both := {c.lower() for c in left.columns} & {c.lower() for c in right.columns}:
        raise ValueError(f"rename the columns that both sides have: {sorted(both)}")
    ttl_ms, time_mode = (None, "None") if ttl_s is None else (int(ttl_s * 1000), "ProcessingTime")
    tagged = tag_sides(left, right, left_key, right_key, how, salts, groups)
    if groups is not None:
        found = tagged.groupBy("slot").transformWithStateInPandas(
            GroupedRetractingJoin(how, ttl_ms), "op STRING, l STRING, r STRING", "Append", time_mode)
        sides = [F.from_json(name, df.schema, JSON).alias(name) for name, df in (("l", left), ("r", right))]
        return found.select("op", *sides).select("op", "l.*", "r.*")
    spec = T.StructType([T.StructField("op", T.StringType()), *[
        T.StructField(f.name, f.dataType) for f in (*left.schema.fields, *right.schema.fields)]])
    return tagged.groupBy("key", "salt").transformWithState(
        RetractingJoin(left.schema, right.schema, how, ttl_ms), spec, "Append", time_mode)


def materialize(changes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Apply a changelog: net count of ``+I`` minus ``-D`` per row, rows with a
    positive count kept (repeated as often as they occur)."""
    net = changes.groupBy(*cols).agg(
        F.sum(F.when(F.col("op") == "-D", -1).otherwise(1)).alias("_n"))
    return net.where(F.col("_n") > 0).select(
        *cols, F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))).alias("_one")).drop("_one")
