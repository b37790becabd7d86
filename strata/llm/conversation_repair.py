"""Repair of conversation structure by Hirschberg's divide and conquer.

Rows of a conversation, in the order of their turn (nulls first; equal turns by
role, then by the text's digest), are kept, given another role, or deleted, and
empty rows are inserted, at least cost, so that the roles read ``(s?(ua)+)?``.
Four states tell where in that pattern a prefix ends: nothing yet, after a system
row, after a user row, after an assistant row. A forward vector holds the least
cost of every state, a backward vector the least cost from every state to the end.
Where both meet in the middle of a conversation, the cheapest state is the
crossing, and both halves are solved alone: linear space.

Equal costs: the edits whose initials (Delete, Insert, Keep, Rerole) read least in
ASCII win. Two states' edits never are prefixes of each other, as each ends with
an edit that consumes the same row, so their order survives whatever follows. The
forward vector therefore carries the states' order beside the costs, and of equally
cheap crossings the first in that order is right.

Bounded memory. Rows are range partitioned, sorted and written once, numbered in
that order, so a conversation with a third of all rows is spread over many tasks.
Blocks of at most ``BLOCK`` rows become one byte a row. A block's effect is a 4 by 4
table of costs and orders; the same recursion over these tables gives every block its
first and last state, and then the blocks are solved side by side. Rows and edits
meet again in a sorted stream: a task holds one block's edits, and a digest needs no
whole conversation in memory (it reads a conversation in one task, as SHA-256 does).

Cases: null ids are one conversation; null roles and texts are one space; a null
turn sorts first and opens no gap; an empty role fits no place in the pattern; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import to_arrow_schema, written

# The costs, and the white space that makes a row blank.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
# Where an inserted row leads, and the cost from a state to the end.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
NEVER = 1 << 60
BLOCK_BITS = 14

Vector = tuple[tuple[int, int], ...]


def follows(state: int, initial: str) -> int | None:
    """State after a row whose role begins with ``initial``; None if it can't stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=None)
def row_edits(code: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> (cost, edits) of one row: inserts, then the row."""
    initial, fault = (INITIALS + "?")[code % 4], code // 4
    out: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(a: int, b: int, cost: int, edits: str) -> None:
        if (cost, edits) < out.get((a, b), (NEVER, "")):
            out[a, b] = cost, edits

    for a in range(4):
        at, pad = a, ""
        for _ in range(3):
            paid = INSERT * len(pad)
            offer(a, at, paid + DELETE, pad + "D")
            if fault not in (BLANK, DUPLICATE):
                kept = paid + (CUT if fault == TRUNCATED else 0)
                if (to := follows(at, initial)) is not None:
                    offer(a, to, kept + KEEP, pad + "K")
                offer(a, NEXT[at], kept + REROLE, pad + "R")
            at, pad = NEXT[at], pad + "I"
    return out


@lru_cache(maxsize=None)
def row_moves(code: int) -> tuple[tuple[int, int, int, int], ...]:
    """The same as (before, after, cost, order of the edits among those of ``before``)."""
    edits = row_edits(code)
    order = {ab: k for k, ab in enumerate(sorted(edits, key=lambda ab: edits[ab][1]))}
    return tuple((a, b, edits[a, b][0], order[a, b]) for a, b in edits)


def only(state: int) -> Vector:
    return tuple((0 if s == state else NEVER, s) for s in range(4))


def ahead(vector: Vector, moves) -> tuple[Vector, int]:
    """The forward vector after ``moves``, less its smallest cost, and that cost."""
    best = [(NEVER, 4, s) for s in range(4)]
    for a, b, cost, order in moves:
        c, rank = vector[a]
        if c < NEVER and (c + cost, rank, order) < best[b]:
            best[b] = c + cost, rank, order
    ranks = {b: k for k, b in enumerate(sorted(range(4), key=lambda b: best[b][1:]))}
    low = min(c for c, _, _ in best)
    return tuple((c - low if c < NEVER else NEVER, ranks[b]) for b, (c, _, _) in enumerate(best)), low


def behind(costs: tuple[int, ...], moves) -> tuple[int, ...]:
    """The backward vector before ``moves``, less its smallest cost."""
    best = [NEVER] * 4
    for a, b, cost, _ in moves:
        best[a] = min(best[a], cost + costs[b])
    low = min(best)
    return tuple(c - low if c < NEVER else NEVER for c in best)


@lru_cache(maxsize=1 << 16)
def row_ahead(vector: Vector, code: int) -> tuple[Vector, int]:
    return ahead(vector, row_moves(code))


@lru_cache(maxsize=1 << 16)
def row_behind(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    return behind(costs, row_moves(code))


def crossings(steps: Sequence, first: int, last: int, forward: Callable = row_ahead,
              backward: Callable = row_behind) -> list[int]:
    """The state before, between and after ``steps`` on the cheapest way from
    ``first`` to ``last`` whose edits read least."""
    out = [first, *[START] * (len(steps) - 1), last]
    todo = [(0, len(steps))]
    while todo:
        low, high = todo.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        vector = only(out[low])
        for k in range(low, middle):
            vector, _ = forward(vector, steps[k])
        costs = tuple(0 if s == out[high] else NEVER for s in range(4))
        for k in range(high - 1, middle - 1, -1):
            costs = backward(costs, steps[k])
        out[middle] = min(range(4), key=lambda s: (vector[s][0] + costs[s], vector[s][1]))  # noqa: B023
        todo += [(low, middle), (middle, high)]
    return out


def last_state(vector: Vector) -> int:
    """The state in which a conversation with this forward vector ends best."""
    return min(range(4), key=lambda s: (vector[s][0] + INSERT * len(CLOSING[s]), vector[s][1]))


# ---------------------------------------------------------------------------
# Rows in order, their faults, and blocks of them
# ---------------------------------------------------------------------------

def damaged(convs: DataFrame) -> DataFrame:
    """``convs`` (conv_id, turn, role, text) with damage chosen by a checksum of id
    and turn: rows dropped, emptied, cut short, repeated or given to the user."""
    space = F.lit(" ")
    rows = convs.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                        F.coalesce("text", space).alias("text"),
                        (F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                                          F.coalesce(F.col("turn").cast("string"), space))) % 20).alias("how"))
    text = F.when(F.col("how") == 1, "").when(
        F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("how") == 3, 2).otherwise(1)))
    return rows.where("how <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                         copies.alias("copy")).drop("copy")


def ordered(convs: DataFrame) -> DataFrame:
    """The rows, numbered (``at``) in the order of conversation, turn, role and digest
    and written in that order."""
    space = F.lit(" ")
    rows = convs.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                        F.coalesce("text", space).alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    key = ["conv_id", "turn", "role", "digest"]
    spread = rows.withColumn("digest", digest).repartitionByRange(*key).sortWithinPartitions(*key)
    return written(spread.withColumn("at", F.monotonically_increasing_id()), "conversations")


def row_code() -> Column:
    """Initial and first fault of a row in one byte; ``fresh`` marks first copies."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(end == "", BLANK).when(F.col("fresh").isNull(), DUPLICATE).when(
        ~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    place = F.instr(F.lit(INITIALS), F.left(F.col("role"), F.lit(1))) - 1
    initial = F.when((F.col("role") == "") | (place < 0), 3).otherwise(place)
    return (initial + 4 * fault).cast("tinyint")


def blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, first, codes): runs of at most 2**BLOCK_BITS rows of a conversation."""
    firsts = rows.groupBy("conv_id", "digest").agg(F.min("at").alias("at")).select(
        "at", F.lit(True).alias("fresh"))
    # Row numbers are unique: the join has no hot key.
    coded = rows.join(firsts, "at", "left").select("conv_id", "at", row_code().alias("code"))
    grouped = coded.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "code"))).alias("rows"))
    return grouped.select("conv_id", F.col("rows")[0]["at"].alias("first"),
                          F.transform("rows", lambda r: r["code"]).alias("codes"))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's effect: (before, after, cost, order) flattened."""
    for batch in batches:
        moves = []
        for codes in batch.column("codes").to_pylist():
            flat: list[int] = []
            for a in range(4):
                vector, paid = only(a), 0
                for code in codes:
                    vector, low = row_ahead(vector, code)
                    paid += low
                for b, (cost, rank) in enumerate(vector):
                    if cost < NEVER:
                        flat += [a, b, paid + cost, rank]
            moves.append(flat)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("first"), pa.array(moves, pa.list_(pa.int64()))],
            names=["conv_id", "first", "moves"])


def _grouped(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """(conversation, is it a new one, row) of sorted batches."""
    held: object = _grouped
    for batch in batches:
        for conv, *row in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
            yield conv, conv != held, row
            held = conv


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last state of every block, from the tables of its conversation."""
    def solved(firsts: list[int], steps: list) -> pa.RecordBatch:
        vector = only(START)
        for moves in steps:
            vector, _ = ahead(vector, moves)
        path = crossings(steps, START, last_state(vector), ahead, behind)
        return pa.RecordBatch.from_arrays(
            [pa.array(firsts, pa.int64()), pa.array(path[:-1], pa.int32()), pa.array(path[1:], pa.int32()),
             pa.array([k + 1 == len(firsts) for k in range(len(firsts))])],
            names=["first", "before", "after", "ends"])

    firsts, steps = [], []
    for _, new, (first, flat) in _grouped(batches, ["conv_id", "first", "moves"]):
        if new and firsts:
            yield solved(firsts, steps)
            firsts, steps = [], []
        firsts.append(first)
        steps.append(tuple(zip(flat[::4], flat[1::4], flat[2::4], flat[3::4], strict=True)))
    if firsts:
        yield solved(firsts, steps)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block solved between its states: edits per row (with the last, those that
    end the conversation), cost, faults."""
    for batch in batches:
        edits, costs, faults = [], [], []
        for codes, before, after, ends in zip(*[batch.column(c).to_pylist() for c in (
                "codes", "before", "after", "ends")], strict=True):
            path = crossings(codes, before, after)
            found = [row_edits(c)[a, b] for c, a, b in zip(codes, path, path[1:], strict=False)]
            letters = [x for _, x in found]
            if ends:
                letters[-1] += CLOSING[after]
            edits.append(letters)
            costs.append(sum(c for c, _ in found) + (INSERT * len(CLOSING[after]) if ends else 0))
            faults.append([sum(c // 4 == f for c in codes) for f in (BLANK, DUPLICATE, TRUNCATED)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("first"), batch.column("before"),
             pa.array(edits, pa.list_(pa.string())), pa.array(costs, pa.int64()),
             pa.array(faults, pa.list_(pa.int64()))],
            names=["conv_id", "first", "before", "edits", "cost", "faults"])


def solved_blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, first, before, edits, cost, faults) of every block of ``rows``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    cut = written(blocks(rows), "conversation-blocks")
    tables = cut.mapInArrow(_tables, f"conv_id {kind}, first long, moves array<long>")
    states = tables.repartition("conv_id").sortWithinPartitions("conv_id", "first").mapInArrow(
        _states, "first long, before int, after int, ends boolean")
    return cut.join(states, "first").select("conv_id", "first", "codes", "before", "after", "ends").mapInArrow(
        _edits, f"conv_id {kind}, first long, before int, edits array<string>, cost long, faults array<long>")


# ---------------------------------------------------------------------------
# Results
# ---------------------------------------------------------------------------

MARK, EDITS, ROW = range(3)
_COLUMNS = ["conv_id", "kind", "turn", "role", "text", "before", "edits", "cost", "faults"]


def _stream(convs: DataFrame, every: DataFrame | None) -> DataFrame:
    """Per conversation, in order: a mark, then each block's edits before its rows."""
    rows = ordered(convs)
    void = F.lit(None)
    solved = solved_blocks(rows).select(
        "conv_id", F.col("first").alias("at"), F.lit(EDITS).alias("kind"), void.cast(
            rows.schema["turn"].dataType).alias("turn"), void.cast("string").alias("role"),
        void.cast("string").alias("text"), "before", "edits", "cost", "faults")
    plain = rows.select("conv_id", "at", F.lit(ROW).alias("kind"), "turn", "role", "text")
    marks = (convs if every is None else every).select("conv_id").distinct().withColumns(
        {"at": F.lit(-1).cast("long"), "kind": F.lit(MARK)})
    both = solved.unionByName(plain, allowMissingColumns=True).unionByName(marks, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind").select(*_COLUMNS)


def rewritten(edits: str, state: int, role: str | None, text: str | None):
    """The rows (role, text, edit) that the edits of one row give, and the state after."""
    out: list[tuple[str, str, str]] = []
    for edit in edits:
        if edit == "D":
            continue
        named = role if edit == "K" else "assistant" if state == USER else "user"
        state = follows(state, named[:1])
        out.append((named, "" if edit == "I" else text, edit))
    return out, state


class _Conversation:
    """What the report keeps of one conversation while its rows pass by."""

    def __init__(self, conv):
        self.conv, self.cost, self.illegal, self.faults = conv, 0, 0, [0, 0, 0]
        self.low = self.high = self.role = None
        self.turns = self.lines = 0
        self.audit: list[str] = []
        self.sha = sha256()

    def saw(self, turn, role) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.role is not None and self.role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role

    def line(self, role: str, text: str) -> None:
        if self.lines:
            self.sha.update(b"\n")
        self.lines += 1
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.faults, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _walk(batches: Iterator[pa.RecordBatch]):
    """(conversation, is it a new one, kind, value) of the sorted stream. The value is
    (cost, faults, letters) of edits, and (turn, role, rewritten rows) of a row."""
    edits: list[str] = []
    at, state = 0, START
    for conv, new, (kind, turn, role, text, before, letters, cost, faults) in _grouped(batches, _COLUMNS):
        value = None
        if kind == EDITS:
            edits, at, state = letters, 0, before
            value = cost, faults, letters
        elif kind == ROW:
            lines, state = rewritten(edits[at], state, role, text)
            at += 1
            value = turn, role, lines
        yield conv, new, kind, value


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _arrow(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type)
                                       for k, f in enumerate(schema)], schema=schema)


def reports(convs: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``every`` (default: of ``convs``): gaps in the turns,
    faults, illegal neighbours, cost, audit (the edits' initials) and the digest of the
    repaired ``role:text`` lines. ``convs`` has conv_id, turn, role and text."""
    stream = _stream(convs, every)
    kind = stream.schema["conv_id"].dataType.simpleString()
    schema = to_arrow_schema(stream.sparkSession, f"conv_id {kind}, {REPORT}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = [], None
        for conv, new, what, value in _walk(batches):
            if new:
                if seen is not None:
                    out.append(seen.row())
                seen = _Conversation(conv)
                if len(out) == 1024:
                    yield _arrow(schema, out)
                    out = []
            if what == EDITS:
                seen.cost += value[0]
                seen.faults = [a + b for a, b in zip(seen.faults, value[1], strict=True)]
                seen.audit.append("".join(value[2]))
            elif what == ROW:
                turn, role, lines = value
                seen.saw(turn, role)
                for line in lines:
                    seen.line(*line[:2])
        if seen is not None:
            yield _arrow(schema, [*out, seen.row()])

    return stream.mapInArrow(run, f"conv_id {kind}, {REPORT}")


def repaired(convs: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (0, 1, ...), turn (of the row that
    it is or stands before), role, text and edit (K, R or I) of every row."""
    stream = _stream(convs, None)
    kind, turn = (stream.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    ddl = f"conv_id {kind}, place long, turn {turn}, role string, text string, edit string"
    schema = to_arrow_schema(stream.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, place = [], 0, 0
        for conv, new, what, value in _walk(batches):
            place = 0 if new else place
            for line in value[2] if what == ROW else ():
                out.append((conv, place, value[0], *line))
                place += 1
                size += len(line[1])
            if size > 1 << 22 or len(out) > 8192:
                yield _arrow(schema, out)
                out, size = [], 0
        if out:
            yield _arrow(schema, out)

    return stream.mapInArrow(run, ddl)
