"""SentencePiece N-best encoding and decoding.

A forward Viterbi pass over a part's piece lattice gives every position the best
score of reaching it. That score is an exact heuristic for the search backward
from the end: A* takes the partial path whose own score plus the heuristic is
highest, so complete segmentations leave the agenda best first and only edges
of the N best are expanded.

A text parts where no piece crosses (before runs of spaces, around line ends).
Each distinct part's best segmentation, and what its second best loses, come from
the forward pass and one backward pass, and are remembered in a bounded memo that
the tasks of a worker process share. Arrow tells the distinct parts of many texts. The
N best of the text combine the parts' N best: besides the best, only the parts
with the N - 1 smallest losses can take part, so A* searches these alone.

Ties: equal scores are ordered by the search, which is deterministic.
Unknown characters become byte pieces. Null and empty texts have the one empty
segmentation; ids may be null or repeated; extra columns are not read; decoding
gives the text back, except that literal U+2581 marks decode as spaces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.part_lattices import LONGEST, Columns, Lattices, places
from strata.llm.pieces import SPACE, Pieces, model_bytes, shared_pieces

SCHEMA = ("ids array<int>, n_tokens int, score double, nbest array<struct<score:double,"
          "n_tokens:int,edits:array<struct<at:int,drop:int,ids:array<int>>>>>, round_trip boolean")
MEMO = 800_000   # parts whose best a worker process remembers
SLICE = 1 << 20  # bytes of the texts worked on at once, but for the last one's rest


def _forward(part: str, pieces: Pieces):
    """Best score of every position, and the edges (length, score, id) that end there."""
    goto, fail, ends = pieces.goto, pieces.fail, pieces.edges
    best, edges, state, end = [0.0], [()], 0, 0
    for c in part:
        while state and c not in goto[state]:
            state = fail[state]
        state = goto[state].get(c, 0)
        end += 1
        here = ends[state]
        edges.append(here)
        top = -1e300
        for length, score, _ in here:
            x = best[end - length] + score
            if x > top:
                top = x
        best.append(top)
    return best, edges


def _ids(part: str, path: list[tuple[int, int]], pieces: Pieces) -> tuple[int, ...]:
    """Piece ids of a path of (length, id), unknown characters spelled out."""
    out: list[int] = []
    at = 0
    for length, piece in path:
        if piece < 0:
            out.extend(pieces.unknown_ids(part[at]))
        else:
            out.append(piece)
        at += length
    return tuple(out)


def best_part(part: str, pieces: Pieces) -> tuple[float, tuple[int, ...], float]:
    """(score, ids) of the best segmentation, and what the second best loses."""
    best, edges = _forward(part, pieces)
    size = len(part)
    total = best[size]
    after = [-1e300] * size + [0.0]
    second, path, on = -1e300, [], size
    for end in range(size, 0, -1):
        rest = after[end]
        if rest == -1e300:
            continue
        chosen = end == on
        for length, score, piece in edges[end]:
            start = end - length
            x = score + rest
            if x > after[start]:
                after[start] = x
            if chosen and best[start] + score == best[end]:
                # The first edge that attains the score is the best path's.
                path.append((length, piece))
                on, chosen = start, False
                continue
            x += best[start]
            if x > second:
                second = x
    path.reverse()
    return total, _ids(part, path, pieces), total - second if second > -1e299 else float("inf")


def nbest_part(part: str, pieces: Pieces, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best (score, ids) of one part, best first."""
    size = len(part)
    best, edges = _forward(part, pieces)
    out: list[tuple[float, tuple[int, ...]]] = []
    # (minus the estimate, minus the order of arrival, position, score so far, path): of
    # equal estimates the latest, hence deepest, goes on, or ties would be explored in breadth.
    agenda = [(-best[size], 0, size, 0.0, None)]
    tick = -1
    while agenda and len(out) < n:
        _, _, pos, score, path = heapq.heappop(agenda)
        if pos == 0:
            steps = []
            while path is not None:
                step, path = path
                steps.append(step)
            out.append((score, _ids(part, steps, pieces)))
            continue
        for length, s, piece in edges[pos]:
            total = score + s
            heapq.heappush(agenda, (-(total + best[pos - length]), tick, pos - length, total,
                                    ((length, piece), path)))
            tick -= 1
    return out


def _ranked(part: str, pieces: Pieces, n: int, first: tuple[int, ...]):
    """``nbest_part`` with the segmentation ``first``, one of the best, in front."""
    found = nbest_part(part, pieces, n)
    rest = [x for x in found if x[1] != first]
    return [(found[0][0], first), *rest][:n]


def combine(gaps: np.ndarray, ranked, n: int):
    """The ``n`` best of a text: (loss, ((part number, ids), ...)), best first.
    ``gaps`` holds each part's loss of the second best, ``ranked(k)`` its n best."""
    k = min(n - 1, len(gaps))
    order = np.argpartition(gaps, k - 1)[:k] if k else np.zeros(0, int)
    # Equal losses: the earlier part.
    if k:
        worst = gaps[order].max()
        sure = np.flatnonzero(gaps < worst)
        order = np.concatenate([sure, np.flatnonzero(gaps == worst)[:k - len(sure)]])
        order = order[np.isfinite(gaps[order])]
    # Part after part, only the n best so far can be among the n best of all.
    found = [(0.0, 0, ())]
    for p in sorted(order.tolist()):
        best = ranked(p)
        others = [(best[0][0] - score, (p, ids)) for score, ids in best[1:]]
        found = heapq.nsmallest(n, found + [
            (loss + more, k + 1, (*picked, choice)) for loss, k, picked in found for more, choice in others])
    return [(loss, picked) for loss, _, picked in found]


class Memo:
    """What a task worked out lately: two generations of at most ``size`` short parts."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def find(self, part: str, work):
        got = self.young.get(part)
        if got is None:
            got = self.old.get(part)
            if got is None:
                got = work(part)
            if len(part) <= LONGEST:
                if len(self.young) >= self.size:
                    self.old, self.young = self.young, {}
                self.young[part] = got
        return got


class _Grown:
    """An array with room at its end."""

    def __init__(self, kind: type):
        self.values, self.size = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.values):
            room = np.empty(max(end, len(self.values) * 3 // 2), self.values.dtype)
            room[:self.size] = self.values[:self.size]
            self.values = room
        self.values[self.size:end] = more
        self.size = end


class _Kept:
    """Results of parts as columns, found by the part if it is short."""

    def __init__(self):
        self.row: dict[str, int] = {}
        self.score, self.gap, self.trip = _Grown(np.float64), _Grown(np.float64), _Grown(np.bool_)
        self.first, self.count, self.ids = _Grown(np.int64), _Grown(np.int32), _Grown(np.int32)

    def add(self, parts: list[str], got: Columns, trip: np.ndarray) -> np.ndarray:
        """The rows that the parts get."""
        start = self.score.size
        self.first.add(self.ids.size + np.cumsum(got.count) - got.count)
        self.ids.add(got.ids[places(got.first, got.count)])
        for column, values in ((self.score, got.score), (self.gap, got.gap), (self.count, got.count), (self.trip, trip)):
            column.add(values)
        self.row.update((p, k) for k, p in enumerate(parts, start) if len(p) <= LONGEST)
        return np.arange(start, self.score.size)

    def take(self, rows: np.ndarray) -> tuple[Columns, np.ndarray]:
        score, gap, first, count = (x.values[rows] for x in (self.score, self.gap, self.first, self.count))
        return Columns(score, gap, first, count, self.ids.values), self.trip.values[rows]


class Solved:
    """The best segmentations of the parts that a worker process met lately: two
    generations of about ``size`` short parts."""

    def __init__(self, pieces: Pieces, size: int):
        self.pieces, self.size, self.lattices = pieces, size, Lattices(pieces)
        self.width = np.array([len(t) for t in pieces.texts], np.int64)
        self.odd = np.zeros(len(pieces.texts), bool)
        self.odd[list(pieces.odd)] = True
        self.young, self.old = _Kept(), _Kept()

    def find(self, parts: list[str]) -> tuple[Columns, np.ndarray]:
        """The results of distinct parts, and whether decoding gives the part back."""
        if len(self.young.row) >= self.size or self.young.ids.size >= 16 * self.size:
            self.old, self.young = self.young, _Kept()
        rows = np.fromiter(map(self.young.row.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(rows < 0)
        past = np.fromiter((self.old.row.get(parts[k], -1) for k in missing.tolist()), np.int64, len(missing))
        again, new = missing[past >= 0], missing[past < 0]
        rows[again] = self.young.add([parts[k] for k in again.tolist()], *self.old.take(past[past >= 0]))
        unknown = [parts[k] for k in new.tolist()]
        got = self.lattices.columns(unknown, lambda p: best_part(p, self.pieces))
        rows[new] = self.young.add(unknown, got, self.trips(unknown, got))
        return self.young.take(rows)

    def trips(self, parts: list[str], got: Columns) -> np.ndarray:
        """Whether decoding the best segmentation gives each part back."""
        ids, ends = got.ids[places(got.first, got.count)], np.cumsum(got.count)

        def sums(values: np.ndarray) -> np.ndarray:
            return np.diff(np.r_[0, np.cumsum(values)][np.r_[0, ends]])

        # Parts of plain pieces are compared as one text, part for part of the same length.
        plain = sums(self.odd[ids]) == 0
        spelled = "".join(map(self.pieces.texts.__getitem__, ids[np.repeat(plain, got.count)].tolist()))
        same = np.array([len(p) for p in parts], np.int64)[plain] == sums(self.width[ids])[plain]
        joined = all(same.tolist()) and spelled == "".join(p for p, x in zip(parts, plain.tolist(), strict=True) if x)
        out = plain & joined
        for k in np.flatnonzero(~out).tolist():
            out[k] = self.pieces.spelled(ids[ends[k] - got.count[k]:ends[k]].tolist()) == parts[k]
        return out


def _solved(pieces: Pieces) -> Solved:
    """The memo of this worker process, shared by its tasks."""
    if pieces.solved is None:
        pieces.solved = Solved(pieces, MEMO // 2)
    return pieces.solved


class _Rows:
    """Segmentations of some documents as flat columns."""

    def __init__(self):
        self.scores = []
        self.best = ([], [], [])              # score, tokens, edits of every segmentation
        self.edits = ([], [], [])             # at, drop, ids of every edit
        self.segmentations = []

    def add(self, size: int, score: float, chosen: list, at, drop) -> None:
        """``size`` ids; part ``p`` has ``drop(p)`` of them from ``at(p)`` on."""
        self.scores.append(score)
        self.segmentations.append(len(chosen))
        for loss, picked in chosen:
            more = 0
            for p, other in picked:
                gone = drop(p)
                more += len(other) - gone
                for column, value in zip(self.edits, (at(p), gone, list(other)), strict=True):
                    column.append(value)
            for column, value in zip(self.best, (score - loss, size + more, len(picked)), strict=True):
                column.append(value)

    def batch(self, docs: pa.Array, ids: np.ndarray, ends: np.ndarray, trips: np.ndarray) -> pa.RecordBatch:
        """``ids`` of all documents, ``ends`` of each, from 0 on."""
        def lists(sizes: list[int], values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes, dtype=np.int64)], pa.int32()), values)

        def struct(**columns: pa.Array) -> pa.Array:
            return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))

        at, drop, other = self.edits
        edits = struct(at=pa.array(at, pa.int32()), drop=pa.array(drop, pa.int32()),
                       ids=pa.array(other, pa.list_(pa.int32())))
        score, tokens, n_edits = self.best
        nbest = struct(score=pa.array(score, pa.float64()), n_tokens=pa.array(tokens, pa.int32()),
                       edits=lists(n_edits, edits))
        return pa.RecordBatch.from_arrays(
            [docs, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
             pa.array(np.diff(ends), pa.int32()), pa.array(self.scores, pa.float64()),
             lists(self.segmentations, nbest), pa.array(trips, pa.bool_())],
            names=["id", "ids", "n_tokens", "score", "nbest", "round_trip"])


def _encoder(model: bytes, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(model)
        solved, lists = _solved(pieces), Memo(MEMO // 32)

        def encoded(docs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
            codes, parts, ends = pieces.split(texts)
            known, good = solved.find(parts)
            count = known.count[codes]
            ids = known.ids[places(known.first[codes], count)]
            before = np.r_[0, np.cumsum(count, dtype=np.int64)]
            # Parts make up the text, and no character's bytes cross them.
            bad = np.r_[0, np.cumsum(~good[codes])]
            literal = pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False)
            trips = (bad[ends[1:]] == bad[ends[:-1]]) & ~literal
            scores, gaps = known.score[codes].tolist(), known.gap[codes]
            rows, tokens = _Rows(), before[ends]
            for k, (low, high) in enumerate(pairwise(ends.tolist())):

                def work(p: int) -> tuple:
                    own = known.first[p]
                    return _ranked(parts[p], pieces, n, tuple(known.ids[own:own + known.count[p]].tolist()))

                def ranked(p: int, low=low):
                    c = codes[low + p]
                    return lists.find(parts[c], lambda _: work(c))

                rows.add(int(tokens[k + 1] - tokens[k]), float(sum(scores[low:high])), combine(gaps[low:high], ranked, n),
                         lambda p: int(before[low + p] - before[low]), lambda p: int(count[low + p]))  # noqa: B023
            return rows.batch(docs, ids, tokens, trips)

        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            start = 0
            while start < len(texts):
                done = ends[start - 1] if start else 0
                stop = min(int(np.searchsorted(ends, done + SLICE)) + 1, len(texts))
                yield encoded(batch.column("id").slice(start, stop - start), texts.slice(start, stop - start))
                start = stop
    return run


def segmentations(docs: DataFrame, model_path: str, n: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: id, the best segmentation's ids, their number and
    score, the ``n`` best as edits of the best (replace ``drop`` ids at ``at``),
    and whether decoding the best gives the text back."""
    narrow = docs.select(F.col(id_col).alias("id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(_encoder(model_bytes(model_path), n), f"id {kind}, {SCHEMA}")


def edited(ids: list[int], edits: list) -> list[int]:
    """A segmentation of the N best, from the best one and its edits."""
    out = list(ids)
    for e in sorted(edits, key=lambda e: -e["at"]):
        out[e["at"]:e["at"] + e["drop"]] = e["ids"]
    return out


def decode_ids(docs: DataFrame, model_path: str, ids_col: str = "ids",
               out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of its id lists (null ids: null)."""
    model = model_bytes(model_path)

    def run(column: pd.Series) -> pd.Series:
        pieces = shared_pieces(model)
        return pd.Series([None if x is None else pieces.decode(x) for x in column])

    return docs.withColumn(out_col, F.pandas_udf(run, "string")(F.col(ids_col)))
