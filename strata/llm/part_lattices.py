"""The best segmentation of many short parts at once, with numpy.

The same two passes as ``nbest.best_part``, position by position over all parts: the
forward pass gives every position its best score, the backward pass the best path and
what the second best loses. Sums are taken in the same order, so scores are equal to
the last bit.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from strata.llm.pieces import Pieces

LONGEST = 64     # characters of a part; longer ones are worked out one by one
TOGETHER = 8192  # parts of one pass
NONE = -1e300


def places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of every run of ``count``, one run after another."""
    ends = np.cumsum(count)
    return np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


class Columns(NamedTuple):
    """Results of some parts: score, loss of the second best, and where in ``ids``
    the best segmentation stands."""
    score: np.ndarray
    gap: np.ndarray
    first: np.ndarray
    count: np.ndarray
    ids: np.ndarray


class Lattices:
    """A model's automaton as arrays."""

    def __init__(self, pieces: Pieces):
        chars = sorted({c for step in pieces.goto for c in step})
        self.width = len(chars) + 1
        self.code = np.full(0x110000, self.width - 1, np.int32)
        self.code[[ord(c) for c in chars]] = np.arange(len(chars))
        code = {c: k for k, c in enumerate(chars)}
        steps = sorted((s * self.width + code[c], t) for s, step in enumerate(pieces.goto) for c, t in step.items())
        self.keys = np.array([k for k, _ in steps], np.int64)
        self.next = np.array([t for _, t in steps], np.int32)
        self.fail = np.array(pieces.fail, np.int32)
        # The edges of all states one after another.
        self.edges = np.array([len(x) for x in pieces.edges], np.int64)
        self.first = np.cumsum(self.edges) - self.edges
        flat = [e for edges in pieces.edges for e in edges]
        self.length = np.array([e[0] for e in flat], np.int64)
        self.score = np.array([e[1] for e in flat], np.float64)
        self.piece = np.array([e[2] for e in flat], np.int32)

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The automaton's states after one more character."""
        state, out = state.astype(np.int64), np.zeros(len(state), np.int64)
        todo = np.arange(len(state))
        while len(todo):
            key = state[todo] * self.width + c[todo]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[todo[hit]] = self.next[at[hit]]
            # No step from here: on from the longest suffix, unless that was the empty one.
            todo = todo[~hit & (state[todo] != 0)]
            state[todo] = self.fail[state[todo]]
        return out

    def best(self, parts: list[str]) -> tuple[Columns, np.ndarray]:
        """The results of parts, the longest first, and which of them have an
        unknown character, whose ids its bytes give."""
        n, size = len(parts), np.array([len(p) for p in parts])
        most = int(size[0])
        points = np.frombuffer("".join(p.ljust(most, "\0") for p in parts).encode("utf-32-le", "surrogatepass"),
                               np.uint32).reshape(n, most)
        codes = np.ascontiguousarray(self.code[points].T)
        # Position k of part p stands at k * n + p.
        best, state, passes = np.zeros((most + 1) * n), np.zeros(n, np.int64), []
        for k in range(1, most + 1):
            # The parts that have this position are the first ones.
            r = int(np.searchsorted(-size, -k, "right"))
            state = self.step(state[:r], codes[k - 1, :r])
            many = self.edges[state]
            edge = places(self.first[state], many)
            heads = np.cumsum(many) - many
            part = np.repeat(np.arange(r), many)
            start = (k - self.length[edge]) * n + part
            score = self.score[edge]
            ways = best[start] + score
            top = np.maximum.reduceat(ways, heads)
            best[k * n:k * n + r] = top
            # The first edge that attains the score.
            hits = np.flatnonzero(ways == top[part])[::-1]
            chosen = np.empty(r, np.int64)
            chosen[part[hits]] = hits
            passes.append((r, edge, heads, part, start, score, chosen))
        after = np.full((most + 1) * n, NONE)
        after[size * n + np.arange(n)] = 0.0
        on, second = size.copy(), np.full(n, NONE)
        path = np.full((most + 1, n), -2, np.int32)
        for k in range(most, 0, -1):
            r, edge, heads, part, start, score, chosen = passes.pop()
            x = score + after[k * n:k * n + r][part]
            # The starts of one part's edges differ; what no way reaches stays at NONE.
            after[start] = np.maximum(after[start], x)
            whole = x + best[start]
            mine = np.flatnonzero(on[:r] == k)
            own = chosen[mine]
            path[k, mine] = self.piece[edge[own]]
            on[mine] = k - self.length[edge[own]]
            whole[own] = NONE
            second[:r] = np.maximum(second[:r], np.maximum.reduceat(whole, heads))
        total = best[size * n + np.arange(n)]
        gap = np.where(second > -1e299, total - second, np.inf)
        path = np.ascontiguousarray(path.T)
        found = path > -2
        count = found.sum(axis=1)
        return Columns(total, gap, np.cumsum(count) - count, count, path[found]), (path == -1).any(axis=1)

    def columns(self, parts: list[str], alone) -> Columns:
        """Every part's result; ``alone(part)`` gives those of long and odd parts."""
        size = np.array([len(p) for p in parts], np.int64)
        score, gap = np.zeros(len(parts)), np.zeros(len(parts))
        first, count = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        ids, held = [], 0
        single = np.flatnonzero(size > LONGEST).tolist()
        short = np.flatnonzero(size <= LONGEST)
        short = short[np.argsort(-size[short], kind="stable")]
        for k in range(0, len(short), TOGETHER):
            some = short[k:k + TOGETHER]
            got, odd = self.best([parts[p] for p in some.tolist()])
            score[some], gap[some], first[some], count[some] = got.score, got.gap, got.first + held, got.count
            ids.append(got.ids)
            held += len(got.ids)
            single += some[odd].tolist()
        for p in single:
            score[p], own, gap[p] = alone(parts[p])
            first[p], count[p] = held, len(own)
            ids.append(np.array(own, np.int32))
            held += len(own)
        return Columns(score, gap, first, count, np.concatenate(ids) if ids else np.zeros(0, np.int32))

    def solve(self, parts: list[str], alone) -> dict[str, tuple]:
        """``columns`` as (score, ids, loss of the second best) per part."""
        got = self.columns(parts, alone)
        return {p: (score, tuple(got.ids[a:a + n].tolist()), gap) for p, score, gap, a, n in zip(
            parts, got.score.tolist(), got.gap.tolist(), got.first.tolist(), got.count.tolist(), strict=True)}
