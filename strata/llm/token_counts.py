"""Unigram token counts by dynamic programming shared over a trie.

Pre-tokens (the parts of a text that no piece crosses) go into a trie. A trie
node stands for a prefix: its forward score, the count of tokens of the best
segmentation up to it and its automaton state are worked out once, when the node
is made, from its ancestors on the path; all pre-tokens below share them. A
terminal's count is the node's own. A text's count is the sum of its
pre-tokens' terminals.

The trie of a task is bounded: past ``nodes`` nodes it is dropped and grows
anew, which changes no count. Ties between equally good segmentations go to the
one whose last piece is longest. Null and empty texts count 0; ids may be null
or repeated; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.pieces import Pieces, model_bytes, shared_pieces


class Trie:
    """Forward scores and token counts of all prefixes seen."""

    def __init__(self, pieces: Pieces, nodes: int):
        self.pieces, self.limit = pieces, nodes
        self.clear()

    def clear(self) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.state, self.score, self.count = [0], [0.0], [0]

    def terminal(self, token: str) -> int:
        """Tokens in the best segmentation of ``token``, which is inserted."""
        if len(self.child) > self.limit:
            self.clear()
        child, node = self.child, 0
        path = [0]
        for c in token:
            nxt = child[node].get(c)
            if nxt is None:
                nxt = self._grow(path, node, c)
            node = nxt
            path.append(node)
        return self.count[node]

    def _grow(self, path: list[int], parent: int, c: str) -> int:
        pieces = self.pieces
        state = pieces.step(self.state[parent], c)
        top, count, single = float("-inf"), 0, False
        # Longest piece first: it wins ties.
        for length, score, _ in pieces.matches[state]:
            before = path[-length]
            x = self.score[before] + score
            if x > top:
                top, count = x, self.count[before] + 1
            single = single or length == 1
        if not single:
            x = self.score[parent] + pieces.unknown_score
            if x > top:
                top, count = x, self.count[parent] + len(pieces.unknown_ids(c))
        node = self.child[parent][c] = len(self.child)
        self.child.append({})
        self.state.append(state)
        self.score.append(top)
        self.count.append(count)
        return node


def _counter(model: bytes, nodes: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = shared_pieces(model)
        trie = Trie(pieces, nodes)
        known: dict[str, int] = {}
        for part in parts:
            split = [pieces.parts(t) for t in part["text"]]
            # Distinct pre-tokens of the batch, in order, so that neighbours
            # share their prefixes.
            fresh = sorted({p for x in split for p in x if p not in known})
            if len(known) + len(fresh) > nodes:
                known.clear()
                fresh = sorted({p for x in split for p in x})
            for p in fresh:
                known[p] = trie.terminal(p)
            yield pd.DataFrame({"id": part["id"].array,
                                "n_tokens": [sum(map(known.__getitem__, x)) for x in split]})
    return run


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 nodes: int = 600_000) -> DataFrame:
    """One row per document: id, n_tokens (long)."""
    narrow = docs.select(F.col(id_col).alias("id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInPandas(_counter(model_bytes(model_path), nodes), f"id {kind}, n_tokens long")
