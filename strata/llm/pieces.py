"""A SentencePiece model's pieces as an automaton for lattice building."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "▁"
# An unknown character scores this much below the lowest piece.
UNKNOWN_PENALTY = 10.0


@dataclass
class Pieces:
    """Ids and scores of the normal pieces, and their Aho-Corasick automaton.

    ``matches[state]`` lists (length, score, id) of the pieces that end at a
    position whose state is ``state``; ``step`` goes from state to state.
    """

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    unknown_id: int
    unknown_score: float
    prefix: bool
    texts: list[str]
    byte_of: dict[int, int]
    hidden: set[int]
    odd: set[int] = field(default_factory=set)
    goto: list[dict[str, int]] = field(default_factory=lambda: [{}])
    fail: list[int] = field(default_factory=lambda: [0])
    matches: list[list[tuple[int, float, int]]] = field(default_factory=lambda: [[]])
    edges: list[list[tuple[int, float, int]]] = field(default_factory=list)
    splitter: re.Pattern | None = None
    lines: bool = False
    solved: object = None  # what this process has worked out with the model

    def build(self) -> Pieces:
        self.odd = self.hidden | set(self.byte_of)
        goto, fail, matches = self.goto, self.fail, self.matches
        for piece, score in self.scores.items():
            s = 0
            for c in piece:
                n = goto[s].get(c)
                if n is None:
                    n = goto[s][c] = len(goto)
                    goto.append({})
                    fail.append(0)
                    matches.append([])
                s = n
            matches[s].append((len(piece), score, self.ids[piece]))
        queue = list(goto[0].values())
        for s in queue:
            for c, n in goto[s].items():
                f = fail[s]
                while f and c not in goto[f]:
                    f = fail[f]
                fail[n] = goto[f].get(c, 0)
                queue.append(n)
            matches[s] = matches[s] + matches[fail[s]]
        # The same with an unknown character wherever no piece of one character ends.
        self.edges = [m if m and m[-1][0] == 1 else [*m, (1, self.unknown_score, -1)] for m in matches]
        # Texts part before every run of space marks, and around a line end, where
        # no piece crosses: the best and n-best segmentations of the parts then
        # make up those of the text.
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.scores)
        lines = self.lines = any("\n" in p and p != "\n" for p in self.scores)
        stop = SPACE if lines else SPACE + "\n"
        self.splitter = None if crossing else re.compile(
            f"{SPACE}+[^{stop}]*|[^{stop}]+" + ("" if lines else "|\n"))
        return self

    def step(self, state: int, c: str) -> int:
        goto, fail = self.goto, self.fail
        while state and c not in goto[state]:
            state = fail[state]
        return goto[state].get(c, 0)

    def normal(self, text: str) -> str:
        """The text the lattice is built on (identity normalisation)."""
        text = text.replace(" ", SPACE)
        return SPACE + text if self.prefix and text else text

    def parts(self, text: str) -> list[str]:
        text = self.normal(text)
        if self.splitter is None:
            return [text] if text else []
        return self.splitter.findall(text)

    def split(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
        """``parts`` of many large strings at once: the number of every part, the
        distinct parts, and how many parts end before each text and in all."""
        marked = pc.replace_substring(texts, " ", SPACE)
        if self.prefix:
            mark, none = pa.scalar(SPACE, pa.large_string()), pa.scalar("", pa.large_string())
            marked = pc.if_else(pc.equal(marked, none), marked, pc.binary_join_element_wise(mark, marked, none))
        _, ends, data = marked.buffers()
        ends = np.frombuffer(ends, np.int64)[marked.offset:marked.offset + len(marked) + 1]
        data = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        starts = np.zeros(len(data), bool)
        if self.splitter is not None:
            mark = np.zeros(len(data), bool)
            mark[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            starts |= mark
            starts[3:] &= ~mark[:-3]
            if not self.lines:
                line = data == 0x0A
                starts |= line
                starts[1:] |= line[:-1]
        starts[ends[:-1][ends[:-1] < ends[1:]]] = True
        at = np.flatnonzero(starts)
        parts = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)).dictionary_encode()
        return parts.indices.to_numpy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist(), np.searchsorted(at, ends)

    def unknown_ids(self, c: str) -> tuple[int, ...]:
        if not self.byte_ids:
            return (self.unknown_id,)
        return tuple(self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass"))

    def decode(self, ids) -> str:
        """Text of a segmentation; byte pieces join into UTF-8 characters."""
        text = self.spelled(ids).replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def spelled(self, ids) -> str:
        """The pieces' text as it stands in the lattice."""
        if self.odd.isdisjoint(ids):
            return "".join(map(self.texts.__getitem__, ids))
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.hidden:
                out.append(self.texts[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)


def load(model: bytes) -> Pieces:
    """Read a serialized SentencePiece model with identity normalisation."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_proto=model)
    if sp.normalize("A  éﬁ\n b") not in (
            f"{SPACE}A{SPACE}{SPACE}éﬁ\n{SPACE}b", f"A{SPACE}{SPACE}éﬁ\n{SPACE}b"):
        raise ValueError("only models without text normalisation are supported")
    ids, scores, byte_ids, byte_of, hidden, texts = {}, {}, [], {}, set(), []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        texts.append(piece)
        if sp.is_byte(i):
            byte_of[i] = len(byte_ids)
            byte_ids.append(i)
        elif sp.is_control(i) or sp.is_unknown(i):
            hidden.add(i)
        elif not sp.is_unused(i):
            ids[piece], scores[piece] = i, float(sp.get_score(i))
    unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
    prefix = sp.normalize("a").startswith(SPACE)
    return Pieces(ids, scores, byte_ids, sp.unk_id(), unknown, prefix, texts, byte_of,
                  hidden).build()


def shared_pieces(model: bytes) -> Pieces:
    """The automaton of ``model``, built once per Python worker process."""
    import sys
    from zlib import crc32
    memo = sys.__dict__.setdefault("_strata_pieces", {})
    key = (crc32(model), len(model))
    if key not in memo:
        memo.clear()
        memo[key] = load(model)
    return memo[key]


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver; tasks get its bytes."""
    with open(path, "rb") as f:
        return f.read()
