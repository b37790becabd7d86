"""Token ids as Re-Pair grammars: binary shards with random access.

Documents are dealt by ranges of their id and sorted; within a range they fill
shards. A shard's ids are compressed by Re-Pair: each round counts adjacent
pairs, replaces the most frequent ones (a batch of distinct pairs, left to
right) by new nonterminals, and repeats until no pair is frequent enough or the
shard has ``max_rules`` rules. A
document's end has a symbol of its own (the number of terminals; a text may hold
the end id too) that is in no pair, so every document begins and ends at a symbol.

Shard file: the magic ``RPR1``; seven unsigned 32-bit numbers (terminals, rules,
symbols, documents, tokens, bytes per symbol, end id); per rule its two symbols and its
expansion length (32 bit); per document its first symbol and first token, and
their totals (32 bit); the symbols (16 or 32 bit). A token is found by the
symbols' summed expansion lengths and a walk down the rules.

Files are rows of a Parquet table (part, shard, before, ids of the documents, n_tokens, file), so
any store that Spark writes holds them, and a lost task writes its rows anew.

Order: ascending id, nulls first; rows of equal id by text. Null text is empty:
its document holds the end id alone. Repeated rows are kept. Only id and text
are read. An empty table gives no shard and an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.session import shuffle_partitions

MAGIC = b"RPR1"
# No token of the vocabulary crosses these, nor does its normalisation.
BREAKS = "\n\t\r"
# Characters that stay single letters or marks of their kind when lower-cased and
# composed, whatever stands beside them: printable ASCII, the letters of Latin-1 and
# those of basic Cyrillic.
STABLE = re.compile(r"[!-~À-ÖØ-öø-ÿА-яЁё]+")
ADDED = "<|"      # a token added to the vocabulary, found before any normalisation, begins so
LOOKS_AROUND = re.compile(r"\(\?|\\[bBAGZz]|\$|(?<!\[)\^")
JOINED = 64       # words of one call of the library


def grammar(ids: np.ndarray, end: int, least: int = 8, batch: int = 512,
            max_rules: int = 8192):
    """(symbols, rules) of one shard's symbols; ``end`` is the largest terminal,
    in no rule, and the first nonterminal comes after it. Rounds go on until no pair
    occurs ``least`` times or there are ``max_rules`` rules. A round's grid of symbols
    has ``batch + 1`` squared places at most."""
    # Symbols of 16 bits make pairs of 32, which sort twice as fast.
    narrow = end + 1 + max_rules <= 0x10000
    kind, shift = (np.uint32, 16) if narrow else (np.int64, 32)
    seq = ids.astype(kind)
    rules: list[np.ndarray] = []
    n_rules = 0
    while len(seq) > 1 and n_rules < max_rules:
        room = min(batch, max_rules - n_rules)
        code = (seq[:-1] << kind(shift)) | seq[1:]
        ordered = np.sort(code[(seq[:-1] != end) & (seq[1:] != end)])
        if not len(ordered):
            break
        at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        count, pair = np.diff(np.r_[at, len(ordered)]), ordered[at]
        good = count >= least
        count, pair = count[good], pair[good]
        if not len(pair):
            break
        best = np.lexsort((pair, -count))[:room]
        chosen = np.sort(pair[best])
        # A grid gives the number of a chosen pair by its symbols; symbols that stand first
        # (second) in no chosen pair share the empty row (column) 0.
        size = end + 1 + n_rules
        heads, row = np.unique(chosen >> kind(shift), return_inverse=True)
        tails, column = np.unique(chosen & kind((1 << shift) - 1), return_inverse=True)
        head, tail = np.zeros(size, np.intp), np.zeros(size, np.intp)
        head[heads] = (len(tails) + 1) * np.arange(1, len(heads) + 1)
        tail[tails] = np.arange(1, len(tails) + 1)
        grid = np.full((len(heads) + 1) * (len(tails) + 1), -1, np.int32)
        grid[(row + 1) * (len(tails) + 1) + column + 1] = np.arange(len(chosen))
        place = seq.astype(np.intp)
        slot = grid[head[place[:-1]] + tail[place[1:]]]
        hit = np.flatnonzero(slot >= 0)
        slot = slot[hit]
        # Overlapping hits form runs of neighbours; every second one is taken.
        first = np.r_[True, np.diff(hit) > 1]
        begin = hit[first][np.cumsum(first) - 1]
        taken = (hit - begin) % 2 == 0
        hit, slot = hit[taken], slot[taken]
        seq[hit] = end + 1 + n_rules + slot
        left = np.ones(len(seq), bool)
        left[hit + 1] = False
        seq = seq[left]
        pairs = chosen.astype(np.int64)
        rules.append(np.stack([pairs >> shift, pairs & ((1 << shift) - 1)], 1))
        n_rules += len(chosen)
    return seq.astype(np.int64), np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Tokens per rule; a rule refers to earlier rules only."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1))
    return np.array(out, np.int64)


def pack(docs: list[np.ndarray], terminals: int, end_id: int, **options) -> bytes:
    """The shard file of the documents' ids (each with its end id)."""
    ids = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
    ids[np.cumsum([len(d) for d in docs], dtype=np.int64) - 1] = terminals
    seq, rules = grammar(ids, terminals, **options)
    lengths = expansion_lengths(rules, terminals + 1)
    ends = np.flatnonzero(seq == terminals) + 1
    first_symbol = np.r_[0, ends]
    first_token = np.r_[0, np.cumsum([len(d) for d in docs], dtype=np.int64)]
    wide = 2 if terminals + 1 + len(rules) <= 0x10000 else 4
    head = np.array([terminals, len(rules), len(seq), len(docs), len(ids), wide, end_id],
                    "<u4")
    return b"".join([MAGIC, head.tobytes(), rules.astype("<u4").tobytes(),
                     lengths.astype("<u4").tobytes(), first_symbol.astype("<u4").tobytes(),
                     first_token.astype("<u4").tobytes(), seq.astype(f"<u{wide}").tobytes()])


def gathered(flat: np.ndarray, start: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[start[k]:start[k + 1]]`` of the numbers one after another, and where each ends."""
    begin = start[number]
    count = start[number + 1] - begin
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(begin - (ends - count), count)], ends


class Shard:
    """A shard file opened for reading."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a grammar shard")
        self.end, n_rules, n_symbols, self.n_docs, self.n_tokens, wide, self.end_id = (
            int(x) for x in np.frombuffer(data, "<u4", 7, 4))
        self.first = self.end + 1
        at = 32
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2).astype(np.int64)
        at += 8 * n_rules
        self.lengths = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self.first_symbol = np.frombuffer(data, "<u4", self.n_docs + 1, at).astype(np.int64)
        at += 4 * (self.n_docs + 1)
        self.first_token = np.frombuffer(data, "<u4", self.n_docs + 1, at).astype(np.int64)
        at += 4 * (self.n_docs + 1)
        self.symbols = np.frombuffer(data, f"<u{wide}", n_symbols, at).astype(np.int64)

    def expand(self, seq: np.ndarray) -> np.ndarray:
        """Terminal ids of a run of symbols, one level of rules at a time."""
        while True:
            inner = seq >= self.first
            if not inner.any():
                return np.where(seq == self.end, self.end_id, seq)
            place = np.cumsum(1 + inner) - 1 - inner
            out = np.empty(len(seq) + int(inner.sum()), np.int64)
            pair = self.rules[seq[inner] - self.first]
            out[place[~inner]] = seq[~inner]
            out[place[inner]], out[place[inner] + 1] = pair[:, 0], pair[:, 1]
            seq = out

    def all(self) -> np.ndarray:
        """Ids of the whole shard: each rule is expanded once, symbols copy from that."""
        size = np.r_[np.ones(self.first, np.int64), self.lengths]
        flat = np.r_[np.arange(self.end), self.end_id, self.expand(np.arange(self.first, self.first + len(self.rules)))]
        return gathered(flat, np.r_[0, np.cumsum(size)], self.symbols)[0]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only its own symbols are expanded."""
        return self.expand(self.symbols[self.first_symbol[k]:self.first_symbol[k + 1]])

    def token(self, k: int) -> int:
        """The k-th id of the shard, by expansion lengths alone."""
        if not 0 <= k < self.n_tokens:
            raise IndexError(k)
        doc = int(np.searchsorted(self.first_token, k, "right")) - 1
        k -= int(self.first_token[doc])
        seq = self.symbols[self.first_symbol[doc]:self.first_symbol[doc + 1]]
        size = np.ones(len(seq), np.int64)
        inner = seq >= self.first
        size[inner] = self.lengths[seq[inner] - self.first]
        total = np.cumsum(size)
        at = int(np.searchsorted(total, k, "right"))
        k -= int(total[at] - size[at])
        symbol = int(seq[at])
        while symbol >= self.first:
            a, b = (int(x) for x in self.rules[symbol - self.first])
            left = int(self.lengths[a - self.first]) if a >= self.first else 1
            symbol, k = (a, k) if k < left else (b, k - left)
        return self.end_id if symbol == self.end else symbol


def _word_tokenizer(model: str):
    """(tokenizer, pattern, word-end flags): a tokenizer for words that are already
    normalised, the pattern that finds them in a chunk, and by id whether a token ends
    a word. None where the model's steps are others than those that this relies on."""
    import json

    import regex
    from tokenizers import Tokenizer
    spec = json.loads(model)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    suffix = spec["model"].get("end_of_word_suffix")
    if ([x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"]
            or [x["type"] for x in splits] != ["Split", "ByteLevel"] or not suffix
            or "Regex" not in splits[0]["pattern"] or not splits[0]["invert"]
            or splits[0]["behavior"] != "Removed" or splits[1]["use_regex"]
            or splits[1]["add_prefix_space"]
            # A word alone is split as in its chunk: no pattern looks around it.
            or LOOKS_AROUND.search(splits[0]["pattern"]["Regex"])
            or not all(x["content"].startswith(ADDED) for x in spec["added_tokens"])):
        return None
    spec["normalizer"] = None
    spec["pre_tokenizer"] = {"type": "Sequence",
                             "pretokenizers": [{"type": "WhitespaceSplit"}, splits[1]]}
    tokenizer = Tokenizer.from_str(json.dumps(spec))
    ends = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
    for token, number in tokenizer.get_vocab().items():
        ends[number] = token.endswith(suffix)
    return tokenizer, regex.compile(splits[0]["pattern"]["Regex"]), ends


class Encoder:
    """The library's ids of texts, chunk by chunk (the runs between plain white space),
    each distinct chunk encoded once.

    A known chunk is a number; its ids stand in one flat array, so a text's ids are
    a gather. A new chunk of ``STABLE`` characters is made of words, each of which the
    library encodes once whatever chunks it is in; any other chunk goes to the library
    as it is. A word is a chunk of that one word too, so one memo holds both, and a
    chunk of one word takes that word's number. Texts that find more than ``limit``
    entries start the memo anew, which changes no id."""

    def __init__(self, model: str, limit: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(model)
        self.words = _word_tokenizer(model)
        self.terminals = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _add(self, texts: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        first = len(self.start) - 1
        self.number.update(zip(texts, range(first, first + len(texts)), strict=True))
        self.start = np.concatenate([self.start, self.start[-1] + ends])
        self.flat = np.concatenate([self.flat, ids])

    def _encode_words(self, new: list[str]) -> None:
        tokenizer, _, is_end = self.words
        coded = tokenizer.encode_batch_fast(
            [" ".join(new[k:k + JOINED]) for k in range(0, len(new), JOINED)], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int32) for e in coded])
        ends = np.flatnonzero(is_end[ids]) + 1
        if len(ends) != len(new):
            raise ValueError("a word has not one end")
        self._add(new, ids, ends)

    def _learn(self, chunks: list[str]) -> None:
        # A chunk's word, or list of words; None: the library takes it whole.
        split: list[str | list[str] | None] = [None] * len(chunks)
        if self.words:
            find = self.words[1].findall
            stable = STABLE.fullmatch
            # Letters of ASCII are stable and hold no added token.
            split = [(c if c.islower() else c.lower()) if c.isascii() and c.isalpha()
                     else None if not stable(c) or ADDED in c
                     else c.lower() if c.isalpha() else find(c.lower()) for c in chunks]
        number = self.number
        if new := [w for w in dict.fromkeys(chain.from_iterable(
                x if type(x) is list else (x,) for x in split if x is not None)) if w not in number]:
            self._encode_words(new)
        number.update((c, number[x]) for c, x in zip(chunks, split, strict=True) if type(x) is str)
        if whole := [c for c, x in zip(chunks, split, strict=True) if x is None]:
            coded = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(
                whole, add_special_tokens=False)]
            self._add(whole, np.concatenate(coded), np.cumsum([len(x) for x in coded]))
        if more := [(c, x) for c, x in zip(chunks, split, strict=True) if type(x) is list and c not in number]:
            sizes = np.fromiter((len(x) for _, x in more), np.int64, len(more))
            words = np.fromiter((number[w] for _, x in more for w in x), np.int64, int(sizes.sum()))
            ids, ends = gathered(self.flat, self.start, words)
            self._add([c for c, _ in more], ids, np.r_[0, ends][np.cumsum(sizes)])

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if len(self.number) > self.limit:
            self.clear()
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        for c in BREAKS:
            column = pc.replace_substring(column, c, " ")
        # Two breaks in a row leave an empty chunk, which has no ids.
        split = pc.split_pattern(column, " ")
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.number.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = [chunks[k] for k in missing.tolist()]
            self._learn(new)
            number[missing] = np.fromiter(map(self.number.__getitem__, new), np.int64, len(new))
        number = number[coded.indices.to_numpy()]
        ids, ends = gathered(self.flat, self.start, number)
        bound = np.r_[0, ends][np.cumsum(pc.list_value_length(split).to_numpy())]
        return np.split(ids, bound[:-1])


def shared_encoder(model: str, limit: int) -> Encoder:
    """One encoder per Python worker process, whose memo serves all its tasks."""
    import os
    import sys
    from zlib import crc32
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    memo = sys.__dict__.setdefault("_strata_encoders", {})
    key = (crc32(model.encode()), limit)
    if key not in memo:
        memo.clear()
        memo[key] = Encoder(model, limit)
    return memo[key]


def slices(sizes: list[int], least: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of ``least`` bytes at least, but for the last."""
    start = held = 0
    for k, size in enumerate(sizes):
        held += size
        if held >= least:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _shards(model: str, end_id: int, shard_tokens: int, memo_size: int, options: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = shared_encoder(model, memo_size)
        part_no, shard_no = TaskContext.get().partitionId(), 0
        names: list = []
        docs: list[np.ndarray] = []
        held = before = 0

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part_no], pa.int32()), pa.array([shard_no], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([names], pa.list_(kind)), pa.array([held], pa.int64()),
                 pa.array([pack(docs, encoder.terminals, end_id, **options)], pa.binary())],
                names=["part", "shard", "before", "ids", "n_tokens", "file"])

        # The texts stay in Arrow's memory; no text becomes a string of Python's.
        for batch in batches:
            own, texts = batch.column("id"), batch.column("text")
            for lo, hi in slices(pc.binary_length(texts).to_pylist()):
                coded = encoder.encode(texts.slice(lo, hi - lo))
                for name, ids in zip(own.slice(lo, hi - lo).to_pylist(), coded, strict=True):
                    names.append(name)
                    docs.append(np.append(ids, np.int32(end_id)))
                    held += len(ids) + 1
                    if held >= shard_tokens:
                        yield flush(own.type)
                        before += held
                        names, docs, held = [], [], 0
                        shard_no += 1
        if docs:
            yield flush(own.type)
    return run


def write_shards(docs: DataFrame, tokenizer_json: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = 1 << 18, memo: int = 1_000_000,
                 **options) -> DataFrame:
    """Encode and write all documents; the written table (part, shard, tokens of the
    part's shards before, ids, n_tokens, file). ``end_id`` is appended to each document."""
    with open(tokenizer_json, encoding="utf-8") as f:
        model = f.read()
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    dealt = narrow.repartitionByRange(shuffle_partitions(spark), "id").sortWithinPartitions(
        "id", "text")
    return written(dealt.mapInArrow(
        _shards(model, end_id, shard_tokens, memo, options),
        f"part int, shard int, before long, ids array<{kind}>, n_tokens long, file binary"), "grammar-shards")


def _reader(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from zlib import crc32
    for part in parts:
        for names, data, base in zip(part["ids"], part["file"], part["base"], strict=True):
            shard = Shard(data)
            ids = shard.all().astype("<u4").tobytes()
            at = (4 * shard.first_token).tolist()
            yield pd.DataFrame({
                "id": pd.Series(list(names), dtype=object),
                "start": base + shard.first_token[:-1], "n_tokens": np.diff(shard.first_token),
                "ids_crc32": [crc32(ids[a:b]) for a, b in pairwise(at)],
                "n_symbols": np.diff(shard.first_symbol)})


def read_documents(shards: DataFrame) -> DataFrame:
    """One row per document from the files: id, start, n_tokens, ids_crc32 and
    the number of grammar symbols that store it."""
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    # One row per range, so no more rows than the writer's partitions: a small broadcast.
    ranges = shards.groupBy("part").agg(F.sum("n_tokens").alias("all")).select(
        F.col("part").alias("p"), F.coalesce(F.sum("all").over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    placed = shards.join(F.broadcast(ranges), F.col("part") == F.col("p"))
    return placed.select("ids", "file", (F.col("before") + F.col("earlier")).alias("base")).mapInPandas(
        _reader, f"id {kind}, start long, n_tokens long, ids_crc32 long, n_symbols long")
