"""Benchmark decontamination: block-max WAND over a BM25 index of test items.

The index holds test items, its queries are the passages of training texts.
Impacts are BM25 weights of an item's own terms, divided by the item's score
against itself, so that a passage holding the whole item scores 1 and one
threshold serves items of every length. A passage is ``2 L`` words at every
``L``-th word, ``L`` no shorter than the longest item, so every run of ``L``
words lies inside one passage.

The commonest terms are set aside as far as they make up at most ``common_share``
of any item. The impacts of all others are summed for all passages and items of
a batch at once; a passage that cannot reach the threshold for any item, even
with all of the item's common terms, is not searched. For the rest the cursors
move by pivots, and a pivot is scored only if the impacts of the blocks it falls
in can reach the threshold. Every item at or above it is retrieved, then verified: the
word n-grams of its question and of its answer (the last sentence, or the last
third of a single sentence) must both occur in the passage to the given share.

An index holds at most ``max_items`` items and ``max_chars`` characters; a
larger benchmark is dealt over several indexes, and every passage asks them all.

Defined results: null and empty texts have no hit; null, empty or wordless items
match nothing; repeated items are found under each of their ids; null ids pass
through; an empty benchmark finds nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"[.?!]+\s+")
HIT = "array<struct<item:bigint,score:double>>"


@dataclass
class Posting:
    """One term's items in ascending order, with block maxima."""

    items: list[int]
    impacts: list[float]
    block_max: list[float]
    largest: float


@dataclass
class Index:
    """BM25 impacts of test items (normalised by each item's self score)."""

    width: int
    names: list[int] = field(default_factory=list)
    words: list[list[str]] = field(default_factory=list)
    answer_at: list[int] = field(default_factory=list)
    terms: dict[str, int] = field(default_factory=dict)
    postings: list[Posting] = field(default_factory=list)
    length: int = 64
    # Per item the weight of its common terms; rare terms in compressed rows.
    common: np.ndarray | None = None
    rare_start: np.ndarray | None = None
    rare_items: np.ndarray | None = None
    rare_impacts: np.ndarray | None = None


def answer_start(text: str) -> int:
    """Number of words before the answer."""
    total = len(WORD.findall(text.lower()))
    cuts = [m.end() for m in SENTENCE_END.finditer(text.rstrip())]
    if cuts:
        before = len(WORD.findall(text[:cuts[-1]].lower()))
        if 0 < before < total:
            return before
    return max(1, total - max(1, total // 3)) if total > 1 else 0


def build_index(items: list[tuple[int, str]], k1: float = 1.2, b: float = 0.75, width: int = 8,
                least_passage: int = 64, common_share: float = 0.3) -> Index:
    index = Index(width)
    for name, text in items:
        words = WORD.findall((text or "").lower())
        if name is not None and words:
            index.names.append(name)
            index.words.append(words)
            index.answer_at.append(answer_start(text))
    index.length = max([least_passage, *map(len, index.words)])
    n = len(index.words)
    if not n:
        return index
    mean = sum(map(len, index.words)) / n
    found: dict[str, list[tuple[int, int]]] = {}
    for i, words in enumerate(index.words):
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        for w, c in counts.items():
            found.setdefault(w, []).append((i, c))
    weight: dict[str, list[float]] = {}
    whole = [0.0] * n
    for w, posting in found.items():
        idf = log(1 + (n - len(posting) + 0.5) / (len(posting) + 0.5))
        weight[w] = [idf * c * (k1 + 1) / (c + k1 * (1 - b + b * len(index.words[i]) / mean))
                     for i, c in posting]
        for (i, _), x in zip(posting, weight[w], strict=True):
            whole[i] += x
    for w, posting in found.items():
        ids = [i for i, _ in posting]
        impact = [x / whole[i] for i, x in zip(ids, weight[w], strict=True)]
        index.terms[w] = len(index.postings)
        index.postings.append(Posting(
            ids, impact, [max(impact[k:k + width]) for k in range(0, len(impact), width)],
            max(impact)))
    # Commonest first, a term joins the common ones while no item has too much of
    # its weight in them.
    common, aside = np.zeros(n), set()
    for t in sorted(range(len(index.postings)), key=lambda t: -len(index.postings[t].items)):
        p = index.postings[t]
        if len(p.items) < 2 or (common[p.items] + p.impacts).max() > common_share:
            break
        common[p.items] += p.impacts
        aside.add(t)
    index.common = common
    kept = [[] if t in aside else p.items for t, p in enumerate(index.postings)]
    index.rare_start = np.r_[0, np.cumsum([len(x) for x in kept])]
    index.rare_items = np.array([i for x in kept for i in x], np.int64)
    index.rare_impacts = np.array([v for t, p in enumerate(index.postings) if t not in aside
                                   for v in p.impacts])
    return index


def promising(index: Index, docs: list[np.ndarray], threshold: float) -> list[np.ndarray]:
    """Per document (its term numbers, -1 for no term) the first words of the
    passages that may reach the threshold for some item."""
    n, length = len(index.words), index.length
    chunks = np.array([max(1, -(-len(d) // length)) for d in docs])
    first = np.cumsum(chunks) - chunks
    place = np.concatenate([f + np.arange(len(d)) // length for f, d in zip(first, docs, strict=True)])
    term = np.concatenate(docs)
    place, term = place[term >= 0], term[term >= 0]
    count = index.rare_start[term + 1] - index.rare_start[term]
    place, begin, count = place[count > 0], index.rare_start[term][count > 0], count[count > 0]
    ends = np.cumsum(count)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - count), count)
    total = np.bincount(np.repeat(place, count) * n + index.rare_items[at],
                        index.rare_impacts[at], int(chunks.sum()) * n).reshape(-1, n)
    need = threshold - index.common - 1e-9
    out = []
    for f, c in zip(first, chunks, strict=True):
        own = total[f:f + c]
        # A passage is two chunks; a document of one chunk is one passage.
        pair = own[:-1] + own[1:] if c > 1 else own
        out.append(np.flatnonzero((pair >= need).any(axis=1)) * length)
    return out


def search(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All (item number, score) at or above the threshold, by block-max WAND."""
    end = len(index.words)
    width, post = index.width, [index.postings[t] for t in terms]
    at = [0] * len(post)
    here = [p.items[0] for p in post]
    out = []
    slack = 1e-9  # sums of the same impacts in another order

    def move(c: int, to: int) -> None:
        items, k = post[c].items, at[c]
        while k < len(items) and items[k] < to:
            # Whole blocks are passed by their last item.
            k = k + width if k + width <= len(items) and items[k + width - 1] < to else k + 1
        at[c] = k
        here[c] = items[k] if k < len(items) else end

    while True:
        order = sorted((c for c in range(len(post)) if here[c] < end), key=here.__getitem__)
        bound, pivot = 0.0, None
        for c in order:
            bound += post[c].largest
            if bound >= threshold - slack:
                pivot = here[c]
                break
        if pivot is None:
            return out
        front = [c for c in order if here[c] <= pivot]
        bound, edge = 0.0, end
        for c in front:
            # The block where the pivot would stand in this cursor's list.
            items, k = post[c].items, at[c] // width
            while (k + 1) * width <= len(items) and items[(k + 1) * width - 1] < pivot:
                k += 1
            if k * width < len(items):
                bound += post[c].block_max[k]
                edge = min(edge, items[min((k + 1) * width, len(items)) - 1] + 1)
        if bound < threshold - slack:
            later = [here[c] for c in order if here[c] > pivot]
            to = max(pivot + 1, min([edge, *later]))
            for c in front:
                move(c, to)
        elif here[order[0]] == pivot:
            score = sum(post[c].impacts[at[c]] for c in front)
            if score >= threshold - slack:
                out.append((pivot, score))
            for c in front:
                move(c, pivot + 1)
        else:
            for c in front:
                move(c, pivot)


def _grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def verified(item: list[str], cut: int, passage: list[str], n: int, share: float) -> bool:
    """Both the question's and the answer's n-grams occur in the passage."""
    for part in (item[:cut], item[cut:]):
        want = _grams(part, n)
        if want:
            have = _grams(passage, min(n, len(part)))
            if len(want & have) < share * len(want):
                return False
    return True


# Passages times items that are scored at once.
MOST_SUMS = 4_000_000


def portions(docs: list[np.ndarray], length: int, most: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Pieces (document, first word, terms) of at most ``most`` chunks, as many together
    as make up that number. Neighbouring pieces share a chunk, so no passage is cut."""
    held, chunks = [], 0
    for d, terms in enumerate(docs):
        n = max(1, -(-len(terms) // length))
        for at in range(0, max(1, n - 1), most - 1):
            size = min(most, n - at)
            if held and chunks + size > most:
                yield held
                held, chunks = [], 0
            held.append((d, at * length, terms[at * length:(at + size) * length]))
            chunks += size
    if held:
        yield held


def _finder(index: Index, threshold: float, ngram: int, share: float):
    step, most = 64, max(2, MOST_SUMS // max(1, len(index.words)))

    def hits(words: list[str], ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, float]]:
        best: dict[int, float] = {}
        for a in starts.tolist():
            b = min(a + 2 * index.length, len(words))
            terms = [int(t) for t in np.unique(ids[a:b]) if t >= 0]
            for item, score in search(index, terms, threshold):
                if verified(index.words[item], index.answer_at[item], words[a:b], ngram, share):
                    name = index.names[item]
                    best[name] = max(score, best.get(name, 0.0))
        return sorted(best.items())

    def run(texts: pd.Series) -> pd.Series:
        get, out = index.terms.get, []
        for lo in range(0, len(texts), step):
            words = [WORD.findall(t.lower()) if t else [] for t in texts.iloc[lo:lo + step]]
            if not index.words:
                out += [[] for _ in words]
                continue
            ids = [np.fromiter((get(w, -1) for w in x), np.int64, len(x)) for x in words]
            starts: list[set[int]] = [set() for _ in ids]
            for some in portions(ids, index.length, most):
                for (d, at, _), own in zip(some, promising(index, [x for *_, x in some], threshold), strict=True):
                    starts[d].update((own + at).tolist())
            for x, i, own in zip(words, ids, starts, strict=True):
                out.append([{"item": n, "score": v} for n, v in hits(x, i, np.array(sorted(own)))]
                           if own else [])
        return pd.Series(out, dtype=object)
    return run


def found_items(docs: DataFrame, items: DataFrame, text: Column, item_id: str = "item_id",
                item_text: str = "text", threshold: float = 0.6, ngram: int = 3,
                share: float = 0.6, max_items: int = 5000, max_chars: int = 8_000_000) -> Column:
    """Column of the verified items in ``text``, with their scores, by item id."""
    usable = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")) \
        .where("i is not null and length(t) > 0")
    count, chars = usable.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    shards = max(1, ceil(count / max_items), ceil(chars / max_chars))
    found = []
    for k in range(shards):
        part = usable.where(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == k)
        index = build_index(sorted((r.i, r.t) for r in part.collect()))
        run = F.pandas_udf(_finder(index, threshold, ngram, share), HIT)
        found.append(run(text))
    return found[0] if shards == 1 else F.array_sort(F.concat(*found))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, leaked, items, scores."""
    hit = docs.select(F.col(id_col).alias("doc_id"), found_items(
        docs, items, F.col(text_col), **options).alias("h"))
    return hit.select("doc_id", (F.size("h") > 0).alias("leaked"), F.col("h.item").alias("items"),
                      F.transform("h.score", lambda x: F.round(x, 6)).alias("scores"))


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    return docs.where(F.size(found_items(docs, items, F.col(text_col), **options)) == 0)
