"""Near-duplicate documents: Jaccard join of word n-grams by chosen paths.

A document is the set of its hashed five-word shingles (lower-case words; a text
of fewer words has one shingle of all of them). Sets are embedded as ``hashes``
minhash values. A run starts at a root node; every node samples one coordinate,
and with probability ``1/t - 1`` a second one, and sends each set to the child
named by the node, the coordinate and the set's value there. Sets that meet in a
node of at most ``bucket`` sets are compared there by brute force (on 128-bit
sketches); larger nodes split again, up to ``depth`` levels, and what is still
larger then is linked as a whole. The number of runs follows from the target
recall, 0.9999 unless given: a pair at the threshold survives a run with a
probability that the branching recursion gives for each share of equal minhash
values, and these shares are weighed by their chance. A pair above the threshold
is missed with at most the remaining chance.

Meeting only nominates: connected nominees form clusters, and every pair of
different sets in a cluster is verified on its exact shingles, block against
block, so a large group is dealt over many tasks. A task returns one row per set
(its number of links and the root of its local forest), never the pairs.

Defined results: equal sets are copies and form one class without expanding into
pairs; all texts without a word are copies of each other; null text is empty;
rows equal in id and text are one document; null ids are allowed (a class takes
its smallest non-null id); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import durable, fresh, whole_text, written
from strata.llm.components import connected_components

WORD = re.compile(r"\w+")
NGRAM = 5
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
EMPTY_SET = 0


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def shingles(text: str, known: dict[str, int], n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    from xxhash import xxh3_64_intdigest
    words = WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    if len(known) > 300_000:  # a bounded memo of word hashes
        known.clear()
    values = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxh3_64_intdigest(w)
        values.append(h)
    w = np.array(values, np.uint64)
    k = min(n, len(w))
    out = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        out = mix64(out + w[i:len(w) - k + 1 + i] + np.uint64(MIX[0]))
    return np.unique(out)


def _minhash(grams: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    x = (grams >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        low = np.minimum(low, (x[i:i + 4096, None] * mul + add).min(axis=0))
    return low


def _embed(hashes: int):
    """(id, text) -> id, key, sig, size, minhash values, two sketch words."""
    rng = np.random.default_rng(20_001)
    mul = (rng.integers(0, 1 << 32, hashes, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    add = rng.integers(0, 1 << 32, hashes, dtype=np.uint64).astype(np.uint32)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_64_intdigest
        known: dict[str, int] = {}
        for part in parts:
            rows = []
            for doc, key, text in zip(part["id"], part["key"], part["text"], strict=True):
                grams = shingles(text, known)
                if not len(grams):
                    rows.append((doc, key, EMPTY_SET, 0, [], 0, 0))
                    continue
                values = _minhash(grams, mul, add)
                bits = np.packbits((mix64(values.astype(np.uint64)) & np.uint64(1)).astype(bool)
                                   [:128]).view(np.int64)
                sig = np.uint64(xxh3_64_intdigest(grams.tobytes())).astype(np.int64)
                rows.append((doc, key, int(sig), len(grams), values.view(np.int32),
                             int(bits[0]), int(bits[1])))
            out = pd.DataFrame(rows, columns=["id", "key", "sig", "size", "mh", "s0", "s1"])
            out["id"] = out["id"].astype(part["id"].dtype)
            yield out
    return run


def survival(t: float, depth: int, equal: float | None = None) -> float:
    """Chance that a pair of similarity ``t`` still shares a node at ``depth``
    when each node samples one coordinate, or two with chance 1/t - 1. ``equal``
    is the share of the pair's minhash values that are equal, if it is not ``t``."""
    second, alive = 1 / t - 1, 1.0
    for _ in range(depth):
        one = (t if equal is None else equal) * alive
        alive = (1 - second) * one + second * (1 - (1 - one) ** 2)
    return alive


def runs_for(t: float, depth: int, recall: float, hashes: int = 128) -> int:
    """Least number of runs that find a pair of similarity ``t`` with chance ``recall``.
    All runs see the same ``hashes`` values, of which more or fewer than a share of
    ``t`` may be equal."""
    if not 0 <= recall < 1:
        raise ValueError("recall must be at least 0 and below 1")
    if t >= 1:
        return 1
    k = np.arange(hashes + 1)
    chance = np.array([comb(hashes, int(i)) * t ** int(i) * (1 - t) ** int(hashes - i) for i in k])
    lost = np.array([1 - survival(t, depth, i / hashes) for i in k])
    runs = 1
    while (chance * lost ** runs).sum() > 1 - recall:
        runs += 1
    return runs


def _coordinates(seed: int, t: float, hashes: int) -> list[int]:
    rng = np.random.default_rng(seed & 0xFFFFFFFFFFFFFFFF)
    return rng.choice(hashes, 1 + (rng.random() < 1 / t - 1), replace=False).tolist()


def _children(t: float, hashes: int):
    """Rows of split nodes (path, sig, mh) -> child paths."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen: dict[int, list[int]] = {}
        for part in parts:
            path, sig = [], []
            for p, s, mh in zip(part["path"], part["sig"], part["mh"], strict=True):
                if p not in chosen:
                    if len(chosen) > 200_000:
                        chosen.clear()
                    chosen[p] = _coordinates(p, t, hashes)
                for c in chosen[p]:
                    x = np.array([p, c, mh[c]], np.int64).view(np.uint64)
                    h = mix64(x[:1] + mix64(x[1:2] + mix64(x[2:] + np.uint64(MIX[0]))))
                    path.append(int(h.view(np.int64)[0]))
                    sig.append(s)
            yield pd.DataFrame({"path": path, "sig": sig}, dtype="int64")
    return run


def nominated(sets: DataFrame, t: float, hashes: int, depth: int, bucket: int,
              recall: float) -> DataFrame:
    """Edges (u, v) between set hashes that met in a small node with similar
    sketches, or in a node that stayed large at the last depth."""
    brief = sets.select("sig", "size", "s0", "s1")
    # At similarity t a sketch differs in (1 - t) / 2 of 128 bits; six standard
    # deviations are added (at 0.8 about 1 pair in 40 million differs in more).
    p = (1 - t) / 2
    differ = int(128 * p + 6 * (128 * p * (1 - p)) ** 0.5) + 1
    roots = [(r, c) for r in range(runs_for(t, depth, recall, hashes))
             for c in _coordinates(r + 1, t, hashes)]
    nodes = sets.select("sig", F.explode(F.array(*[
        F.xxhash64(F.lit(r), F.lit(c), F.get("mh", c)) for r, c in roots])).alias("path"))
    edges = None
    for level in range(1, depth + 1):
        nodes = durable(nodes)
        counted = nodes.groupBy("path").count().where("count > 1")
        few = nodes.join(counted.where(F.col("count") <= bucket).select("path"), "path")
        many = nodes.join(counted.where(F.col("count") > bucket).select("path"), "path")
        # At most `bucket` members by the count above.
        full = few.join(brief, "sig").groupBy("path").agg(F.sort_array(F.collect_list(
            F.struct("sig", "size", "s0", "s1"))).alias("m"))
        pair = full.select("m", F.posexplode("m").alias("i", "a")).select(
            "a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b"))
        close = ((F.least("a.size", "b.size") >= t * F.greatest("a.size", "b.size"))
                 & (F.bit_count(F.col("a.s0").bitwiseXOR(F.col("b.s0")))
                    + F.bit_count(F.col("a.s1").bitwiseXOR(F.col("b.s1"))) <= differ))
        found = pair.where(close).select(F.col("a.sig").alias("u"), F.col("b.sig").alias("v"))
        if level == depth:
            low = many.groupBy("path").agg(F.min("sig").alias("u"))
            found = found.union(many.join(low, "path").select("u", F.col("sig").alias("v")))
        else:
            nodes = many.join(sets.select("sig", "mh"), "sig").select("path", "sig", "mh") \
                .mapInPandas(_children(t, hashes), "path long, sig long").distinct()
        edges = found if edges is None else edges.union(found)
    return edges.distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes, by dense products over slices of the
    shingles that occur twice or more."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right]
                         for a in left], np.float32).reshape(len(left), len(right))
    groups = [left, right]
    flat = np.concatenate([*left, *right])
    row = np.concatenate([np.repeat(np.arange(len(g)) + k * len(left), [len(x) for x in g])
                          for k, g in enumerate(groups)])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    start = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(start) - 1
    shared = np.bincount(column)[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 2048
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + width,
                                              width))
    for k in range(len(edges) - 1):
        part = slice(edges[k], edges[k + 1])
        m = np.zeros((len(left) + len(right), width), np.float32)
        m[row[part], column[part] - k * width] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def _verify(num: int, den: int):
    """One block pair of a cluster -> per set its links and its local root."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        known: dict[str, int] = {}
        sides = [part[part["side"] == s] for s in (0, 1)]
        own = bool(part["diagonal"].iloc[0])
        if own:
            sides[1] = sides[0]
        grams = [[shingles(x, known) for x in s["text"]] for s in sides[:1 if own else 2]]
        if own:
            grams.append(grams[0])
        sig = [s["sig"].to_numpy() for s in sides]
        size = [np.array([len(g) for g in x], np.int64) for x in grams]
        total = size[0][:, None] + size[1][None, :]
        link = np.zeros(total.shape, bool)
        if total.size:
            link = _overlaps(*grams).astype(np.int64) * (num + den) >= num * total
        if own:
            np.fill_diagonal(link, False)
        names = sig[0] if own else np.concatenate(sig)
        links = link.sum(1) if own else np.concatenate([link.sum(1), link.sum(0)])
        # A forest over the block pair: rounds of smallest labels.
        root = names.copy()
        shift = 0 if own else len(sig[0])
        i, j = np.nonzero(link)
        j = j + shift
        while len(i):
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            if (low == root).all():
                break
            root = low
        return pd.DataFrame({"sig": names, "links": links.astype(np.int64), "root": root})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.8, recall: float = 0.9999, hashes: int = 128,
                    depth: int = 4, bucket: int = 24, block: int = 256) -> DataFrame:
    """(id, key, sig, size, n_links, class_id, first): one row per document (id,
    text). ``sig`` names its set, ``n_links`` counts the other sets linked to
    it, ``class_id`` is the smallest id of its class and ``first`` whether it is
    the document of the class that stays."""
    exact = Fraction(threshold).limit_denominator(1000)
    t = float(exact)
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("key"),
                         whole_text(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    embedded = written(narrow.mapInPandas(
        _embed(hashes), f"id {kind}, key long, sig long, size long, mh array<int>, "
        "s0 long, s1 long"), "sets")
    sets = embedded.where("size > 0").groupBy("sig").agg(
        F.min(F.struct("id", "key")).alias("doc"), F.first("size").alias("size"),
        F.first("s0").alias("s0"), F.first("s1").alias("s1"), F.first("mh").alias("mh"))
    sets = durable(sets)
    clusters = connected_components(nominated(sets, t, hashes, depth, bucket, recall))
    # Blocks: a cluster of m sets has ceil(m / block) of them, and every pair of
    # blocks is one task's group.
    blocks = clusters.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    member = clusters.join(blocks, "label").join(
        sets.select(F.col("sig").alias("node"), "doc"), "node").select(
        "label", F.col("node").alias("sig"), "doc", "nb",
        F.pmod(F.xxhash64("node"), F.col("nb")).cast("int").alias("b"))
    d, m = narrow.alias("d"), member.alias("m")
    full = d.join(m, F.col("d.id").eqNullSafe(F.col("m.doc.id"))
                  & (F.col("d.key") == F.col("m.doc.key"))).select(
        "label", "sig", "b", "text",
        F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o")).dropDuplicates(["sig", "o"])
    dealt = full.select("label", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"),
                        (F.col("b") > F.col("o")).cast("int").alias("side"),
                        (F.col("b") == F.col("o")).alias("diagonal"), "sig", "text")
    local = durable(dealt.groupBy("label", "bi", "bj").applyInPandas(
        _verify(exact.numerator, exact.denominator), "sig long, links long, root long"))
    links = local.groupBy(F.col("sig").alias("set")).agg(F.sum("links").alias("n_links"))
    group = connected_components(local.select(F.col("sig").alias("u"), F.col("root").alias("v")))
    of = links.join(group, F.col("set") == F.col("node"), "left").select(
        "set", "n_links", F.coalesce("label", "set").alias("label"))
    labelled = embedded.select("id", "key", "sig", "size").join(
        of, F.col("sig") == F.col("set"), "left").select(
        "id", "key", "sig", "size", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("label", "sig").alias("label"))
    heads = labelled.groupBy(F.col("label").alias("head")).agg(
        F.min("id").alias("class_id"), F.min(F.struct("id", "key")).alias("stays"))
    return labelled.join(heads, F.col("label") == F.col("head")).select(
        "id", "key", "sig", "size", "n_links", "class_id",
        (F.struct("id", "key").eqNullSafe(F.col("stays"))).alias("first"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """``docs`` with one document of each class: the one of the smallest id."""
    i, k = fresh(docs, "_first_id", "_first_key")
    stays = near_duplicates(docs, id_col, text_col, **options).where("first").select(
        F.col("id").alias(i), F.col("key").alias(k))
    return docs.join(stays, F.col(id_col).eqNullSafe(F.col(i))
                     & (F.xxhash64(whole_text(text_col)) == F.col(k)), "left_semi")
