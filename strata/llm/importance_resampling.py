"""Importance resampling towards a target distribution, by bit-sliced sums.

Hashed word features of all documents and of all target texts are counted per bucket.
A bucket's gain is the scaled logarithm of how much likelier the target makes it. A
document's weight is the sum of its buckets' gains, each as often as the bucket occurs.
The sum is taken bit by bit: bit i of the document's counts is one plane of 10,000
bits, bit j of the gains' amounts another (positive and negative gains apart). The
bits set in both planes, counted, are worth 2**(i + j), so the weight is exact in
integers. Scores add Gumbel noise derived from a keyed digest of the id, and the
highest scores are the sample.

Counts cover all texts; a task returns one number per bucket. Only these, at most
``BUCKETS`` rows, reach the driver. Ranks come from one range-partitioned sort of narrow
rows and the number of rows before each partition. Words of long texts are counted
piece by piece.

Cases: null texts have no features and weight 0; a null id draws its noise from an
empty id and ranks last among ties; repeated ids are separate rows (with equal scores
their order is open); extra columns are not read; an empty target or table is allowed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import to_arrow_schema, written

BUCKETS = 10_000
SCALE = 1000
WORDS = (BUCKETS + 63) // 64
TOGETHER = 64        # documents whose planes are counted at once
PIECE = 1 << 20      # bytes of a text split at once
MEMO = 200_000       # words whose buckets a task remembers

# Bytes of words: digits, letters (made small) and all beyond ASCII; others part words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                 for b in range(256))


def feature_counts(text: str | None, ngrams: int = 1) -> tuple[Counter, int]:
    """(features with their number, number of words) of one text."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS)
    counts: Counter = Counter()
    words, at, tail = 0, 0, []
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        piece = data[at:end].split()
        counts.update(piece)
        words += len(piece)
        if ngrams > 1:
            run = tail + piece
            for n in range(2, ngrams + 1):
                # Runs that end in this piece; the words carried over stand before it.
                for k in range(max(0, len(tail) - n + 1), len(run) - n + 1):
                    counts[b" ".join(run[k:k + n])] += 1
            tail = run[-(ngrams - 1):]
        at = end
    return counts, words


class Hashed:
    """Buckets of features, remembered for as long as a task runs."""

    def __init__(self, ngrams: int):
        self.ngrams, self.memo = ngrams, {}

    def counts(self, text: str | None) -> tuple[list[int], list[int], int, int]:
        """(buckets, how often each, number of features, number of words)."""
        found, words = feature_counts(text, self.ngrams)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        buckets = []
        for feature in found:
            b = memo.get(feature)
            if b is None:
                b = memo[feature] = crc32(feature) % BUCKETS
            buckets.append(b)
        times = list(found.values())
        return buckets, times, sum(times), words


def bucket_counts(texts: DataFrame, text_col: str = "text", ngrams: int = 1) -> np.ndarray:
    """How often every bucket occurs in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hashed = np.zeros(BUCKETS, np.int64), Hashed(ngrams)
        for batch in batches:
            for text in batch.column(0):
                buckets, times, _, _ = hashed.counts(text.as_py())
                np.add.at(total, buckets, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])],
                                         names=["bucket", "n"])

    parts = texts.select(text_col).mapInArrow(run, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket: a floored, scaled log ratio of smoothed shares."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative numbers: (rows, bits, 64-bit words), lowest bit first."""
    rows = values.shape[0]
    n = max(1, int(values.max(initial=0)).bit_length())
    out = np.zeros((rows, n, WORDS * 8), np.uint8)
    for i in range(n):
        bits = np.packbits((values >> i).astype(np.uint8) & 1, axis=1, bitorder="little")
        out[:, i, :bits.shape[1]] = bits
    return out.view(np.uint64)


class Gains:
    """The gains' bit planes, and weights from documents' planes."""

    def __init__(self, gains: np.ndarray):
        up, down = (planes(np.maximum(g, 0)[None, :])[0] for g in (gains, -gains))
        self.planes = np.concatenate([up, down])
        self.worth = np.r_[1 << np.arange(len(up), dtype=np.int64), -(1 << np.arange(len(down), dtype=np.int64))]

    def weights(self, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(len(counts), np.int64)
        sliced = planes(counts)
        for i in range(sliced.shape[1]):
            both = sliced[:, i, None, :] & self.planes[None, :, :]
            total += (np.bitwise_count(both).sum(axis=2, dtype=np.int64) @ self.worth) << i
        return total


def weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            ngrams: int = 1) -> DataFrame:
    """(id, n_features, n_words, weight) of every document."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ddl = f"id {narrow.schema['id'].dataType.simpleString()}, n_features long, n_words long, weight long"
    schema = to_arrow_schema(docs.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashed = Gains(gains), Hashed(ngrams)
        for batch in batches:
            n = batch.num_rows
            features, words, weight = (np.zeros(n, np.int64) for _ in range(3))
            texts = batch.column("text")
            for at in range(0, n, TOGETHER):
                to = min(at + TOGETHER, n)
                counts = np.zeros((to - at, BUCKETS), np.int64)
                for k in range(at, to):
                    buckets, times, features[k], words[k] = hashed.counts(texts[k].as_py())
                    np.add.at(counts[k - at], buckets, times)
                weight[at:to] = table.weights(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(features), pa.array(words), pa.array(weight)], schema=schema)

    return narrow.mapInArrow(run, ddl)


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
              seed: str = "2024", id_col: str = "doc_id", text_col: str = "text",
              ngrams: int = 1) -> DataFrame:
    """Every document's id, n_features, weight, score and rank: 1, 2, ... for the
    ``percent`` of the documents of ``least_words`` words or more that have the highest
    scores (ties: the smaller id), null for all others."""
    gains = bucket_gains(bucket_counts(docs, text_col, ngrams), bucket_counts(target, text_col, ngrams))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))
    # Written first: the sort below samples its rows before it deals them out.
    scored = written(weights(docs, gains, id_col, text_col, ngrams), "weights").withColumn(
        "score", F.col("weight") + noise)
    order = [F.col("drawable").desc(), F.col("score").desc(), F.col("id").asc_nulls_last()]
    placed = written(scored.withColumn("drawable", F.col("n_words") >= least_words).repartitionByRange(
        *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "resampling")
    # Drawable rows come first. One row per partition reaches the driver: how many it holds.
    part = F.shiftright("at", 33)
    held = placed.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("drawable").cast("long")).alias("m")).orderBy("part").collect()
    before, starts = 0, []
    for r in held:
        starts.append((r.part, before))
        before += r.n
    drawn = percent * sum(r.m for r in held) // 100
    spark = docs.sparkSession
    offset = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("part", part).join(offset, "part").select(
        F.col("id").alias(id_col), "n_features", "weight", "score",
        F.when(F.col("drawable") & (place <= drawn), place).alias("rank"))
