import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import importance_resampling as ir
from tests.llm.helpers import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[k:k + m]) for m in range(1, n + 1) for k in range(len(words) - m + 1)], len(words)


def brute(rows, target, n=1, percent=10, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, grams(text, n)[0]))
    for text in target:
        t.update(map(bucket, grams(text, n)[0]))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        fs, words = grams(text, n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
                     for b in map(bucket, fs))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    can = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(can[:percent * len(can) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def texts(rng, n=200):
    words = ["Alpha", "beta", "GAMMA", "delta7", "été", "Ünder", "x_y", "q-r", "naïve", "42", "日本語"]
    return [rng.choice([" ", "\n", ", "]).join(rng.choice(words) + (str(rng.randrange(40)) if rng.random() < 0.5 else "")
                                               for _ in range(rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 3])
def test_equals_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(k, t) for k, t in enumerate(texts(rng))]
    rows += [(500, None), (501, ""), (502, "..."), (None, "word " * 30), (3, "again " * 25), (504, "a " * 70_000)]
    target = ["Alpha beta 42", None, "été été delta7", ""]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows], extra="weight int, rank string")
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = sorted((tuple(r) for r in ir.resampled(docs, bench, ngrams=n).collect()), key=str)
    assert got == brute(rows, target, n)


def test_pieces_of_a_long_text_count_as_one(monkeypatch):
    rng = random.Random(9)
    text = " ".join(texts(rng, 20))
    for n in (1, 2, 4):
        whole = ir.feature_counts(text, n)
        monkeypatch.setattr(ir, "PIECE", 7)
        assert ir.feature_counts(text, n) == whole
        monkeypatch.undo()
        want, words = grams(text, n)
        assert ({k.decode(): v for k, v in whole[0].items()}, whole[1]) == (dict(Counter(want)), words)


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(4)
    gains = rng.integers(-30_000, 20_000, ir.BUCKETS)
    counts = rng.integers(0, 3, (70, ir.BUCKETS)) * rng.integers(0, 5000, (70, ir.BUCKETS))
    assert (ir.Gains(gains).weights(counts) == counts @ gains).all()
    zero = np.zeros((2, ir.BUCKETS), np.int64)
    assert (ir.Gains(np.zeros(ir.BUCKETS, np.int64)).weights(zero) == 0).all()


def test_ties_go_to_smaller_ids_and_empty_tables(spark, monkeypatch):
    bench = spark.createDataFrame([(0, "a b")], "item_id long, text string")
    assert ir.resampled(documents(spark, []), bench).collect() == []
    docs = documents(spark, ["one two three " * 10] * 40, list(range(40)))
    none = ir.resampled(docs, bench.where("false"), percent=50).collect()
    assert sorted(r["rank"] for r in none if r["rank"]) == list(range(1, 21))
    monkeypatch.setattr(ir, "SCALE", 0)  # all scores equal
    tied = {r.doc_id: r["rank"] for r in ir.resampled(docs, bench, percent=25).collect()}
    assert {k: v for k, v in tied.items() if v} == {k: k + 1 for k in range(10)}
