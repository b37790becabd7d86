import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import quality_rules as q
from tests.llm.helpers import documents

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(4)
    out = [None, "", " \t\r\n\x0b", "a", "a b", "a b c", "a a a a a", "x\nx\n\nx \nx", "é日本 𝄞𝄞 é",
           "a b c a b c a b", "  nbsp is a letter"]
    for n in (60, 300, 4000):
        out.append(" ".join(rng.choice("abcdefgh#$|") * rng.randint(1, 3) for _ in range(n)))
        out.append("\n".join(" ".join(rng.choice("ab") for _ in range(3)) for _ in range(n // 3)))
        out.append(" ".join(str(rng.random()) for _ in range(n)))
    return out


def test_statistics_match_brute_force(spark):
    t = texts()
    docs = documents(spark, t, extra="kept string, n_words string, _words int, stats int")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = {r.doc_id: r for r in q.quality(docs, none).collect()}
    assert len(rows) == len(t)
    for i, text in enumerate(t):
        r, b = rows[i], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        assert r.base_failed == failed and r.kept == (not failed)


def test_rules_find_planted_fault_and_spare_clean_rows():
    rng = np.random.default_rng(0)
    n = 900
    rows = {"a": rng.random(n), "b": rng.random(n), "c": rng.random(n)}
    bad = (rows["a"] > 0.8) & (rows["b"] < 0.5)
    rules = q.cover(rows, bad)
    hit = np.zeros(n, bool)
    for r in rules:
        hit |= r.covers(rows)
    assert (hit & bad).sum() >= 0.9 * bad.sum()
    assert (hit & ~bad).sum() <= 0.02 * (~bad).sum()
    # Noise alone yields no rule.
    assert not q.cover(rows, rng.random(n) < 0.1)
    assert not q.cover(rows, np.zeros(n, bool))


def test_verdicts_follow_the_list_and_nulls_pass(spark):
    rng = random.Random(1)
    good = [" ".join(f"word{rng.randrange(10 ** 6)}" for _ in range(80)) for _ in range(60)]
    junk = [" ".join(f"w{rng.randrange(10 ** 6)}$$$" for _ in range(80)) for _ in range(60)]
    docs = documents(spark, good + junk + [None, None], ids=[*range(120), None, None])
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(60)] + [(i, 0, 0) for i in range(60, 120)]
        + [(None, 0, 0), (3, None, None), (500, 0, 0), (7, 1, 0)],
        "doc_id bigint, quality int, toxic int")
    out = q.quality(docs, labels)
    kept = {r.doc_id for r in out.where("kept").collect()}
    assert kept == set(range(60)) and out.count() == 122
    left = q.keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == 60


def test_one_repeated_id_brings_one_row(spark, monkeypatch):
    text = " ".join(f"word{j}" for j in range(60))
    docs = documents(spark, [f"{text} {k}" for k in range(300)], ids=[7] * 300)
    labels = spark.createDataFrame([(7, 1)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(q, "cover", lambda data, bad, **_: seen.append(len(bad)) or [])
    assert q.learn_rules(docs, labels) == [] and seen == [1]


def test_empty_table(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert q.quality(docs, labels).count() == 0 and q.keep_good(docs, labels).count() == 0


def test_plan_has_no_python(spark):
    docs = documents(spark, ["a b c"])
    plan = q.quality(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    assert plan.where(F.col("kept")).count() == 0
