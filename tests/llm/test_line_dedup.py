import random
import re

from strata.llm import line_dedup as q
from tests.llm.helpers import documents, pseudo_words


def brute_all(rows, t=(4, 5)):
    """Cleaned texts; a removed line still counts as an earlier line."""
    seen, out = [], []
    for _, text in rows:
        keep = []
        for line in (text or "").split("\n"):
            words = frozenset(x for x in re.split("[ \t-\r]+", line) if x)
            hit = bool(words) and any(len(words & s) * t[1] >= t[0] * len(words | s) for s in seen)
            if words:
                seen.append(words)
            if not hit:
                keep.append(line)
        out.append("\n".join(keep))
    return out


def noisy(rng, line):
    words = line.split(" ")
    for _ in range(rng.randrange(4)):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
    if rng.random() < 0.3:
        rng.shuffle(words)
    return " ".join(words)


def corpus(rng, n):
    base = [" ".join(pseudo_words(rng, rng.choice([1, 2, 3, 4, 5, 9, 20, 60]))) for _ in range(40)]
    docs = []
    for _ in range(n):
        lines = [rng.choice(base) if rng.random() < 0.3 else noisy(rng, rng.choice(base))
                 if rng.random() < 0.6 else " ".join(pseudo_words(rng, rng.randint(1, 40), 10 ** 5))
                 for _ in range(rng.randint(1, 8))]
        docs.append("\n".join(lines + [""] * rng.randrange(2)))
    return docs


def test_matches_brute_force(spark):
    rng = random.Random(3)
    texts = corpus(rng, 120) + ["", " \t", "\n\n", "\r", "a\x0bb\na b\nb a", None]
    docs = documents(spark, texts, extra="kept string, _kept int, key int, pos int")
    got = {r.doc_id: r for r in q.dedup_lines(docs, counts=("n_lines", "n_removed")).collect()}
    want = brute_all(enumerate(texts))
    assert len(got) == len(texts)
    for i, text in enumerate(want):
        assert got[i].text == text, i
    assert sum(r.n_removed for r in got.values()) > 100


def test_other_thresholds(spark):
    rng = random.Random(5)
    texts = corpus(rng, 40)
    for threshold, pair in ((0.5, (1, 2)), (0.9, (9, 10)), (1.0, (1, 1))):
        got = {r.doc_id: r.text for r in q.dedup_lines(documents(spark, texts),
                                                        threshold=threshold).collect()}
        assert [got[i] for i in range(len(texts))] == brute_all(enumerate(texts), pair)


def test_null_and_repeated_ids(spark):
    line = "one two three four five six"
    docs = documents(spark, [line, line, line, "other words stand here", None, line],
                     ids=[5, None, 5, None, 2, 9])
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text) for r in q.dedup_lines(docs).collect()))
    # The null id comes first; the two equal rows of id 5 are one document.
    assert rows == [(False, 0, line), (False, 0, "other words stand here"), (True, 2, ""),
                    (True, 5, ""), (True, 5, ""), (True, 9, "")]


def test_empty_table_and_native_plan(spark):
    out = q.dedup_lines(documents(spark, []))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_hot_line_and_long_text(spark):
    hot = " ".join(f"h{i}" for i in range(30))
    texts = [hot + "\n" + f"own{i} line{i} here{i} now{i}" for i in range(300)]
    texts.append("\n".join(f"l{i} a{i} b{i} c{i} d{i}" for i in range(3000)))
    got = {r.doc_id: r.text for r in q.dedup_lines(documents(spark, texts)).collect()}
    assert got[0] == texts[0] and got[300] == texts[300]
    assert all(got[i] == texts[i].split("\n")[1] for i in range(1, 300))
