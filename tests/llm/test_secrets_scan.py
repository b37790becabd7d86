import hashlib
import random
import re

from pyspark.sql import functions as F

from strata.llm import secrets_scan as q
from tests.llm.helpers import documents

KEYWORD = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in KEYWORD.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def told(spans):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)


def run(spark, docs, **kw):
    return q.scan(docs, F.col("source"), F.concat_ws("/", "source", "lang"), **kw).collect()


def test_base_matches_brute_force(spark):
    rng = random.Random(1)
    bits = ["token", "PASSWORD", "api_key", "apikey", "secret", " ", "=", ": ", '"', "'", "AKIA", "A1B2",
            "0123456789abcdef", "deadbeef", "é", "𝄞", "toKen", "ſecret", "\n", "-", "mypassword", "abcdefghijkl"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += [None, "", "token=mypassword: abcdefghijklmnop", "AKIA" * 9, "a" * 40, "x" * 100_000]
    docs = documents(spark, texts, extra="spans string, found int, owner string, value int")
    rows = {r.id: r for r in run(spark, docs)}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        want, r = brute(text), rows[i]
        assert r.base_sha256 == hashlib.sha256(told(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in want) for n in range(3))
        assert [x for x in r.spans.split(",") if x and not x.startswith("owned")] == (
            told(want).split(",") if want else [])


def test_ownership_separates_examples_from_live_values(spark):
    live, copied, lone = ("Xk9q2LmZ8vTr4WbN7pYc3HsD", "Qw8eRt5yUi2oPa9sDf4gHj7k", "Zx3cVb6nMa1sDf8gHj5kLq0w")
    texts = [f"use {live} now", f"see {copied}", f"see {copied}", f"key {lone} {lone}", "xxxxxxxx1Xxxxxxxxxxxxxxxxxxx",
             f"token = {live}"]
    rows = spark.createDataFrame(
        [(0, texts[0], "a", "r1"), (1, texts[1], "a", "r1"), (2, texts[2], "b", "r1"), (3, texts[3], None, "r2"),
         (4, texts[4], "c", "r3"), (5, texts[5], "a", "r9")], "doc_id int, text string, owner string, repo string")
    got = {r.id: r for r in q.scan(rows, F.col("owner"), F.col("repo")).collect()}
    assert got[0].spans == f"owned:4:{4 + len(live)}" and got[0].n_owned == 1
    assert got[1].spans == got[2].spans == "" and got[1].n_copied == 1
    assert got[3].spans.count("owned") == 2 and got[4].spans == ""
    # A base span stays, whoever holds the value.
    assert got[5].spans.startswith("assign:0:") and got[5].n_owned == 1


def test_one_owner_with_many_repositories(spark):
    example, own = "Xk9q2LmZ8vTr4WbN7pYc3HsD", "Qw8eRt5yUi2oPa9sDf4gHj7k"
    rows = [(i, f"see {example}", "a", f"r{i % 5}") for i in range(40)]
    rows += [(50, own, "b", "r1"), (51, own, "b", "r2"), (52, own, "b", "r2"), (53, "no", "b", "r3")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, owner string, repo string")
    got = {r.id: r for r in q.scan(docs, F.col("owner"), F.col("repo")).collect()}
    assert {(got[i].spans, got[i].n_owned, got[i].n_copied, got[i].n_owners, got[i].n_repos)
            for i in range(40)} == {("", 0, 1, 1, 5)}
    assert {(got[i].n_owned, got[i].n_copied, got[i].n_owners, got[i].n_repos)
            for i in (50, 51, 52)} == {(1, 0, 1, 2)}
    assert (got[53].n_owners, got[53].n_repos) == (0, 0)
    strict = q.scan(docs, F.col("owner"), F.col("repo"), copied_repos=6).collect()
    assert sum(r.n_owned for r in strict) == 43
    # The same name under two owners is two repositories.
    two = spark.createDataFrame([(1, own, "a", "r"), (2, own, "b", "r")], docs.schema)
    assert {(r.n_owners, r.n_repos) for r in q.scan(two, F.col("owner"), F.col("repo")).collect()} == {(2, 2)}


def test_null_and_repeated_rows_and_empty_table(spark):
    text = "token = abcdefabcdefabcdef0123"
    rows = run(spark, documents(spark, [text, text, text], ids=[None, 4, 4]))
    assert len(rows) == 3 and len({r.spans for r in rows}) == 1 and rows[0].n_assign == 1
    assert run(spark, documents(spark, [])) == []
