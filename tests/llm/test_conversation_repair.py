import hashlib
import os
import random

import duckdb
import pytest

from strata.llm import conversation_repair as cr
from strata.llm import sql

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def best(codes):
    """Least (cost, audit) by trying every edit, with strings kept per state."""
    ways = {cr.START: (0, "")}
    for code in codes:
        new = {}
        for a, (cost, audit) in ways.items():
            for (x, b), (more, edits) in cr.row_edits(code).items():
                if x == a:
                    offer = (cost + more, audit + edits)
                    new[b] = min(new.get(b, offer), offer)
        ways = new
    return min((c + cr.INSERT * len(cr.CLOSING[s]), a + cr.CLOSING[s]) for s, (c, a) in ways.items())


def solved(codes):
    vector = cr.only(cr.START)
    for code in codes:
        vector, _ = cr.row_ahead(vector, code)
    path = cr.crossings(codes, cr.START, cr.last_state(vector))
    found = [cr.row_edits(c)[a, b] for c, a, b in zip(codes, path, path[1:], strict=False)]
    end = cr.CLOSING[path[-1]]
    return sum(c for c, _ in found) + cr.INSERT * len(end), "".join(e for _, e in found) + end


def test_crossings_are_the_audit_least_optimum():
    rng = random.Random(5)
    for _ in range(3000):
        codes = [rng.randrange(16) for _ in range(rng.randint(1, 12))]
        assert solved(codes) == best(codes)
    long = [rng.randrange(16) for _ in range(5000)]
    assert solved(long) == best(long)


def test_row_edits_by_exhaustion():
    # Every sequence of at most three inserts and one edit, from every state.
    for code in range(16):
        initial, fault = "sua?"[code % 4], code // 4
        for a in range(4):
            found, at = {}, a
            for n in range(4):
                options = [(at, 3, "D")]
                if fault not in (1, 2):
                    late = int(fault == 3)
                    if cr.follows(at, initial) is not None:
                        options.append((cr.follows(at, initial), late, "K"))
                    options += [(cr.follows(at, r), 2 + late, "R") for r in "ua" if cr.follows(at, r) is not None]
                for b, cost, edit in options:
                    offer = (2 * n + cost, "I" * n + edit)
                    found[b] = min(found.get(b, offer), offer)
                at = cr.NEXT[at]
            got = {b: v for (x, b), v in cr.row_edits(code).items() if x == a}
            assert got == found


def conversations(rng, n=60):
    texts = ["Yes.", "No!", "why", "", " \t", "A longer line.\nwith an end?", "é", "Yes."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            if rng.random() < 0.9:
                rows.append((c, t, rng.choice(roles), rng.choice(texts) + (f" {t}." if rng.random() < 0.6 else "")))
    rows += [(None, 1, "user", "Null id."), (None, None, None, None), (7, None, "system", "No turn."),
             (1000, 5, "user", None), (1001, None, "user", "Only.")]
    return rows


def duck(rows, query):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(query).fetchall(), key=str)


@pytest.mark.parametrize("bits", [14, 1])
def test_equals_the_row_by_row_sql(spark, monkeypatch, bits):
    # One bit: every conversation is cut into blocks of at most two rows.
    monkeypatch.setattr(cr, "BLOCK_BITS", bits)
    rows = conversations(random.Random(bits))
    convs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", audit string")
    got = sorted((tuple(r) for r in cr.reports(cr.damaged(convs), convs).collect()), key=str)
    assert got == duck(rows, sql.CONVERSATION_REPAIR)


def test_one_long_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_BITS", 3)
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["system", "user", "user", "assistant"]), rng.choice(["a.", "b", f"{t}?", ""]))
            for t in range(700)]
    convs = spark.createDataFrame(rows, SCHEMA)
    report = cr.reports(convs).first()
    order, seen, codes = sorted(rows, key=lambda r: r[1]), set(), []
    for _, _, role, text in order:
        fault = cr.BLANK if not text else cr.DUPLICATE if (role, text) in seen else 0 if text[-1] in ".?" else cr.TRUNCATED
        seen.add((role, text))
        codes.append("sua".index(role[0]) + 4 * fault)
    assert (report.cost, report.audit) == best(codes)
    lines = cr.repaired(convs).orderBy("place").collect()
    body = "\n".join(f"{r.role}:{r.text}" for r in lines)
    assert hashlib.sha256(body.encode()).hexdigest() == report.repaired_sha256
    initials = "".join(r.role[0] for r in lines)
    assert initials.removeprefix("s") == "ua" * (len(initials) // 2)
    assert [r.edit for r in lines] == [e for e in report.audit if e != "D"]


def test_empty_table_and_lost_conversation(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.reports(cr.damaged(empty), empty).collect() == []
    one = spark.createDataFrame([(5, 0, "user", "Hi.")], SCHEMA)
    got = cr.reports(one.where("false"), one).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_text(spark):
    text = "word " * 400_000 + "end."
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "user", text)]
    report = cr.reports(spark.createDataFrame(rows, SCHEMA)).first()
    assert (report.duplicate, report.audit, report.cost) == (1, "KKD", 3)
    body = f"user:{text}\nassistant:{text}"
    assert report.repaired_sha256 == hashlib.sha256(body.encode()).hexdigest()


def test_given_table(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    convs = spark.read.parquet(path)
    got = sorted((tuple(r) for r in cr.reports(cr.damaged(convs), convs).collect()), key=str)
    assert got == duck([tuple(r) for r in convs.collect()], sql.CONVERSATION_REPAIR)
