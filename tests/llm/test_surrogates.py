import re

import pytest
from pyspark.sql import functions as F

from strata.llm import surrogates as q
from tests.llm.helpers import documents


def run(spark, texts, **kw):
    docs = documents(spark, texts, **kw)
    return {r.doc_id: r for r in q.replace_entities(docs, "key", counts=True).collect()}


def test_formats_are_kept(spark):
    text = ("Write Anna.Smith7@Mail5.example.com, +1 (743) 555-3824, 70.23.22.57, 4012888888881881, "
            "4111 1111 1111 1111, 123-45-6789, DE44 5001 0517 5407 3249 31.")
    r = run(spark, [text])[0]
    shape = re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d+", lambda m: "9" * len(m[0]), r.text)))
    want = re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d+", lambda m: "9" * len(m[0]), text)))
    ip = re.compile(r"9+\.9+\.9+\.9+")
    assert ip.sub("IP", shape).lower() == ip.sub("IP", want).lower()
    for secret in ("Smith", "555-3824", "743", "70.23.22.57", "4012888888881881", "123-45", "5001 0517"):
        assert secret not in r.text
    assert "+1 (" in r.text and re.search(r"\bDE\d\d ", r.text)
    cards = [re.sub(r"\D", "", c) for c in re.findall(r"\b4\d{15}\b|\b4\d{3}(?: \d{4}){3}", r.text)]
    assert len(cards) == 2
    for c in cards:
        d = [int(x) * (2 if i % 2 == 0 else 1) for i, x in enumerate(c)]
        assert sum(x - 9 if x > 9 else x for x in d) % 10 == 0
    assert (r.n_email, r.n_phone, r.n_ip, r.n_card, r.n_national, r.n_iban) == (1, 1, 1, 2, 1, 1)


def test_coreference_and_keys(spark):
    texts = ["a.b@c.org and +49 30 1234567", "A.B@C.ORG calls +49-30-1234567",
             "Frau Anna Weber met Dr. Weber and Mr Paul Jones", "Г-н Иван Петров и Г-жа Анна Петров"]
    a = run(spark, texts)
    first, second = (re.search(r"\S+@\S+", a[i].text)[0] for i in (0, 1))
    assert first != "a.b@c.org" and second == first.upper()
    phones = [re.sub(r"\D", "", a[i].text.split("+")[1]) for i in (0, 1)]
    assert phones[0] == phones[1] and phones[0].startswith("4")
    m = re.fullmatch(r"Frau (\w+) (\w+) met Dr. (\w+) and Mr (\w+) (\w+)", a[2].text)
    assert m[2] == m[3] != m[5] and "Weber" not in a[2].text and m[1][0].isupper()
    # A female ending and a male one.
    assert any(m[1].endswith(e) for e in q.ENDINGS["latin", "female"])
    assert any(m[4].endswith(e) for e in q.ENDINGS["latin", "male"])
    c = re.fullmatch(r"Г-н (\w+) (\w+) и Г-жа (\w+) (\w+)", a[3].text)
    assert c[2] == c[4] and re.fullmatch("[а-яА-Я]+", c[1] + c[2] + c[3])
    docs = documents(spark, texts)
    other = {r.doc_id: r.text for r in q.replace_entities(docs, "another key").collect()}
    assert all(other[i] != a[i].text for i in range(4))


def test_distinct_entities_stay_distinct(spark):
    """One-letter addresses have few surrogates: clashes must be drawn again."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters[:16]]
    entities = spark.createDataFrame([("email", m) for m in mails], "kind string, canon string")
    got = {r.canon: r.surrogate for r in q.assign(entities, "k").collect()}
    assert set(got) == set(mails) and len(set(got.values())) == len(mails)
    assert not set(got.values()) & set(mails)
    with pytest.raises(ValueError):
        q.assign(entities, "k", max_rounds=1)


def test_edge_cases(spark):
    texts = [None, "", "nothing here 12", "x" * 50_000, "v1.2.3.4.5 1234 @x a@b", "m@n.org " * 500]
    docs = documents(spark, texts + ["m@n.org"], ids=[0, 1, 2, 3, 4, None, None],
                     extra="n_email string, kind string, _pii_id int, pos int")
    out = q.replace_entities(docs, "key")
    assert out.columns == docs.columns
    rows = {r.doc_id: r.text for r in out.where("doc_id is not null").collect()}
    assert rows == dict(enumerate(texts[:5]))
    nulls = [r.text for r in out.where("doc_id is null").collect()]
    assert len(nulls) == 2 and len({w for t in nulls for w in t.split()}) == 1
    twice = documents(spark, ["m@n.org", "m@n.org"], ids=[1, 1])
    assert q.replace_entities(twice, "key").count() == 2
    assert q.replace_entities(documents(spark, []), "key", counts=True).count() == 0


def test_plan_has_no_python(spark):
    out = q.replace_entities(documents(spark, ["a@b.org"]), "key")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert out.where(F.col("text").contains("a@b")).count() == 0


def test_untitled_mentions_and_titles_of_other_gender(spark):
    text = "Ms. Maria Rossi met Dr. Maria Rossi. Maria Rossi left, ROSSI said; maria, Rossini and Marias stay."
    a = run(spark, [text, "Rossi and Maria stand in a document without a title.", "Mr Alex Kent\nMrs Alex Kent. Alex"])
    m = re.fullmatch(r"Ms\. (\w+) (\w+) met Dr\. (\w+) (\w+)\. (\w+) (\w+) left, (\w+) said; maria, Rossini and Marias stay\.",
                     a[0].text)
    assert m[1] == m[3] == m[5] != "Maria" and m[2] == m[4] == m[6] == m[7].title() != "Rossi" and m[7].isupper()
    assert any(m[1].endswith(e) for e in q.ENDINGS["latin", "female"])
    assert a[1].text.startswith("Rossi and Maria stand")
    k = re.fullmatch(r"Mr (\w+) (\w+)\nMrs (\w+) (\w+)\. (\w+)", a[2].text)
    assert k[1] == k[3] == k[5] and any(k[1].endswith(e) for e in q.ENDINGS["latin", "any"])


def test_later_draws_keep_the_script(spark):
    names = [("surname", "петров"), ("given", "ελένη"), ("email", "иван@пример.рф")]
    todo = spark.createDataFrame([(k, c, "any", q.GROW_AFTER) for k, c in names],
                                 "kind string, canon string, gender string, attempt int")
    got = {r.kind: r.surrogate for r in q.draw(todo, "k").collect()}
    assert re.fullmatch("[а-яё]+", got["surname"]) and re.fullmatch("[α-ωά-ώ]+", got["given"])
    assert re.fullmatch(r"[а-яё]{8}@[а-яё]{6}\.рф", got["email"])
