import random

from strata.llm import decontaminate as q
from tests.llm.helpers import documents, pseudo_words


def items(n=30, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(pseudo_words(rng, rng.randint(12, 60), 900)) + ". "
             + " ".join(pseudo_words(rng, 6, 900)) + ".") for i in range(n)]


def test_search_equals_brute_force():
    index = q.build_index(items(200), width=4)
    rng = random.Random(3)
    for threshold in (0.05, 0.2, 0.6):
        for _ in range(60):
            terms = sorted({index.terms[w] for k in rng.sample(range(200), 2)
                            for w in index.words[k][:rng.randint(3, 60)]}
                           | set(rng.sample(range(len(index.postings)), 10)))
            score = {}
            for t in terms:
                p = index.postings[t]
                for i, x in zip(p.items, p.impacts, strict=True):
                    score[i] = score.get(i, 0.0) + x
            want = sorted(i for i, x in score.items() if x >= threshold - 1e-9)
            got = q.search(index, terms, threshold)
            assert [i for i, _ in got] == want
            assert all(abs(x - score[i]) < 1e-9 for i, x in got)


def test_planted_items_are_found_and_clean_texts_are_not(spark):
    rng = random.Random(5)
    bench = items()
    texts, want = [], []
    for k in range(80):
        words = pseudo_words(rng, rng.choice([10, 100, 900]), 900)
        hit = sorted(rng.sample(range(30), k % 3))
        for i in hit:
            at = rng.randrange(len(words) + 1)
            words = words[:at] + ["#"] + bench[i][1].upper().split(" ") + ["#"] + words[at:]
        texts.append(" ".join(words))
        # Planted inside another planted item, an item may be cut in two.
        flat = " ".join(q.WORD.findall(texts[-1].lower()))
        want.append([i for i in hit if " ".join(q.WORD.findall(bench[i][1].lower())) in flat])
    texts += [None, "", "!!!"]
    want += [[], [], []]
    table = spark.createDataFrame(bench + [(None, "x y z"), (99, None), (98, ""), (97, "...")],
                                  "item_id int, text string")
    docs = documents(spark, texts, extra="items int, h string, leaked string")
    got = {r.doc_id: r for r in q.contaminated(docs, table).collect()}
    for i, w in enumerate(want):
        assert set(w) <= set(got[i]["items"]) and (bool(got[i]["items"]) == got[i].leaked)
        if not w:
            assert len(got[i]["items"]) <= 1 or i % 3
    assert not any(got[i].leaked for i in range(0, 80, 3))
    left = q.keep_clean(docs, table)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, r in got.items() if not r.leaked}
    # Several indexes find what one index finds.
    many = q.contaminated(docs, table, max_items=7)
    assert {r.doc_id for r in many.where("leaked").collect()} >= {i for i, w in enumerate(want) if w}


def test_item_longer_than_a_passage(spark):
    rng = random.Random(9)
    long = " ".join(pseudo_words(rng, 700, 10 ** 5))
    text = " ".join(pseudo_words(rng, 500, 10 ** 5)) + " " + long + " tail"
    table = spark.createDataFrame([(1, long), (1, long), (2, long)], "item_id int, text string")
    row = q.contaminated(documents(spark, [text]), table).first()
    assert row["items"] == [1, 2]


def test_long_texts_are_scored_in_portions(spark, monkeypatch):
    rng = random.Random(11)
    bench = items(20)
    texts = []
    for _ in range(6):
        words = pseudo_words(rng, 6000, 900)
        for i in rng.sample(range(20), 4):
            at = rng.randrange(len(words))
            words[at:at] = bench[i][1].split()
        texts.append(" ".join(words))
    texts += ["", "short text", bench[3][1]]
    index = q.build_index(bench)
    ids = [q.np.array([index.terms.get(w, -1) for w in t.split()], int) for t in texts]
    cut = list(q.portions(ids, index.length, 3))
    assert max(sum(-(-len(x) // index.length) for *_, x in some) for some in cut) <= 3
    table = spark.createDataFrame(bench, "item_id int, text string")
    whole = [r["items"] for r in q.contaminated(documents(spark, texts), table).orderBy("doc_id").collect()]
    monkeypatch.setattr(q, "MOST_SUMS", 60)  # three passages at once
    parts = [r["items"] for r in q.contaminated(documents(spark, texts), table).orderBy("doc_id").collect()]
    assert parts == whole and all(len(x) >= 4 for x in whole[:6])


def test_one_side_alone_is_not_enough(spark):
    bench = [(0, "alpha beta gamma delta epsilon zeta eta theta? The answer is forty two lemons today.")]
    table = spark.createDataFrame(bench, "item_id int, text string")
    texts = [bench[0][1], "alpha beta gamma delta epsilon zeta eta theta and so on",
             "alpha beta gamma delta epsilon zeta eta theta " + "answer " * 3 + "lemons today is forty two the"]
    rows = sorted(q.contaminated(documents(spark, texts), table).collect())
    assert [r.leaked for r in rows] == [True, False, False]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    docs = documents(spark, ["a b c", None])
    assert not any(r.leaked for r in q.contaminated(docs, none).collect())
    assert q.contaminated(documents(spark, []), none).count() == 0
