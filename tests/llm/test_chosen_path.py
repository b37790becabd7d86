import random
from collections import Counter, defaultdict

from strata.llm import chosen_path as q
from strata.llm.components import connected_components
from tests.llm.helpers import documents, pseudo_words


def brute(texts, num=4, den=5):
    """(class smallest id, links to other sets) per text index."""
    sets = [frozenset(q.shingles(t or "", {}).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same = a == b
            if same or (a and b and len(a & b) * den >= num * len(a | b)):
                x, y = sorted((find(i), find(j)))
                root[y] = x
                if not same:
                    linked[i].add(b)
                    linked[j].add(a)
    return [find(i) for i in range(len(texts))], [len(linked[i]) for i in range(len(texts))]


def corpus(rng):
    base = [" ".join(pseudo_words(rng, rng.randint(40, 300), 5000)) for _ in range(25)]
    texts = list(base)
    for _ in range(120):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 12])):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    return texts + ["", None, "   ", "one", "one", "One!", "a b", "a b c d e", "a b c d e f"]


def test_classes_and_links_match_brute_force(spark):
    texts = corpus(random.Random(8))
    docs = documents(spark, texts, extra="sig string, label int, class_id int")
    rows = {r.id: r for r in q.near_duplicates(docs, block=8).collect()}
    classes, links = brute(texts)
    assert len(rows) == len(texts)
    found = sum(r.n_links for r in rows.values())
    assert found >= 0.95 * sum(links) and all(rows[i].n_links <= n for i, n in enumerate(links))
    wrong = sum(rows[i].class_id != c for i, c in enumerate(classes))
    assert wrong <= 0.03 * len(texts)
    firsts = Counter(r.class_id for r in rows.values() if r.first)
    assert set(firsts.values()) == {1} and set(firsts) == {r.class_id for r in rows.values()}


def test_recall_at_the_threshold(spark):
    """Pairs of similarity just above 0.8, in tiny nodes so that all levels run."""
    rng = random.Random(2)
    texts = []
    for _ in range(150):
        words = pseudo_words(rng, 104, 10 ** 6)
        other = list(words)
        other[rng.randrange(10, 90)] = "x"
        other[-1] = "y"
        other[0] = "z"
        texts += [" ".join(words), " ".join(other)]
    _, links = brute(texts)
    got = q.near_duplicates(documents(spark, texts), bucket=2)
    assert sum(r.n_links for r in got.collect()) >= 0.95 * sum(links) > 0


def test_claimed_recall_at_the_threshold(spark):
    """At most 0.0001 of the pairs may be missed, so of 1,000 none, even if every
    node splits down to the last level."""
    rng = random.Random(12)
    texts = []
    for _ in range(1000):
        words = pseudo_words(rng, 104, 10 ** 9)
        other = list(words)
        # 11 of 100 shingles differ: similarity 89 / 111.
        other[rng.randrange(10, 40)] = other[rng.randrange(50, 90)] = other[-1] = "x"
        texts += [" ".join(words), " ".join(other)]
    got = q.near_duplicates(documents(spark, texts), bucket=1)
    assert sum(r.n_links for r in got.collect()) == 2000


def test_large_group_is_dealt_in_blocks(spark):
    rng = random.Random(6)
    words = pseudo_words(rng, 300, 10 ** 6)
    texts = []
    for i in range(200):
        own = list(words)
        own[rng.randrange(300)] = f"own{i}"
        texts.append(" ".join(own))
    texts += [" ".join(words)] * 40
    rows = q.near_duplicates(documents(spark, texts), block=32).collect()
    assert {r.class_id for r in rows} == {0} and sum(r["first"] for r in rows) == 1
    _, links = brute(texts)
    assert {r.id: r.n_links for r in rows} == dict(enumerate(links))


def test_keep_first(spark):
    rng = random.Random(1)
    a, b = (" ".join(pseudo_words(rng, 80, 10 ** 5)) for _ in range(2))
    docs = documents(spark, [a, b, a, None, "", a.upper()], ids=[4, 2, 3, None, 8, 9])
    kept = q.keep_first(docs)
    assert kept.columns == docs.columns
    # Of the texts without a word the null id comes first.
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 0), (True, 2), (True, 3)]
    assert q.keep_first(documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [
        (i, i + 1) for i in range(1000, 1080)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.label for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}


def test_runs_follow_the_recall():
    assert q.survival(1.0, 5) == 1 and q.survival(0.8, 1) > q.survival(0.8, 4)
    assert q.runs_for(0.8, 4, 0.99) > q.runs_for(0.8, 4, 0.9) > 1


def test_runs_cover_the_spread_of_equal_values():
    """With few hashes the share of equal ones spreads more, so more runs are needed."""
    assert q.runs_for(0.8, 4, 0.9999, 64) > q.runs_for(0.8, 4, 0.9999, 128) > \
        q.runs_for(0.8, 4, 0.9999, 1024)
    assert (1 - q.survival(0.8, 4)) ** q.runs_for(0.8, 4, 0.9999) <= 1e-4
