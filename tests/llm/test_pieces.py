import random

import numpy as np
import pytest

from strata.llm import nbest, token_counts
from strata.llm.part_lattices import Lattices
from strata.llm.pieces import load, model_bytes
from strata.llm.queries import tokenizer
from tests.llm.helpers import documents

PATH = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return load(model_bytes(PATH))


@pytest.fixture(scope="module")
def unigram():
    """The library's own lattice over the same pieces and scores."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
    m = sentencepiece_model_pb2.ModelProto()
    m.ParseFromString(model_bytes(PATH))
    m.trainer_spec.model_type = 1
    return SentencePieceProcessor(model_proto=m.SerializeToString())


def all_segmentations(part, pieces):
    if not part:
        return [(0.0, ())]
    out = []
    for k in range(1, len(part) + 1):
        head = part[:k]
        if head in pieces.scores:
            step, ids = pieces.scores[head], (pieces.ids[head],)
        elif k == 1:
            step, ids = pieces.unknown_score, pieces.unknown_ids(head)
        else:
            continue
        out += [(step + s, ids + rest) for s, rest in all_segmentations(part[k:], pieces)]
    return out


@pytest.mark.parametrize("part", ["▁the", "▁brownish", "abab", "▁é日x", "a", "\n", "▁▁▁x", "𝄞"])
def test_nbest_part_is_exact(pieces, part):
    want = sorted((s for s, _ in all_segmentations(part, pieces)), reverse=True)[:6]
    got = nbest.nbest_part(part, pieces, 6)
    assert [s for s, _ in got] == pytest.approx(want)
    assert len({ids for _, ids in got}) == len(got)


def test_matches_the_library(pieces, unigram):
    words = "the ing tion stand entre queux unter niño token international fox".split()
    for w in words:
        want = unigram.nbest_encode_as_ids(w, 5)
        got = nbest.nbest_part("▁" + w, pieces, 5)
        score = [sum(pieces.scores[pieces.texts[i]] for i in ids) for ids in want]
        assert [s for s, _ in got] == pytest.approx(score)


def test_text_nbest_combines_parts(pieces):
    text = "the cat sat"
    parts = pieces.parts(text)
    firsts = [nbest.best_part(p, pieces) for p in parts]
    whole = sorted((s for s, _ in all_segmentations(pieces.normal(text), pieces)), reverse=True)[:4]
    found = nbest.combine(np.array([x[2] for x in firsts]),
                          lambda k: nbest.nbest_part(parts[k], pieces, 4), 4)
    assert [sum(x[0] for x in firsts) - loss for loss, _ in found] == pytest.approx(whole)


@pytest.mark.parametrize("part", ["▁the", "▁brownish", "abab", "▁é日x", "a", "\n", "▁▁▁x", "aaaa"])
def test_best_and_gap(pieces, part):
    want = sorted((s for s, _ in all_segmentations(part, pieces)), reverse=True)
    score, ids, gap = nbest.best_part(part, pieces)
    assert score == pytest.approx(want[0]) and pieces.decode(ids) == part.replace("▁", " ").removeprefix(" ")
    assert gap == pytest.approx(want[0] - want[1]) if len(want) > 1 else gap == float("inf")


@pytest.mark.parametrize("part", ["-" * 2000, "=" * 2000, "a" * 2000, "▁" + "ab" * 1000])
def test_ties_are_not_explored_in_breadth(pieces, part):
    import time
    start = time.process_time()
    got = nbest.nbest_part(part, pieces, 4)
    assert time.process_time() - start < 1
    scores = [s for s, _ in got]
    assert len({ids for _, ids in got}) == 4 and scores == sorted(scores, reverse=True)
    assert scores[0] == pytest.approx(nbest.best_part(part, pieces)[0])


def test_combine_of_many_needs_no_product(pieces):
    parts = [f"▁{w}" for w in "stand entre queux unter token international fox being their".split()]
    firsts = [nbest.best_part(p, pieces) for p in parts]
    gaps = np.array([x[2] for x in firsts])
    found = nbest.combine(gaps, lambda k: nbest.nbest_part(parts[k], pieces, 12), 12)
    losses = [loss for loss, _ in found]
    assert len(found) == 12 and losses == sorted(losses) and losses[0] == 0
    # The best that change one part alone are among them, or beaten by all of them.
    single = sorted(firsts[k][0] - s for k in range(len(parts)) for s, _ in nbest.nbest_part(parts[k], pieces, 12)[1:])
    assert losses[1] == pytest.approx(single[0])
    pairs = sorted({round(a + b, 9) for a in gaps for b in gaps if a < b} | {round(x, 9) for x in single})
    assert all(x <= y + 1e-6 for x, y in zip(losses[1:], pairs, strict=False))


def test_many_parts_at_once_equal_one_by_one(pieces):
    rng = random.Random(8)
    letters = "abcdeinorst▁é日𝄞x\u0000-='\n"
    parts = list({"".join(rng.choices(letters, k=rng.randint(1, 70))) for _ in range(3000)}
                 | {"▁the", "a", "▁", "▁▁▁▁x", "-" * 64, "=" * 63, "\0", "ab\0", "▁international"})
    found = Lattices(pieces).solve(parts, lambda p: nbest.best_part(p, pieces))
    assert len(found) == len(parts)
    for part in parts:
        assert found[part] == nbest.best_part(part, pieces)


def test_split_equals_parts(pieces):
    import pyarrow as pa
    rng = random.Random(4)
    texts = ["", "▁", "\n", "", " \n ▁\n\n", "a", "ab \n"] + [
        "".join(rng.choices("ab ▁\n\té日𝄞\0", k=rng.randint(0, 40))) for _ in range(400)]
    whole = pa.array(["cut off", *texts, "too"], pa.large_string()).slice(1, len(texts))
    for some in (whole, whole.slice(3, 0), whole.slice(0, 1), whole.slice(1, 1)):
        codes, parts, ends = pieces.split(some)
        assert len(parts) == len(set(parts)) and len(ends) == len(some) + 1
        for k, text in enumerate(some.to_pylist()):
            assert [parts[c] for c in codes[ends[k]:ends[k + 1]]] == pieces.parts(text)


def test_tasks_of_a_worker_share_what_they_solved(pieces, monkeypatch):
    import pyarrow as pa
    texts = ["sharing one memo between tasks", "x" * 200 + " \x7f日"] * 2
    batch = pa.record_batch({"id": pa.array(range(4)), "text": pa.array(texts)})
    solved, plain = [], Lattices.columns if hasattr(Lattices, "columns") else Lattices.solve
    monkeypatch.setattr(Lattices, plain.__name__, lambda self, parts, alone: solved.extend(
        p for p in parts if len(p) <= 64) or plain(self, parts, alone))
    runs = [pa.Table.from_batches(nbest._encoder(model_bytes(PATH), 4)(iter([batch]))) for _ in range(2)]
    assert len(solved) == len(set(solved)) and runs[0].equals(runs[1])


def test_small_generations_give_the_same(pieces):
    rng = random.Random(6)
    solved = nbest.Solved(pieces, 3)
    for _ in range(200):
        parts = list({"".join(rng.choices("ab▁é\x7f", k=rng.choice((1, 2, 3, 70)))) for _ in range(4)})
        got, trips = solved.find(parts)
        for k, part in enumerate(parts):
            own = tuple(got.ids[got.first[k]:got.first[k] + got.count[k]].tolist())
            assert (got.score[k], own, got.gap[k]) == nbest.best_part(part, pieces)
            assert trips[k] == (pieces.spelled(own) == part)
        assert len(solved.young.row) < 3 + 4


TEXTS = [None, "", " ", "a", "  two  spaces \n\n and\tlines\r\n", "é日本 𝄞 \u0000 x",
         "the of and " * 300, "x" * 3000, "a ▁ mark"]


def test_query_round_trip_and_counts(spark, pieces):
    rng = random.Random(2)
    texts = TEXTS + [" ".join("".join(rng.choices("abcdeinorst", k=rng.randint(1, 12)))
                              for _ in range(50)) for _ in range(20)]
    ids = [None, *range(1, len(texts) - 1), 1]
    docs = documents(spark, texts, ids=ids, extra="ids int, id string, n_tokens string")
    rows = nbest.segmentations(docs, PATH).collect()
    counts = token_counts.token_counts(docs, PATH, nodes=500).collect()
    assert len(rows) == len(counts) == len(texts)
    # Only a literal space mark is not given back.
    assert sorted(r.round_trip for r in rows) == [False] + [True] * (len(rows) - 1)
    assert sorted((r.id or 0, r.n_tokens) for r in rows) == sorted((r.id or 0, r.n_tokens) for r in counts)
    for r in rows:
        assert r.n_tokens == len(r.ids) and r.nbest[0].score == pytest.approx(r.score)
        scores = [b.score for b in r.nbest]
        assert scores == sorted(scores, reverse=True)
        text = pieces.decode(r.ids)
        seen = set()
        for b in r.nbest:
            other = nbest.edited(list(r.ids), [e.asDict() for e in b.edits])
            seen.add(tuple(other))
            assert len(other) == b.n_tokens and pieces.decode(other) == text
        assert len(seen) == len(r.nbest)
    back = nbest.decode_ids(nbest.segmentations(docs, PATH), PATH).collect()
    assert sorted(r.decoded for r in back) == sorted((t or "").replace("▁", " ") for t in texts)


def test_trie_shares_prefixes_and_survives_clearing(pieces):
    words = ["▁internation", "▁international", "▁inter", "x", "▁日本", ""]
    trie = token_counts.Trie(pieces, 10_000)
    want = [len(nbest.nbest_part(w, pieces, 1)[0][1]) if w else 0 for w in words]
    assert [trie.terminal(w) for w in words] == want
    before = len(trie.child)
    assert [trie.terminal(w) for w in words] == want and len(trie.child) == before
    small = token_counts.Trie(pieces, 3)
    assert [small.terminal(w) for w in words * 3] == want * 3


def test_empty_table(spark):
    docs = documents(spark, [])
    assert nbest.segmentations(docs, PATH).count() == 0
    assert token_counts.token_counts(docs, PATH).count() == 0
