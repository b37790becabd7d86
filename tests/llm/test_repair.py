import random
from itertools import product
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import repair as q
from strata.llm.queries import tokenizer
from tests.llm.helpers import documents

PATH = tokenizer("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=80), max_size=12), st.integers(2, 4))
def test_shards_give_every_document_back(texts, least):
    docs = [np.array([*t, 2], np.int32) for t in texts]
    shard = q.Shard(q.pack(docs, 10, 2, least=least, batch=3))
    flat = [i for d in docs for i in d.tolist()]
    assert [shard.document(k).tolist() for k in range(shard.n_docs)] == [d.tolist() for d in docs]
    assert [shard.token(k) for k in range(shard.n_tokens)] == flat
    assert shard.n_tokens == len(flat)
    if texts:
        assert shard.end_id == 2
    with pytest.raises(IndexError):
        shard.token(len(flat))


def test_repetition_is_compressed():
    docs = [np.array([*range(50), 2], np.int32)] * 400
    shard = q.Shard(q.pack(docs, 100, 2))
    assert len(shard.symbols) < 0.1 * shard.n_tokens and len(shard.rules) > 40
    assert max(shard.lengths) >= 16 and shard.document(399).tolist() == docs[0].tolist()
    wide = q.Shard(q.pack(docs, 70_000, 2))
    assert wide.document(7).tolist() == docs[0].tolist()
    with pytest.raises(ValueError):
        q.Shard(b"nope" + bytes(40))


def test_rounds_go_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 40_000, 26_000)
    seq, rules = q.grammar(np.tile(np.r_[one, 40_000], 10), 40_000)
    assert len(rules) == 8192
    seq, rules = q.grammar(np.tile(np.r_[one[:6000], 40_000], 10), 40_000)
    inside = (seq[:-1] != 40_000) & (seq[1:] != 40_000)
    assert 5120 < len(rules) < 8192
    assert np.unique((seq[:-1] << 32 | seq[1:])[inside], return_counts=True)[1].max(initial=0) < 8


def test_files_hold_what_the_library_encodes(spark):
    from tokenizers import Tokenizer
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["don't", "Été", "ÉTÉ,", "x1y22", "###", "日本", "áb", "İ", "ΟΔΟΣ", "<|endoftext|>",
                                  " ", "\x1c", "𝄞", "́", "'s", "--"]) for _ in range(rng.randint(0, 90)))
             .replace("--", rng.choice("\n\t \r")) for _ in range(60)]
    texts += [None, "", " \n", "word " * 3000]
    ids = [i * 3 % 64 for i in range(64)]
    docs = documents(spark, texts, ids=ids, extra="file string, ids int, part int")
    shards = q.write_shards(docs, PATH, 2, shard_tokens=500)
    rows = sorted(q.read_documents(shards).collect(), key=lambda r: r.start)
    encode = Tokenizer.from_file(PATH)
    start = 0
    for r, (i, text) in zip(rows, sorted(zip(ids, texts, strict=True), key=lambda x: x[0]), strict=True):
        want = encode.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.id, r.start, r.n_tokens) == (i, start, len(want))
        assert r.ids_crc32 == crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    assert shards.select("part", "shard").distinct().count() == shards.count() > 4


def test_punctuation_after_any_letter(spark):
    """Lower-casing or NFC may leave a mark at a word's end, which joins the stop."""
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(PATH)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    texts = ["BİLGİ.", "TARİHİ: 1923", "হয়, ভালো".replace("য়", "\u09df"), "x\u095b.", "\ufb2a.",
             *(c + s for c in letters for s in (".", ",!"))]
    assert "\u09df" in texts[2]
    mine = q.Encoder(encode.to_str(), 500_000).encode(texts)
    library = encode.encode_batch_fast(texts, add_special_tokens=False)
    wrong = [t for t, a, b in zip(texts, mine, library, strict=True) if a.tolist() != b.ids]
    assert wrong == []
    rows = q.read_documents(q.write_shards(documents(spark, texts[:5]), PATH, 2)).collect()
    assert {r.id: r.ids_crc32 for r in rows} == {
        i: crc32(np.array([*e.ids, 2], "<u4").tobytes()) for i, e in enumerate(library[:5])}


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = q.read_documents(q.write_shards(documents(spark, ["b", "a", "c", None], ids=[1, 1, None, None]),
                                           PATH, 2)).collect()
    assert [(r.id, r.n_tokens) for r in sorted(rows, key=lambda r: r.start)] == [
        (None, 1), (None, 2), (1, 2), (1, 2)]
    assert q.read_documents(q.write_shards(documents(spark, []), PATH, 2)).count() == 0


def test_words_apart_equal_the_whole_text():
    """Every way through the memo: stable and other chunks, contractions, added tokens,
    control characters, both memos starting anew."""
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(PATH)
    rng = random.Random(8)
    bits = ["don't", "WE'LL", "'s", "''ve", "ÉTÉ", "straße", "Ёлка", "йод,", "x1y22", "--'d", "<|endoftext|>", "</w>",
            "a<|b", "́", "é", "ŉ", "µm", "ª", "²", "\x0b", "\x1c", "\xa0", "\x85", "日本", "İ", "…", "_", "\r\n"]
    texts = ["".join(rng.choice([*bits, " ", "\t", "\n", " "]) for _ in range(rng.randrange(60))) for _ in range(800)]
    want = [e.ids for e in encode.encode_batch_fast(texts, add_special_tokens=False)]
    for limit in (1_000_000, 40):
        mine = q.Encoder(encode.to_str(), limit)
        got = [x.tolist() for k in range(0, len(texts), 50) for x in mine.encode(texts[k:k + 50])]
        assert got == want


def test_other_tokenizers_are_not_taken_apart():
    import json
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    assert q._word_tokenizer(json.dumps(spec)) is not None
    for change in ({"normalizer": None}, {"pre_tokenizer": None}, {"model": spec["model"] | {"end_of_word_suffix": None}}):
        assert q._word_tokenizer(json.dumps(spec | change)) is None
    assert q.Encoder(json.dumps(spec | {"pre_tokenizer": None}), 10).words is None


def test_a_word_is_held_once():
    """A chunk that is its own word, or one word in other letter case, takes no second place."""
    mine = q.Encoder(open(PATH, encoding="utf-8").read(), 1_000_000)
    words = ["".join(w) for w in product("abcd", repeat=4)]
    got = mine.encode([" ".join(words), " ".join(w.title() for w in words)])
    assert got[0].tolist() == got[1].tolist()
    assert sum(len(x) for x in vars(mine).values() if isinstance(x, dict)) == 2 * len(words)
    assert len(mine.flat) == len(got[0])


def test_a_pattern_that_looks_around_is_not_taken_apart():
    import json
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]
    pattern["Regex"] = "[a-z]+(?=,)|" + pattern["Regex"]
    assert q._word_tokenizer(json.dumps(spec)) is None


def plain_round(seq, end, n_rules, least, batch):
    """One round of the grammar in plain Python: (symbols, pairs)."""
    counts = {}
    for a, b in zip(seq, seq[1:]):
        if end not in (a, b):
            counts[a, b] = counts.get((a, b), 0) + 1
    best = sorted((p for p in counts if counts[p] >= least), key=lambda p: (-counts[p], p))[:batch]
    number = {p: end + 1 + n_rules + k for k, p in enumerate(sorted(best))}
    out, k, run = [], 0, False
    while k < len(seq):
        pair = tuple(seq[k:k + 2])
        if pair in number and not run:
            out.append(number[pair])
            run = True     # its second symbol is taken; a hit there is the run's next
        elif run:
            run = False
        else:
            out.append(seq[k])
        k += 1
    return out, sorted(best)


def test_one_round_of_the_grammar_replaces_the_most_frequent_pairs():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 6, 3000)
    ids[::50] = 9
    for batch in (1, 4, 30):
        seq, rules = q.grammar(ids, 9, least=8, batch=batch, max_rules=batch)
        want, pairs = plain_round(ids.tolist(), 9, 0, 8, batch)
        assert (seq.tolist(), [tuple(r) for r in rules.tolist()]) == (want, pairs)


def test_a_whole_shard_is_read_with_each_rule_expanded_once():
    rng = np.random.default_rng(7)
    docs = [np.append(np.repeat(rng.integers(0, 40, 30), 4), 2).astype(np.int32) for _ in range(60)]
    for options in ({}, {"max_rules": 0}):
        shard = q.Shard(q.pack(docs, 100, 2, **options))
        assert shard.all().tolist() == np.concatenate(docs).tolist() == shard.expand(shard.symbols).tolist()
    calls = []
    expand = shard.expand
    shard = q.Shard(q.pack(docs, 100, 2))
    shard.expand = lambda seq: calls.append(len(seq)) or expand.__func__(shard, seq)
    shard.all()
    assert calls == [len(shard.rules)]
