import corpus_pipeline
from strata.llm import chosen_path, nbest
from strata.llm.common import table, written
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_chosen_path import brute as brute_classes
from tests.llm.test_line_dedup import brute_all as brute_lines


def test_stages_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = written(stage(spark, docs, SF_SMALL), name)
        seen[name] = before, {r.doc_id: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = seen["quality_rules"]
    labels = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
    short = {i for i, r in before.items() if len(r.text.split()) < 50}
    assert not short & set(after)
    assert all(after[i].text == before[i].text for i in after)
    before, after = seen["line_dedup"]
    order = sorted(before)
    want = brute_lines((i, before[i].text) for i in order)
    assert {i: r.text for i, r in after.items()} == dict(zip(order, want, strict=True))
    assert all(r.n_chars == len(r.text) for r in after.values())
    before, after = seen["ngram_jaccard_join"]
    order = sorted(before)
    classes, _ = brute_classes([before[i].text for i in order])
    assert set(after) == {order[c] for c in classes}
    before, after = seen["benchmark_decontamination"]
    items = [" ".join(r.text.lower().split()) for r in table(spark, SF_SMALL, "benchmark").collect()]
    holds = {i for i, r in before.items() if any(x in " ".join(r.text.lower().split()) for x in items)}
    assert holds and not holds & set(after) and len(after) >= len(before) - len(holds) - 1
    before, after = seen["sentencepiece_nbest"]
    assert set(after) == set(before) and all(r.round_trip for r in after.values())
    kept = [i for i in labels if labels[i] == 1 and i in seen["quality_rules"][0] and i not in short]
    assert sum(i in seen["quality_rules"][1] for i in kept) >= 0.97 * len(kept)


def test_run_and_registration(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination",
                     "sentencepiece_nbest"]
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns[0] == "doc_id" and out.count() > 0
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert chosen_path.NGRAM == 5 and nbest.MEMO


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF_SMALL, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
