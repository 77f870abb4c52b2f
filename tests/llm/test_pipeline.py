"""The pipeline's stages against brute force, and the registered queries."""

import brute
from conftest import SF

import corpus_pipeline
from certloom.llm import queries, quality_rules
from certloom.llm.textops import materialize


def test_stages(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = materialize(stage(spark, docs, SF))
        assert docs.columns == documents.columns
        seen[name] = before, {r.doc_id: r.text for r in docs.collect()}
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in quality_rules.digest(documents, labels).where("kept").collect()}
    assert after == {i: before[i] for i in kept} and all(not brute.rule_statistics(t)[5] for t in after.values())
    before, after = seen["simhash_near_dedup"]
    first = set(brute.near_components({i: brute.simhash(t) for i, t in before.items()}).values())
    assert after == {i: before[i] for i in first}
    before, after = seen["substring_dedup"]
    want = brute.words_removed(sorted(before.items()))
    assert {i: brute.sha(b" ".join(brute.words(t))) for i, t in after.items()} == {i: x[2] for i, x in want.items()}
    before, after = seen["benchmark_decontamination"]
    assert after == {i: t for i, t in before.items() if not brute.contamination(t, bench)[4]}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(after)


def test_stages_odd(spark, odd, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, odd, SF).count() <= odd.count()
        assert stage(spark, nothing, SF).count() == 0


def test_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.REGISTRY)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.REGISTRY)
