"""The pipeline: every stage on its own input against the operators' reports."""
import corpus_pipeline
from forgeline.llm import decontaminate, importance, jaccard_join, packing
from forgeline.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = read(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    rows, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SF)
        out.write.parquet(str(tmp_path / name))
        before, rows = rows, spark.read.parquet(str(tmp_path / name))
        ids = sorted(r[0] for r in rows.select("doc_id").distinct().collect())
        own = {r["doc_id"]: r for r in before.collect()}
        if name == "quality_classifier":
            want = [r["doc_id"] for r in importance.select(before, read(spark, SF, "labels")).where("kept").collect()]
        elif name == "exact_dedup":
            first = {}
            for i, r in own.items():
                k = "".join((r["text"] or "").split(" ")).translate({9: None, 10: None, 11: None, 12: None, 13: None})
                first[k] = min(first.get(k, (0, 10**9)), (-len(r["text"] or ""), i))
            want = [i for _, i in first.values()]
        elif name == "ngram_jaccard_join":
            want = {r["component_id"] for r in jaccard_join.near_duplicates(before).collect()}
        elif name == "benchmark_decontamination":
            want = [r["doc_id"] for r in decontaminate.report(before, read(spark, SF, "benchmark")).where("not contaminated").collect()]
        else:
            want = own
        assert ids == sorted(want), name
        if name != "best_fit_packing":
            assert rows.columns == docs.columns
        seen.append(len(ids))
    assert seen[0] <= docs.count() and seen == sorted(seen, reverse=True) and seen[0] > seen[2]
    whole = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in whole.select("doc_id").collect()} == set(ids)
    assert whole.agg({"length": "max"}).first()[0] <= packing.CAPACITY
