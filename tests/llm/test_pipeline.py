"""The stages one after the other, each on what its predecessor kept."""

import corpus_pipeline
from scorelab.llm import decontaminate, line_dedup, pieces, toxicity
from test_decontaminate import brute
from test_models import brute_lines


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
        if name != "encoding":
            assert docs.columns == columns
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{small}/labels.parquet"))
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect() if model.score(r.text) < 0.7}
        if name == "line_dedup":
            expected = brute_lines([(r.doc_id, r.text, r.source) for r in before.collect()], line_dedup.SPREAD)
            assert sorted([(r.doc_id, r.text) for r in docs.collect()], key=str) == expected
        if name == "near_dedup":
            # Exact copies leave one row each.
            assert docs.count() == docs.select("text").distinct().count() and docs.count() >= 0.8 * before.count()
        if name == "decontamination":
            items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect() if not brute(r.text, items, decontaminate.WINDOW)[1]}
        if name == "encoding":
            texts = {r.doc_id: r.text for r in before.collect()}
            assert {r.doc_id: r.text for r in pieces.decode(docs).collect()} == texts
    assert sorted(map(str, corpus_pipeline.run(spark, small).select("doc_id", "ids").collect())) == sorted(map(str, kept["encoding"].select("doc_id", "ids").collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows(spark, odd, none, small):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, small)
        assert name == "encoding" or out.columns == odd.columns
        assert out.count() > 0 and stage(spark, none, small).count() == 0
