import corpus_pipeline
from fareflow.llm import toxicity
from tests.llm.conftest import plain_words
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_ngram_join import plain as plain_classes

SF = "/root/testdata/sf0.001"


def test_each_stage_against_a_plain_version(spark, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept[name] = (docs.collect(), out.collect())
        if name != "best_fit_packing":
            assert out.dtypes == documents.dtypes
            docs = spark.createDataFrame(kept[name][1], documents.schema)

    before, after = kept["toxicity"]
    weights = corpus_pipeline.queries.toxicity_weights(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(documents, weights).filter("predicted = 0").collect()}
    assert {r.doc_id for r in after} == clean and 0 < len(clean) < len(before)

    before, after = kept["line_dedup"]
    assert sorted((r.doc_id, r.text) for r in after) == [(d, t) for d, t, _, _ in sorted(plain_lines([(r.doc_id, r.text) for r in before]))]
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = kept["ngram_jaccard_join"]
    assert {r.doc_id for r in after} == {d for d, _, c in plain_classes([(r.doc_id, r.text) for r in before]) if d == c}

    before, after = kept["benchmark_decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {r.doc_id for r in before if any(i in r.text for i in items)}

    before, after = kept["best_fit_packing"]
    assert sum(r.n_tokens for r in after) == sum(len(plain_words(r.text)) for r in before)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "n_tokens", "bin_id", "position"] and out.count() > 0


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", None, "s", 3), (3, "a b", None, "s", 3),
                                  (None, "c " * 5000, "en", None, 10000)], "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, SF)
            rows = out.collect()
            assert empty == (not rows)
            now = spark.createDataFrame(rows, out.schema)
