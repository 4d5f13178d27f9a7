import pytest

from fareflow.llm import queries, toxicity

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = queries.op4_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").dropDuplicates(["doc_id"])
    seen = out.filter("held_out").join(labels, "doc_id").toPandas()
    rank = seen.score.rank()
    bad = seen.toxic == 1
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.97 and (seen.predicted == seen.toxic).mean() > 0.95
    assert out.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()


@pytest.fixture(scope="module")
def taught(spark):
    rows = [(i, ("you are an idiot and a fool " if i % 4 == 0 else "what a fine day for a walk ") + f"word{i} " * (i % 7)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


def test_weights_are_sparse_and_cases_defined(spark, taught):
    weights = taught.cache()
    assert 0 < weights.count() < 200
    odd = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "\n \t", 0.5), (4, "An IDIOT, and a fool!", 0.5), (4, "fine day", 0.5),
                                 (None, "idiot " * 50_000, 0.5)], "doc_id long, text string, Score double")
    out = toxicity.score(odd, weights).collect()
    assert [r.score for r in out[:2]] == [out[2].score] * 2 and out[0].predicted == 0
    assert out[3].predicted == 1 and out[4].predicted == 0 and out[5].predicted == 1
    assert all(0 <= r.score <= 1 for r in out)
    assert toxicity.drop_toxic(odd, weights).count() == 4
    assert toxicity.score(odd.limit(0), weights).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    weights = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, weights).collect()[0].score == 0


def test_sample_bound(spark):
    docs = spark.createDataFrame([(i, "bad word" if i % 2 else "good word") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    weights = toxicity.fit(docs, labels, toxicity.Ftrl(max_rows=500, rows_per_learner=100))
    assert [r.predicted for r in toxicity.score(docs.filter("doc_id < 2").orderBy("doc_id"), weights).collect()] == [0, 1]
