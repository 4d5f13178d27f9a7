import hashlib

from pyspark.sql import functions as F

from fareflow.llm import fingerprints, queries
from tests.llm.conftest import SMALL, plain_shingles


def likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_against_plain_version(spark, rows):
    out = {r.doc_id: r for r in queries.op8_document_fingerprints(spark, SMALL).collect()}
    order = sorted(rows, key=lambda r: -r.doc_id)
    off = []
    for i, row in enumerate(order):
        text, after = row.text, order[(i + 1) % len(order)].text
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        got = out[row.doc_id]
        assert (got.n_chars, got.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own = plain_shingles(text.lower())
        off.append(abs(got.near_edited - likeness(own, plain_shingles(edited.lower()))))
        off.append(abs(got.near_next - likeness(own, plain_shingles(after.lower()))))
    assert len(out) == len(order) and sum(off) / len(off) < 0.04


def marks(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    return fingerprints.with_fingerprint(df, "text", "mark")


def test_short_texts_are_exact_and_equal_texts_equal(spark):
    texts = [None, "", " \n", "one", "One", "a b c d", "a b c d e", "a b c d e f", "a  B c d e\tf", "a b c d e f g h"]
    df = marks(spark, texts)
    both = df.alias("x").join(df.alias("y"), F.lit(True)).select(
        F.col("x.id").alias("i"), F.col("y.id").alias("j"), fingerprints.likeness(F.col("x.mark"), F.col("y.mark")).alias("near"),
        fingerprints.as_text(F.col("x.mark")).alias("a"), fingerprints.as_text(F.col("y.mark")).alias("b")).collect()
    for r in both:
        a, b = plain_shingles((texts[r.i] or "").lower()), plain_shingles((texts[r.j] or "").lower())
        assert r.near == likeness(a, b)
        assert (r.a == r.b) == (a == b)


def test_containment_of_unequal_texts_and_merging(spark):
    words = [f"w{i}" for i in range(20_000)]
    part, whole, rest = " ".join(words[:2000]), " ".join(words), " ".join(words[1996:])
    one = marks(spark, [part]).select(F.col("mark").alias("a"))
    two = marks(spark, [whole]).select(F.col("mark").alias("b"))
    three = marks(spark, [rest]).select(F.col("mark").alias("c"))
    r = one.join(two, F.lit(True)).join(three, F.lit(True)).select(
        fingerprints.containment(F.col("a"), F.col("b")).alias("inside"), fingerprints.likeness(F.col("a"), F.col("b")).alias("near"),
        fingerprints.merged(F.col("a"), F.col("c")).alias("merged"), "b").first()
    assert r.inside == 1.0 and abs(r.near - 0.1) < 0.02
    assert r.merged == r.b


def test_order_of_documents(spark):
    docs = spark.createDataFrame([(5, "aaaa"), (2, "bb"), (9, "cccccc"), (None, "dddd"), (7, None), (7, None)], "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_chars, r.edited) for r in fingerprints.edited_by_next(docs).collect()), key=str)
    assert out == sorted([(9, 6, "ccc"), (7, 0, ""), (7, 0, ""), (5, 4, "aabb"), (2, 2, "bc"), (None, 4, "dd")], key=str)
    assert fingerprints.edited_by_next(docs.filter("doc_id = 2")).first().edited == "bb"
    assert fingerprints.edited_by_next(docs.limit(0)).count() == 0
