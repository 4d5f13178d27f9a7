from collections import defaultdict

from pyspark.sql import functions as F

from fareflow.llm import packing
from tests.llm.conftest import plain_words


def plain_best_fit(pieces, capacity):
    """Each piece into the compatible bin with the least room that is enough, all bins looked at."""
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [b for b in bins if b["room"] >= size and source not in b["sources"] and cluster not in b["clusters"]]
        if not fits:
            bins.append({"room": capacity, "sources": set(), "clusters": set(), "id": len(bins)})
            fits = bins[-1:]
        best = min(fits, key=lambda b: (b["room"], b["id"]))
        best["room"] -= size
        if source is not None:
            best["sources"].add(source)
        best["clusters"].add(cluster)
        out.append(best["id"])
    return out


def test_successor_search_against_all_bins():
    rows = [(i, 1 + (i * 37) % 90, f"s{i * i % 5}" if i % 9 else None, str(i % 40)) for i in range(400)]
    packed = {r[0]: r for r in packing.pack_shard(rows, 100)}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    wanted = plain_best_fit([r[1:] for r in order], 100)
    assert [int(packed[r[0]][3]) for r in order] == wanted


def test_documents(spark, documents, rows):
    out = packing.pack(documents, capacity=300, rows_per_shard=60).collect()
    by_doc, by_bin = defaultdict(int), defaultdict(list)
    docs = {r.doc_id: r for r in rows}
    for r in out:
        by_doc[r.doc_id] += r.n_tokens
        by_bin[r.bin_id].append(r)
    assert by_doc == {r.doc_id: len(plain_words(r.text)) for r in rows}
    for pieces in by_bin.values():
        pieces.sort(key=lambda r: r.position)
        at = 0
        for r in pieces:
            assert r.position == at
            at += r.n_tokens
        assert at <= 300
        assert len({docs[r.doc_id].source for r in pieces}) == len(pieces)
        assert len({tuple(plain_words(docs[r.doc_id].text)) for r in pieces}) == len(pieces)


def test_defined_cases(spark):
    df = spark.createDataFrame(
        [(1, None, "a", 1), (2, "", "a", 1), (3, "w " * 25, None, 1), (3, "w " * 25, None, 1), (None, "x y", None, 1), (4, "x  y", "a", 2), (5, "z", "a", 2)],
        "doc_id long, text string, source string, piece int")
    out = sorted((str(r.doc_id), r.piece, r.n_tokens, r.bin_id is None) for r in packing.pack(df, capacity=10).collect())
    assert out == sorted([("1", 0, 0, True), ("2", 0, 0, True), *[("3", p, n, False) for p, n in ((0, 10), (1, 10), (2, 5))] * 2,
                          ("None", 0, 2, False), ("4", 0, 2, False), ("5", 0, 1, False)])
    assert packing.pack(df.limit(0)).count() == 0
    lengths = packing.pack(df, capacity=10, length=F.lit(3), cluster=F.col("piece")).collect()
    assert {r.n_tokens for r in lengths} == {3} and len({r.bin_id for r in lengths}) == 5  # five rows of one cluster
