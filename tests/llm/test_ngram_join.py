import random

import pytest

from fareflow.llm import ngram_join
from fareflow.llm.components import components
from tests.llm.conftest import plain_shingles


def plain(rows):
    """Smallest id reachable by links, each pair compared."""
    sets = [plain_shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 4 >= max(len(a), len(b)) * 3 and 100 * len(a & b) >= 75 * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted([(doc, len(s), least.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))], key=str)


def got(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.near_duplicates(docs, ngram_join.Likeness(**how))
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out.collect()], key=str)


def test_hand_made_cases(spark):
    words = [f"w{i}" for i in range(60)]
    text = " ".join(words)
    rows = [(5, text), (3, text.upper()), (9, " \n".join(words[:55]) + "\t"), (4, None), (2, ""), (1, " \n "), (7, "a b"), (6, "A  b"), (8, "a b c"),
            (7, "other words that are not like it at all"), (None, text), (11, "long " * 30_000)]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("block, sample", [(256, 64), (4, 1)])
def test_chains_and_groups_against_all_pairs(spark, monkeypatch, block, sample):
    monkeypatch.setattr(ngram_join, "SAMPLE", sample)
    rng = random.Random(block)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=25)
    rows = []
    for base in range(6):
        words = rng.choices(vocabulary, k=rng.choice([8, 40, 120]))
        for _ in range(25):
            words_now = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words_now[rng.randrange(len(words_now))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words_now)))
            if base == 2:
                words = words_now  # a chain of copies of copies
    for _ in range(40):
        own = rng.choices(vocabulary, k=rng.randint(10, 60))
        rows.append((len(rows), " ".join(own[:5] + passage + own[5:])))
    assert got(spark, rows, block=block) == plain(rows)


def test_against_all_pairs_on_documents(spark, rows):
    pairs = [(r.doc_id, r.text) for r in rows]
    assert got(spark, pairs) == plain(pairs)


def test_one_document_of_each_group_stays(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", 1), (1, "a b c d e f", 2), (3, "", 3), (4, None, 4)], "doc_id long, text string, cls int")
    assert sorted(r.doc_id for r in ngram_join.drop_near_duplicates(docs).collect()) == [1, 3, 4]
    assert ngram_join.drop_near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)]
    out = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
