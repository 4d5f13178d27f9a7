import random

import numpy as np
import pytest

from fareflow.llm import minhash
from fareflow.llm import text as tx
from fareflow.llm.queries import op13_minhash_dedup
from tests.llm.conftest import SMALL, plain_shingles


def plain(rows):
    """Smallest id reachable by links, each pair compared on full sets."""
    sets = [plain_shingles(t, 2) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and 100 * len(a & b) >= 80 * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    out = [(doc, len(s), least.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]
    return sorted([(*r, r[0] == r[2]) for r in out], key=str)


def got(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = minhash.near_duplicates(docs, minhash.MinHash(**how))
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()], key=str)


def test_hand_made_cases(spark):
    words = [f"w{i}" for i in range(60)]
    text = " ".join(words)
    rows = [(5, text), (3, text.upper()), (9, " \n".join(words[:52]) + "\t"), (4, None), (2, ""), (1, " \n "), (7, "a"), (6, " A  "), (8, "a b c"),
            (10, "a b c d"), (12, "a b c d e"), (13, "a b c d e f"), (14, "a b c d e f g"), (None, text), (None, None), (11, "long " * 30_000), (11, "long " * 3)]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("block", [256, 4])
def test_chains_and_groups_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(minhash, "STAR", 1024 if block == 256 else 3)
    rng = random.Random(block)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for base in range(6):
        words = rng.choices(vocabulary, k=rng.choice([8, 40, 120]))
        for _ in range(25):
            words_now = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 16))):
                words_now[rng.randrange(len(words_now))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words_now)))
            if base == 2:
                words = words_now  # a chain of copies of copies
    for _ in range(60):  # a shared passage: many are near the threshold, on both sides of it
        own = rng.choices(vocabulary, k=rng.randint(2, 8))
        rows.append((len(rows), " ".join(own[:2] + passage + own[2:])))
    assert got(spark, rows, block=block) == plain(rows)


def test_query_against_all_pairs(spark, rows):
    out = sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op13_minhash_dedup(spark, SMALL).collect()], key=str)
    assert out == plain([(r.doc_id, r.text) for r in rows])


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(2, "a b c", 1, "x"), (1, "a b c", 2, "y")], "doc_id long, text string, cls int, minima string")
    assert [tuple(r) for r in minhash.near_duplicates(docs).orderBy("doc_id").collect()] == [(1, 2, 1, True), (2, 2, 1, False)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_minima_estimate_and_reject_as_told():
    rule = minhash.MinHash()
    assert (1 - 0.8 ** rule.rows) ** rule.bands < 1e-8 and 140 < rule.least_agreement() < 170
    rng, least, agreed = np.random.default_rng(1), 240, []
    for _ in range(200):  # sets of 90 with 80 in common: Jaccard 0.8
        both = rng.integers(0, 1 << 63, 100).astype(np.uint64)
        sets = np.concatenate([both[:90], both[10:]])
        signed = minhash.minima(sets, np.array([0, 90]), rule.minima)
        agreed.append(int((signed[0] == signed[1]).sum()))
        least = min(least, agreed[-1])
        assert (minhash.band_keys(signed, rule)[0] == minhash.band_keys(signed, rule)[1]).any()
    assert least >= rule.least_agreement() and abs(np.mean(agreed) / rule.minima - 0.8) < 0.01
    assert tx.mix(np.arange(3, dtype=np.uint64)).dtype == np.uint64
