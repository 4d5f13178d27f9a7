import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from fareflow.llm import queries, suffix_tree
from fareflow.llm import text as tx
from fareflow.session import shared_dir
from tests.conftest import MEDIUM
from tests.llm.conftest import SMALL, plain_words


def test_base_scores_against_plain_version(spark, rows):
    out = {r.doc_id: r for r in queries.op7_lm_scoring(spark, SMALL).collect()}
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    tokens = {r.doc_id: [*plain_words(r.text), "\0"] for r in rows}
    counts = Counter(t for d, ts in tokens.items() if not held[d] for t in ts)
    n, v = sum(counts.values()), len(counts)
    for doc, ts in tokens.items():
        got = out[doc]
        assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (held[doc], len(ts), sum(t in counts for t in ts), n)
        assert math.isclose(got.base_score, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts), rel_tol=1e-9)
        assert got.score < 0


def column(texts):
    return next(iter(tx.chunks(pa.array(texts, pa.string()), 1 << 30)))[2:]


def test_spelling():
    symbols, begin = suffix_tree.spelled(*column([" Ab  c\n", None, "", "x", " \t", "É y"]), 3)
    assert bytes(symbols) == b"\0\0\0ab c\0\0\0\0\0\0\0\0\0x\0\0\0\0\0\0" + "É y".encode() + b"\0\0\0"
    places = suffix_tree._places(begin, len(symbols), 3)
    assert bytes(symbols[places]) == b"ab c\0\0\0x\0\0" + "É y".encode() + b"\0"


def grown(spark, texts, rules):
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    return suffix_tree.grow(suffix_tree.corpus_counts(docs, rules.depth).cache(), rules)


def test_probabilities_sum_to_one_and_states_are_closed(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", None, ""] * 20
    rules = suffix_tree.TreeRules(depth=4, context_share=1e-3, entry_share=2e-3)
    tree = grown(spark, texts, rules)
    for before in ("\0\0\0\0", " the", "at o", "zzzz", "e ca"):
        gram = sum(b << (8 * (4 - i)) for i, b in enumerate(before.encode()))
        total = (10 ** tree._log(np.uint64(gram) | np.arange(256, dtype=np.uint64), 4)).sum()
        assert math.isclose(total, 1, rel_tol=1e-4)
    states = {int(k) for k in tree.states.keys if k}
    assert states
    for key in states:
        level, ctx = (key >> 56) - 1, key & ((1 << 56) - 1)
        assert level == 1 or (level << 56 | ctx & ((1 << (8 * (level - 1))) - 1)) in states
    likely, unlikely, nothing = tree.score(*column(["the cat sat on the log", "qzx vkj wpy", None]))
    assert unlikely < likely < nothing < 0


def test_model_beats_the_base_on_held_out_documents(spark):
    out = queries.op7_lm_scoring(spark, "/root/testdata/sf0.1").filter("held_out").selectExpr(
        "sum(score) / sum(n_tokens) as tree", "sum(base_score) / sum(n_tokens) as base").first()
    assert out.tree > out.base


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, None, "z"), (2, "w" * 300_000, "v")], "doc_id long, text string, row string")
    out = suffix_tree.scores(docs, docs["doc_id"] == 1).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens) for r in out) == [(0, 1, 1, 6), (1, 3, 3, 6), (1, 3, 3, 6), (2, 2, 1, 6)]
    untaught = suffix_tree.scores(docs, docs["doc_id"] > 7).filter("doc_id = 1").first()
    assert (untaught.n_known, untaught.base_score) == (0, 0) and math.isclose(untaught.score, 4 * math.log10(1 / 256), rel_tol=1e-6)
    assert suffix_tree.scores(docs.limit(0), docs["doc_id"] == 1).count() == 0


def test_what_is_broadcast_changes_no_score(spark, documents):
    docs = documents.select("doc_id", "text").filter("doc_id % 4 = 0").limit(60)
    def scored(**how):
        out = suffix_tree.scores(docs, docs["doc_id"] % 3 > 0, suffix_tree.TreeRules(**how))
        return sorted((r.doc_id, r.score) for r in out.collect())
    whole = scored(context_share=0.0, entry_share=0.0, entry_limit=1 << 30)
    for few in (dict(context_share=1e-2, entry_share=1e-3), dict(entry_limit=100), dict(entry_limit=0)):
        part = scored(**few)
        assert [d for d, _ in part] == [d for d, _ in whole]
        assert all(math.isclose(a, b, rel_tol=1e-5) for (_, a), (_, b) in zip(part, whole))


def stored(spark):
    return sum(p.stat().st_size for p in Path(shared_dir(spark).removeprefix("file://")).rglob("*.parquet") if p.is_file())


def test_written_stages_are_a_small_multiple_of_the_text(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    before = stored(spark)
    assert suffix_tree.scores(docs, docs["doc_id"] % 7 != 2, suffix_tree.TreeRules(entry_limit=50_000)).count() == docs.count()
    assert stored(spark) - before < 5 * docs.selectExpr("sum(octet_length(text))").first()[0]


def test_runs_leave_the_counting_tasks_packed(spark, documents):
    docs = documents.select("text")
    runs = {t[i:i + 8] for r in docs.collect() if r.text for t in [b"\0" * 7 + " ".join(plain_words(r.text)).encode() + b"\0"] for i in range(len(t) - 7)}
    counts = suffix_tree.corpus_counts(docs, 7).cache()
    assert counts.count() * 10 < len(runs)
    assert suffix_tree.learn(counts, suffix_tree.TreeRules()).counts.filter(f"kind = {suffix_tree.RUNS}").agg({"n": "sum"}).first()[0] == len(runs)


def plain_tree(texts, depth, deviations=4.0):
    """The module's description word by word: log10 p of a text."""
    spelt = [b"\0" * depth + " ".join(plain_words(t)).encode() + b"\0" for t in texts]
    seen = {}
    for s in spelt:
        for i in range(depth, len(s)):
            for j in range(depth + 1):
                seen.setdefault(s[i - j:i], Counter())[s[i]] += 1
    states = {b""}
    for ctx, own in seen.items():
        if ctx:
            n, short = sum(own.values()), seen[ctx[1:]]
            g = 2 * sum(c * math.log(c / n / (short[b] / sum(short.values()))) for b, c in own.items())
            if g > len(own) + deviations * math.sqrt(2 * len(own)):
                states |= {ctx[k:] for k in range(len(ctx))}

    def p(ctx, byte):
        own = seen.get(ctx, Counter())
        n = sum(own.values())
        if not ctx:
            return (own[byte] + 1) / (n + 256)
        if ctx not in states:
            return p(ctx[1:], byte)
        return (own[byte] + len(own) * p(ctx[1:], byte)) / (n + len(own))

    def score(text):
        s = b"\0" * depth + " ".join(plain_words(text)).encode() + b"\0"
        return sum(math.log10(p(s[i - depth:i], s[i])) for i in range(depth, len(s)))
    return score


@pytest.mark.parametrize("depth, limit", [(7, 1 << 22), (7, 30), (7, 0), (4, 30), (2, 30), (1, 0)])
def test_scores_against_a_plain_tree(spark, depth, limit):
    rng = random.Random(5)
    words = ["the", "cat", "sat", "mat", "Dog", "log", "é", "of", "x", "aa" * 9]
    texts = [" ".join(rng.choices(words, range(10, 0, -1), k=rng.randrange(30))) for _ in range(80)] + ["", None, "zq vk\nthe cat", "aaaa" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = plain_tree([t for d, t in enumerate(texts) if d % 5], depth)
    for r in suffix_tree.scores(docs, docs["doc_id"] % 5 != 0, suffix_tree.TreeRules(depth=depth, entry_limit=limit)).collect():
        assert math.isclose(r.score, want(texts[r.doc_id]), rel_tol=1e-5)
