import random
import re
from collections import Counter

import numpy as np
import pytest

from checks.compare import connect, differences
from fareflow.llm import collocations as co
from fareflow.llm import text as tx
from fareflow.llm.queries import OP11_SQL, op11_phrase_collocations
from tests.llm.conftest import LOWER, SMALL


def plain(rows, least=100, longest=5, top=2000, share=100):
    """The contract word by word."""
    counts = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(w for w in re.split("[\x20\x09]+", piece) if w)
            for k in range(1, longest + 1):
                own.update(words[i:i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n, found = sum(c for p, c in own.items() if len(p) == 1), []
        for phrase, a in own.items():
            if len(phrase) == 1 or a < least:
                continue
            if any(len(q) > len(phrase) and c >= least and 100 * c >= share * a
                   and any(q[i:i + len(phrase)] == phrase for i in range(len(q))) for q, c in own.items() if len(q) > len(phrase) and c >= least):
                continue
            score, _, left, right = min((1000 * a * n // (own[phrase[:k]] * own[phrase[k:]]), k, own[phrase[:k]], own[phrase[k:]])
                                        for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(spark, rows, **how):
    docs = spark.createDataFrame(rows, "lang string, text string")
    out = co.collocations(docs, **how).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out)


ODD = [("en", None), ("en", ""), (None, "New York, new york: NEW\tyork! é é É É"), ("und", "new york"), ("en", "a b a b a b.a b\na b\x0bc a b"),
       ("en", "x" * 9000 + " " + "x" * 9000), ("", "a b a b"), ("en", "a b a b a b.a b\na b\x0bc a b"), ("en", " . , ;"), ("fr", "seul")]


@pytest.mark.parametrize("least, longest, top, share", [(2, 5, 2000, 100), (1, 3, 4, 100), (2, 5, 2000, 50)])
def test_odd_texts_against_a_plain_version(spark, least, longest, top, share):
    how = {"least": least, "longest": longest, "top": top, "share": share}
    assert got(spark, ODD, **how) == plain(ODD, **how)


def test_bursting_spilling_tries_against_a_plain_version(spark, monkeypatch):
    for name, value in (("BURST", 5), ("TRIE_BYTES", 20_000), ("CHUNK_BYTES", 600)):
        monkeypatch.setattr(co, name, value)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(rng.choice(["en", "fr"]), " ".join(w + rng.choice(["", "", "", ".", ",", " ."]) for w in rng.choices(vocabulary, range(40, 0, -1), k=rng.choice([3, 60, 700]))))
            for _ in range(40)]
    rows += [("en", "one hot phrase again " * 400)]
    assert got(spark, rows, least=4) == plain(rows, least=4)


def test_trie_keeps_its_counts_and_order(monkeypatch):
    monkeypatch.setattr(co, "BURST", 8)
    rng, trie, want = np.random.default_rng(3), co.Node(3), Counter()
    pool = np.array([0, 1, 5, (1 << 64) - 1, 1 << 63, 77], np.uint64)
    for _ in range(30):
        words = np.unique(pool[rng.integers(0, 6, (40, 3)) * rng.integers(0, 2, (40, 3))], axis=0)
        order = np.lexsort(words.T[::-1])
        words = words[order]
        counts = rng.integers(1, 5, len(words))
        trie.add(co.row_ids(tx.mix(words + np.uint64(3))), words, counts)
        want.update({tuple(map(int, w)): int(c) for w, c in zip(words, counts)})
    depths = [kid.depth for kid in trie.kids if isinstance(kid, co.Node)]
    assert depths and set(depths) == {1} and (np.diff(trie.lows.astype(object)) > 0).all()
    rows = [(tuple(map(int, w)), int(c)) for words, counts in trie.runs() for w, c in zip(words, counts)]
    assert dict(rows) == want and [w for w, _ in rows] == sorted(want)
    before = trie.bytes()
    spilled = [(tuple(map(int, w)), int(c)) for words, counts in trie.spilled(before // 2) for w, c in zip(words, counts)]
    assert trie.bytes() <= before // 2 and dict(spilled) | {tuple(map(int, w)): int(c) for ws, cs in trie.runs() for w, c in zip(ws, cs)} == want


def test_long_texts_are_cut_between_pieces():
    text = (b"one two three. " * 50 + b"x " * 300 + b"! end").replace(b"\t", b" ")
    data, starts = np.frombuffer(text + b"next", np.uint8), np.array([0, 0, len(text), len(text) + 4])
    whole = co.word_ids(data, starts[:-1], np.array([1, 2, 3], np.uint64))[0]
    cut = [co.word_ids(*part)[0] for part in co.parts(data, starts, np.array([1, 2, 3], np.uint64), 64)]
    assert (np.concatenate(cut) == whole).all() and len(cut) > 8
    assert tx.LOWER[ord("A")] == ord("a")


def test_query_against_sql_and_clashing_columns(spark):
    assert differences(spark, connect(SMALL), SMALL, op11_phrase_collocations, OP11_SQL)[0] == ""
    docs = spark.createDataFrame([("en", "a b", "x", 1, 2)], "lang string, text string, id string, a int, w1 int")
    assert [tuple(r) for r in co.collocations(docs, least=1).collect()] == [("en", 1, "a b", 1, 1, 1, 2, 2000)]
    assert co.collocations(docs.limit(0)).count() == 0
