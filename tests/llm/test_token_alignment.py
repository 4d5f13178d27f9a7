import hashlib

import pytest
import sentencepiece
from tokenizers import Tokenizer

from fareflow.llm import token_alignment as ta
from fareflow.llm.queries import op12_token_alignment
from tests.llm.conftest import SMALL

A, B = f"{ta.FOLDER}/byte_bpe_50k.json", f"{ta.FOLDER}/piece_bpe_32k.model"


def plain(rows):
    """The contract word by word: both tokenizers' own encoders, every pair of intervals of a text compared by a sweep."""
    a_side, b_side = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    letters = ta.byte_of_letter()
    texts_a = {i: bytes(letters[c] for c in t) for t, i in a_side.get_vocab().items() if t != "<|endoftext|>"}
    texts_b = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, b_side.id_to_piece(i)) for i in range(b_side.get_piece_size()))]
    out, counts = [], {}
    for doc, text in rows:
        spans, ids = [], []
        for found, texts in ((a_side.encode(" " + (text or ""), add_special_tokens=False).ids, texts_a), (b_side.encode(text or ""), texts_b)):
            at, own = 0, []
            for i in found:
                own.append((at, at + len(texts[i])))
                at += len(texts[i])
            spans.append(own)
            ids.append(found)
        if not text or any(b"".join(t[i] for i in f) != (" " + text).encode() for f, t in zip(ids, (texts_a, texts_b))):
            out.append([doc, 0, 0, 0, [], ""])
            continue
        links, j = [], 0
        for i, (start, end) in enumerate(spans[0]):
            while spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < end:
                links.append((ids[0][i], ids[1][k]))
                k += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(f, own) if low <= s and e <= cut) for f, own in zip(ids, spans)))
            low = cut
        for pair in links:
            counts[pair] = counts.get(pair, 0) + 1
        out.append([doc, len(ids[0]), len(ids[1]), len(cuts), links, ";".join(groups)])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    return sorted([(doc, a, b, g, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), text)
                   for doc, a, b, g, links, text in out], key=str)


def got(spark, rows, head=ta.HEAD):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stored = ta.written(ta.align(docs), "aligned")
    out = ta.with_counts(stored, ta.written(ta.pair_counts(stored, ta.b_size()), "pairs"), head)
    return sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in out.collect()], key=str)


ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a literal ▁ piece"), (6, "<s> <|endoftext|> </s> <unk>"), (7, "zero \0 byte"),
       (8, "naïve café ﬁ 日本語 🙂👩‍👩‍👧 ́"), (9, "line\n\n\ttab\r\n"), (9, "line\n\n\ttab\r\n"), (None, "the same the same"), (10, "x" * 3000), (11, "don't we'll 1234567 ...")]


@pytest.mark.parametrize("head", [ta.HEAD, 40, 0])
def test_odd_texts_against_a_plain_version(spark, head):
    assert got(spark, ODD, head) == plain(ODD)


def test_documents_against_a_plain_version(spark, rows, monkeypatch):
    monkeypatch.setattr(ta, "CHUNK_CHARS", 5000)
    few = [(r.doc_id, r.text) for r in rows]
    assert got(spark, few, 2000) == plain(few)


def test_query_and_clashing_columns(spark, rows):
    out = {r.doc_id: r for r in op12_token_alignment(spark, SMALL).collect()}
    want = plain([(r.doc_id, r.text) for r in rows])
    assert len(out) == len(want)
    for doc, *numbers, groups in want:
        r = out[doc]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == numbers
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    docs = spark.createDataFrame([(5, "a b", "x", 1)], "doc_id long, text string, uid string, pairs int")
    assert ta.align(docs).count() == 1
    assert ta.align(docs.limit(0)).count() == 0 and ta.pair_counts(ta.align(docs.limit(0)), 7).count() == 0
