import hashlib
import random
from collections import defaultdict

import numpy as np

from fareflow.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from tests.llm.conftest import LOWER

STRIP = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string"


def plain(rows, min_chars=20, min_docs=3):
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(STRIP).translate(LOWER)
            if doc is not None and len(key) >= min_chars:
                held[key].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            docs = held.get(line.strip(STRIP).translate(LOWER), ())
            if doc is None or len(docs) < min_docs or max(docs) == doc:
                keep.append(line)
        out.append((doc, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


LINE, OTHER, SHORT = "A line that is Long enough é", "another line that is long enough", "short line"
CASES = [(1, f"{LINE}\n{OTHER}"), (2, f"  {LINE.lower().replace('É', 'é')}\t\nx"), (3, f"{LINE}\n{LINE}\n{SHORT}"), (3, OTHER), (4, None),
         (5, ""), (6, f"{SHORT}\n{OTHER}"), (7, SHORT), (7, SHORT), (None, LINE), (8, "y" * 200_000 + "\n" + LINE)]


def test_hand_made_cases(spark):
    assert got(dedup_lines(spark, spark.createDataFrame(CASES, SCHEMA))) == plain(CASES)


def test_against_plain_version(spark, documents, rows):
    out = dedup_lines(spark, documents)
    assert out.columns[:5] == documents.columns
    assert got(out) == plain([(r.doc_id, r.text) for r in rows])


def test_join_without_filters_is_the_same(spark):
    docs = spark.createDataFrame(CASES, SCHEMA)
    assert got(dedup_lines(spark, docs, broadcast_bytes=0)) == plain(CASES)


def test_insert_and_delete_are_reversible(spark):
    rng = random.Random(5)
    lines = [f"line number {i} with some more text" for i in range(30)]
    first = [(i, "\n".join(rng.sample(lines, 4))) for i in range(20)]
    second = [(i, "\n".join(rng.sample(lines, 4))) for i in range(20, 40)]
    one, two = (spark.createDataFrame(x, SCHEMA) for x in (first, second))
    index = LineIndex(spark, shards=4)
    index.insert(one)
    before = got(index.clean(one))
    assert before == plain(first)
    index.insert(two)
    assert got(index.clean(one.unionByName(two))) == plain(first + second)
    index.delete(two)
    assert got(index.clean(one)) == before
    index.insert(two)
    index.delete(one.filter("doc_id < 10"))
    assert got(index.clean(one.filter("doc_id >= 10").unionByName(two))) == plain(first[10:] + second)


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a", 7, "x")], "doc_id long, text string, n_lines long, Kept string")
    assert dedup_lines(spark, docs).columns == ["doc_id", "text", "kept", "n_lines", "n_dropped"]
    assert dedup_lines(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_cuckoo_filter():
    keys = np.frombuffer(b"".join(hashlib.blake2b(bytes([i % 256, i // 256]), digest_size=8).digest() for i in range(3000)), np.uint64)
    one = CuckooFilter.sized(2000)
    assert one.insert(keys[:2000]) and one.contains(keys[:2000]).all()
    assert one.contains(keys[2000:]).mean() < 0.01
    one.delete(keys[:1000])
    assert one.contains(keys[1000:2000]).all() and one.contains(keys[:1000]).mean() < 0.01
    assert not CuckooFilter.sized(1).insert(keys)
