"""Alignment of two tokenizers' tokens over the same bytes, by as-of merges.

Side A is a byte-level BPE (a tokenizers JSON file), side B a sentencepiece model. Both cut one byte string, a space and the text, so a
token is an interval of bytes. Within a batch, keyed by document, ``pandas.merge_asof`` gives each token start the token of the
other side that covers it. The union of both directions is all pairs that overlap: of two overlapping intervals, one holds
the start of the other. Offsets where both sides end a token cut them into groups, the smallest runs that hold the same bytes.

Distribution: texts are aligned where they are read, about ``CHUNK_CHARS`` at a time, and the links of a document leave as
distinct id pairs with their numbers. Corpus-wide counts of pairs are a hash aggregate over them. Documents then meet the counts in two
ways that give the same sums: the most frequent pairs (at most ``HEAD`` rows) are broadcast, and what is left is joined,
one row per document and pair, and added up by row. No row is ever keyed by a pair before documents' repeats are merged.

The vocabulary files are read by the driver and broadcast; executors need no copy. A's merges are taken from the file in their
order, which for this kind of vocabulary is the order of the ids.

Defined cases. Null and empty texts have no tokens, and neither have texts whose tokens of either side do not spell the space and
the text again (a literal U+2581 comes back as a space): zeros and empty groups. Strings of special tokens within a text are text.
Rows that repeat an id are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.store import most_frequent, written

FOLDER = "/opt/tokenizers"
CHUNK_CHARS = 1 << 20
HEAD = 1 << 20
# Fixed value: how this vocabulary's pre-tokenizer cuts a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COLUMNS = "uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"


def byte_of_letter() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable Latin-1 ones stand for themselves, others follow 255."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Side:
    """Bytes of every token id, laid end to end, and the ids in decimal."""

    flat: np.ndarray
    first: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, spelled: list[bytes]) -> Side:
        length = np.array([len(s) for s in spelled], np.int64)
        return cls(np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(length) - length, length)

    def spells(self, ids: np.ndarray, wanted: bytes) -> bool:
        n = self.length[ids]
        total = int(n.sum())
        if total != len(wanted):
            return False
        place = np.repeat(self.first[ids] - (np.cumsum(n) - n), n) + np.arange(total)
        return bool(np.array_equal(self.flat[place], np.frombuffer(wanted, np.uint8)))


def byte_level(vocabulary: bytes):
    """(side, encoder) of a byte-level BPE in a tokenizers file; special tokens have no bytes and are never produced."""
    import tiktoken

    held = json.loads(vocabulary)
    letters, special = byte_of_letter(), {t["id"] for t in held["added_tokens"]}
    spelled = {i: bytes(letters[c] for c in token) for token, i in held["model"]["vocab"].items() if i not in special}
    size = max(held["model"]["vocab"].values()) + 1
    encoder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks={s: i for i, s in spelled.items()}, special_tokens={})
    return Side.of([spelled.get(i, b"") for i in range(size)]), encoder.encode_ordinary


def pieces(model: bytes):
    """(side, encoder of several texts) of a sentencepiece model."""
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_proto=model)
    spelled = []
    for i in range(made.get_piece_size()):
        piece = made.id_to_piece(i)
        spelled.append(bytes([int(piece[3:5], 16)]) if made.is_byte(i) else b"" if made.is_control(i) or made.is_unknown(i)
                       else piece.replace("▁", " ").encode())
    return Side.of(spelled), lambda texts: made.encode(texts, num_threads=1)


def covering(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """For each token of ``left``, the token of ``right`` that covers its start, within the same document."""
    return pd.merge_asof(left, right, on="start", by="doc", direction="backward")["token"].to_numpy()


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and ``b`` of all token pairs that overlap, each once; both have doc and start, in order."""
    here, there = np.arange(len(a), dtype=np.int64), np.arange(len(b), dtype=np.int64)
    from_a = here << 32 | covering(a, b.assign(token=there))
    from_b = covering(b, a.assign(token=here)) << 32 | there
    both = np.sort(np.concatenate([from_a, from_b]), kind="stable")  # two runs in order but for equal starts
    both = both[np.diff(both, prepend=-1) != 0]
    return both >> 32, both & 0xFFFFFFFF


def written_groups(ids: list[np.ndarray], ends: list[np.ndarray], common: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """The tokens of both sides as texts, in the order of ``a1,a2|b1;a3|b2``; ``tables`` have an id with a comma, and closing its side."""
    group = [np.searchsorted(common, e) for e in ends]
    counts = [np.bincount(g, minlength=len(common)) for g in group]
    before = np.cumsum(counts[1]) - counts[1]
    out = np.empty(len(ids[0]) + len(ids[1]), object)
    for side, place in ((0, np.arange(len(ids[0])) + before[group[0]]), (1, np.arange(len(ids[1])) + np.cumsum(counts[0])[group[1]])):
        closes = (common[group[side]] == ends[side]).astype(np.int64)
        out[place] = tables[side][closes, ids[side]]
    return out


class Aligner:
    def __init__(self, vocabulary: bytes, model: bytes):
        (self.a, self.encode_a), (self.b, self.encode_b) = byte_level(vocabulary), pieces(model)
        self.width = len(self.b.length)
        self.tables = [np.array([[f"{i}{sign}" for i in range(len(side.length))] for sign in (",", closing)], object)
                       for side, closing in ((self.a, "|"), (self.b, ";"))]

    def align(self, texts: list[str | None]) -> dict[str, list]:
        """One row per text: counts, groups, distinct links (A id times B's size plus B id) and how often each occurs."""
        n = len(texts)
        out = {"n_a": [0] * n, "n_b": [0] * n, "n_groups": [0] * n, "n_links": [0] * n, "groups": [""] * n,
               "pairs": [np.zeros(0, np.int64)] * n, "times": [np.zeros(0, np.int64)] * n}
        given = [i for i in range(n) if texts[i]]
        rows, ids = [], ([], [])
        for i, b in zip(given, self.encode_b([texts[i] for i in given]) if given else []):
            spaced = " " + texts[i]
            a, b, wanted = np.array(self.encode_a(spaced), np.int64), np.array(b, np.int64), spaced.encode()
            if len(b) and self.a.spells(a, wanted) and self.b.spells(b, wanted):
                rows.append(i)
                ids[0].append(a)
                ids[1].append(b)
        if not rows:
            return out
        sizes = [np.array([len(x) for x in side]) for side in ids]
        docs = [np.repeat(np.arange(len(rows)), s) for s in sizes]
        ids = [np.concatenate(side) for side in ids]
        ends = [np.cumsum(side.length[i]) for side, i in zip((self.a, self.b), ids)]
        a, b = (pd.DataFrame({"doc": d, "start": e - side.length[i]}) for d, e, side, i in zip(docs, ends, (self.a, self.b), ids))
        at_a, at_b = overlaps(a, b)
        common = np.intersect1d(ends[0], ends[1], assume_unique=True)
        spelled = written_groups(ids, ends, common, self.tables)
        bounds = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])])
        last = ends[0][np.cumsum(sizes[0]) - 1]  # a document's last byte ends tokens of both sides
        groups = np.diff(np.concatenate([[0], np.searchsorted(common, last, "right")]))
        links = np.bincount(docs[0][at_a], minlength=len(rows))
        size = len(self.a.length) * self.width
        met, times = np.unique(docs[0][at_a] * size + ids[0][at_a] * self.width + ids[1][at_b], return_counts=True)
        cut = np.searchsorted(met, np.arange(len(rows) + 1) * size)
        for k, i in enumerate(rows):
            out["n_a"][i], out["n_b"][i] = int(sizes[0][k]), int(sizes[1][k])
            out["n_groups"][i], out["n_links"][i] = int(groups[k]), int(links[k])
            out["groups"][i] = "".join(spelled[bounds[k]:bounds[k + 1]])[:-1]
            out["pairs"][i], out["times"][i] = met[cut[k]:cut[k + 1]] - k * size, times[cut[k]:cut[k + 1]]
        return out


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def align(docs: DataFrame, a_file: str = f"{FOLDER}/byte_bpe_50k.json", b_file: str = f"{FOLDER}/piece_bpe_32k.model", doc: str = "doc_id",
          text: str = "text") -> DataFrame:
    """uid, doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``), pairs and times of each row of ``docs``.

    ``pairs`` are the distinct linked ids (A id times the size of B's vocabulary plus B id), ``times`` how often each is linked.
    ``uid`` tells rows apart once the result is written.
    """
    vocabulary, model = read_file(a_file), read_file(b_file)
    size = (max(json.loads(vocabulary)["model"]["vocab"].values()) + 1) * len(pieces(model)[0].length)
    kind, arrow = ("int", pa.int32()) if size < 1 << 31 else ("long", pa.int64())
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, model))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            made = made or Aligner(*sent.value)
            ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_numpy())
            row = 0
            while row < batch.num_rows:
                before = ends[row - 1] if row else 0
                end = max(row + 1, int(np.searchsorted(ends, before + CHUNK_CHARS, "right")))
                part = batch.slice(row, end - row)
                out = made.align(part.column(2).to_pylist())
                pairs, times = out.pop("pairs"), out.pop("times")
                at = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(out[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(out["groups"], pa.string()), pa.ListArray.from_arrays(at, pa.array(np.concatenate(pairs)).cast(arrow)),
                     pa.ListArray.from_arrays(at, pa.array(np.concatenate(times)).cast(pa.int32()))],
                    names=["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
                row = end

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{doc}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(aligned, f"{COLUMNS}, pairs array<{kind}>, times array<int>")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best) of every linked id pair of the corpus; ``best``: no pair with the same B id has more links."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        F.col("p.pairs").cast("long").alias("pair"), F.col("p.times").cast("long").alias("times"))
    counts = written(each.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    counts = counts.withColumn("b", F.pmod("pair", F.lit(b_size)))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))  # one row per B id
    return counts.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))


def with_counts(aligned: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``aligned``, a written table, with n_best and count_sum: links that are their B id's most frequent, and the sum of all links' counts."""
    frequent = most_frequent(counts, head, "count").toArrow()
    order = np.argsort(frequent.column("pair").to_numpy())
    sent = aligned.sparkSession.sparkContext.broadcast(tuple(frequent.column(c).to_numpy()[order] for c in ("pair", "count", "best")))
    whole = frequent.num_rows == counts.count()
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = sent.value
        for batch in batches:
            lists = batch.column("pairs")
            at, n = lists.offsets.to_numpy(), batch.num_rows
            row = np.repeat(np.arange(n), np.diff(at))
            pair, times = lists.flatten().to_numpy().astype(np.int64), batch.column("times").flatten().to_numpy().astype(np.int64)
            place = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            hit = known[place] == pair if len(known) else np.zeros(len(pair), bool)
            sums = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
            for total, value in zip(sums, (best, count)):
                np.add.at(total, row[hit], value[place[hit]] * times[hit])
            left = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(left), pa.array(pair[~hit])),
                 pa.ListArray.from_arrays(pa.array(left), pa.array(times[~hit]))], names=[*kept, "n_best", "count_sum", "pairs", "times"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name in kept)
    summed = aligned.mapInArrow(add_up, f"{types}, n_best long, count_sum long, pairs array<long>, times array<long>")
    if whole:
        return summed.drop("pairs", "times")
    summed = written(summed, "frequent-links")
    rest = (summed.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
            .select("uid", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")).join(counts, "pair")
            .groupBy("uid").agg(F.sum(F.col("best") * F.col("times")).alias("more_best"), F.sum(F.col("count") * F.col("times")).alias("more_sum")))
    return (summed.join(rest, "uid", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
            .drop("pairs", "times", "more_best", "more_sum"))


def b_size(b_file: str = f"{FOLDER}/piece_bpe_32k.model") -> int:
    return len(pieces(read_file(b_file))[0].length)
