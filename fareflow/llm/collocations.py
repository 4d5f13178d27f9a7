"""Collocations: phrases counted in burst tries of word ids, scored by how much more often their parts meet than by chance.

A text is cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at blanks; A-Z are lower-cased. Everything is per language.
A word's id is a 64-bit hash of language and word.

Counting goes by phrase length. A phrase of k words is counted only where both its parts of k - 1 words reach ``least``, since no phrase
is more frequent than its parts; a Bloom filter of those parts (16 MB at most) is broadcast, and what it lets through in error
is counted and falls below ``least`` exactly. In a task, phrases go into a trie over word ids whose leaves are hash tables
(a HAT-trie): a leaf covers a range of ids; when it has more than ``BURST`` phrases it bursts, into two ranges, or, if all its phrases
begin alike, into a node of its own over the next word, at most ``DEPTH`` words deep. When a task's trie exceeds
``TRIE_BYTES``, its largest subtrees leave as runs sorted by words, and the rest at the end. Runs are cut by prefix partitions, ranges of
the first word's ids with sixteen ranges of the second word's in each, so a frequent word is spread over its followers. A partition's
runs are merged at once; there are so many partitions that ``PART_BYTES`` would hold one if all phrases of the corpus were different.

Each cut of a phrase gives ``floor(1000 a n / (l r))`` in exact decimals; the lowest counts. Of equal phrases by score and count, those that may
be among the first ``top`` are spelled out, so ties are ordered by bytes.

Defined cases. Null and empty texts have no words. A null language is ``und``, together with a language of that name. Rows that repeat
an id count each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm import text as tx
from fareflow.llm.ngram_join import may_hold, needed_filter
from fareflow.llm.store import written

LONGEST = 5
BURST = 1 << 14
DEPTH = 2
TRIE_BYTES = 32 << 20
CHUNK_BYTES = 1 << 18
PART_BYTES = 128 << 20
BREAKERS = b".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BREAKS = np.isin(np.arange(256), np.frombuffer(BREAKERS, np.uint8))
_INSIDE = ~(_BREAKS | np.isin(np.arange(256), [0x20, 0x09]))
_VALUES = np.where(_INSIDE, tx.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.uint64(0))[tx.LOWER]
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(4095, 0x9E3779B97F4A7C15, np.uint64))])


def spelled(lang: Column, text: Column) -> tuple[Column, Column]:
    """Language and lower-cased words of a text; an empty first or last word is to be left out."""
    return F.coalesce(lang, F.lit("und")), F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x20\x09.,;:!?\x0A-\x0D]+")


def seed(lang: str | None) -> int:
    return xxhash.xxh3_64_intdigest("und" if lang is None else lang)


def word_ids(data: np.ndarray, starts: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words of consecutive texts and the number of the piece each is in; ``starts`` are the texts' first bytes."""
    inside = _INSIDE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = starts[starts < len(data)]
    begins[first] = inside[first]
    at = np.flatnonzero(begins)
    if len(at) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lead, spans = int(at[0]), np.diff(np.append(at, len(data)))
    place = np.arange(len(data) - lead) - np.repeat(at - lead, spans)
    hashes = tx.mix(np.add.reduceat(_VALUES[data[lead:]] * _POWERS[place & 4095], at - lead))
    text = np.searchsorted(starts, at, "right") - 1
    return tx.mix(hashes ^ seeds[text]), np.cumsum(_BREAKS[data])[at] + text


def phrase_ids(words: np.ndarray, size: int) -> np.ndarray:
    """Id of each run of ``size`` words."""
    return words if size == 1 else tx.runs(words, size)


def parts(data: np.ndarray, starts: np.ndarray, seeds: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of about ``limit`` bytes of whole texts; a longer text is cut at breakers, between which no phrase reaches."""
    row, n = 0, len(starts) - 1
    while row < n:
        end = min(n, max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1))
        low, high = int(starts[row]), int(starts[end])
        while high - low > limit and end == row + 1:
            breaks = np.flatnonzero(_BREAKS[data[low:low + limit]])
            cut = low + (int(breaks[-1]) + 1 if len(breaks) else limit)
            while not len(breaks) and cut < high and not _BREAKS[data[cut]]:
                cut += 1
            yield data[low:cut], np.zeros(1, np.int64), seeds[row:row + 1]
            low = cut
        yield data[low:high], np.maximum(starts[row:end] - low, 0), seeds[row:end]
        row = end


class Leaf:
    """Hash table of phrases whose next word is in a range: open addressing over rows kept in order of arrival."""

    def __init__(self, width: int):
        self.n, self.grows, self.slots = 0, False, np.full(64, -1, np.int32)
        self.keys, self.words, self.counts = np.zeros(32, np.uint64), np.zeros((32, width), np.uint64), np.zeros(32, np.int64)

    def bytes(self) -> int:
        return self.slots.nbytes + self.keys.nbytes + self.words.nbytes + self.counts.nbytes

    def _grow(self, wanted: int) -> None:
        size = len(self.keys)
        while size < wanted:
            size *= 2
        if more := size - len(self.keys):
            self.keys, self.counts = np.append(self.keys, np.zeros(more, np.uint64)), np.append(self.counts, np.zeros(more, np.int64))
            self.words = np.concatenate([self.words, np.zeros((more, self.words.shape[1]), np.uint64)])
            self.slots = np.full(2 * size, -1, np.int32)
            self._place(np.arange(self.n))

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _place(self, rows: np.ndarray) -> None:
        """Find slots for rows that have none."""
        at = self._home(self.keys[rows])
        while len(rows):
            free = np.flatnonzero(self.slots[at] < 0)
            slot, first = np.unique(at[free], return_index=True)
            self.slots[slot] = rows[free[first]]
            stay = np.ones(len(rows), bool)
            stay[free[first]] = False
            rows, at = rows[stay], (at[stay] + 1) & (len(self.slots) - 1)

    def add(self, keys: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of phrases, each given once."""
        self._grow(self.n + len(keys))
        left, at, new = np.arange(len(keys)), self._home(keys), []
        while len(left):
            row = self.slots[at]
            same = (row >= 0) & (self.keys[row] == keys[left])
            self.counts[row[same]] += counts[left[same]]
            new.append(left[row < 0])
            stay = (row >= 0) & ~same
            left, at = left[stay], (at[stay] + 1) & (len(self.slots) - 1)
        new = np.concatenate(new) if new else left
        rows = np.arange(self.n, self.n + len(new))
        self.keys[rows], self.words[rows], self.counts[rows] = keys[new], words[new], counts[new]
        self.n += len(new)
        self._place(rows)

    def by_words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort(self.words[:self.n].T[::-1])
        return self.keys[order], self.words[order], self.counts[order]


class Node:
    """Children by ranges of the word at ``depth``; ``lows`` are the ranges' first ids."""

    def __init__(self, width: int, depth: int = 0):
        self.width, self.depth, self.lows, self.kids = width, depth, np.zeros(1, np.uint64), [Leaf(width)]

    def bytes(self) -> int:
        return sum(k.bytes() for k in self.kids)

    def add(self, keys: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of phrases, each given once, in the order of their first words."""
        symbols = words[:, self.depth]
        cuts = np.append(np.searchsorted(symbols, self.lows), len(symbols))
        for i in range(len(self.kids) - 1, -1, -1):
            part = slice(cuts[i], cuts[i + 1])
            if cuts[i] < cuts[i + 1]:
                kid = self.kids[i]
                kid.add(keys[part], words[part], counts[part])
                if isinstance(kid, Leaf) and kid.n > BURST and not kid.grows:
                    self.burst(i)

    def burst(self, i: int) -> None:
        """Two leaves for the lower and the upper half of a leaf's phrases; a node for them if all have one word here."""
        keys, words, counts = self.kids[i].by_words()
        symbols = words[:, self.depth]
        word = symbols[len(symbols) // 2]
        if word == symbols[0]:
            word = symbols[min(int(np.searchsorted(symbols, word, "right")), len(symbols) - 1)]
        if word != symbols[0]:
            cut, kids = int(np.searchsorted(symbols, word)), [Leaf(self.width), Leaf(self.width)]
            for kid, part in zip(kids, (slice(0, cut), slice(cut, None))):
                kid.add(keys[part], words[part], counts[part])
            lows = [self.lows[i], word]
        elif self.depth + 1 < min(DEPTH, self.width):
            node = Node(self.width, self.depth + 1)
            node.add(keys, words, counts)
            last = self.lows[i + 1] - np.uint64(1) if i + 1 < len(self.lows) else np.uint64((1 << 64) - 1)
            before, after = int(self.lows[i] < word), int(word < last)
            kids = [Leaf(self.width)] * before + [node] + [Leaf(self.width)] * after
            lows = [self.lows[i]] * before + [word] + [np.uint64(int(word) + 1)] * after if after else [self.lows[i]] * before + [word]
        else:
            self.kids[i].grows = True
            return
        self.kids[i:i + 1] = kids
        self.lows = np.concatenate([self.lows[:i], np.array(lows, np.uint64), self.lows[i + 1:]])

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words and counts of all phrases below, in the order of their words."""
        for kid in self.kids:
            if isinstance(kid, Leaf):
                yield kid.by_words()[1:]
            else:
                yield from kid.runs()

    def spilled(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Runs of whole subtrees, the largest first, until at most ``keep`` bytes are left."""
        while self.bytes() > keep:
            i = max(range(len(self.kids)), key=lambda k: self.kids[k].bytes())
            kid, empty = self.kids[i], Leaf(self.width)
            if kid.bytes() <= empty.bytes():
                return
            self.kids[i] = empty
            yield from [kid.by_words()[1:]] if isinstance(kid, Leaf) else kid.runs()


def prefix_part(words: np.ndarray, bits: int) -> np.ndarray:
    """Number of the prefix partition: a range of the first word's ids by its highest ``bits``, cut by the second word's into sixteen,
    so that a frequent word is spread over its followers."""
    first = (words[:, 0] >> np.uint64(1)) >> np.uint64(63 - bits)
    return (first << np.uint64(4) | words[:, 1] >> np.uint64(60)).astype(np.int64)


def part_bits(n_words: int, size: int, partitions: int) -> int:
    """So many that a partition's runs fit a task, were all phrases different, and tasks get several partitions each."""
    wanted = max(4 * partitions, n_words * 8 * (size + 1) // PART_BYTES) / 16
    return min(40, max(0, math.ceil(math.log2(max(1, wanted)))))


def counted(docs: DataFrame, size: int, held: np.ndarray, least: int, bits: int) -> DataFrame:
    """``PHRASES`` of ``size`` words found ``least`` times; ``held`` is a Bloom filter of their parts one word shorter."""
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def pieces(words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """A sorted run by prefix partition, each with its words column by column."""
        part = prefix_part(words, bits)
        order = np.argsort(part, kind="stable")
        part, words, counts = part[order], words[order], counts[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        for low, high in zip(cuts, np.append(cuts[1:], len(part))):
            yield int(part[low]), words[low:high].T.tobytes(), counts[low:high].tobytes()

    def packed(runs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for words, counts in runs:
            rows = list(pieces(words, counts)) if len(counts) else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))],
                                                 names=["part", "words", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, seeds = Node(size), {}
        for batch in batches:
            langs = np.array([seeds.setdefault(x, seed(x)) for x in batch.column(0).to_pylist()], np.uint64)
            for data, starts, own in parts(*tx.column_bytes(batch.column(1)), langs, CHUNK_BYTES):
                words, piece = word_ids(data, starts, own)
                if len(words) < size:
                    continue
                may = may_hold(sent.value, phrase_ids(words, size - 1))
                at = np.flatnonzero(may[:-1] & may[1:] & (piece[:len(may) - 1] == piece[size - 1:]))
                if not len(at):
                    continue
                keys, first, counts = np.unique(phrase_ids(words, size)[at], return_index=True, return_counts=True)
                found = words[at[first][:, None] + np.arange(size)]
                order = np.lexsort(found.T[:DEPTH][::-1])
                trie.add(keys[order], found[order], counts[order])
                if trie.bytes() > TRIE_BYTES:
                    yield from packed(trie.spilled(TRIE_BYTES // 2))
        yield from packed(trie.runs())

    def merged(runs: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        """Sums of one partition's runs, where they reach ``least``."""
        if not runs:
            return
        words = np.concatenate([np.frombuffer(w, np.uint64).reshape(size, -1) for w, _ in runs], axis=1).T
        counts = np.concatenate([np.frombuffer(c, np.int64) for _, c in runs])
        keys = row_ids(words)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]) != 0)
        total = np.add.reduceat(counts[order], first)
        enough = np.flatnonzero(total >= least)
        if len(enough):
            yield described(words[order[first[enough]]], total[enough])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs = None, []
        for batch in batches:
            for part, words, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if part != now:
                    yield from merged(runs)
                    now, runs = part, []
                runs.append((words, counts))
        yield from merged(runs)

    runs = docs.select("lang", "text").mapInArrow(count, "part long, words binary, counts binary")
    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(merge, PHRASES)


def row_ids(words: np.ndarray) -> np.ndarray:
    """Id of each row's phrase, as ``phrase_ids``."""
    out = words[:, 0].copy()
    for k in range(1, words.shape[1]):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[:, k]
    return out if words.shape[1] == 1 else tx.mix(out)


PHRASES = "id long, words array<long>, a long, lefts array<long>, rights array<long>"


def described(words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """(id, words, a, lefts, rights): ids of phrases and of their parts at every cut."""
    size = words.shape[1]
    lefts = np.stack([row_ids(words[:, :k]) for k in range(1, size)], axis=1)
    rights = np.stack([row_ids(words[:, k:]) for k in range(1, size)], axis=1)
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]),
                                      pa.array(np.ascontiguousarray(m).reshape(-1).view(np.int64))) for m in (words, lefts, rights)]
    return pa.RecordBatch.from_arrays([pa.array(row_ids(words).view(np.int64)), lists[0], pa.array(counts), *lists[1:]],
                                      names=["id", "words", "a", "lefts", "rights"])


def word_table(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(id, lang, word, a) of words found ``least`` times, and (lang, n) of all words."""
    lang, words = spelled(F.col("lang"), F.col("text"))
    every = docs.select(lang.alias("lang"), F.explode(words).alias("word")).filter("word != ''")
    every = written(every.groupBy("lang", "word").agg(F.count("*").alias("a")), "words")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([seed(x) for x in batch.column(0).to_pylist()], np.uint64)
            data, starts = tx.column_bytes(batch.column(1))
            ids, _ = word_ids(data[starts[0]:starts[-1]], starts[:-1] - starts[0], langs)
            yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), *batch.columns], names=["id", "lang", "word", "a"])

    frequent = every.filter(F.col("a") >= least).mapInArrow(name, "id long, lang string, word string, a long")
    return written(frequent, "frequent-words"), every.groupBy("lang").agg(F.sum("a").alias("n"))


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000, share: int = 100, lang: str = "lang",
                 text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases of two to ``longest`` words found ``least`` times.

    A phrase is left out where a longer one that holds it has ``share`` hundredths of its count.
    """
    docs = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    words, totals = word_table(docs, least)
    totals = written(totals, "totals")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held, levels = needed_filter(words.select(F.col("id").alias("h"))), []
    for size in range(2, longest + 1):
        level = counted(docs, size, held, least, part_bits(n_words, size, partitions))
        levels.append(written(level, f"phrases-{size}"))
        held = needed_filter(levels[-1].select(F.col("id").alias("h")))
        if not held.any():
            break
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    known = words.select("id", F.col("a").alias("f")).unionByName(phrases.select("id", F.col("a").alias("f")))
    phrases = (phrases.join(words.select(F.col("id").alias("w1"), "lang"), F.col("words")[0] == F.col("w1")).drop("w1").join(totals, "lang"))

    # Scores are below 10 n and a cut below 16, so both fit one long.
    cuts = (phrases.select("id", "a", "n", F.posexplode(F.arrays_zip("lefts", "rights")).alias("cut", "p"))
            .select("id", "a", "n", "cut", F.col("p.lefts").alias("left"), F.col("p.rights").alias("right"))
            .join(known.select(F.col("id").alias("left"), F.col("f").alias("l")), "left")
            .join(known.select(F.col("id").alias("right"), F.col("f").alias("r")), "right"))
    score = F.expr("(cast(1000 * a as decimal(20)) * cast(n as decimal(17))) div (cast(l as decimal(19)) * cast(r as decimal(18)))")
    cuts = cuts.withColumn("order", score * 16 + F.col("cut")).groupBy("id").agg(
        F.min("order").alias("order"), F.min_by("l", "order").alias("l"), F.min_by("r", "order").alias("r"))
    longer = (phrases.filter(F.size("words") > 2).select(F.explode(F.array(F.element_at("lefts", -1), F.element_at("rights", 1))).alias("id"), "a")
              .groupBy("id").agg(F.max("a").alias("longer")))
    scored = (phrases.select("id", "lang", "words", "a", "n").join(cuts, "id").join(longer, "id", "left")
              .filter(F.coalesce(F.col("longer") * 100 < F.col("a") * share, F.lit(True)))
              .select("id", "lang", "words", "a", "l", "r", "n", F.shiftright("order", 4).alias("score")))
    per_lang = Window.partitionBy("lang")
    first = scored.withColumn("rank", F.rank().over(per_lang.orderBy(F.desc("score"), F.desc("a")))).filter(F.col("rank") <= top)
    first = written(first.drop("rank"), "leading")
    texts = (first.select("id", F.posexplode("words").alias("k", "w")).join(words.select(F.col("id").alias("w"), "word"), "w")
             .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("k", "word"))).alias("spelled"))
             .select("id", F.array_join(F.col("spelled.word"), " ").alias("phrase")))
    order = per_lang.orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (first.join(texts, "id").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
