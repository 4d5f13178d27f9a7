"""Language-model scores of texts by a probabilistic suffix tree, with a word unigram model beside it.

A text is the sequence of its words (A-Z lower-cased, runs outside ``[\\x20\\x09-\\x0D]``), spelled in bytes with one space between
words and an end mark, so the tree's probability is that of the words and the end. The tree's states are contexts of up to ``depth`` bytes:

* counted over all training texts: every run of ``depth + 1`` bytes, from which shorter contexts follow by summing;
* kept by a divergence test over the full counts, whatever the corpus's size: a context stays when its next-byte distribution diverges
  from that of its longest proper suffix by more than chance would have it (G-test, four standard deviations above its mean), and so
  do all suffixes of it;
* smoothed: a state gives its counts and leaves the rest, with one count for each next byte seen, to its parent; the root gives every byte
  one count more.

A position is scored by the longest suffix of what precedes it that is a state. All contexts that end in the same two bytes are a subtree:
the runs a task has counted leave it sorted and packed by subtree, are merged there, and only the merged counts are written. A subtree's
levels, tests and probabilities follow from these in one task, and are not stored. Of the lowest levels, at most 2^24 runs whatever the corpus's
size, the counts are summed on the driver and broadcast. A model of which every part holds ``context_share`` and ``entry_share`` of the
positions and that has at most ``entry_limit`` next bytes is broadcast whole. Of a larger one the most frequent full runs are broadcast with
their probabilities, at most ``entry_limit``; all other runs travel packed to their subtree. Shares and limit decide where a run is looked
up and change no score (but for rounding: what is broadcast is in single precision). A run fits one long, so ``depth`` is at most 7.

Unigram base: the sum over tokens (words and one end) of log10((c + 1) / (N + V + 1)). Counts of the most frequent
words, at most ``HEAD_WORDS``, are broadcast; tokens of all others are counted by document and joined with the full table of counts.

Defined cases. A null or empty text has the end as its one token. Rows that repeat an id are scored each, and each teaches. With nothing to
learn from, every byte has 1/256 and N and V are 0. Columns other than id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm import text as tx
from fareflow.llm.store import most_frequent, written

HEAD_WORDS = 1 << 19
HOLD = 1 << 21  # counts a task holds before it hands them on
CHUNK_BYTES = 1 << 20  # of text at a time
BLOB = 1 << 16  # packed counts in one row
LOW = 2  # levels that are broadcast whole: at most 1 << 24 runs, however large the corpus

# Packed columns of keys and counts, and what they hold.
PACKED = "kind int, part int, n long, keys binary, counts binary"
WORDS, RUNS, TEXTS, OPEN, LOWEST, ENDS, STEPS, OWN, TOP, SUMS, ENTRIES, STATES = (*range(10), 16, 32)


@dataclass(frozen=True)
class TreeRules:
    depth: int = 7
    context_share: float = 1e-6
    entry_share: float = 1e-7
    entry_limit: int = 1 << 22
    deviations: float = 4.0


def spelled(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of consecutive texts as the tree reads them, each after ``depth`` zeros and ended by one; and where each begins."""
    inside = ~tx.IS_SPACE[data]
    keep = inside.copy()
    if len(data):
        # White space stays, as one space, where a word follows and one of the same text came before.
        follows = np.zeros(len(data), bool)
        follows[:-1] = inside[1:]
        first = starts[:-1][starts[:-1] > 0]
        follows[first - 1] = False
        seen = np.concatenate([[0], np.cumsum(inside)])
        opening = np.repeat(seen[starts[:-1]], np.diff(starts))
        keep |= ~inside & follows & (seen[:-1] > opening)
    at = np.flatnonzero(keep)
    ends = np.searchsorted(at, starts[1:])
    counts = np.diff(np.concatenate([[0], ends]))
    n = len(counts)
    begin = depth + np.concatenate([[0], ends[:-1]]) + np.arange(n) * depth
    out = np.zeros(len(at) + depth * (n + 1), np.uint8)
    place = np.arange(len(at)) + depth + np.repeat(np.arange(n), counts) * depth
    symbols = tx.LOWER[data[at]]
    symbols[~inside[at]] = 32
    symbols[symbols == 0] = 1  # zero is the mark of a text's end
    out[place] = symbols
    return out, begin


def grams(symbols: np.ndarray, depth: int) -> np.ndarray:
    """At each place the byte with the ``depth`` before it, the byte itself lowest."""
    wide = symbols.astype(np.uint64)
    out = wide.copy()
    for k in range(1, depth + 1):
        out[k:] |= wide[:-k] << np.uint64(8 * k)
    return out


def _places(begin: np.ndarray, total: int, depth: int) -> np.ndarray:
    """Mask of the places that hold a text's bytes or its end."""
    mask = np.ones(total, bool)
    mask[:depth] = False
    ends = np.append(begin[1:], total)  # after each text's bytes come its end and depth - 1 zeros
    for k in range(1, depth):
        mask[ends - k] = False
    return mask


def packed(values: np.ndarray) -> bytes:
    """Values of eight bytes, byte by byte and compressed: of sorted ones the high bytes hardly vary."""
    return pa.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int, kind: type = np.uint64) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(kind).ravel()


class Counter64:
    """Counts of uint64 keys, merged by sorting."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.merged = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True) if counts is None else (keys, counts))
            self.held += len(self.parts[-1][0])

    def settle(self) -> None:
        """Merge once what came since the last merge outweighs it."""
        if self.held - self.merged > max(HOLD, self.merged):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in self.parts] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([p[1] for p in self.parts] or [np.zeros(0, np.int64)])
        self.parts = [_summed(keys, counts)]
        self.held = self.merged = len(self.parts[0][0])
        return self.parts[0]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def part_numbers(runs: np.ndarray, parts: int) -> np.ndarray:
    """The part that a run's subtree is in, told by the ``LOW`` bytes before the next one."""
    return (tx.mix((runs >> np.uint64(8)) & _low(LOW)) % np.uint64(parts)).astype(np.uint16)


def blobs(part: np.ndarray, keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(part, n, keys, values) with at most ``BLOB`` keys each, in the given order."""
    order = np.argsort(part, kind="stable")
    part, keys, values = part[order], keys[order], values[order]
    cuts = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
    for low, high in zip(cuts, np.append(cuts[1:], len(part))):
        for a in range(low, high, BLOB):
            b = min(high, a + BLOB)
            yield int(part[low]), int(b - a), packed(keys[a:b]), packed(values[a:b])


def _batch(rows: list[tuple], kinds: int | list[int]) -> pa.RecordBatch:
    kinds = [kinds] * len(rows) if isinstance(kinds, int) else kinds
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(
        (pa.int32(), pa.int64(), pa.binary(), pa.binary())))], names=["kind", "part", "n", "keys", "counts"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(column[k].as_py() for column in batch.columns)


def _parts(docs: DataFrame) -> int:
    return min(1 << 15, 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def corpus_counts(docs: DataFrame, depth: int) -> DataFrame:
    """``PACKED`` counts of each task: ``WORDS``, ``RUNS`` of ``depth + 1`` bytes, and the number of ``TEXTS``."""
    n_parts = _parts(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = (Counter64(), Counter64()), 0

        def flush(kind: int) -> Iterator[pa.RecordBatch]:
            keys, n = held[kind].merge()
            for row in blobs((keys % np.uint64(n_parts)).astype(np.uint16) if kind == WORDS else part_numbers(keys, n_parts), keys, n):
                yield _batch([row], kind)
            held[kind].__init__()

        for batch in batches:
            texts += batch.num_rows
            for _, _, data, starts in tx.chunks(batch.column(0), CHUNK_BYTES):
                held[WORDS].add(tx.words(data, starts).hashes)
                symbols, begin = spelled(data, starts, depth)
                held[RUNS].add(grams(symbols, depth)[_places(begin, len(symbols), depth)])
                for kind in (WORDS, RUNS):
                    if held[kind].held > HOLD:
                        held[kind].merge()
                        if held[kind].held > HOLD // 2:
                            yield from flush(kind)
        yield from flush(WORDS)
        yield from flush(RUNS)
        yield _batch([(0, texts, b"", b"")], TEXTS)

    return docs.select("text").mapInArrow(count, PACKED)


def _key(level: int, context: np.ndarray) -> np.ndarray:
    return context | np.uint64((level + 1) << 56)


def _run_key(level: int, gram: np.ndarray) -> np.ndarray:
    return tx.mix(gram + np.uint64((level + 1) << 56))  # a run may fill all 64 bits


def _low(level: int) -> np.uint64:
    """Mask of the lowest ``level`` bytes."""
    return np.uint64((1 << (8 * level)) - 1)


class SuffixTree:
    """What is broadcast of a model, in log10: states by context and next bytes by state, or only the most frequent full runs."""

    def __init__(self, depth: int, whole: bool, root: np.ndarray, entries: list[tuple], states: list[tuple], top: tuple | None = None):
        """``entries``: (level, run, log10 p); ``states``: (level, context, log10 of what it leaves), as arrays by level; ``top``: full
        runs and their log10 p."""
        self.depth, self.whole, self.root = depth, whole, root

        def table(parts: list[tuple], key) -> tx.HashTable:
            keys = np.concatenate([np.zeros(0, np.uint64), *(key(j, k) for j, k, _ in parts)])
            return tx.HashTable(keys, np.concatenate([np.zeros(0), *(v for _, _, v in parts)]).astype(np.float32))
        self.entries, self.states = table(entries, _run_key), table(states, _key)
        runs, logs = (np.zeros(0, np.uint64), np.zeros(0)) if top is None else top
        order = np.argsort(runs)
        self.top = runs[order], logs[order].astype(np.float32)

    def over(self, lower: SuffixTree) -> SuffixTree:
        """This tree of the levels above ``lower``'s, together with it."""
        out = SuffixTree.of(self.plain())
        for name in ("entries", "states"):
            own, low = getattr(self, name), getattr(lower, name)
            keys, values = (np.concatenate([getattr(t, of)[t.keys != 0] for t in (own, low)]) for of in ("keys", "values"))
            setattr(out, name, tx.HashTable(keys, values))
        return out

    def plain(self) -> tuple:
        return self.depth, self.whole, self.root, self.top, self.entries.plain(), self.states.plain()

    @classmethod
    def of(cls, plain: tuple) -> SuffixTree:
        tree = cls.__new__(cls)
        tree.depth, tree.whole, tree.root, tree.top = plain[:4]
        tree.entries, tree.states = map(tx.HashTable.of, plain[4:])
        return tree

    def _log(self, gram: np.ndarray, level: int) -> np.ndarray:
        """log10 of the lowest byte's probability after the ``level`` bytes above it, from a whole model."""
        out = np.zeros(len(gram))
        open_ = np.arange(len(gram))
        for j in range(level, 0, -1):
            at, hit = self.entries.find(_run_key(j, gram[open_] & _low(j + 1)))
            out[open_[hit]] += self.entries.values[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out
            at, hit = self.states.find(_key(j, (gram[open_] & _low(j + 1)) >> np.uint64(8)))
            out[open_[hit]] += self.states.values[at[hit]]
        out[open_] += self.root[(gram[open_] & np.uint64(255)).astype(np.int64)]
        return out

    def judged(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each text's runs that are known here; the other runs, and the text of each."""
        symbols, begin = spelled(data, starts, self.depth)
        at = np.flatnonzero(_places(begin, len(symbols), self.depth))
        runs = grams(symbols, self.depth)[at]
        owner = np.searchsorted(begin, at, "right") - 1
        known, place = np.unique(runs, return_inverse=True)
        if self.whole:
            return np.bincount(owner, weights=self._log(known, self.depth)[place], minlength=len(begin)), runs[:0], owner[:0]
        at, hit = _find(self.top[0], known)
        logs = np.zeros(len(known))
        logs[hit] = self.top[1][at[hit]]
        open_ = np.flatnonzero(~hit[place])
        return np.bincount(owner, weights=logs[place], minlength=len(begin)), runs[open_], owner[open_]

    def score(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each text, from a whole model."""
        return self.judged(data, starts)[0]


class Level:
    """Runs of one level in order, their counts, and their contexts."""

    def __init__(self, runs: np.ndarray, n: np.ndarray):
        self.runs, self.n = runs, n
        own = runs >> np.uint64(8)
        self.first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
        self.ctx, self.kinds = own[self.first], np.diff(np.append(self.first, len(runs)))
        self.total = np.add.reduceat(n, self.first) if len(n) else n
        self.of = np.repeat(np.arange(len(self.first)), self.kinds)

    def left(self) -> np.ndarray:
        """log10 of what each context leaves to its parent, were it a state."""
        return np.log10(self.kinds / (self.total + self.kinds))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is among sorted ones, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Subtree:
    """Levels from ``lowest`` on of all that ends alike, from the counts of its longest runs; which contexts are states."""

    def __init__(self, runs: np.ndarray, n: np.ndarray, lowest: int, depth: int, deviations: float, below: np.ndarray | None = None):
        """``below``: contexts of the deepest level that longer states end in."""
        self.lowest, self.depth, self.levels, self.kept = lowest, depth, {}, {}
        for j in range(depth, lowest - 1, -1):
            if j < depth:
                runs, n = _summed(runs & _low(j + 1), n)
            self.levels[j] = Level(runs, n)
        self.up = {j: np.searchsorted(self.levels[j - 1].runs, self.levels[j].runs & _low(j)) for j in range(lowest + 1, depth + 1)}
        self.below = np.zeros(0, np.uint64) if below is None else below
        for j in range(depth, lowest, -1):
            own, short = self.levels[j], self.levels[j - 1]
            share = short.n[self.up[j]] / short.total[short.of[self.up[j]]]
            terms = own.n * np.log(own.n / own.total[own.of] / share)
            g = 2 * np.add.reduceat(terms, own.first) if len(terms) else terms
            self.kept[j] = (g > own.kinds + deviations * np.sqrt(2.0 * own.kinds)) | np.isin(own.ctx, self.below)
            self.below = np.unique(own.ctx[self.kept[j]] & _low(j - 1))

    def spread(self, base: np.ndarray) -> None:
        """log10 p of all runs, given those of the lowest level's."""
        self.logs = {self.lowest: base}
        for j in range(self.lowest + 1, self.depth + 1):
            own, under = self.levels[j], self.logs[j - 1][self.up[j]]
            whole = (own.total + own.kinds)[own.of]
            smoothed = np.log10(own.n / whole + own.kinds[own.of] / whole * 10.0 ** under)
            self.logs[j] = np.where(self.kept[j][own.of], smoothed, under)

    def judge(self, runs: np.ndarray, low: SuffixTree) -> np.ndarray:
        """log10 p of any full runs: from the longest part that was seen, and the states above it that never saw it."""
        out, open_ = np.zeros(len(runs)), np.arange(len(runs))
        for j in range(self.depth, self.lowest, -1):
            run = runs[open_] & _low(j + 1)
            at, hit = _find(self.levels[j].runs, run)
            out[open_[hit]] += self.logs[j][at[hit]]
            open_, run = open_[~hit], run[~hit]
            at, hit = _find(self.levels[j].ctx, run >> np.uint64(8))
            hit[hit] = self.kept[j][at[hit]]
            out[open_[hit]] += self.levels[j].left()[at[hit]]
        out[open_] += low._log(runs[open_], self.lowest)
        return out


@dataclass
class Model:
    """Written table of packed counts by subtree, and the tree's lowest levels."""
    counts: DataFrame
    low: SuffixTree
    total: int
    texts: int


def learn(counts: DataFrame, rules: TreeRules) -> Model:
    """The corpus's runs merged by subtree, where the states of each are told, and the lowest levels over all."""
    if rules.depth > 7:
        raise ValueError("a run of more than 8 bytes does not fit a long")
    lowest, depth, deviations = min(LOW, rules.depth), rules.depth, rules.deviations

    def told(part: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        tree = Subtree(keys, n, lowest, depth, deviations)
        base, own = tree.levels[lowest], [tree.levels[j] for j in tree.kept]
        step, times = np.unique((np.log2(n) * 8).astype(np.int64), return_counts=True)
        seen = [level.total[tree.kept[j]] for j, level in zip(tree.kept, own)]
        mine = [level.n[tree.kept[j][level.of]] for j, level in zip(tree.kept, own)]
        least = [min([int(x.min()) for x in some if len(x)], default=1 << 62) for some in (mine, seen)]
        rows = [(RUNS, keys, n), (LOWEST, base.runs, base.n), (ENDS, tree.below, tree.below), (STEPS, step, times),
                (OWN, np.array([sum(map(len, mine)), least[0], least[1]]), np.zeros(3, np.int64))]
        yield _batch([(part, len(k), packed(k), packed(v)) for _, k, v in rows if len(k)], [r[0] for r in rows if len(r[1])])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, texts = None, Counter64(), 0

        def done() -> Iterator[pa.RecordBatch]:
            keys, n = held.merge()
            if now and now[0] == RUNS and len(keys):
                yield from told(now[1], keys, n)
            elif now and now[0] == WORDS and len(keys):
                yield _batch([(now[1], len(keys), packed(keys), packed(n))], WORDS)
            held.__init__()

        for kind, part, n, keys, counted in _rows(batches):
            if kind == TEXTS:
                texts += n
                continue
            if (kind, part) != now:
                yield from done()
                now = kind, part
            held.add(unpacked(keys, n), unpacked(counted, n, np.int64))
            held.settle()
        yield from done()
        if texts:
            yield _batch([(0, texts, b"", b"")], TEXTS)

    merged = written(counts.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(merge, PACKED), "counts")
    small = {LOWEST: [], ENDS: []}
    for kind, _, n, keys, values in _rows(merged.filter(F.col("kind").isin(LOWEST, ENDS)).toArrow().to_batches()):  # bounded by LOW
        small[kind].append((unpacked(keys, n), unpacked(values, n, np.int64)))
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs, n = _summed(*(np.concatenate(c) for c in zip(none, *small[LOWEST])))
    below = np.unique(np.concatenate([none[0], *(k for k, _ in small[ENDS])]))
    low = Subtree(runs, n, 0, lowest, deviations, below)
    root = np.ones(256)
    root[low.levels[0].runs.astype(np.int64)] += low.levels[0].n
    root = np.log10(root / root.sum())
    low.spread(root[low.levels[0].runs.astype(np.int64)])
    texts = merged.filter(F.col("kind") == TEXTS).agg(F.sum("n")).first()[0] or 0
    entries, states = _own(low)
    return Model(merged, SuffixTree(lowest, True, root, entries, states), int(n.sum()), texts)


def _own(tree: Subtree) -> tuple[list[tuple], list[tuple]]:
    """Next bytes of a spread tree's states by level, and the states."""
    own = {j: tree.kept[j][tree.levels[j].of] for j in tree.kept}
    return ([(j, tree.levels[j].runs[own[j]], tree.logs[j][own[j]]) for j in own],
            [(j, tree.levels[j].ctx[tree.kept[j]], tree.levels[j].left()[tree.kept[j]]) for j in own])


def head(model: Model, rules: TreeRules) -> SuffixTree:
    """What is broadcast of a model: at most ``entry_limit`` runs, and as many states at most, reach the driver."""
    depth, deviations, low, least, own = rules.depth, rules.deviations, model.low.plain(), 1 << 62, []
    histogram: dict[int, int] = {}
    for kind, _, n, keys, times in _rows(model.counts.filter(F.col("kind").isin(STEPS, OWN)).toArrow().to_batches()):  # 500 steps a part at most
        if kind == OWN:
            own.append(unpacked(keys, n, np.int64))
        else:
            for step, more in zip(unpacked(keys, n, np.int64).tolist(), unpacked(times, n, np.int64).tolist()):
                histogram[step] = histogram.get(step, 0) + more
    entries, states = int(sum(x[0] for x in own)), int(min((x[2] for x in own), default=1 << 62))
    whole = (entries <= rules.entry_limit and min((x[1] for x in own), default=1 << 62) >= model.total * rules.entry_share
             and states >= model.total * rules.context_share)
    room = rules.entry_limit
    for step in sorted(histogram, reverse=True):  # a step that would exceed the limit stays out as a whole
        room -= histogram[step]
        if room < 0:
            break
        least = step

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = SuffixTree.of(low)
        for _, part, n, keys, counted in _rows(batches):
            runs, n = unpacked(keys, n), unpacked(counted, n, np.int64)
            tree = Subtree(runs, n, base.depth, depth, deviations)
            tree.spread(base._log(tree.levels[base.depth].runs, base.depth))
            if whole:
                found = [(kind + j, k, v) for kind, some in zip((ENTRIES, STATES), _own(tree)) for j, k, v in some]
            else:
                top = (np.log2(n) * 8).astype(np.int64) >= least
                found = [(TOP, runs[top], tree.logs[depth][top])]
            for kind, k, v in found:
                if len(k):
                    yield _batch([(part, len(k), packed(k), packed(v))], kind)

    found: dict[int, list] = {}
    for kind, _, n, keys, logs in _rows(model.counts.filter(F.col("kind") == RUNS).mapInArrow(finish, PACKED).toArrow().to_batches()):
        found.setdefault(kind, []).append((unpacked(keys, n), unpacked(logs, n, np.float64).astype(np.float32)))

    def all_of(kind: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate(c) for c in zip((np.zeros(0, np.uint64), np.zeros(0, np.float32)), *found.pop(kind, [])))
    if not whole:
        runs, logs = all_of(TOP)
        return SuffixTree(depth, False, model.low.root, [], [], (runs, logs))
    deep = range(model.low.depth + 1, depth + 1)
    out = SuffixTree(depth, True, model.low.root, [(j, *all_of(ENTRIES + j)) for j in deep], [(j, *all_of(STATES + j)) for j in deep])
    return out.over(model.low)


def grow(counts: DataFrame, rules: TreeRules) -> SuffixTree:
    """What is broadcast of a corpus's model."""
    return head(learn(counts, rules), rules)


def run_logs(open_runs: DataFrame, model: Model, rules: TreeRules) -> DataFrame:
    """(row, run_log): the sum of the logs of each row's open runs, which meet their subtree's counts. Sums travel packed, by blocks of texts."""
    depth, deviations, low, n_parts = rules.depth, rules.deviations, model.low.plain(), _parts(open_runs)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, now, tree = SuffixTree.of(low), [], None, None

        def flush() -> Iterator[pa.RecordBatch]:
            rows, logs = _totals(held)
            held.clear()
            for row in blobs((tx.mix(rows.view(np.uint64) >> np.uint64(12)) % np.uint64(n_parts)).astype(np.uint16), rows, logs):
                yield _batch([row], SUMS)

        counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for kind, part, n, keys, values in _rows(batches):
            if part != now:
                now, tree, counts = part, None, (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            if kind == RUNS:
                counts = unpacked(keys, n), unpacked(values, n, np.int64)
                continue
            if tree is None:
                tree = Subtree(*counts, base.depth, depth, deviations)
                tree.spread(base._log(tree.levels[base.depth].runs, base.depth))
            runs, place = np.unique(unpacked(keys, n), return_inverse=True)
            held.append((unpacked(values, n, np.int64), tree.judge(runs, base)[place]))
            if sum(len(r) for r, _ in held) > HOLD:
                yield from flush()
        if held:
            yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                rows, logs = _totals(held)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(logs)], names=["row", "run_log"])

        for _, part, n, keys, values in _rows(batches):
            if part != now:
                yield from done()
                now = part
            held.append((unpacked(keys, n, np.int64), unpacked(values, n, np.float64)))
            if sum(len(r) for r, _ in held) > HOLD:
                held[:] = [_totals(held)]
        yield from done()

    met = model.counts.filter(F.col("kind") == RUNS).unionByName(open_runs)
    sums = met.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(answer, PACKED)
    return sums.repartition("part").sortWithinPartitions("part").mapInArrow(add, "row long, run_log double")


def _totals(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sum of each one's logs."""
    rows, place = np.unique(np.concatenate([r for r, _ in held]), return_inverse=True)
    return rows, np.bincount(place, weights=np.concatenate([x for _, x in held]))


def scores(docs: DataFrame, training: Column, rules: TreeRules = TreeRules(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score; learnt from the rows that ``training`` holds for."""
    docs = docs.withColumn("teaches", F.coalesce(training, F.lit(False))).select(
        F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), "teaches")
    spark = docs.sparkSession
    model = learn(corpus_counts(docs.filter("teaches"), rules.depth), rules)
    n_texts = model.texts

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, n, keys, times in _rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(keys, n, np.int64)), pa.array(unpacked(times, n, np.int64))], names=["key", "n"])

    vocabulary_counts = written(model.counts.filter(F.col("kind") == WORDS).mapInArrow(listed, "key long, n long"), "words")
    sums = vocabulary_counts.agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).first()
    n_words, n_kinds = sums["n"] or 0, sums["kinds"]
    train_tokens, vocabulary = n_words + n_texts, n_kinds + (n_texts > 0)
    spread = float(train_tokens + vocabulary + 1)
    frequent = most_frequent(vocabulary_counts, HEAD_WORDS).toArrow()
    head_words = frequent.column("key").to_numpy().astype(np.int64).view(np.uint64)
    head_logs = np.log10((frequent.column("n").to_numpy() + 1) / spread)
    tree = head(model, rules)
    whole, n_parts = tree.whole, _parts(docs)
    sent = spark.sparkContext.broadcast((tree.plain(), tx.HashTable(head_words, head_logs).plain()))
    end_log = float(np.log10((n_texts + 1) / spread))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, known = SuffixTree.of(sent.value[0]), tx.HashTable.of(sent.value[1])
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "word", "n", "n_known", "base", "score", "part", "keys", "counts"]
        kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.int32(), pa.binary(), pa.binary()]

        def rows(size: int, **given: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([given.get(name, pa.nulls(size, kind)) for name, kind in zip(names, kinds)], names=names)

        def rare_words(keys: np.ndarray, who: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Words that are not known here, counted by text."""
            order = np.lexsort((keys, who))
            keys, who = keys[order], who[order]
            begins = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (who[1:] != who[:-1])])) if len(keys) else []
            if len(begins):
                yield rows(len(begins), row=pa.array(row + who[begins]), word=pa.array(keys[begins].view(np.int64)),
                           n=pa.array(np.diff(np.append(begins, len(keys)))))

        def open_runs() -> Iterator[pa.RecordBatch]:
            """Runs that are not known here with their texts' rows, by subtree."""
            runs, whose = (np.concatenate(c) for c in zip(*open_))
            order = np.argsort(runs, kind="stable")
            runs, whose = runs[order], whose[order]
            for part, n, keys, values in blobs(part_numbers(runs, n_parts), runs, whose):
                yield rows(1, n=pa.array([n]), part=pa.array([part], pa.int32()), keys=pa.array([keys], pa.binary()),
                           counts=pa.array([values], pa.binary()))
            open_.clear()

        open_: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, starts in tx.chunks(batch.column(1), CHUNK_BYTES):
                found, n = tx.words(data, starts), end - first
                at, hit = known.find(found.hashes)
                owner = np.repeat(np.arange(n), np.diff(found.bounds))
                base = np.bincount(owner[hit], weights=known.values[at[hit]], minlength=n) + end_log
                n_known = np.bincount(owner[hit], minlength=n) + (n_texts > 0)
                logs, runs, of = tree.judged(data, starts)
                yield rows(n, row=pa.array(np.arange(row, row + n)), doc_id=ids.slice(first, n), n=pa.array(np.diff(found.bounds) + 1),
                           n_known=pa.array(n_known), base=pa.array(base), score=pa.array(logs))
                yield from rare_words(found.hashes[~hit], owner[~hit])
                if len(runs):
                    open_.append((runs, row + of))
                    if sum(len(r) for r, _ in open_) > HOLD:
                        yield from open_runs()
                row += n
        if open_:
            yield from open_runs()

    schema = "row long, doc_id long, word long, n long, n_known long, base double, score double, part int, keys binary, counts binary"
    judged = written(docs.select("doc_id", "text").mapInArrow(judge, schema), "judged")
    rare = (judged.filter("word is not null").select("row", F.col("word").alias("key"), F.col("n").alias("times"))
            .join(vocabulary_counts, "key", "left")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / spread)).alias("rare_log"),
                                F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known")))
    out = judged.filter("word is null and part is null").join(rare, "row", "left")
    if whole:
        out = out.withColumn("run_log", F.lit(0.0))
    else:
        open_runs = judged.filter("part is not null").select(F.lit(OPEN).alias("kind"), "part", "n", "keys", "counts")
        out = out.join(run_logs(open_runs, model, rules), "row", "left")
    return (out
            .select("doc_id", F.col("n").alias("n_tokens"), (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(train_tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("rare_log", F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce("run_log", F.lit(0.0))).alias("score")))
