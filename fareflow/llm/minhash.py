"""Near-duplicate groups by MinHash: universal hash minima, banding, verification, components by large-star and small-star.

1. A document's set is its distinct shingles as 64-bit hashes; documents with one set are one class from the start. Each class has
   ``bands * rows`` minima, one under each of as many universal hashes ``a x + b``. The minima of a band make one key. Two sets
   with the threshold's similarity share no key with probability (1 - s^rows)^bands, 5e-9 as set up here.
2. Keys of one class are dropped, and of keys with the same classes one is kept. What is left are buckets.
3. First round: each bucket is a star around its smallest class. A member and the centre are compared by their minima, which reject
   a pair at or above the threshold with probability 1e-9 at most, then on their full sets. A hub's star is dealt in blocks.
   Links make components. A group of near copies, however large, is one component after this, without a pair of members put out.
4. Second round: buckets whose members are not all joined are looked at again, as a link may join two members neither of
   which is the centre. Each class is placed in its largest such bucket, in blocks of ``block`` members. Of each bucket, what did not
   join its main part visits all blocks of the places its members have; a pair not joined yet has such a visitor. In a task a
   visitor meets a block's minima at once, and the sets of those that pass.
5. Components of both rounds' links; each round of stars is written.

Sets are read again from the texts of the classes that meet another one, so they travel only then.

Defined cases. Null and empty texts and texts without words have an empty set and link with nothing. With fewer words than a shingle the
whole sequence is one shingle. Rows that repeat an id are documents of their own with the same id; a null id never is a
component's id unless all are null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm import text as tx
from fareflow.llm.components import components
from fareflow.llm.ngram_join import may_hold, needed_filter
from fareflow.llm.store import written

SEEN_LIMIT = 1 << 18
STAR = 1024
MISSED = 1e-9


@dataclass(frozen=True)
class MinHash:
    """Jaccard threshold as a fraction, shingle length in words, bands and rows of a band, members of a block."""

    above: int = 4
    below: int = 5
    words: int = 2
    bands: int = 48
    rows: int = 5
    block: int = 256

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    def least_agreement(self) -> int:
        """Minima that two sets at the threshold agree in, but for a probability of ``MISSED``."""
        n, p, total = self.minima, self.above / self.below, 0.0
        for k in range(n + 1):
            total += math.comb(n, k) * p ** k * (1 - p) ** (n - k)
            if total > MISSED:
                return k
        return n

    def linked(self, overlap: int, a: int, b: int) -> bool:
        return self.below * overlap >= self.above * (a + b - overlap)


def universal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of ``n`` hashes."""
    drawn = tx.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return drawn[:n] | np.uint64(1), drawn[n:]


def minima(tokens: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """(sets, n) least hashes of consecutive sets; ``starts`` are their first tokens, and no set is empty."""
    factors, summands = universal(n)
    out = np.empty((len(starts), n), np.uint64)
    for k in range(n):
        out[:, k] = np.minimum.reduceat(tokens * factors[k] + summands[k], starts)
    return out


def band_keys(least: np.ndarray, rule: MinHash) -> np.ndarray:
    """(sets, bands) hashes of each band's minima, different by band."""
    shaped = least.reshape(len(least), rule.bands, rule.rows)
    keys = np.broadcast_to(np.arange(1, rule.bands + 1, dtype=np.uint64), shaped.shape[:2]).copy()
    for row in range(rule.rows):
        keys = tx.mix(keys * np.uint64(0x9E3779B97F4A7C15) + shaped[:, :, row])
    return keys


def class_of(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def sign(docs: DataFrame, rule: MinHash) -> DataFrame:
    """(doc_id, cls, n, keys, minima) of each document; keys and two bytes of each minimum only for the first of a class that a task meets."""
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, end, data, starts in tx.chunks(batch.column(1)):
                found, kinds, sizes, new, sets = tx.words(data, starts), [], [], [], []
                for i in range(end - first):
                    tokens = tx.shingle_set(found.of(i), rule.words)
                    kinds.append(class_of(tokens))
                    sizes.append(len(tokens))
                    if len(tokens) and kinds[-1] not in seen:
                        if len(seen) >= SEEN_LIMIT:
                            seen.clear()
                        seen.add(kinds[-1])
                        new.append(i)
                        sets.append(tokens)
                keys, bodies = [None] * len(kinds), [None] * len(kinds)
                if new:
                    lengths = np.array([len(s) for s in sets])
                    least = minima(np.concatenate(sets), np.cumsum(lengths) - lengths, rule.minima)
                    for i, key, body in zip(new, band_keys(least, rule).view(np.int64), (least & np.uint64(0xFFFF)).astype(np.uint16)):
                        keys[i], bodies[i] = key, body.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(kinds, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(bodies, pa.binary())], names=["doc_id", "cls", "n", "keys", "minima"])

    return docs.mapInArrow(signed, "doc_id long, cls long, n long, keys array<long>, minima binary")


def buckets(signed: DataFrame) -> DataFrame:
    """(key, cls, size, centre): the classes of each key that several share; of keys with the same classes only one.

    Keys are first counted alone; a Bloom filter of those met twice keeps the rest from travelling with their classes.
    """
    counts = written(signed.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "key-counts")
    carried = signed.sparkSession.sparkContext.broadcast(needed_filter(counts.select(F.col("key").alias("h"))))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            keys, row = lists.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.flatnonzero(may_hold(carried.value, keys.view(np.uint64)))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(batch.column(0).to_numpy()[row[at]]), pa.array(keys[at])], names=["cls", "key"])

    held = signed.filter("keys is not null").select("cls", "keys").mapInArrow(pick, "cls long, key long")
    held = written(held.join(counts, "key").select("key", "cls").distinct(), "keys")
    shared = held.groupBy("key").agg(
        F.count("*").alias("size"), F.min("cls").alias("centre"), F.bit_xor(F.xxhash64("cls")).alias("x"),
        F.bit_xor(F.xxhash64("cls", F.lit(7))).alias("y")).filter("size > 1")
    shared = written(shared.groupBy("size", "centre", "x", "y").agg(F.min("key").alias("key")).select("key", "size", "centre"), "shared-keys")
    return held.join(shared, "key").select("key", "cls", "size", "centre")


def bodies(docs: DataFrame, signed: DataFrame, classes: DataFrame, rule: MinHash) -> DataFrame:
    """(cls, minima, tokens as bytes) of the given classes, each read from its document with the smallest id."""
    least = signed.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))  # combined where the copies are
    told = signed.filter("minima is not null").select("cls", "minima").join(classes, "cls", "left_semi").groupBy("cls").agg(
        F.max("minima").alias("minima"))
    chosen = told.join(least, "cls")
    chosen = written(chosen.select("cls", "minima", F.xxhash64("doc_id").alias("h")), "chosen")
    carried = docs.sparkSession.sparkContext.broadcast(needed_filter(chosen))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.take(pa.array(np.flatnonzero(may_hold(carried.value, batch.column(0).to_numpy().view(np.uint64)))))
            for first, end, data, starts in tx.chunks(part.column(1)):
                found = tx.words(data, starts)
                tokens = [tx.shingle_set(found.of(i), rule.words) for i in range(end - first)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(first, end - first), pa.array([class_of(t) for t in tokens], pa.int64()),
                     pa.array([t.tobytes() for t in tokens], pa.binary())], names=["h", "cls", "tokens"])

    found = docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(sets, "h long, cls long, tokens binary")
    return found.join(chosen, ["h", "cls"]).select("cls", "minima", "tokens")


class Joined:
    """Roots tied to each other in one cell."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(above, above)
        return x

    def tie(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def verified(rows: DataFrame, rule: MinHash) -> DataFrame:
    """Links (a, b) between roots in (cell, block, role, cls, root, minima, tokens) rows: role 0 are a cell's members, role 1 visitors.

    Only links that join roots not yet joined in the cell are put out.
    """
    least = rule.least_agreement()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members, signs, tied, links = None, [], None, Joined(), []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("cell", "block", "role", "cls", "root")]
            own_minima, own_tokens = batch.column("minima"), batch.column("tokens")
            for i, (gid, block, role, cls, root) in enumerate(zip(*columns)):
                if (gid, block) != cell:
                    cell, members, signs, tied = (gid, block), [], None, Joined()
                if role == 0:
                    members.append((cls, root, np.frombuffer(own_minima[i].as_py(), np.uint16), np.frombuffer(own_tokens[i].as_py(), np.int64)))
                    continue
                if not members:
                    continue
                if signs is None:
                    signs = np.stack([m[2] for m in members])
                agreed = (signs == np.frombuffer(own_minima[i].as_py(), np.uint16)).sum(axis=1)
                tokens = None
                for j in np.flatnonzero(agreed >= least):
                    other, its_root, _, its_tokens = members[j]
                    if other == cls or tied.root(its_root) == tied.root(root):
                        continue
                    if tokens is None:
                        tokens = np.frombuffer(own_tokens[i].as_py(), np.int64)
                    small, large = sorted((tokens, its_tokens), key=len)
                    if not rule.linked(len(small), len(small), len(large)):
                        continue
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    if rule.linked(int((large[at] == small).sum()), len(small), len(large)) and tied.tie(root, its_root):
                        links.append((root, its_root))
            if len(links) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])
                links.clear()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    dealt = rows.repartition("cell", "block").sortWithinPartitions("cell", "block", "role")
    return dealt.select("cell", "block", "role", "cls", "root", "minima", "tokens").mapInArrow(compare, "a long, b long")


def stars(met: DataFrame) -> DataFrame:
    """(cell, block, role, cls): every class of a bucket with the bucket's centre, each pair once, a centre's classes in blocks."""
    asked = written(met.filter("cls != centre").select("cls", F.col("centre").alias("cell")).distinct(), "stars")
    blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / STAR).cast("long").alias("blocks"))
    visitors = asked.join(blocks, "cell").select("cell", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block"), F.lit(1).alias("role"), "cls")
    centres = blocks.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"),
                            F.col("cell").alias("cls"))
    return visitors.unionByName(centres)


def strays(met: DataFrame, labels: DataFrame, rule: MinHash) -> DataFrame:
    """(cell, block, role, cls, root): what the first round left open, see the module's fourth step."""
    rooted = written(met.filter("size > 2").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                     .select("key", "cls", "size", F.coalesce("root", "cls").alias("root")), "rooted")
    open_ = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    left = written(rooted.join(written(open_.select("key"), "open-keys"), "key", "left_semi"), "open-buckets")
    weight = F.least(F.col("size"), F.lit(1 << 40)) * (1 << 20) + F.pmod(F.xxhash64("key"), F.lit(1 << 20))
    placed = left.groupBy("cls", "root").agg(F.max_by("key", weight).alias("cell"))
    blocks = F.ceil(F.col("members") / rule.block).cast("long")
    placed = written(placed.join(placed.groupBy("cell").agg(F.count("*").alias("members")), "cell").withColumn("blocks", blocks)
                     .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks"))), "placed")
    main = written(left.groupBy("key", "root").agg(F.count("*").alias("k")).groupBy("key").agg(F.max_by("root", "k").alias("main")), "main-parts")
    outside = left.join(main, "key").filter("root != main").select("key", "cls", "root")
    places = left.select("key", "cls").join(placed.select("cls", "cell"), "cls").select("key", "cell").distinct()
    visits = outside.join(places, "key").select("cls", "root", "cell").distinct()
    visits = (visits.join(placed.select("cell", "blocks").distinct(), "cell")
              .select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "cls", "root"))
    visits = written(visits, "visits")
    members = placed.join(visits.select("cell", "block").distinct(), ["cell", "block"], "left_semi").select(
        "cell", "block", F.lit(0).alias("role"), "cls", "root")
    return visits.unionByName(members)


def links(docs: DataFrame, signed: DataFrame, rule: MinHash) -> DataFrame:
    """(node, root) of all classes that have a link to another one."""
    met = written(buckets(signed), "buckets")
    first = stars(met)
    held = bodies(docs, signed, first.select("cls").distinct(), rule)
    labels = written(components(verified(first.withColumn("root", F.col("cls")).join(held, "cls"), rule)), "labels")
    second = written(strays(met, labels, rule), "second-round")
    if second.isEmpty():
        return labels
    held = bodies(docs, signed, second.select("cls").distinct(), rule)
    more = verified(second.join(held, "cls"), rule)
    return components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def near_duplicates(docs: DataFrame, rule: MinHash = MinHash(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the component's id is its own) of each row of ``docs``."""
    docs = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    signed = written(sign(docs, rule), "signed")
    labels = written(links(docs, signed, rule), "classes")
    classes = signed.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    rooted = written(classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                     .select("cls", "least", F.coalesce("root", "cls").alias("root")), "rooted-classes")
    roots = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    named = written(rooted.join(roots, "root").select("cls", "component_id"), "named-classes")
    out = (signed.filter("n > 0").select("doc_id", "cls", "n").join(named, "cls").select("doc_id", "n", "component_id")
           .unionByName(signed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
