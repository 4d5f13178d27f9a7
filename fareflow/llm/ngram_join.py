"""Near-duplicate classes by an exact Jaccard join over word shingles with a token-group matrix.

Tokens are the 64-bit hashes of a text's distinct five-word shingles. Texts with one token set are one class from the start.

1. Tokens have a global order: frequent ones last, others by hash. Which ones are frequent is estimated on every 64th document
   and only steers the work: any order gives the same links. Two sets with Jaccard t or more share a token among the first
   n - ceil(t n) + 1 of each, so only these are looked up.
2. Classes that share such tokens are partitioned into groups: by the rarest frequent token in the prefix, else by the prefix
   token most classes share, and by size. A group of near copies, however large, is one group, or a few.
3. The token-group matrix has one row per prefix token and group, with the bounds of the group's sizes and of the tokens
   that follow the shared one. A query meets a group if a matrix row allows an overlap of t.
4. Groups are opened in tasks. A task holds a block of at most about ``block`` members, the union of their tokens, and takes the
   queries one by one: one whose tokens in the union can't reach the overlap is dropped, the others are compared exactly with
   all members at once. Only links that join parts not yet joined in the task are put out, never all pairs.
5. A group of several blocks is first joined through its blocks and a few leaders (the members with the fewest rare tokens),
   which every block holds. Only classes that did not join their group's main part then visit its other blocks.

Sets are read again from the texts; a Bloom filter of the classes that are needed (at most 16 MB) decides which travel, and
a join behind it is exact.

Defined cases. Null and empty texts and texts without words have no token and link with nothing. Fewer than five words are one
shingle. Rows that repeat an id are documents of their own with the same id; a null id never is a component's id unless all are
null. An empty table gives an empty
result.
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
from fareflow.llm.store import most_frequent, written

SAMPLE = 64
FREQUENT_IN_SAMPLE = 4
FREQUENT_LIMIT = 1 << 19
BLOOM_WORDS = 1 << 21
SEEN_LIMIT = 1 << 18
CUTS = 16
SIZE_STEP = 1.15


@dataclass(frozen=True)
class Likeness:
    """Jaccard threshold as a fraction, shingle length in words, members of a block."""

    above: int = 3
    below: int = 4
    words: int = 5
    block: int = 256

    def prefix(self, n):
        return n - (self.above * n + self.below - 1) // self.below + 1

    def enough(self, overlap, a, b):
        """overlap / union >= above / below."""
        return (self.above + self.below) * overlap >= self.above * (a + b)


def _class(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def token_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, end, data, starts in tx.chunks(column):
        found = tx.words(data, starts)
        for i in range(end - first):
            yield first + i, tx.shingle_set(found.of(i), words)


def frequent_tokens(docs: DataFrame, rule: Likeness) -> np.ndarray:
    """Tokens of many documents, rarest first; at most ``FREQUENT_LIMIT``, so fit to broadcast."""
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for _, found in token_sets(batch.column(0), rule.words):
                kind = _class(found)
                if len(found) and kind not in seen:
                    seen.add(kind)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array(np.full(len(found), kind, np.int64))], names=["token", "cls"])

    sampled = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text")
    counts = (sampled.mapInArrow(tokens, "token long, cls long").distinct().groupBy("token").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= FREQUENT_IN_SAMPLE))
    rows = most_frequent(written(counts, "frequent"), FREQUENT_LIMIT).toArrow()
    token, n = rows.column("token").to_numpy(), rows.column("n").to_numpy()
    return token[np.lexsort((token, n))].astype(np.int64).view(np.uint64)


def signatures(docs: DataFrame, frequent: np.ndarray, rule: Likeness) -> DataFrame:
    """(doc_id, cls, n, n_rare, reach, step, cuts, prefix) of each document; the last ones only for the first of a class
    that a task meets.

    All rare tokens up to ``reach`` are in the prefix; ``cuts`` are every ``step``-th of its rare tokens.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = tx.HashTable(sent.value, np.arange(len(sent.value), dtype=np.int64))
        seen: set[int] = set()
        for batch in batches:
            kinds, sizes, rares, reaches, steps, cuts, prefixes = [], [], [], [], [], [], []
            for _, tokens in token_sets(batch.column(1), rule.words):
                kind, n = _class(tokens), len(tokens)
                kinds.append(kind)
                sizes.append(n)
                at, hit = rank.find(tokens)
                rares.append(n - int(hit.sum()))
                if n == 0 or kind in seen:
                    for column in (prefixes, reaches, steps, cuts):
                        column.append(None)
                    continue
                if len(seen) >= SEEN_LIMIT:
                    seen.clear()
                seen.add(kind)
                p = rule.prefix(n)
                first = tokens[~hit][:p]
                reaches.append((1 << 63) - 1 if len(first) < p else int(first[-1:].view(np.int64)[0]))
                steps.append(max(1, len(first) // CUTS))
                cuts.append(first[steps[-1] - 1::steps[-1]].view(np.int64))
                if len(first) < p:
                    often = tokens[hit]
                    first = np.concatenate([first, often[np.argsort(rank.values[at[hit]])][:p - len(first)]])
                prefixes.append(first.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kinds, pa.int64()), pa.array(sizes, pa.int64()), pa.array(rares, pa.int64()),
                 pa.array(reaches, pa.int64()), pa.array(steps, pa.int32()), pa.array(cuts, pa.list_(pa.int64())),
                 pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "cls", "n", "n_rare", "reach", "step", "cuts", "prefix"])
    return docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, cls long, n long, n_rare long, reach long, step int, cuts array<long>, prefix array<long>")


def shared_tokens(signed: DataFrame) -> DataFrame:
    """(token, cls, n, n_rare, reach, pos, df) of prefix tokens more than one row has; frequent ones always.

    Tokens are counted first; a Bloom filter of those that are shared then keeps the others from travelling once more.
    """
    rows = signed.filter("prefix is not null")
    counts = rows.select("n_rare", F.posexplode("prefix").alias("pos", "token")).filter("pos < n_rare").groupBy("token").agg(
        F.count("*").alias("df")).filter("df > 1")
    counts = written(counts, "shared-counts")
    carried = signed.sparkSession.sparkContext.broadcast(needed_filter(counts.select(F.col("token").alias("h"))))
    names = ["cls", "n", "n_rare", "reach", "pos", "token"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            lengths = np.diff(prefix.offsets.to_numpy())
            tokens = prefix.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lengths)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            rare = batch.column("n_rare").to_numpy()[row] > pos
            at = np.flatnonzero(~rare | may_hold(carried.value, tokens.view(np.uint64)))
            if len(at):
                fixed = [pa.array(batch.column(c).to_numpy()[row[at]]) for c in names[:4]]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(pos[at]), pa.array(tokens[at])], names=names)

    picked = rows.select("cls", "n", "n_rare", "reach", "prefix").mapInArrow(
        pick, "cls long, n long, n_rare long, reach long, pos long, token long")
    return (picked.filter("pos < n_rare").join(counts, "token")
            .unionByName(picked.filter("pos >= n_rare").withColumn("df", F.lit(0).cast("long")))
            .select("token", "cls", "n", "n_rare", "reach", "pos", "df").dropDuplicates(["cls", "token"]))


def groups(shared: DataFrame) -> DataFrame:
    """(gid, cls, n, n_rare, lo, hi, reach): the group of each class, with the bounds of its members' sizes and the least reach."""
    spread = F.pmod(F.xxhash64("token"), F.lit(1 << 20))
    weight = F.when(F.col("pos") >= F.col("n_rare"), F.lit(1 << 61) - F.col("pos") * (1 << 20) + spread).otherwise(
        F.least(F.col("df"), F.lit(1 << 39)) * (1 << 20) + spread)
    bucket = F.floor(F.log(F.col("n").cast("double")) / math.log(SIZE_STEP))
    own = (shared.withColumn("weight", weight).groupBy("cls", "n", "n_rare", "reach").agg(F.max_by("token", "weight").alias("key"))
           .withColumn("gid", F.xxhash64("key", bucket)).drop("key"))
    stats = own.groupBy("gid").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("reach").alias("least"))
    return own.drop("reach").join(stats, "gid").withColumnRenamed("least", "reach")


def candidates(signed: DataFrame, shared: DataFrame, grouped: DataFrame, rule: Likeness) -> DataFrame:
    """(cls, n, own, gid): which group a class may have a link into, by the token-group matrix; its own group included.

    A matrix row says that a group has a token in its members' prefixes. Rare tokens that a query has within the reach of every
    member, but not in common with the group, are in no member at all: they bound the overlap. For the own group only tokens
    of two members count. As a link goes both ways, a class meets another group only if some member of that one meets its own.
    """
    a, b = rule.above, rule.below
    rows = shared.select("token", "cls", "n", "n_rare", "pos").join(grouped.select("cls", "gid", "lo", "hi", "reach"), "cls")
    matrix = rows.groupBy("token", "gid").agg(F.max(F.col("n") - F.col("pos")).alias("rest"), F.min("n").alias("least"),
                                              F.count("*").alias("holders"), F.first("lo").alias("lo"), F.first("hi").alias("hi"),
                                              F.first("reach").alias("reach"))
    query = rows.select("token", "cls", "n", "n_rare", "pos", F.col("gid").alias("own"))

    def fits(overlap, smallest):  # (a + b) * overlap >= a * (n + size), the size being at least smallest and a / b of n
        return overlap * (a + b) * b >= (F.col("n") * b + F.greatest(smallest * b, F.col("n") * a)) * a

    within = (F.col("pos") < F.col("n_rare")) & (F.col("token") <= F.col("reach"))
    met = query.join(matrix, "token").filter(
        ((F.col("own") != F.col("gid")) | (F.col("holders") > 1))
        & (F.col("hi") * b >= F.col("n") * a) & (F.col("n") * b >= F.col("lo") * a))
    met = met.groupBy("cls", "n", "own", "gid", "lo", "reach").agg(
        F.max(fits(F.least(F.col("n") - F.col("pos"), F.col("rest")), F.col("least"))).alias("starts"),
        F.sum(within.cast("long")).alias("common"), F.max(F.when(within, F.col("pos") + 1).otherwise(0)).alias("looked_at"))
    met = met.filter("starts").filter(fits(F.col("n") - F.col("looked_at") + F.col("common"), F.col("lo")))
    cuts = signed.filter("prefix is not null").select("cls", "step", "cuts").dropDuplicates(["cls"])
    met = met.join(cuts, "cls").withColumn("looked_at", F.greatest(
        F.col("looked_at"), F.size(F.expr("filter(cuts, c -> c <= reach)")).cast("long") * F.col("step")))
    met = written(met.filter(fits(F.col("n") - F.col("looked_at") + F.col("common"), F.col("lo"))).select("cls", "n", "own", "gid"), "met")
    back = met.select(F.col("gid").alias("own"), F.col("own").alias("gid")).distinct()
    return met.join(back, ["own", "gid"], "left_semi")


def placed_in_blocks(grouped: DataFrame, met: DataFrame, rule: Likeness) -> DataFrame:
    """(gid, cls, n, n_rare, members, n_blocks, block) of the classes that may have a link."""
    live = grouped.join(met.select("cls").distinct(), "cls", "left_semi").select("gid", "cls", "n", "n_rare")
    stats = live.groupBy("gid").agg(F.count("*").alias("members"))
    n_blocks = F.ceil(F.col("members") / rule.block).cast("long")
    return live.join(stats, "gid").withColumn("n_blocks", n_blocks).withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("n_blocks")))


def leaders(placed: DataFrame, slots: int = 8) -> DataFrame:
    """(gid, cls, n_blocks): of each group with several blocks, in each of ``slots`` parts the member with fewest rare tokens."""
    share = F.col("n_rare") / F.col("n")
    order = F.floor((1 - share) * (1 << 20)) * (1 << 20) + F.pmod(F.xxhash64("cls", F.lit(3)), F.lit(1 << 20))
    return (placed.filter("n_blocks > 1").withColumn("slot", F.pmod(F.xxhash64("cls", F.lit(5)), F.lit(slots)))
            .withColumn("order", order).groupBy("gid", "slot", "n_blocks").agg(F.max_by("cls", "order").alias("cls"))
            .select("gid", "cls", "n_blocks"))


BLOOM_SHIFTS = (0, 11, 22, 37)


def needed_filter(hashes: DataFrame) -> np.ndarray:
    """Bloom filter of a column ``h`` of hashes as 64-bit words, at most ``BLOOM_WORDS`` of them."""
    n = hashes.count()
    size = 1 << min(BLOOM_WORDS.bit_length() - 1, max(4, (n * 16 // 64).bit_length()))
    places = F.array(*[F.struct(
        F.shiftrightunsigned("h", s).bitwiseAND(F.lit(size - 1)).alias("word"),
        F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {s + 21}) & 63 as int))").alias("mask")) for s in BLOOM_SHIFTS])
    words = hashes.select(F.explode(places).alias("p")).groupBy("p.word").agg(F.bit_or("p.mask").alias("mask"))
    rows, out = words.toArrow(), np.zeros(size, np.int64)  # at most ``size`` rows of a sketch
    out[rows.column("word").to_numpy()] = rows.column("mask").to_numpy()
    return out.view(np.uint64)


def may_hold(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    held = np.ones(len(hashes), bool)
    for s in BLOOM_SHIFTS:
        word = bloom[((hashes >> np.uint64(s)) & np.uint64(len(bloom) - 1)).astype(np.int64)]
        held &= (word >> ((hashes >> np.uint64(s + 21)) & np.uint64(63))) & np.uint64(1) == 1
    return held


def token_rows(docs: DataFrame, signed: DataFrame, classes: DataFrame, rule: Likeness) -> DataFrame:
    """(cls, tokens as bytes) of the given classes, each read from its document with the smallest id."""
    chosen = signed.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(classes, "cls", "left_semi")
    chosen = written(chosen.select("cls", F.xxhash64("doc_id").alias("h")), "chosen")
    carried = docs.sparkSession.sparkContext.broadcast(needed_filter(chosen))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.flatnonzero(may_hold(carried.value, batch.column(0).to_numpy().view(np.uint64)))
            part = batch.take(pa.array(held))
            hashes = part.column(0)
            kinds, bodies, rows, size = [], [], [], 0
            for row, tokens in token_sets(part.column(1), rule.words):
                kinds.append(_class(tokens))
                bodies.append(tokens.tobytes())
                rows.append(row)
                size += len(bodies[-1])
                if size > 1 << 24 or row + 1 == part.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [hashes.take(pa.array(rows)), pa.array(kinds, pa.int64()), pa.array(bodies, pa.binary())],
                        names=["h", "cls", "tokens"])
                    kinds, bodies, rows, size = [], [], [], 0

    found = docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(sets, "h long, cls long, tokens binary")
    return found.join(chosen, ["h", "cls"], "left_semi").select("cls", "tokens")


class Block:
    """Token sets of a block's members with the union of their tokens."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        self.classes = np.array([m[0] for m in members])
        self.roots = np.array([m[1] for m in members])
        self.sizes = np.array([len(m[2]) for m in members])
        tokens = np.concatenate([m[2] for m in members])
        owners = np.repeat(np.arange(len(members)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.owners = owners[order]
        self.union, self.first, self.count = np.unique(tokens[order], return_index=True, return_counts=True)
        self.least = int(self.sizes.min())

    def linked(self, tokens: np.ndarray, rule: Likeness, shared_by: int = 1) -> np.ndarray:
        """Members linked with a token set; the group stays closed when the union can't reach the overlap."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[(self.union[at] == tokens) & (self.count[at] >= shared_by)]
        n = len(tokens)
        if not rule.enough(len(at), n, max(self.least, -(-rule.above * n // rule.below))):
            return np.zeros(0, np.int64)
        counts = self.count[at]
        ends = np.cumsum(counts)
        place = np.repeat(self.first[at] - (ends - counts), counts) + np.arange(ends[-1])
        overlap = np.bincount(self.owners[place], minlength=len(self.sizes))
        return np.flatnonzero(rule.enough(overlap, n, self.sizes))


class Joined:
    """Parts joined in one task, by their roots."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(above, above)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def open_groups(rows: DataFrame, rule: Likeness, inside: bool) -> DataFrame:
    """Links (a, b) between roots that exact comparison finds in (gid, block, role, cls, root, tokens) rows.

    Role 0 are a block's members, role 1 its queries; ``inside`` also compares the members with each other.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members, block, parts, links = None, {}, None, Joined(), []

        def tie(a: int, b: int) -> None:
            if parts.join(a, b):
                links.append((a, b))

        def opened() -> Block | None:
            if not members:
                return None
            made = Block([(c, r, t) for c, (r, t) in members.items()])
            if inside and len(members) > 1:
                for i, (root, tokens) in enumerate(members.values()):
                    for j in made.linked(tokens, rule, 2):
                        if j > i:
                            tie(root, int(made.roots[j]))
            return made

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("gid", "block", "role", "cls", "root")]
            bodies = batch.column("tokens")
            for i, (gid, place, role, cls, root) in enumerate(zip(*columns)):
                if (gid, place) != cell:
                    if cell is not None and block is None:
                        opened()
                    cell, members, block, parts = (gid, place), {}, None, Joined()
                tokens = np.frombuffer(bodies[i].as_py(), np.uint64)
                if role == 0:
                    members[cls] = (root, tokens)
                    continue
                if block is None:
                    block = opened()
                    if block is None:
                        continue
                if cls in members:
                    continue
                for j in block.linked(tokens, rule):
                    if block.roots[j] != root:
                        tie(root, int(block.roots[j]))
            if len(links) > 10_000:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links], pa.schema([("a", pa.int64()), ("b", pa.int64())]))
                links.clear()
        if cell is not None and block is None:
            opened()
        if links:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links], pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    dealt = rows.repartition("gid", "block").sortWithinPartitions("gid", "block", "role")
    return dealt.select("gid", "block", "role", "cls", "root", "tokens").mapInArrow(compare, "a long, b long")


def links(docs: DataFrame, signed: DataFrame, rule: Likeness) -> DataFrame:
    """(node, root) of all classes that have a link to another one."""
    shared = written(shared_tokens(signed), "shared")
    grouped = written(groups(shared), "groups")
    met = written(candidates(signed, shared, grouped, rule), "candidates")
    placed = written(placed_in_blocks(grouped, met, rule), "blocks")
    lead = written(leaders(placed), "leaders")
    counts = placed.select("gid", "n_blocks").distinct()
    met = (met.filter("own != gid").join(counts, "gid")
           .join(counts.select(F.col("gid").alias("own"), F.col("n_blocks").alias("own_blocks")), "own"))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block")

    # First round: each block with its leaders, and queries of other groups.
    queries = (met.filter("n_blocks > 1 or own_blocks > 1 or own < gid").filter("n_blocks = 1 or own_blocks > 1")
               .select("gid", F.pmod(F.xxhash64("cls"), F.col("n_blocks")).alias("block"), "cls").withColumn("role", F.lit(1)))
    alive = placed.filter("members > 1").select("gid").unionByName(queries.select("gid")).distinct()
    members = (placed.join(alive, "gid", "left_semi").select("gid", "block", "cls")
               .unionByName(lead.select("gid", blocks, "cls")).distinct().withColumn("role", F.lit(0)))
    rows = members.unionByName(queries)
    tokens = token_rows(docs, signed, rows.select("cls").distinct(), rule)
    first = open_groups(rows.join(tokens, "cls").withColumn("root", F.col("cls")), rule, inside=True)
    labels = components(first)

    # Second round: what did not join its group's main part visits the group's other blocks.
    large = placed.filter("n_blocks > 1")
    if large.isEmpty():
        return labels
    labels = written(labels, "labels")
    rooted = written(large.join(labels, large["cls"] == labels["node"], "left")
                     .select("gid", "block", "cls", "n_blocks", F.coalesce("root", "cls").alias("root")), "rooted")
    main = (rooted.groupBy("gid", "root").agg(F.count("*").alias("k")).groupBy("gid")
            .agg(F.max_by("root", F.struct("k", "root")).alias("main")))
    stray = (rooted.join(main, "gid").filter("root != main").select("gid", "cls", "root", F.col("block").alias("home"), blocks)
             .filter("block != home").drop("home"))
    own = rooted.select("cls", "root").distinct()
    cross = (met.filter("n_blocks > 1 and own_blocks > 1").join(own, "cls").join(main, "gid")
             .join(main.select(F.col("gid").alias("own"), F.col("main").alias("own_main")), "own")
             .filter("root != main or root != own_main").select("gid", "cls", "root", blocks))
    queries = stray.unionByName(cross).withColumn("role", F.lit(1))
    queries = written(queries, "strays")
    if queries.isEmpty():
        return labels
    members = (rooted.join(queries.select("gid", "block").distinct(), ["gid", "block"], "left_semi")
               .select("gid", "block", "cls", "root").withColumn("role", F.lit(0)))
    rows = members.unionByName(queries.select(*members.columns))
    tokens = token_rows(docs, signed, rows.select("cls").distinct(), rule)
    second = open_groups(rows.join(tokens, "cls"), rule, inside=False)
    return components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second))


def near_duplicates(docs: DataFrame, rule: Likeness = Likeness(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs``."""
    docs = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = written(signatures(docs, frequent_tokens(docs, rule), rule), "signatures")
    labels = written(links(docs, signed, rule), "classes")
    full = signed.filter("n > 0").select("doc_id", "cls", "n")
    placed = (full.join(labels, full["cls"] == labels["node"], "left")
              .select("doc_id", "n", F.coalesce("root", "cls").alias("root")))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (placed.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(signed.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def drop_near_duplicates(docs: DataFrame, rule: Likeness = Likeness(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` less those that are not the smallest id of their component."""
    extra = near_duplicates(docs, rule, doc, text).filter("doc_id != component_id").select(F.col("doc_id").alias("extra_doc"))
    return docs.join(extra.distinct(), F.col(f"`{doc}`").cast("long") == F.col("extra_doc"), "left_anti")
