"""Conflict-constrained best-fit packing of documents into sequences of fixed length.

Documents are taken from long to short. Open bins are ordered by residual; the search for a place starts at the successor of
the document's length, the tightest bin that could hold it, and goes on to larger residuals until a bin is found whose
source and duplicate-cluster bitmaps do not hold the document's bits. If there is none, a bin is opened. So within
a bin no two pieces share a source, and none a duplicate cluster.

A document longer than a bin gives full bins of its own and one rest, which is packed like any other document.

Distribution: only ids, lengths, sources and clusters are shuffled, never texts. Rows are dealt by hash into shards of about
``rows_per_shard``, each packed by itself; bins are numbered by shard. A shard's work is bounded at any table size, and a
source with a third of all rows is spread over all shards.

Defined cases. Null and empty texts have no token and stand in no bin (``bin_id`` null, piece 0). A null source or cluster never
conflicts. Rows that repeat an id are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, piece int, n_tokens long, bin_id string, position long"


class Bins:
    """Open bins of one shard."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, bin), ascending
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and first position of a piece; ``source`` and ``cluster`` are bitmaps of at most one bit."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, one = self.order[at]
            if not self.sources[one] & source and not self.clusters[one] & cluster:
                del self.order[at]
                return self._fill(one, residual, size, source, cluster)
            at += 1
        self.sources.append(0)
        self.clusters.append(0)
        return self._fill(len(self.sources) - 1, self.capacity, size, source, cluster)

    def _fill(self, one: int, residual: int, size: int, source: int, cluster: int) -> tuple[int, int]:
        self.sources[one] |= source
        self.clusters[one] |= cluster
        if residual > size:
            insort(self.order, (residual - size, one))
        return one, self.capacity - residual


def pack_shard(rows: list[tuple], capacity: int) -> Iterator[tuple]:
    """(doc_id, piece, n_tokens, bin, position) of (doc_id, n_tokens, source, cluster) rows."""
    bins, full = Bins(capacity), 0
    bits: dict = {}
    repeated = Counter(r[3] for r in rows if r[3] is not None)  # a cluster met once can't conflict
    pieces = []
    for doc, n, source, cluster in rows:
        whole, rest = divmod(n, capacity)
        for piece in range(whole):
            yield doc, piece, capacity, f"full{full}", 0
            full += 1
        if rest:
            pieces.append((-rest, doc is None, doc or 0, whole, source, cluster))
    pieces.sort(key=lambda p: (*p[:4], p[4] or "", str(p[5])))
    for size, missing, doc, piece, source, cluster in pieces:
        s = 1 << bits.setdefault(("s", source), len(bits)) if source is not None else 0
        c = 1 << bits.setdefault(("c", cluster), len(bits)) if repeated[cluster] > 1 else 0
        one, position = bins.place(-size, s, c)
        yield None if missing else doc, piece, -size, str(one), position


def pack(docs: DataFrame, capacity: int = 2048, rows_per_shard: int = 4000, doc: str = "doc_id", length: Column | None = None,
         source: str = "source", cluster: Column | None = None, text: str = "text") -> DataFrame:
    """doc_id, piece, n_tokens, bin_id and position (first token in the bin) of every piece.

    ``length`` defaults to the text's words, ``cluster`` to its words' hash, so exact copies conflict.
    """
    flat = F.trim(F.regexp_replace(F.col(f"`{text}`"), r"[\x20\x09-\x0D]+", " "))
    words = F.length(flat) - F.length(F.replace(flat, F.lit(" "))) + (F.length(flat) > 0).cast("int")
    rows = docs.select(
        F.col(f"`{doc}`").cast("long").alias("doc_id"),
        F.coalesce(length if length is not None else words, F.lit(0)).cast("long").alias("n_tokens"),
        F.col(f"`{source}`").cast("string").alias("source"),
        (cluster if cluster is not None else F.xxhash64(F.lower(flat))).cast("string").alias("cluster"))
    rows = rows.withColumn("part", F.spark_partition_id())  # rows that repeat an id go to different shards, too
    empty = rows.filter("n_tokens <= 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("n_tokens"),
                                                 F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("long").alias("position"))
    full = rows.filter("n_tokens > 0")
    shards = max(1, -(-docs.count() // rows_per_shard))
    dealt = (full.withColumn("shard", F.pmod(F.xxhash64("doc_id", "n_tokens", "source", "cluster", "part"), F.lit(shards)))
             .repartition(shards, "shard").sortWithinPartitions("shard", "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(shard, rows):
            out = list(pack_shard(rows, capacity))
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                 pa.array([f"{shard}-{b}" for b in columns[3]], pa.string()), pa.array(columns[4], pa.int64())],
                names=["doc_id", "piece", "n_tokens", "bin_id", "position"])
        now, rows = None, []
        for batch in batches:
            for shard, *row in zip(*(batch.column(n).to_pylist() for n in ("shard", "doc_id", "n_tokens", "source", "cluster"))):
                if shard != now and rows:
                    yield packed(now, rows)
                    rows = []
                now = shard
                rows.append(tuple(row))
        if rows:
            yield packed(now, rows)
    return dealt.mapInArrow(run, SCHEMA).unionByName(empty)
