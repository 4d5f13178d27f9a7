"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

``LineIndex`` keeps three tables below one folder:

* ``references``: one row per line key and document that holds it, with the step that inserted it; deletions are rows
  of their own (``deletions``) and take effect on references of earlier steps.
* ``repeated``: the exact reference counts of the keys found in at least ``min_docs`` documents, with the largest
  document that holds each.
* ``filters``: one cuckoo filter per shard over the keys of ``repeated``. A key that reaches ``min_docs`` is inserted, a
  key that falls below is deleted from its filter, which a Bloom filter could not do.

``clean`` probes the filters while it scans the texts, so only lines that may be repeated (and about one in 8,000
others) are shuffled to the exact table, which then decides. Filters are broadcast only while their total is below
``broadcast_bytes``; beyond it, all lines are joined with the exact table, with the same result.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased, as a 128-bit hash. Keys
shorter than ``min_chars`` code points never count.

Defined cases. A null or empty text is one empty line and comes back as an empty text. Rows of one document id count as one
document, and each comes back. A row without id is not referenced and keeps all its lines. Columns named like the ones added
(``n_lines``, ``n_dropped``, ``kept``) are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.store import folder, without

SPACE = b" \t\n\x0b\x0c\r"
SLOTS = 4
FILTER_SCHEMA = "shard int, buckets binary, n_keys long"


class CuckooFilter:
    """Four 16-bit fingerprints a bucket; keys are uint64 hashes."""

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets
        self.mask = np.uint64(len(buckets) - 1)

    @classmethod
    def sized(cls, n_keys: int) -> CuckooFilter:
        size = 1
        while size * SLOTS * 0.85 < n_keys + 4:
            size *= 2
        return cls(np.zeros((size, SLOTS), np.uint16))

    @classmethod
    def loaded(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint64)
        first = keys & self.mask
        return prints.astype(np.uint16), first, self.other(first, prints)

    def other(self, place: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (place ^ (prints * np.uint64(0x5BD1E995) >> np.uint64(3))) & self.mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        return ((self.buckets[first] == prints[:, None]) | (self.buckets[second] == prints[:, None])).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False when the filter is too full; it must then be built anew from the exact table."""
        prints, first, second = self.places(keys)
        for mark, a, b in zip(prints, first, second):
            if not self._put(mark, int(a)) and not self._put(mark, int(b)) and not self._move(mark, int(b)):
                return False
        return True

    def _put(self, mark: np.uint16, place: int) -> bool:
        row = self.buckets[place]
        for slot in range(SLOTS):
            if row[slot] == 0:
                row[slot] = mark
                return True
        return False

    def _move(self, mark: np.uint16, place: int) -> bool:
        for turn in range(500):
            slot = turn % SLOTS
            mark, self.buckets[place][slot] = self.buckets[place][slot], mark
            place = int(self.other(np.uint64(place), np.uint64(mark)))
            if self._put(mark, place):
                return True
        return False

    def delete(self, keys: np.ndarray) -> None:
        prints, first, second = self.places(keys)
        for mark, a, b in zip(prints, first, second):
            for place in (int(a), int(b)):
                found = np.flatnonzero(self.buckets[place] == mark)
                if len(found):
                    self.buckets[place][found[0]] = 0
                    break


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a lower-cased line's key; None when the key is too short."""
    key = line.strip(SPACE)
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def text_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    return [line_key(line, min_chars) for line in (text or "").encode().lower().split(b"\n")]


def _halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


def line_keys(docs: DataFrame, min_chars: int, filters=None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct (doc_id, k1, k2) of each text; with ``filters`` (a broadcast list by shard), only keys they may hold."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = filters and [data and CuckooFilter.loaded(data) for data in filters.value]
        for batch in batches:
            ids, found = [], []
            for row, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine = {k for k in text_keys(body.as_py(), min_chars) if k}
                found.extend(mine)
                ids.extend([row] * len(mine))
            if not found:
                continue
            pair, ids = _halves(found), np.array(ids, np.int64)
            if shards:
                held = np.zeros(len(pair), bool)
                shard = pair[:, 0].view(np.int64) % len(shards)
                for i, one in enumerate(shards):
                    at = np.flatnonzero(shard == i)
                    if one and len(at):
                        held[at] = one.contains(pair[at, 1])
                pair, ids = pair[held], ids[held]
            signed = pair.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(signed[:, 0].copy()), pa.array(signed[:, 1].copy())],
                                             names=["doc_id", "k1", "k2"])
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    return source.mapInArrow(keys, "doc_id long, k1 long, k2 long")


class LineIndex:
    """Lines of the documents inserted so far and not deleted."""

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = 32, min_chars: int = 20,
                 min_docs: int = 3, broadcast_bytes: int = 1 << 27):
        self.spark, self.path, self.shards = spark, path or folder(spark, "lines"), shards
        self.min_chars, self.min_docs, self.broadcast_bytes = min_chars, min_docs, broadcast_bytes
        self.step = 0
        self.inserted: list[str] = []
        self.deleted: list[str] = []
        self.repeated_path: str | None = None
        self.filter_path: str | None = None

    # --- tables

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def references(self) -> DataFrame:
        """Live (k1, k2, doc_id, step)."""
        rows = self._read(self.inserted, "doc_id long, k1 long, k2 long, step int")
        if not self.deleted:
            return rows
        gone = self._read(self.deleted, "gone_id long, gone_step int").groupBy("gone_id").agg(
            F.max("gone_step").alias("gone_step"))
        return rows.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("step") < F.col("gone_step")), "left_anti")

    def repeated(self) -> DataFrame:
        paths = [self.repeated_path] if self.repeated_path else []
        return self._read(paths, "k1 long, k2 long, n_docs long, top_doc long")

    def filters(self) -> DataFrame:
        return self._read([self.filter_path] if self.filter_path else [], FILTER_SCHEMA)

    def _shard(self):
        return F.pmod(F.col("k1"), F.lit(self.shards)).cast("int")

    # --- changes

    def insert(self, docs: DataFrame, doc: str = "doc_id", text: str = "text") -> None:
        """Add the lines of documents; inserting a document twice changes nothing."""
        self.step += 1
        path = f"{self.path}/references-{self.step}"
        line_keys(docs, self.min_chars, doc=doc, text=text).withColumn("step", F.lit(self.step)).write.parquet(path)
        first = not self.inserted
        self.inserted.append(path)
        touched = None if first else self._read([path], "k1 long, k2 long").distinct()
        self._recount(touched)

    def delete(self, doc_ids: DataFrame, doc: str = "doc_id") -> None:
        """Take documents back: their references go, and lines held by too few documents are no longer repeated."""
        before = self.references()
        self.step += 1
        ids = doc_ids.select(F.col(doc).cast("long").alias("gone_id")).distinct()
        path = f"{self.path}/deletions-{self.step}"
        ids.withColumn("gone_step", F.lit(self.step)).write.parquet(path)
        gone = self._read([path], "gone_id long")
        touched = before.join(gone, F.col("doc_id") == F.col("gone_id"), "left_semi").select("k1", "k2").distinct()
        self.deleted.append(path)
        self._recount(touched)

    def _recount(self, touched: DataFrame | None) -> None:
        """Exact counts of the touched keys, then the same changes to the filters."""
        live = self.references().select("k1", "k2", "doc_id")
        if touched is not None:
            live = live.join(touched, ["k1", "k2"], "left_semi")
        counts = (live.distinct().groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top_doc"))
                  .filter(F.col("n_docs") >= self.min_docs))
        old = self.repeated()
        new = counts if touched is None else old.join(touched, ["k1", "k2"], "left_anti").unionByName(counts)
        path = f"{self.path}/repeated-{self.step}"
        new.write.parquet(path)
        self.repeated_path = path
        now = self.repeated()
        changes = (now.join(old, ["k1", "k2"], "left_anti").select("k1", "k2", F.lit(1).alias("change"))
                   .unionByName(old.join(now, ["k1", "k2"], "left_anti").select("k1", "k2", F.lit(-1).alias("change"))))
        self._update_filters(changes)

    def _update_filters(self, changes: DataFrame) -> None:
        def update(key, kept: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
            keys = moved["k2"].to_numpy(np.int64).view(np.uint64)
            add, drop = keys[moved["change"].to_numpy() > 0], keys[moved["change"].to_numpy() < 0]
            n = (int(kept["n_keys"].iloc[0]) if len(kept) else 0) + len(add) - len(drop)
            one = CuckooFilter.loaded(kept["buckets"].iloc[0]) if len(kept) else CuckooFilter.sized(2 * n)
            one.delete(drop)
            fits = one.insert(add)
            data = one.buckets.tobytes() if fits else None
            return pd.DataFrame({"shard": [key[0]], "buckets": [data], "n_keys": [n]})

        def rebuild(key, rows: pd.DataFrame) -> pd.DataFrame:
            keys, room = rows["k2"].to_numpy(np.int64).view(np.uint64), 2
            one = CuckooFilter.sized(room * len(keys))
            while not one.insert(keys):
                room *= 2
                one = CuckooFilter.sized(room * len(keys))
            return pd.DataFrame({"shard": [key[0]], "buckets": [one.buckets.tobytes()], "n_keys": [len(keys)]})

        path = f"{self.path}/filters-{self.step}"
        moved = changes.withColumn("shard", self._shard())
        out = self.filters().groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(update, FILTER_SCHEMA)
        out.write.parquet(path)
        full = [r["shard"] for r in self._read([path], FILTER_SCHEMA).filter("buckets is null").select("shard").collect()]
        if full:  # at most one row per shard
            anew = (self.repeated().withColumn("shard", self._shard()).filter(F.col("shard").isin(full))
                    .groupBy("shard").applyInPandas(rebuild, FILTER_SCHEMA))
            kept = self._read([path], FILTER_SCHEMA).filter("buckets is not null")
            kept.unionByName(anew).write.parquet(path := f"{path}-rebuilt")
        self.filter_path = path

    # --- use

    def _probe(self):
        """Filters by shard as a broadcast, or None when they are too large for one."""
        sizes = self.filters().agg(F.sum(F.length("buckets")).alias("bytes")).first()["bytes"] or 0
        if sizes > self.broadcast_bytes:
            return None
        by_shard = {r["shard"]: bytes(r["buckets"]) for r in self.filters().collect()}
        return self.spark.sparkContext.broadcast([by_shard.get(i) for i in range(self.shards)])

    def clean(self, docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs`` with ``kept`` (the text without repeated lines, but for each line's largest document), ``n_lines``
        and ``n_dropped``."""
        docs = without(docs, "n_lines", "n_dropped", "kept", "dropped_keys", "dropped_doc")
        lines = line_keys(docs, self.min_chars, self._probe(), doc, text).distinct()
        drops = (lines.join(self.repeated(), ["k1", "k2"]).filter(F.col("doc_id") != F.col("top_doc"))
                 .groupBy(F.col("doc_id").alias("dropped_doc"))
                 .agg(F.collect_set(F.struct("k1", "k2")).alias("dropped_keys")))
        joined = docs.join(drops, F.col(f"`{doc}`").cast("long") == F.col("dropped_doc"), "left")
        joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns],
                               F.col("dropped_keys.k1").alias("dropped_k1"), F.col("dropped_keys.k2").alias("dropped_k2"))
        schema = T.StructType([*docs.schema.fields, T.StructField("kept", T.StringType()),
                               T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
        min_chars, at = self.min_chars, docs.columns.index(text)

        def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept, n_lines, n_dropped = [], [], []
                width = batch.num_columns - 2
                for body, k1, k2 in zip(batch.column(at), batch.column(width), batch.column(width + 1)):
                    body = body.as_py() or ""
                    n = body.count("\n") + 1
                    n_lines.append(n)
                    if not k1.is_valid:
                        kept.append(body)
                        n_dropped.append(0)
                        continue
                    gone = {a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True)
                            for a, b in zip(k1.as_py(), k2.as_py())}
                    stay = [line for line, key in zip(body.split("\n"), text_keys(body, min_chars)) if key not in gone]
                    kept.append("\n".join(stay))
                    n_dropped.append(n - len(stay))
                columns = [batch.column(i) for i in range(width)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    names=schema.names)
        return joined.mapInArrow(strip, schema)


def dedup_lines(spark: SparkSession, docs: DataFrame, min_chars: int = 20, min_docs: int = 3, **index) -> DataFrame:
    """``LineIndex.clean`` of a table against its own lines."""
    lines = LineIndex(spark, min_chars=min_chars, min_docs=min_docs, **index)
    lines.insert(docs)
    return lines.clean(docs)
