"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes, cut to ``bits`` bits, of its words, its pairs of neighbours and its pairs with one
word left out (case and the marks around a word do not matter); a word also counts by its first 5 and first 7 bytes, as
inflected languages have more forms of a word than the labelled rows show. A feature counts once however often it occurs, so a long text
is judged as a short one is. Each coordinate has its own learning rate, and the L1 penalty keeps the weights of features
that tell little at exactly zero: what remains is a small table that is broadcast, at most ``2^bits`` entries.

Learning: at most ``max_rows`` labelled documents (a documented bound: the rows with the smallest hash of their id), dealt to
one learner per ``rows_per_learner`` of them. Every learner makes ``epochs`` passes over its own rows; the learners' weights are
averaged. Scoring covers all rows.

Defined cases. Null and empty texts have no feature and get the score of the bias alone. Rows without label or id do not teach.
An id labelled more than once teaches once, as 1 if any of its labels is. Without any usable label all scores are 0.
Columns named like the ones added (``score``, ``predicted``) are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm import text as tx
from fareflow.llm.store import without, written

STEMS = (5, 7)
_LETTER = np.ones(256, bool)
_LETTER[:128] = [chr(i).isalnum() for i in range(128)]


@dataclass(frozen=True)
class Ftrl:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0
    epochs: int = 4
    max_rows: int = 40_000
    rows_per_learner: int = 5_000


def features(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashed feature of each place) of each text, repeats included."""
    keep = np.uint64((1 << bits) - 1)
    for first, end, data, starts in tx.chunks(column):
        plain = np.where(_LETTER[data], data, np.uint8(32))  # marks part words
        found = tx.words(plain, starts, STEMS)
        h = found.hashes
        pairs = tx.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
        skips = tx.mix(h[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:])
        one, two, three, *stems = ((x & keep).astype(np.int32) for x in (h, pairs, skips, *found.stems))
        for i in range(end - first):
            a, b = int(found.bounds[i]), int(found.bounds[i + 1])
            yield first + i, np.concatenate(
                [one[a:b], two[a:max(a, b - 1)], three[a:max(a, b - 2)], *(s[a:b] for s in stems)])


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, model: Ftrl) -> np.ndarray:
    """Weights after FTRL-proximal passes over distinct feature lists; the last weight is the bias."""
    size = (1 << model.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        l1 = np.where(at == size - 1, 0.0, model.l1)  # the bias is not penalised
        w = -(zi - np.sign(zi) * l1) / ((model.beta + np.sqrt(n[at])) / model.alpha + model.l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(model.epochs):
        for i in order.permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[i]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / model.alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(size))


def fit(docs: DataFrame, labels: DataFrame, model: Ftrl = Ftrl(), label: str = "toxic", doc: str = "doc_id",
        text: str = "text") -> DataFrame:
    """(feature, weight) of non-zero weights; feature 2^bits is the bias."""
    known = (labels.select(F.col(doc).alias("id"), F.col(label).alias("label"))
             .filter("id is not null and label is not null")
             .groupBy("id").agg(F.max(F.col("label").cast("int")).alias("label")))
    total = known.count()
    order = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    if total > model.max_rows:
        cut = most_at(known, order, model.max_rows)
        known = known.filter(order < cut)
    learners = max(1, min(total, model.max_rows) // model.rows_per_learner)
    # at most max_rows rows of 12 bytes: a proven bound
    taught = (docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
              .withColumn("learner", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(learners)).cast("int"))
              .repartition(learners, "learner").sortWithinPartitions("learner", "id", "text"))
    bits = model.bits

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_learner: dict[int, tuple[list, list]] = {}
        for batch in batches:
            who, mark = batch.column("learner").to_numpy(), batch.column("label").to_numpy()
            for row, found in features(batch.column("text"), bits):
                rows, marks = by_learner.setdefault(int(who[row]), ([], []))
                rows.append(np.append(np.unique(found), np.int32(1 << bits)))
                marks.append(mark[row])
        for rows, marks in by_learner.values():
            w = fit_rows(rows, np.array(marks, float), model)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at])], names=["feature", "weight"])

    parts = written(taught.select("learner", "label", "text").mapInArrow(learn, "feature long, weight double"), "weights")
    return parts.groupBy("feature").agg((F.sum("weight") / learners).alias("weight"))


def most_at(rows: DataFrame, order: Column, limit: int) -> int:
    """Smallest hash value that cuts ``rows`` to at most ``limit``, found from 4,096 equal ranges."""
    width = (1 << 30) // 4096
    counts = {r["cell"]: r["n"] for r in rows.groupBy(F.floor(order / width).alias("cell")).agg(F.count("*").alias("n"))
              .collect()}
    total = 0
    for cell in range(4096):
        total += counts.get(cell, 0)
        if total > limit:
            return cell * width
    return 1 << 30


def score(docs: DataFrame, weights: DataFrame, bits: int = Ftrl.bits, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5)."""
    docs = without(docs, "score", "predicted")
    table = np.zeros((1 << bits) + 1, np.float32)
    for row in weights.collect():  # at most 2^bits + 1 by construction
        table[row["feature"]] = row["weight"]
    if not table.any():
        return docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    at = np.flatnonzero(table).astype(np.int32)  # only what is not zero travels
    sent = docs.sparkSession.sparkContext.broadcast((at, table[at]))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    where = docs.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values = sent.value
        w = np.zeros((1 << bits) + 1, np.float32)
        w[places] = values
        tells = w != 0
        bias = float(w[-1])
        for batch in batches:
            total = np.full(batch.num_rows, bias)
            for row, found in features(batch.column(where), bits):
                found = found[tells[found]]
                if len(found):
                    total[row] += float(w[np.unique(found)].sum())
            p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=schema.names)
    return docs.mapInArrow(judge, schema)


def drop_toxic(docs: DataFrame, weights: DataFrame, bits: int = Ftrl.bits, text: str = "text") -> DataFrame:
    """``docs`` less the texts predicted toxic."""
    return score(docs, weights, bits, text).filter("predicted = 0").select(*[F.col(f"`{c}`") for c in without(
        docs, "score", "predicted").columns])
