"""Keyed picks as map-side combinable aggregates, so a hot key never lands whole in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.operators.order import quantile
from fareflow.sources.sinks import staged


def repeat_groups(df: DataFrame, keys: Sequence[str], order: str, named: dict[str, Column] | None = None) -> DataFrame:
    """Keys seen more than once, with the first ``order`` value of each.

    Almost all keys occur once, so they are first counted by a 64-bit hash, a hash aggregate over longs. Only rows whose
    hash repeats reach the exact aggregate, whose minimum of texts needs a sort. ``named`` replaces the keys by others made
    of them, which are then computed for these rows only.
    """
    hashed = df.select(*keys, order, F.xxhash64(*keys).alias("_hash"))
    often = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    again = hashed.join(often, "_hash", "left_semi")
    if named is not None:
        again, keys = again.select(*[v.alias(k) for k, v in named.items()], order), list(named)
    return (
        again.groupBy(*keys)
        .agg(F.min(order).alias("first_record"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )


def mark_repeats(df: DataFrame, groups: DataFrame, keys: Sequence[str], order: str, into: str = "is_repeat") -> DataFrame:
    """Flag every row of a repeated key but its first. ``order`` must be unique per row.

    A left join: adaptive execution turns it into a broadcast join when the
    repeated keys are few and splits a skewed key otherwise.
    """
    later = F.coalesce(F.col(order) > F.col("first_record"), F.lit(False))
    return df.join(groups, list(keys), "left").withColumn(into, later).drop("first_record")


def record_hashes(keys: Sequence[str], order: str) -> dict[str, Column]:
    """128 bits that tell a row by its keys and its ``order`` value."""
    told = [F.col(n) for n in (*keys, order)]
    return {"_row_hash": F.xxhash64(*told), "_row_hash2": F.xxhash64(F.lit("record"), *told)}


def later_copies(df: DataFrame, keys: Sequence[str], order: str, named: dict[str, Column] | None = None) -> DataFrame:
    """``record_hashes`` of all rows of a repeated key but its first, as ``repeat_groups`` and ``mark_repeats`` tell them.

    Hashes that repeat are written first: Spark then knows their size and, if small, the texts of the keys are filtered
    where they are instead of being shuffled. Rows with a null in a key or without an ``order`` value are nobody's copies.
    """
    hashed = df.select(*keys, order, F.xxhash64(*keys).alias("_hash"))
    often = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    again = hashed.join(staged(often, "repeated-hashes"), "_hash", "left_semi")
    if named is not None:
        again, keys = again.select(*[v.alias(k) for k, v in named.items()], order), list(named)
    again = staged(again.select(*keys, order), "repeated-keys")
    firsts = again.groupBy(*keys).agg(F.min(order).alias("first_record"))
    later = again.join(firsts, list(keys)).filter(F.col(order) > F.col("first_record"))
    return later.select(*[v.alias(n) for n, v in record_hashes(keys, order).items()]).distinct()


def mark_copies(df: DataFrame, later: DataFrame, keys: Sequence[str], order: str, into: str = "is_repeat") -> DataFrame:
    """``mark_repeats`` from written ``later_copies``: two longs a copy, so the wide rows stay where they are much longer, and
    where they must move no hot key gathers them."""
    hashes = record_hashes(keys, order)
    marked = df.withColumns(hashes).join(later.withColumn(into, F.lit(True)), list(hashes), "left")
    return marked.withColumn(into, F.coalesce(F.col(into), F.lit(False))).drop(*hashes)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], newest: bool = True) -> DataFrame:
    """One row per key: the newest (or oldest) by ``order``, nulls losing.

    ``order`` should end in a unique column. Null keys form a group of their own.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = (F.max_by if newest else F.min_by)(F.struct(*rest), rank)
    return df.groupBy(*keys).agg(picked.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Top-k report; Spark keeps k rows per task and merges them."""
    return df.orderBy(*order).limit(n)


def at_least_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Keep rows whose value reaches the exact q-quantile (linear interpolation)."""
    return df.filter(F.col(column) >= quantile(df, column, q))


def weighted_mean(value: str, weight: str) -> Column:
    """Sum of value times weight over the sum of all weights (null values keep their weight)."""
    total = F.sum(weight)
    return F.when(total > 0, F.coalesce(F.sum(F.col(value) * F.col(weight)), F.lit(0.0)) / total)
