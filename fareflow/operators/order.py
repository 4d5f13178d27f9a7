"""Order statistics and running numbers over range partitions, so no task holds a whole key or all distinct values.

Rows are written once in range partitions of their order, each with its partition's number. What a row needs to know of all
rows before it are the totals of the partitions before its own, one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.sources.sinks import staged

PART = "_part"


def in_ranges(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` written in range partitions of ``order``, with the number of each row's partition as ``_part``."""
    return staged(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), name)


def sum_before(total: str, *keys: str) -> Column:
    """Sum over the partitions before this one; one row per partition, or per key and partition."""
    window = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(window), F.lit(0))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float], name: str = "value-counts") -> DataFrame:
    """(share, value): the exact quantiles of a column's known values, interpolated linearly; null without any.

    Values are counted, the counts written in ranges of the value. The rank of a quantile tells its range by the ranges' totals,
    and only the at most two ranges that hold its neighbours are numbered through.
    """
    counts = df.select(F.col(column).alias("value")).filter("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ranged = in_ranges(counts, ["value"], name)
    ranges = ranged.groupBy(PART).agg(F.sum("n").alias("n")).withColumns({
        "before": sum_before("n"), "total": F.sum("n").over(Window.partitionBy())})  # one row per partition
    asked = ranges.select(PART, "n", "before", "total", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    asked = asked.withColumn("position", F.col("share") * (F.col("total") - 1))
    neighbours = F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))).alias("rank")
    held = asked.select(PART, "n", "before", "share", "position", neighbours).filter(
        "rank >= before AND rank < before + n").drop("n")  # two rows a share at most
    up_to = F.sum("n").over(Window.partitionBy(PART, "share", "rank").orderBy("value"))
    found = ranged.join(held, PART).withColumn("upto", F.col("before") + up_to).filter("rank < upto AND rank >= upto - n")
    pairs = found.groupBy("share", "position").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    part = F.col("position") - F.floor("position")
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") * (1 - part) + F.col("high") * part)
    wanted = df.sparkSession.createDataFrame([(float(s),) for s in shares], "share double")
    return wanted.join(pairs.select("share", value.cast("double").alias("value")), "share", "left")


def quantile(df: DataFrame, column: str, share: float) -> Column:
    """One exact quantile as a scalar."""
    return exact_quantiles(df, column, [share]).select("value").scalar()


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str, name: str = "ordered") -> DataFrame:
    """1, 2, 3, ... per key in ``order``, which should end in a unique column; null keys are a key of their own.

    Rows are numbered within their range partition; a key that spans several of them gets the counts of the earlier ones added.
    """
    ranged = in_ranges(df, [*keys, *order], name)
    counts = ranged.groupBy(*keys, PART).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_offset", sum_before("_n", *keys)).select(*[F.col(k).alias(f"_{k}") for k in (*keys, PART)], "_offset")
    same = F.lit(True)
    for k in (*keys, PART):
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    within = F.row_number().over(Window.partitionBy(PART, *keys).orderBy(*order))
    return ranged.withColumn("_rank", within).join(offsets, same).withColumn(
        into, (F.col("_rank") + F.col("_offset")).cast("int")).select(*df.columns, into)
