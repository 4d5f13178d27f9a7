"""Written stages below the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import shared_dir


def folder(spark: SparkSession, name: str) -> str:
    """A new path for one table of one run."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex[:12]}-{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: cuts lineage, survives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less columns whose names, in any case, an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def most_frequent(counts: DataFrame, limit: int, count: str = "n") -> DataFrame:
    """At most ``limit`` rows of ``counts``: all rows whose count is above a threshold that is found from a histogram.

    Counts are cut to powers of 2^(1/8), so the histogram has at most some 500 rows at any size. A tie that would
    exceed the limit stays out as a whole.
    """
    step = F.floor(F.log2(F.col(count)) * 8)
    histogram = sorted(
        ((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()),
        reverse=True)
    total, lowest = 0, None
    for level, n in histogram:
        total += n
        if total > limit:
            break
        lowest = level
    return counts.filter(F.lit(False)) if lowest is None else counts.filter(step >= lowest)
