"""Writers: curated splits, facts, datasets, event logs and the file registry."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.session import shared_dir

PERIOD = ("source_year", "source_month")
OUTCOME = "outcome"
FACT_PARTITIONS = ("service_type", *PERIOD)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a written copy in the shared folder: computed once, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/fareflow/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _evened(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a partition meet in few tasks; a large partition is split, small ones share a task."""
    return df.hint("rebalance", *keys) if keys else df


def write_partitions(df: DataFrame, path: str, keys: Sequence[str] = FACT_PARTITIONS) -> None:
    """Replace just the partitions present in ``df`` (the whole table without partition columns)."""
    writer = _evened(df, keys).write.mode("overwrite").option("compression", "snappy")
    if keys:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    writer.parquet(path)


def write_fact(df: DataFrame, path: str, keys: Sequence[str] = FACT_PARTITIONS) -> None:
    """One fact, by service and period; an empty input is an error, not an empty fact."""
    if df.isEmpty():
        raise ValueError(f"nothing to write to {path}")
    write_partitions(df, path, keys)


def write_dataset(df: DataFrame, path: str) -> None:
    """Full overwrite of a dimension, mart or feature table."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_split(flagged: DataFrame, root: str, keys: Sequence[str] = PERIOD) -> str:
    """Write flagged trips in one job without moving them; ``split_part`` reads the accepted or the rejected ones.

    Trips arrive by file and so by period, and stay where they are. Within a period's files they are sorted by outcome, so a reader
    skips the other outcome by its footers. As both are in a period's folder, a rerun replaces both, also when one is empty now.
    """
    outcome = F.when(F.col("quality_error_count") > 0, "rejected").otherwise("curated")
    writer = flagged.withColumn(OUTCOME, outcome).sortWithinPartitions(*keys, OUTCOME).write.mode("overwrite")
    writer.option("compression", "snappy").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)
    return root


def split_part(spark: SparkSession, root: str, outcome: str) -> DataFrame:
    """``curated`` or ``rejected`` trips of a split."""
    return spark.read.parquet(root).filter(F.col(OUTCOME) == outcome).drop(OUTCOME)


MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # the JSON writer would otherwise stop at milliseconds


def append_events(df: DataFrame, root: str, event_type: str, at: Column | None = None, schema_version: int = 1) -> None:
    """Append event rows as JSON lines, one folder per layer."""
    stamped = df.withColumns({
        "layer": F.lower("layer"),
        "event_type": F.lit(event_type),
        "schema_version": F.lit(schema_version),
        "written_at": F.current_timestamp() if at is None else at,
    })
    writer = stamped.write.mode("append").option("timestampNTZFormat", MICROSECONDS)
    writer.partitionBy("layer").json(f"{root}/{event_type}")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def pending_files(incoming: DataFrame, registry: DataFrame) -> DataFrame:
    """Files not yet processed: no READY entry with the same hash and existing outputs."""
    done = registry.filter("status = 'READY' AND outputs_exist").select("service", "year", "month", "sha256")
    return incoming.join(done, ["service", "year", "month", "sha256"], "left_anti")


def merge_registry(registry: DataFrame, processed: DataFrame) -> DataFrame:
    """Registry after a run: a processed period replaces its previous entry."""
    keys = ["service", "year", "month"]
    rest = [c for c in registry.columns if c not in keys]
    both = registry.withColumn("_rank", F.lit(0)).unionByName(processed.withColumn("_rank", F.lit(1)))
    newest = F.max_by(F.struct(*rest), F.struct("_rank", "sha256"))
    return both.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def version_history(ingested: DataFrame) -> DataFrame:
    """Versions per period: a hash that differs from the one before archives it, also when it returns to an older one.

    A period has as many rows as it was ingested, so its window is bounded by the number of runs.
    """
    keys = ["service", "year", "month"]
    in_order = Window.partitionBy(*keys).orderBy("ingested_at", "sha256")
    versions = ingested.withColumn("_before", F.lag("sha256").over(in_order)).filter(
        F.col("_before").isNull() | (F.col("sha256") != F.col("_before")))
    return versions.withColumn("is_current", F.lead(F.lit(1)).over(in_order).isNull()).select(
        *keys, "sha256", "ingested_at", "is_current",
        F.when(F.col("is_current"), "CURRENT").otherwise("ARCHIVED").alias("version_state"),
    )
