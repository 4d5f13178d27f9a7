"""Monthly files as they arrive: only touched periods are rebuilt, and deliveries that bring nothing new are skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import prepare
from fareflow.sources.file_facts import file_facts
from fareflow.sources.sinks import PERIOD, write_partitions

ARRIVALS = "source_year int, source_month int, file_name string, path string, sha256 string, batch_id bigint"


def _same_path(path: str) -> Column:
    """A path without its scheme, as readers spell it differently."""
    return F.regexp_replace(path, r"^[a-z0-9]+:/+", "/")


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    """All files that arrived, in which batch and with which content."""
    try:
        return spark.read.schema(ARRIVALS).option("recursiveFileLookup", True).parquet(registry)
    except Exception as error:  # noqa: BLE001 - only a folder that isn't there yet counts as empty
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], ARRIVALS)


def file_states(arrivals: DataFrame) -> DataFrame:
    """CURRENT, REPEATED or ARCHIVED per arrived file.

    Of files with one content in a period the first to arrive counts, later ones repeat it. Of different contents under one file
    name the newest counts and archives the others; a content that comes back is current again.
    """
    keys = list(PERIOD)
    newest = arrivals.groupBy(*keys, "file_name").agg(F.max_by("sha256", F.col("batch_id")).alias("newest"))
    live = arrivals.join(newest, [*keys, "file_name"]).filter("sha256 = newest")
    first = live.groupBy(*keys, "sha256").agg(F.min(F.struct("batch_id", "path")).alias("first")).select(
        *keys, "sha256", F.col("first.path").alias("kept"))
    state = (F.when(F.col("sha256") != F.col("newest"), "ARCHIVED").when(F.col("path") == F.col("kept"), "CURRENT").otherwise("REPEATED"))
    return arrivals.join(newest, [*keys, "file_name"]).join(first, [*keys, "sha256"], "left").withColumn("state", state).drop("newest", "kept")


def incremental_trips(
    spark: SparkSession, source: str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], registry: str | None = None,
) -> None:
    """Process the files that arrived since the last call, then stop.

    Each batch finds the periods its new files belong to, re-reads those periods
    whole (the filter prunes to their folders) and replaces just their
    partitions. A replayed batch therefore writes the same result again, and
    duplicates are found across files of one period. The checkpoint remembers
    which files were seen.

    With a ``registry`` folder, arriving files are hashed and joined to what is registered: a period is rebuilt only if its set of
    current contents changes, and from its current files alone. The batch's entry is written after its partitions and replaced if the
    batch is run again.
    """
    prepare(spark)
    stored = spark.read.option("basePath", source).parquet(source)
    stream = spark.readStream.schema(stored.schema).option("basePath", source).parquet(source)

    def whole(periods: list) -> DataFrame:
        wanted = " OR ".join(f"(source_year = {r[0]} AND source_month = {r[1]})" for r in periods)
        return spark.read.schema(stored.schema).option("basePath", source).parquet(source).filter(wanted)

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        # One row per calendar month: small enough for the driver to build the partition filter.
        touched = batch.select(*PERIOD).distinct().collect()
        if not touched:
            return
        if registry is None:
            write_partitions(transform(whole(touched)), target, PERIOD)
            return
        hashed = file_facts(spark, source, "hash").select(_same_path("path").alias("path"), "sha256")
        arrived = batch.select(*PERIOD, _same_path("_path").alias("path")).distinct().join(hashed, "path").select(
            *PERIOD, F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "sha256", F.lit(batch_id).cast("long").alias("batch_id"))
        entry = f"{registry}/batch-{batch_id}"
        before = read_registry(spark, registry).filter(F.col("batch_id") < batch_id)
        states = file_states(before.unionByName(arrived)).persist()
        try:
            old = file_states(before).filter("state = 'CURRENT'").select(*PERIOD, "sha256")
            now = states.filter("state = 'CURRENT'").select(*PERIOD, "sha256")
            changed = now.exceptAll(old).unionByName(old.exceptAll(now)).select(*PERIOD).distinct().collect()
            if changed:
                current = states.filter("state = 'CURRENT'").select(F.col("path").alias("_current"))
                rows = whole(changed).withColumn("_path", _same_path("_metadata.file_path"))
                write_partitions(transform(rows.join(current, F.col("_path") == F.col("_current"), "left_semi").drop("_path")), target, PERIOD)
            arrived.write.mode("overwrite").parquet(entry)
        finally:
            states.unpersist()

    if registry is not None:
        stream = stream.select("*", F.col("_metadata.file_path").alias("_path"))
    query = (
        stream.writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
