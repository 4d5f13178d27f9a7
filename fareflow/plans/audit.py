"""Run, dataset, quality and attempt events: replay, merge, roll up and report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.operators.keyed import latest_by
from fareflow.operators.order import exact_quantiles, numbered

FAILED = ("FAILED", "ERROR", "EXHAUSTED")
# Columns that tell one error from another, in identity order.
ERROR_IDENTITY = ("execution_id", "layer", "service", "year", "month", "dataset_name", "rule_code", "attempt_number",
                  "error_type", "error_message", "subject")
TIMESTAMPS = ("updated_at", "written_at", "finished_at", "checked_at", "recorded_at", "attempted_at", "started_at",
              "occurred_at")


def upper_text(name: str) -> Column:
    return F.upper(F.col(name).cast("string"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- runs --------------------------------------------------------------------

def _known_layer() -> Column:
    return F.col("layer").isNotNull() & ~F.lower(F.trim("layer")).isin("", "unknown")


def merged_map(log: DataFrame, column: str, order: Column) -> DataFrame:
    """Per run, the latest non-null value of every map entry."""
    entries = log.select("execution_id", order.alias("_order"), F.explode(column).alias("k", "v")).filter("v IS NOT NULL")
    newest = entries.groupBy("execution_id", "k").agg(F.max_by("v", "_order").alias("v"))
    return newest.groupBy("execution_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(column)
    )


def run_state(log: DataFrame, columns: Sequence[str], order: Sequence[str] = ("written_at", "event_id"),
              maps: Sequence[str] = ()) -> DataFrame:
    """Replay run patches: later non-null fields win and a known layer is never forgotten.

    Every field is an aggregate with map-side combine, so a run with a million
    patches costs no more memory than one with two.
    """
    log = log.filter("execution_id <> ''")
    at = F.struct(*order)
    newest = {c: F.max_by(c, F.when(F.col(c).isNotNull(), at)) for c in columns}
    if "layer" in newest:
        newest["layer"] = F.coalesce(F.max_by("layer", F.when(_known_layer(), at)), newest["layer"])
    state = log.groupBy("execution_id").agg(*[v.alias(k) for k, v in newest.items()])
    for column in maps:
        state = state.join(merged_map(log, column, at), "execution_id", "left")
    return with_duration(state)


def with_duration(runs: DataFrame) -> DataFrame:
    """Fill a missing duration from start and finish."""
    elapsed = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("finished_at")) / F.lit(1e6)
    return runs.withColumn("duration_seconds", F.coalesce("duration_seconds", elapsed))


def normalize_runs(frames: dict[str, DataFrame], tie: str = "event_id") -> DataFrame:
    """Runs of all layers in one shape, the latest start per execution."""
    shaped = []
    for layer, df in frames.items():
        if "run_id" in df.columns and "execution_id" not in df.columns:
            df = df.withColumnRenamed("run_id", "execution_id")
        shaped.append(df if layer == "unified" else df.withColumn("layer", F.lit(layer)))
    return with_duration(latest_by(union_all(shaped), ["execution_id"], ["started_at", tie]))


def coalesce_stores(frames: Sequence[DataFrame], keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The same event from several stores, the newest copy of each."""
    return latest_by(union_all(frames), list(keys), list(newest))


def newest_events(log: DataFrame, n: int = 20000) -> DataFrame:
    """The n newest events. Spark keeps n rows per task, never the whole log in one."""
    return log.orderBy(F.desc("written_at"), F.desc("event_id")).limit(n)


def freshness(df: DataFrame, into: str = "fresh_at", preferred: str | None = None) -> DataFrame:
    """Newest of whichever timestamp columns the table has, ``preferred`` among them; null where there is none."""
    names = dict.fromkeys([*TIMESTAMPS, *([preferred] if preferred else [])])
    present = [F.col(c).try_cast("timestamp_ntz") for c in names if c in df.columns]
    missing = F.lit(None).cast("timestamp_ntz")
    return df.withColumn(into, F.greatest(*present, missing, missing))


def parent_rollup(children: DataFrame, parent: str = "parent_execution_id") -> DataFrame:
    """Status of a platform run from its layer runs: the worst one counts."""
    status = F.col("status")
    worst = F.max(F.when(status == "FAILED", 2).when(status.isin("PARTIAL_SUCCESS", "NO_INPUT"), 1).otherwise(0))
    return children.filter(F.col(parent).isNotNull()).groupBy(parent).agg(
        F.when(worst == 2, "FAILED").when(worst == 1, "PARTIAL_SUCCESS").otherwise("SUCCESS").alias("status"),
        F.count(F.lit(1)).alias("runs"),
    )


def run_status(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Status of each run from its file outcomes; a run without any had no input."""
    counts = outcomes.groupBy("execution_id").agg(
        F.count_if(F.col("status") == "FAILED").alias("failed"), F.count_if(F.col("status") == "READY").alias("ready"),
        F.count(F.lit(1)).alias("files"),
    )
    status = (
        F.when(F.col("files").isNull(), "NO_INPUT")
        .when((F.col("failed") > 0) & (F.col("ready") > 0), "PARTIAL_SUCCESS")
        .when(F.col("failed") > 0, "FAILED").otherwise("SUCCESS")
    )
    return runs.select("execution_id").join(counts, "execution_id", "left").select("execution_id", status.alias("status"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Files by status, volumes and download rate per run; unknown durations make the total unknown."""
    status, seconds = F.col("status"), F.col("duration_seconds")
    attempted = F.col("attempt_count") > 0
    total = F.when((F.count_if(attempted) > 0) & (F.count_if(attempted & seconds.isNull()) == 0),
                   F.sum(F.when(attempted, seconds)))
    ready, failed = F.count_if(status == "READY"), F.count_if(status == "FAILED")
    summary = outcomes.groupBy("execution_id").agg(
        ready.alias("ready_files"), F.count_if(status.startswith("SKIPPED")).alias("skipped_files"),
        failed.alias("failed_files"), F.coalesce(F.sum("rows_read"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("bytes_downloaded"), F.lit(0.0)).alias("bytes_downloaded"), total.alias("download_seconds"),
        F.try_divide(failed, ready + failed).alias("error_rate"),
    )
    rate = F.when(F.col("download_seconds") > 0, F.col("bytes_downloaded") * 8 / F.col("download_seconds") / 1e6)
    return summary.withColumn("average_download_mbps", rate)


# --- attempts ----------------------------------------------------------------

def processing_attempts(starts: DataFrame, finishes: DataFrame) -> DataFrame:
    """Attempt number per stage and subject, joined with its outcome and duration."""
    counted = numbered(starts, ["execution_id", "layer", "stage", "subject"], ["started_at", "attempt_id"], "attempt_number", "attempts")
    ended = finishes.select("attempt_id", "finished_at", F.col("status").alias("end_status"))
    elapsed = F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at"))
    return counted.join(ended, "attempt_id", "left").withColumns({
        "status": F.coalesce("end_status", F.lit("RUNNING")), "duration_seconds": elapsed,
    }).drop("end_status")


def final_downloads(attempts: DataFrame) -> DataFrame:
    """Last conclusive attempt per file and run."""
    conclusive = attempts.filter(upper_text("outcome").isin("SUCCESS", "EXHAUSTED"))
    return latest_by(conclusive, ["execution_id", "service", "year", "month"], ["attempt_number", "event_id"])


def download_kpis(attempts: DataFrame) -> DataFrame:
    """Final error rate, retries, seconds, bytes and throughput over all attempts."""
    wrong = final_downloads(attempts).agg(F.avg((upper_text("outcome") != "SUCCESS").cast("double"))).scalar()
    retry = F.greatest(F.col("attempt_number") - 1, F.lit(0))
    sums = attempts.agg(
        F.sum((retry > 0).cast("int")).alias("retries"), F.sum("duration_seconds").alias("download_seconds"),
        F.sum("bytes_downloaded").alias("downloaded_bytes"),
    )
    rate = F.when(F.col("download_seconds") > 0, F.col("downloaded_bytes") * 8 / F.col("download_seconds") / 1e6)
    return sums.withColumns({"throughput_mbps": rate, "download_error_rate": wrong})


# --- quality events ----------------------------------------------------------

def normalize_legacy_quality(df: DataFrame, layer: str) -> DataFrame:
    """Older quality rows in today's shape; a status that cannot be known stays UNKNOWN."""
    has = set(df.columns)
    affected = F.col("affected_rows").cast("double") if "affected_rows" in has else F.lit(None).cast("double")
    severity = upper_text("severity") if "severity" in has else F.lit("UNKNOWN")
    derived = F.when(affected == 0, "PASSED").when(affected > 0, F.when(severity == "ERROR", "FAILED").otherwise("WARNING"))
    new = {
        "layer": F.coalesce("layer", F.lit(layer)) if "layer" in has else F.lit(layer),
        "source_store": F.lit("legacy"),
    }
    if "checked_at" not in has and "recorded_at" in has:
        new["checked_at"] = F.col("recorded_at")
    if "failed_rows" not in has:
        new["failed_rows"] = affected
    if "dimension" not in has:
        new["dimension"] = F.lit("validity")
    if "dataset_name" not in has:
        new["dataset_name"] = F.concat("service", F.lit("_trips")) if "service" in has else F.lit("legacy_quality")
    if "status" not in has:
        new["status"] = F.coalesce(derived, F.lit("UNKNOWN"))
    return df.withColumns(new)


def _text(df: DataFrame, *names: str) -> Column:
    """First non-empty of several columns as text; a dotted name looks into the context map."""
    found = []
    for name in names:
        if name in df.columns:
            found.append(F.nullif(F.col(name).cast("string"), F.lit("")))
        elif name.startswith("context.") and "context" in df.columns:
            found.append(F.nullif(F.try_element_at("context", F.lit(name[8:])), F.lit("")))
    return F.coalesce(*found, F.lit(""))


def quality_key(df: DataFrame) -> Column:
    parts = [("execution_id",), ("layer",), ("dataset_name",), ("rule_code",), ("service", "context.service"),
             ("year", "context.year"), ("month", "context.month")]
    return F.concat_ws("|", *[_text(df, *p) for p in parts])


def merge_quality(current: Sequence[DataFrame], legacy: dict[str, DataFrame], tie: str = "event_id") -> DataFrame:
    """One quality event per run, dataset, rule and period, the newest from any store."""
    unified = coalesce_stores(current, ["quality_id"], ["checked_at", tie])
    whole = union_all([unified, *[normalize_legacy_quality(df, layer) for layer, df in legacy.items()]])
    keyed = whole.withColumn("_quality_key", quality_key(whole))
    return latest_by(keyed, ["_quality_key"], ["checked_at", tie]).drop("_quality_key")


# --- errors ------------------------------------------------------------------

def failed_events(df: DataFrame, source: str) -> DataFrame:
    return df.filter(upper_text("status").isin(*FAILED)).withColumn("source", F.lit(source))


def dedupe_errors(df: DataFrame, tie: str = "event_id") -> DataFrame:
    """Newest row per error identity; absent and null parts count as empty."""
    identity = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ERROR_IDENTITY if c in df.columns])
    moment = next(c for c in ("occurred_at", "attempted_at", "recorded_at", "checked_at", "finished_at") if c in df.columns)
    keyed = df.withColumn("_error_identity", identity)
    return latest_by(keyed, ["_error_identity"], [moment, tie]).drop("_error_identity")


def consolidated_errors(sources: dict[str, DataFrame], manifests: DataFrame | None = None, tie: str = "event_id") -> DataFrame:
    failed = [failed_events(df, name) for name, df in sources.items()]
    return dedupe_errors(union_all(failed if manifests is None else [manifests, *failed]), tie)


# --- reports -----------------------------------------------------------------

def in_layers(df: DataFrame, layers: Sequence[str]) -> DataFrame:
    """Events of the chosen layers; a table without layers passes unchanged."""
    if "layer" not in df.columns:
        return df
    lowered = df.withColumn("layer", F.lower("layer"))
    return lowered.filter(F.col("layer").isin(*layers))


def finished_runs(runs: DataFrame) -> DataFrame:
    """Runs that are not running; an unknown status counts as not running."""
    return runs.filter(~upper_text("status").eqNullSafe("RUNNING"))


def success_rate(runs: DataFrame, partial_counts: bool = False) -> DataFrame:
    good = ("SUCCESS", "SUCCEEDED", "PARTIAL_SUCCESS") if partial_counts else ("SUCCESS", "SUCCEEDED")
    return finished_runs(runs).agg(F.avg(F.coalesce(upper_text("status").isin(*good), F.lit(False)).cast("double")).alias("success_rate"))


def status_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))


def median_duration(runs: DataFrame) -> DataFrame:
    """Exact median; zero means unknown."""
    known = runs.select(F.nullif("duration_seconds", F.lit(0.0)).alias("seconds"))
    return exact_quantiles(known, "seconds", [0.5], "run-durations").select(F.col("value").alias("median_duration"))


def latest_coverage(snapshots: DataFrame, tie: str = "event_id") -> DataFrame:
    return latest_by(snapshots, ["layer"], ["checked_at", tie])


def audit_kpis(runs: DataFrame, datasets: DataFrame, quality: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row for the head of the audit report."""
    failed = F.count_if(upper_text("status") == "FAILED")
    return runs.agg(F.count(F.lit(1)).alias("runs")).withColumns({
        "success_rate": success_rate(runs, partial_counts=True).scalar(),
        "median_duration": median_duration(runs).scalar(),
        "failed_datasets": datasets.agg(failed).scalar(),
        "failed_rules": quality.agg(failed).scalar(),
        "missing_expected": latest_coverage(coverage).agg(F.sum("missing_count")).scalar(),
    })


def exploded_inventory(inventory: DataFrame) -> DataFrame:
    """Dataset rows out of per-layer snapshots with a nested dataset list."""
    return inventory.select("layer", F.explode("datasets").alias("d")).select("layer", "d.*")


# --- manifests ---------------------------------------------------------------

def _first(df: DataFrame, *names: str) -> Column:
    """First non-null of several alternative summary fields; unknown stays null."""
    fields = set(df.schema["summary"].dataType.fieldNames())
    present = [F.col(f"summary.{n}").try_cast("double") for n in names if n in fields]
    return F.coalesce(*present) if present else F.lit(None).cast("double")


def manifest_runs(manifests: DataFrame) -> DataFrame:
    """One run row per manifest; the error rate divides by what the layer counts."""
    layer, s = F.lower("summary.layer"), "summary."
    built, failed_sets = _first(manifests, "datasets_built"), _first(manifests, "failed_datasets")
    trained, failed_models = _first(manifests, "trained_models"), _first(manifests, "failed_models")
    source = _first(manifests, "source_files", "expected_periods", "applicable_periods")
    base = F.when(layer == "gold", built + failed_sets).when(layer == "ml", trained + failed_models).otherwise(source)
    failed = _first(manifests, "failed_files", "failed_datasets", "failed_models")
    elapsed = F.timestamp_diff("SECOND", F.col(s + "started_at"), F.col(s + "finished_at")).cast("double")
    return manifests.select(
        F.coalesce(s + "execution_id", s + "run_id").alias("execution_id"), layer.alias("layer"),
        F.upper(F.coalesce(s + "status", F.lit("UNKNOWN"))).alias("status"),
        F.col(s + "started_at").alias("started_at"), F.col(s + "finished_at").alias("finished_at"),
        F.coalesce(_first(manifests, "duration_seconds"), elapsed).alias("duration_seconds"),
        source.alias("source_files"),
        _first(manifests, "processed_files", "ready_files", "downloaded_files", "datasets_built", "trained_models").alias("processed_files"),
        failed.alias("failed_files"),
        _first(manifests, "rows_read", "source_rows", "parquet_num_rows").alias("rows_input"),
        F.coalesce(_first(manifests, "error_rate"), F.when(base > 0, failed / base)).alias("error_rate"),
    )


def manifest_errors(manifests: DataFrame) -> DataFrame:
    """Failed or explained items of the manifest's file list, one row each."""
    item = F.col("item")
    status = F.upper(F.coalesce("item.status", F.lit("")))
    bad = status.isin(*FAILED) | item["error_type"].isNotNull() | item["error_message"].isNotNull()
    run = F.coalesce("summary.execution_id", "summary.run_id")
    return manifests.select("summary", F.explode("files").alias("item")).filter(bad).select(
        run.alias("execution_id"), F.lower("summary.layer").alias("layer"),
        F.coalesce(F.nullif(status, F.lit("")), F.upper("summary.status")).alias("status"),
        F.coalesce(item["error_type"], F.lit("UnknownError")).alias("error_type"),
        F.coalesce(item["error_message"], F.lit("")).alias("error_message"),
        item["file_name"].alias("subject"), F.col("summary.finished_at").alias("occurred_at"),
        F.lit("manifest.files").alias("source"),
    )
