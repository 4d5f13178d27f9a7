"""Event rows of fixed shape: runs as they start, finish and fail, datasets, quality results, coverage and download attempts.

Each builder takes a frame with whatever of the kind's columns it has, derives the rest and gives exactly the kind's columns, so logs of any
layer union by position. An event's id is a hash of what identifies it: built twice, it is the same event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.sources.sinks import append_events

ERROR_TEXT = 4000  # characters of an error message that are kept

# Column names and types of each kind of event.
_ERROR = "error_type string, error_message string"
KINDS = {
    "pipeline_run": (
        "execution_id string, parent_execution_id string, layer string, execution_type string, status string, started_at timestamp_ntz, "
        "finished_at timestamp_ntz, duration_seconds double, selection map<string,string>, metrics map<string,double>, "
        f"warnings array<string>, {_ERROR}, updated_at timestamp_ntz, event_action string"),
    "dataset_event": (
        "execution_id string, layer string, dataset_name string, dataset_type string, operation string, status string, path string, "
        "parquet_files bigint, rows bigint, bytes_on_disk bigint, service string, year int, month int, source_dataset string, "
        f"metadata map<string,string>, {_ERROR}, recorded_at timestamp_ntz"),
    "quality_event": (
        "execution_id string, layer string, dataset_name string, rule_code string, dimension string, severity string, status string, "
        "expected string, actual string, failed_rows bigint, message string, context map<string,string>, checked_at timestamp_ntz"),
    "coverage_snapshot": (
        "execution_id string, layer string, status string, expected_count bigint, available_count bigint, ready_count bigint, "
        "missing_count bigint, not_applicable_count bigint, not_published_count bigint, deferred_count bigint, coverage_rate double, "
        "missing array<string>, checked_at timestamp_ntz"),
    "download_attempt": (
        "execution_id string, layer string, service string, year int, month int, url string, attempt_number int, retry_number int, "
        "max_attempts int, outcome string, status_code int, retry_delay_seconds double, "
        f"{_ERROR}, started_at timestamp_ntz, finished_at timestamp_ntz, duration_seconds double, bytes_downloaded bigint, "
        "expected_bytes bigint, throughput_bytes_per_second double, attempted_at timestamp_ntz"),
}
IDENTITY = {
    "pipeline_run": ("execution_id", "event_action", "updated_at"),
    "dataset_event": ("execution_id", "layer", "dataset_name", "operation", "service", "year", "month", "recorded_at"),
    "quality_event": ("execution_id", "layer", "dataset_name", "rule_code", "context", "checked_at"),
    "coverage_snapshot": ("execution_id", "layer"),
    "download_attempt": ("execution_id", "service", "year", "month", "attempt_number"),
}
MOMENT = {"pipeline_run": "updated_at", "dataset_event": "recorded_at", "quality_event": "checked_at", "coverage_snapshot": "checked_at",
          "download_attempt": "attempted_at"}


def schema_of(kind: str) -> T.StructType:
    return T.StructType.fromDDL(f"event_id string, {KINDS[kind]}")


def _given(df: DataFrame, name: str, otherwise: Column | None = None) -> Column:
    default = F.lit(None) if otherwise is None else otherwise
    return F.coalesce(F.col(f"`{name}`"), default) if name in df.columns else default


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def shaped(kind: str, df: DataFrame, now: Column | None = None) -> DataFrame:
    """Exactly the kind's columns: those that ``df`` lacks are null, others are left out, the moment defaults to ``now``."""
    moment, fields = MOMENT[kind], schema_of(kind).fields[1:]
    present = F.localtimestamp() if now is None else now
    columns = [_given(df, f.name, present if f.name == moment else None).cast(f.dataType).alias(f.name) for f in fields]
    rows = df.select(*columns)
    for name in ("error_message",):
        if name in rows.columns:
            rows = rows.withColumn(name, F.substring(name, 1, ERROR_TEXT))
    parts = [F.col(c).cast("string") if c != "context" else F.to_json(c) for c in IDENTITY[kind]]
    identity = F.concat_ws("|", F.lit(kind), *[F.coalesce(p, F.lit("")) for p in parts])
    return rows.select(F.sha2(identity, 256).alias("event_id"), "*")


# --- runs --------------------------------------------------------------------

OUTCOME = ("finished_at", "duration_seconds", "metrics", "warnings", "error_type", "error_message")  # not known at the start


def runs_started(runs: DataFrame) -> DataFrame:
    return shaped("pipeline_run", runs.drop(*OUTCOME).withColumns({
        "status": F.lit("RUNNING"), "updated_at": F.col("started_at"), "event_action": F.lit("START")}))


def runs_finished(runs: DataFrame, failed: bool = False) -> DataFrame:
    """``runs`` have their start and finish; a failed run has an error instead of metrics."""
    status = F.lit("FAILED") if failed else _given(runs, "status", F.lit("SUCCESS"))
    layer = _given(runs, "layer", F.lit("unknown"))
    return shaped("pipeline_run", runs.withColumns({
        "layer": layer, "status": status, "updated_at": F.col("finished_at"),
        "duration_seconds": seconds_between(F.col("started_at"), F.col("finished_at")),
        "event_action": F.lit("FAIL" if failed else "FINISH")}))


def runs_linked(links: DataFrame) -> DataFrame:
    """(execution_id, parent_execution_id, layer, updated_at): a run that turns out to be part of a larger one."""
    return shaped("pipeline_run", links.select(
        "execution_id", "parent_execution_id", "layer", "updated_at", F.lit("LINK_PARENT").alias("event_action")))


# --- other kinds -------------------------------------------------------------

def dataset_events(datasets: DataFrame) -> DataFrame:
    return shaped("dataset_event", datasets)


def quality_events(results: DataFrame) -> DataFrame:
    return shaped("quality_event", results)


def coverage_snapshots(counts: DataFrame, not_published_is_missing: bool = False) -> DataFrame:
    """Rate and status of each layer's counts; periods that don't apply or aren't published yet are not in scope."""
    known = {c: F.coalesce(F.col(c), F.lit(0)) if c in counts.columns else F.lit(0) for c in (
        "expected_count", "ready_count", "not_applicable_count", "not_published_count")}
    outside = known["not_applicable_count"] + (F.lit(0) if not_published_is_missing else known["not_published_count"])
    scope = F.greatest(known["expected_count"] - outside, F.lit(0))
    missing = F.coalesce(F.col("missing"), F.array().cast("array<string>"))
    complete = (F.size(missing) == 0) & (known["ready_count"] >= scope)
    return shaped("coverage_snapshot", counts.withColumns({
        **known, "missing": missing, "missing_count": F.size(missing),
        "coverage_rate": F.when(scope > 0, known["ready_count"] / scope),
        "status": F.when(scope == 0, "NO_SCOPE").when(complete, "COMPLETE").otherwise("PARTIAL")}))


def download_attempts(attempts: DataFrame) -> DataFrame:
    """Every attempt after the first is a retry; duration and rate follow from the times and bytes where they are not told."""
    seconds = _given(attempts, "duration_seconds", seconds_between(F.col("started_at"), F.col("finished_at"))
                     if {"started_at", "finished_at"} <= set(attempts.columns) else None)
    rate = F.when(seconds > 0, _given(attempts, "bytes_downloaded") / seconds)
    return shaped("download_attempt", attempts.withColumns({
        "layer": F.lit("bronze"), "retry_number": F.greatest(F.col("attempt_number") - 1, F.lit(0)), "duration_seconds": seconds,
        "throughput_bytes_per_second": _given(attempts, "throughput_bytes_per_second", rate),
        "attempted_at": _given(attempts, "attempted_at", F.col("finished_at") if "finished_at" in attempts.columns else None)}))


# --- the log -----------------------------------------------------------------

def append(df: DataFrame, root: str, kind: str) -> None:
    """Write events of one kind, stamped with the moment they tell of."""
    if df.schema.fieldNames() != schema_of(kind).fieldNames():
        raise ValueError(f"not {kind} rows: {df.columns}")
    append_events(df, root, kind, at=F.col(MOMENT[kind]))


def read(spark, root: str, kinds: Sequence[str] = tuple(KINDS)) -> dict[str, DataFrame]:
    """The log's frames by kind; malformed lines are skipped, the layer comes from the folder."""
    def one(kind: str) -> DataFrame:
        stamped = T.StructType([*schema_of(kind).fields, *T.StructType.fromDDL("written_at timestamp_ntz").fields])
        return spark.read.schema(stamped).option("mode", "DROPMALFORMED").option("basePath", f"{root}/{kind}").json(f"{root}/{kind}")

    return {kind: one(kind) for kind in kinds}
