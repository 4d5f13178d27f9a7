"""Event log: runs, attempts, quality, errors, manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.blocks import BLOCKS, rnd
from checks.registry import query, register
from fareflow.operators.keyed import latest_by
from fareflow.plans import audit, events
from fareflow.session import shared_dir
from fareflow.sources import files, fixtures, sinks


def scratch(w, name: str) -> str:
    return f"{shared_dir(w.spark)}/fareflow/{name}-{uuid.uuid4().hex[:8]}"


def _from(fixture):
    return lambda w: fixture(w.spark, w.sf_dir)


_log, _attempts = _from(fixtures.run_log), _from(fixtures.download_attempts)
_quality, _datasets = _from(fixtures.quality_log), _from(fixtures.dataset_log)

_SERVICE = "['yellow', 'green', 'fhv', 'fhvhv'][1 + user_id % 4]"
BLOCKS["log"] = f"""
SELECT event_id, ts AS written_at, concat('run-', user_id) AS execution_id,
  CASE WHEN event_id % 13 = 0 THEN 'unknown' ELSE ['bronze', 'silver', 'gold', 'ml'][1 + user_id % 4] END AS layer,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'RUNNING' WHEN 'view' THEN 'SUCCESS'
    ELSE 'PARTIAL_SUCCESS' END AS status,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS duration_seconds,
  CASE WHEN event_id % 7 = 0 THEN ts END AS started_at, CASE WHEN event_id % 11 = 0 THEN ts END AS finished_at,
  CAST(event_id % 4 AS INT) AS attempt_number, concat('RULE_', event_id % 6) AS rule_code,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 4 END AS affected_rows, user_id, event_type, value, ts,
  {_SERVICE} AS service, 1 + user_id % 12 AS m
FROM events"""
BLOCKS["run_state"] = """
SELECT *, coalesce(d, epoch_us(finished_at - started_at) / 1e6) AS duration_seconds FROM (
  SELECT execution_id, arg_max(status, event_id) AS status, arg_max(started_at, event_id) FILTER (started_at IS NOT NULL) AS started_at,
    arg_max(finished_at, event_id) FILTER (finished_at IS NOT NULL) AS finished_at,
    arg_max(duration_seconds, event_id) FILTER (duration_seconds IS NOT NULL) AS d,
    coalesce(arg_max(layer, event_id) FILTER (layer <> 'unknown'), arg_max(layer, event_id)) AS layer
  FROM log GROUP BY execution_id)"""
_RUN_COLUMNS = ("status", "started_at", "finished_at", "duration_seconds", "layer")


def _runs(w):
    return audit.run_state(_log(w), _RUN_COLUMNS)


register("run_state", _runs, f"""
SELECT execution_id, status, started_at, finished_at, layer, {rnd('duration_seconds')} FROM run_state""")


@query("patch_merge", f"""
SELECT s.execution_id, s.layer, s.status, {rnd('m.click', 'click')}, {rnd('m.view', 'view')}, {rnd('m.last', 'last')}
FROM run_state s JOIN (SELECT execution_id,
    arg_max(value, event_id) FILTER (event_type = 'click' AND event_id % 3 <> 0) AS click,
    arg_max(value, event_id) FILTER (event_type = 'view' AND event_id % 3 <> 0) AS view,
    max(event_id) AS last FROM log GROUP BY execution_id) m USING (execution_id)""")
def _(w):
    state = audit.run_state(_log(w), _RUN_COLUMNS, maps=("metrics",))
    at = lambda key: F.try_element_at("metrics", F.lit(key)).alias(key)
    return state.select("execution_id", "layer", "status", at("click"), at("view"), at("last"))


@query("normalize_runs", """
SELECT execution_id, layer, status, event_id, started_at FROM (
  SELECT *, row_number() OVER (PARTITION BY execution_id ORDER BY started_at DESC NULLS LAST, event_id DESC) AS rn FROM (
    SELECT event_id, execution_id, layer, status, started_at FROM log WHERE event_id % 2 = 0
    UNION ALL SELECT event_id, execution_id, 'bronze', status, started_at FROM log WHERE event_id % 2 = 1 AND user_id % 4 = 0
    UNION ALL SELECT event_id, execution_id, 'gold', status, started_at FROM log WHERE event_id % 2 = 1 AND user_id % 4 = 2))
WHERE rn = 1""")
def _(w):
    log = _log(w).select("event_id", "execution_id", "layer", "status", "started_at", "finished_at", "duration_seconds", "user_id")
    odd = log.filter("event_id % 2 = 1").withColumnRenamed("execution_id", "run_id").drop("layer")
    runs = audit.normalize_runs({
        "unified": log.filter("event_id % 2 = 0"), "bronze": odd.filter("user_id % 4 = 0"), "gold": odd.filter("user_id % 4 = 2"),
    })
    return runs.select("execution_id", "layer", "status", "event_id", "started_at")


register("latest_by_key", lambda w: latest_by(_log(w).select("execution_id", "layer", "status", "written_at", "event_id"),
                                              ["layer"], ["written_at", "event_id"]), """
SELECT execution_id, layer, status, written_at, event_id FROM log
QUALIFY row_number() OVER (PARTITION BY layer ORDER BY written_at DESC, event_id DESC) = 1""")


@query("multi_store_coalesce", """
SELECT execution_id, status, event_id FROM (
  SELECT execution_id, status, written_at, event_id FROM log WHERE event_id % 3 = 0 UNION ALL
  SELECT execution_id, 'COPIED', written_at, event_id FROM log WHERE event_id % 3 = 1)
QUALIFY row_number() OVER (PARTITION BY execution_id ORDER BY written_at DESC, event_id DESC) = 1""")
def _(w):
    log = _log(w).select("execution_id", "status", "written_at", "event_id")
    copied = log.filter("event_id % 3 = 1").withColumn("status", F.lit("COPIED"))
    return audit.coalesce_stores([log.filter("event_id % 3 = 0"), copied], ["execution_id"], ["written_at", "event_id"]).drop("written_at")


@query("union_missing_columns", """
SELECT event_id, layer, CASE WHEN part = 1 THEN status END AS status, CASE WHEN part = 2 THEN rule_code END AS rule_code
FROM (SELECT *, 1 AS part FROM log UNION ALL SELECT *, 2 FROM log)""")
def _(w):
    log = _log(w)
    return audit.union_all([log.select("event_id", "layer", "status"), log.select("event_id", "layer", "rule_code")])


register("latest_n_events", lambda w: audit.newest_events(_log(w).select("event_id", "execution_id", "written_at"), 500),
         "SELECT event_id, execution_id, written_at FROM log ORDER BY written_at DESC, event_id DESC LIMIT 500")
register("layer_filter", lambda w: audit.in_layers(_log(w), ["gold", "ml"]).groupBy("layer").agg(F.count(F.lit(1)).alias("n")),
         "SELECT layer, count(*) AS n FROM log WHERE layer IN ('gold', 'ml') GROUP BY ALL")
register("finished_runs", lambda w: audit.finished_runs(_runs(w).withColumn(
    "status", F.when(~F.col("execution_id").endswith("3"), F.col("status")))).filter("duration_seconds > 0").select("execution_id", "status"),
         """SELECT execution_id, status FROM (SELECT * REPLACE (CASE WHEN execution_id NOT LIKE '%3' THEN status END AS status) FROM run_state)
            WHERE status IS DISTINCT FROM 'RUNNING' AND duration_seconds > 0""")
register("freshness", lambda w: audit.freshness(_log(w).select("event_id", "started_at", "finished_at", "written_at"))
         .select("event_id", "fresh_at"),
         "SELECT event_id, greatest(started_at, finished_at, written_at) AS fresh_at FROM log")


@query("parent_rollup", """
SELECT parent_execution_id, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED'
  WHEN bool_or(status IN ('PARTIAL_SUCCESS', 'NO_INPUT')) THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS status, count(*) AS runs
FROM (SELECT *, concat('platform-', CAST(substr(execution_id, 5) AS INT) // 3) AS parent_execution_id FROM run_state)
GROUP BY ALL""")
def _(w):
    parent = F.expr("concat('platform-', CAST(substr(execution_id, 5) AS INT) div 3)")
    return audit.parent_rollup(_runs(w).withColumn("parent_execution_id", parent))


BLOCKS["outcomes"] = """
SELECT execution_id, ['READY', 'FAILED', 'SKIPPED_UNCHANGED', 'READY'][1 + event_id % 4] AS status, event_id % 3 AS attempt_count,
  event_id % 1000 AS rows_read, value * 1000 AS bytes_downloaded,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS duration_seconds FROM log"""
register("run_status", lambda w: audit.run_status(
    _runs(w), fixtures.file_outcomes(w.spark, w.sf_dir).filter("CAST(substr(execution_id, 5) AS INT) % 5 <> 0 AND rows_read % 7 = 0")), """
SELECT r.execution_id, CASE WHEN o.execution_id IS NULL THEN 'NO_INPUT' WHEN failed > 0 AND ready > 0 THEN 'PARTIAL_SUCCESS'
  WHEN failed > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM run_state r LEFT JOIN (SELECT execution_id, count(*) FILTER (status = 'FAILED') AS failed,
    count(*) FILTER (status = 'READY') AS ready FROM outcomes
  WHERE CAST(substr(execution_id, 5) AS INT) % 5 <> 0 AND rows_read % 7 = 0 GROUP BY ALL) o USING (execution_id)""")
register("run_summary", lambda w: audit.run_summary(fixtures.file_outcomes(w.spark, w.sf_dir)), f"""
SELECT execution_id, ready_files, skipped_files, failed_files, rows_read, {rnd('bytes_downloaded')}, {rnd('download_seconds')},
  {rnd('failed_files / nullif(ready_files + failed_files, 0)', 'error_rate')},
  {rnd('CASE WHEN download_seconds > 0 THEN bytes_downloaded * 8 / download_seconds / 1e6 END', 'average_download_mbps')}
FROM (SELECT execution_id, count(*) FILTER (status = 'READY') AS ready_files,
    count(*) FILTER (status LIKE 'SKIPPED%') AS skipped_files, count(*) FILTER (status = 'FAILED') AS failed_files,
    CAST(sum(rows_read) AS BIGINT) AS rows_read, sum(bytes_downloaded) AS bytes_downloaded,
    CASE WHEN count(*) FILTER (attempt_count > 0) > 0 AND count(*) FILTER (attempt_count > 0 AND duration_seconds IS NULL) = 0
      THEN sum(duration_seconds) FILTER (attempt_count > 0) END AS download_seconds FROM outcomes GROUP BY execution_id)""")

register("processing_attempts", lambda w: audit.processing_attempts(
    fixtures.stage_starts(w.spark, w.sf_dir), fixtures.stage_finishes(w.spark, w.sf_dir)), """
SELECT event_id AS attempt_id, execution_id, layer, event_type AS stage, concat('s', event_id % 3) AS subject, ts AS started_at,
  CAST(row_number() OVER (PARTITION BY execution_id, layer, event_type, event_id % 3 ORDER BY ts, event_id) AS INT) AS attempt_number,
  CASE WHEN event_id % 4 <> 0 THEN ts + INTERVAL 1 SECOND * CAST(floor(value) AS INT) END AS finished_at,
  CASE WHEN event_id % 4 <> 0 THEN status ELSE 'RUNNING' END AS status,
  CASE WHEN event_id % 4 <> 0 THEN CAST(floor(value) AS BIGINT) END AS duration_seconds
FROM log""")

# --- downloads ---------------------------------------------------------------

BLOCKS["attempts"] = """
SELECT event_id, execution_id, service, m AS month, event_id % 4 + 1 AS attempt_number,
  CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'error' THEN 'EXHAUSTED' ELSE 'RETRY' END AS outcome,
  duration_seconds, value * 1000 AS bytes_downloaded, ts AS attempted_at FROM log"""
register("download_kpis", lambda w: audit.download_kpis(_attempts(w)), f"""
SELECT CAST(count(*) FILTER (attempt_number > 1) AS BIGINT) AS retries, {rnd('sum(duration_seconds)', 'download_seconds')},
  {rnd('sum(bytes_downloaded)', 'downloaded_bytes')},
  {rnd('sum(bytes_downloaded) * 8 / sum(duration_seconds) / 1e6', 'throughput_mbps')},
  (SELECT {rnd("avg(CASE WHEN outcome <> 'SUCCESS' THEN 1.0 ELSE 0.0 END)", 'x')} FROM (SELECT * FROM attempts
    WHERE outcome IN ('SUCCESS', 'EXHAUSTED') QUALIFY row_number() OVER (PARTITION BY execution_id, service, month
      ORDER BY attempt_number DESC, event_id DESC) = 1)) AS download_error_rate
FROM attempts""")
register("status_counts", lambda w: audit.status_counts(_log(w), "layer", "status"),
         "SELECT layer, status, count(*) AS events FROM log GROUP BY ALL")
register("attempt_outcomes", lambda w: audit.status_counts(_attempts(w), "service", "outcome"),
         "SELECT service, outcome, count(*) AS events FROM attempts GROUP BY ALL")
for _partial, _name, _ok in ((False, "success_rate", "('SUCCESS')"), (True, "success_rate_with_partial", "('SUCCESS', 'PARTIAL_SUCCESS')")):
    register(_name, lambda w, p=_partial: audit.success_rate(_runs(w), p), f"""
SELECT {rnd(f"avg(CASE WHEN status IN {_ok} THEN 1.0 ELSE 0.0 END)", 'success_rate')} FROM run_state WHERE status <> 'RUNNING'""")
register("median_duration", lambda w: audit.median_duration(_runs(w)),
         f"SELECT {rnd('quantile_cont(nullif(duration_seconds, 0), 0.5)', 'median_duration')} FROM run_state")

# --- quality and errors ------------------------------------------------------

BLOCKS["legacy"] = """
SELECT event_id, execution_id, service, rule_code, affected_rows, ts AS recorded_at, ts AS checked_at, 'silver' AS layer,
  CASE WHEN event_id % 3 = 0 THEN 'ERROR' ELSE 'WARNING' END AS severity, CAST(affected_rows AS DOUBLE) AS failed_rows,
  'validity' AS dimension, concat(service, '_trips') AS dataset_name,
  CASE WHEN affected_rows = 0 THEN 'PASSED' WHEN affected_rows > 0 AND event_id % 3 = 0 THEN 'FAILED'
    WHEN affected_rows > 0 THEN 'WARNING' ELSE 'UNKNOWN' END AS status
FROM log"""
_LEGACY = ["event_id", "layer", "dimension", "dataset_name", "status", "failed_rows", "checked_at"]
register("normalize_legacy_quality",
         lambda w: audit.normalize_legacy_quality(fixtures.legacy_quality(w.spark, w.sf_dir), "silver").select(*_LEGACY),
         f"SELECT {', '.join(_LEGACY)} FROM legacy")


@query("merge_quality", """
WITH unified AS (SELECT event_id, execution_id, layer, concat(service, '_trips') AS dataset_name, rule_code, status,
    ts AS checked_at, service, '2024' AS year, CAST(m AS VARCHAR) AS month FROM log
  QUALIFY row_number() OVER (PARTITION BY event_id % 997 ORDER BY ts DESC, event_id DESC) = 1),
both_stores AS (SELECT event_id, execution_id, layer, dataset_name, rule_code, status, checked_at, service, year, month FROM unified
  UNION ALL SELECT event_id, execution_id, layer, dataset_name, rule_code, status, checked_at, service, '', '' FROM legacy)
SELECT event_id, execution_id, layer, dataset_name, rule_code, status FROM both_stores
QUALIFY row_number() OVER (PARTITION BY execution_id, layer, dataset_name, rule_code, service, year, month
  ORDER BY checked_at DESC, event_id DESC) = 1""")
def _(w):
    merged = audit.merge_quality([_quality(w)], {"silver": fixtures.legacy_quality(w.spark, w.sf_dir)})
    return merged.select("event_id", "execution_id", "layer", "dataset_name", "rule_code", "status")


BLOCKS["errors"] = """
SELECT event_id, execution_id, layer, dataset_name, rule_code, attempt_number, service, month, source, happened FROM (
  SELECT event_id, execution_id, 'bronze' AS layer, '' AS dataset_name, '' AS rule_code, CAST(attempt_number AS VARCHAR) AS attempt_number,
    service, CAST(month AS VARCHAR) AS month, 'attempt' AS source, attempted_at AS happened FROM attempts WHERE outcome = 'EXHAUSTED'
  UNION ALL SELECT event_id, execution_id, layer, concat(service, '_trips'), '', '', '', '', 'dataset_event', NULL FROM log WHERE status = 'FAILED'
  UNION ALL SELECT event_id, execution_id, layer, concat(service, '_trips'), rule_code, '', '', '', 'quality_event', NULL FROM log WHERE status = 'FAILED')"""


@query("consolidated_errors", """
SELECT event_id, execution_id, layer, source FROM errors QUALIFY row_number() OVER (PARTITION BY execution_id, layer, dataset_name,
  rule_code, attempt_number, service, month ORDER BY happened DESC NULLS LAST, event_id DESC) = 1""")
def _(w):
    found = audit.consolidated_errors({"attempt": _attempts(w), "dataset_event": _datasets(w), "quality_event": _quality(w)})
    return found.select("event_id", "execution_id", "layer", "source")


@query("error_dedupe", """
SELECT max(event_id) AS event_id, execution_id, concat(service, '_trips') AS dataset_name FROM log
WHERE status = 'FAILED' GROUP BY execution_id, layer, service""")
def _(w):
    return audit.dedupe_errors(audit.failed_events(_datasets(w), "dataset_event")).select("event_id", "execution_id", "dataset_name")


# --- reports -----------------------------------------------------------------

register("audit_views", lambda w: audit.audit_kpis(
    _runs(w), _datasets(w), _quality(w), fixtures.coverage_log(w.spark, w.sf_dir)), f"""
SELECT count(*) AS runs,
  (SELECT {rnd("avg(CASE WHEN status IN ('SUCCESS', 'PARTIAL_SUCCESS') THEN 1.0 ELSE 0.0 END)", 'x')} FROM run_state
   WHERE status <> 'RUNNING') AS success_rate,
  {rnd('quantile_cont(nullif(duration_seconds, 0), 0.5)', 'median_duration')},
  (SELECT count(*) FROM log WHERE status = 'FAILED') AS failed_datasets,
  (SELECT count(*) FROM log WHERE status = 'FAILED') AS failed_rules,
  (SELECT CAST(sum(event_id % 4) AS BIGINT) FROM (SELECT max(event_id) AS event_id FROM log GROUP BY layer)) AS missing_expected
FROM run_state""")
register("latest_coverage", lambda w: audit.latest_coverage(fixtures.coverage_log(w.spark, w.sf_dir)).select("layer", "event_id", "missing_count"),
         "SELECT layer, max(event_id) AS event_id, arg_max(event_id % 4, event_id) AS missing_count FROM log GROUP BY layer")


@query("exploded_inventory", f"""
SELECT layer, concat(service, '_trips') AS dataset_name, CAST(sum(event_id % 9) AS BIGINT) AS parquet_files,
  {rnd('sum(value)', 'bytes_on_disk')} FROM log GROUP BY layer, service""")
def _(w):
    per_dataset = _datasets(w).groupBy("layer", "dataset_name").agg(
        F.sum("parquet_files").alias("parquet_files"), F.sum("bytes_on_disk").alias("bytes_on_disk"))
    nested = per_dataset.groupBy("layer").agg(F.collect_list(F.struct("dataset_name", "parquet_files", "bytes_on_disk")).alias("datasets"))
    return audit.exploded_inventory(nested)


# --- written logs ------------------------------------------------------------

@query("event_log_round_trip", f"""
SELECT event_id, execution_id, layer, status, {rnd('duration_seconds')}, written_at FROM log""")
def _(w):
    root = scratch(w, "events")
    log = _log(w).select("event_id", "execution_id", "layer", "status", "duration_seconds", "written_at", "metrics")
    sinks.append_events(log, root, "pipeline_run", at=F.col("written_at"))
    with_layer = files.read_event_log(w.spark, root)
    layer = F.regexp_extract("source_file", "layer=([a-z]+)", 1)
    return with_layer.select("event_id", "execution_id", layer.alias("layer"), "status", "duration_seconds", "written_at")


def event_log(w) -> dict:
    """Event rows of every kind, built from the run log, written and read back."""
    root, log = scratch(w, "frames"), _log(w)
    runs = log.select("execution_id", "layer", F.col("event_type").alias("execution_type"), "metrics", "event_type", "event_id",
                      F.col("ts").alias("started_at"), (F.col("ts") + F.expr("INTERVAL 1 SECOND * (event_id % 90)")).alias("finished_at"),
                      F.when(F.col("event_type") == "error", F.repeat(F.lit("late "), 1000)).alias("error_message"))
    failed = F.col("event_type") == "error"
    events.append(events.runs_started(runs), root, "pipeline_run")
    events.append(events.runs_finished(runs.filter(~failed).withColumn("status", F.lit("SUCCESS"))), root, "pipeline_run")
    events.append(events.runs_finished(runs.filter(failed).drop("metrics"), failed=True), root, "pipeline_run")
    events.append(events.runs_linked(runs.filter("event_id % 10 = 0").select(
        "execution_id", F.concat(F.lit("parent-"), "execution_id").alias("parent_execution_id"), "layer", F.col("finished_at").alias("updated_at"))),
        root, "pipeline_run")
    events.append(events.dataset_events(_datasets(w)), root, "dataset_event")
    events.append(events.quality_events(_quality(w)), root, "quality_event")
    counts = log.select("execution_id", "layer", F.col("ts").alias("checked_at"), (F.col("event_id") % 5).alias("expected_count"),
                        (F.col("event_id") % 4).alias("ready_count"), (F.col("event_id") % 2).alias("not_applicable_count"),
                        (F.col("event_id") % 3).alias("not_published_count"),
                        F.when(F.col("event_id") % 4 == 1, F.array(F.lit("x"))).alias("missing"))
    events.append(events.coverage_snapshots(counts), root, "coverage_snapshot")
    events.append(events.download_attempts(_attempts(w).withColumn("started_at", F.col("attempted_at"))), root, "download_attempt")
    return events.read(w.spark, root)


@query("event_frames", f"""
WITH runs AS (
  SELECT layer, 'RUNNING' AS state, ts AS written_at, 0 AS seconds, 0 AS measure FROM log UNION ALL
  SELECT layer, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END, ts + INTERVAL 1 SECOND * (event_id % 90), event_id % 90,
    CASE WHEN event_type = 'error' THEN 4000 ELSE 0 END FROM log UNION ALL
  SELECT layer, NULL, ts + INTERVAL 1 SECOND * (event_id % 90), 0, 0 FROM log WHERE event_id % 10 = 0),
scoped AS (SELECT *, greatest(event_id % 5 - event_id % 2 - event_id % 3, 0) AS scope, event_id % 4 AS ready, event_id % 4 = 1 AS lacks FROM log),
whole AS (SELECT 'pipeline_run' AS kind, * FROM runs UNION ALL
  SELECT 'dataset_event', layer, status, ts, 0, event_id % 9 FROM log UNION ALL
  SELECT 'quality_event', layer, status, ts, 0, coalesce(affected_rows, 0) FROM log UNION ALL
  SELECT 'coverage_snapshot', layer, CASE WHEN scope = 0 THEN 'NO_SCOPE' WHEN NOT lacks AND ready >= scope THEN 'COMPLETE' ELSE 'PARTIAL' END, ts,
    CASE WHEN scope > 0 THEN ready / scope ELSE 0 END, CASE WHEN lacks THEN 1 ELSE 0 END FROM scoped UNION ALL
  SELECT 'download_attempt', 'bronze', CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'error' THEN 'EXHAUSTED' ELSE 'RETRY' END, ts,
    coalesce(duration_seconds, 0), event_id % 4 FROM log)
SELECT kind, layer, state, count(*) AS n, min(written_at) AS first_written, {rnd('sum(seconds)', 'seconds')},
  CAST(sum(measure) AS BIGINT) AS measure FROM whole GROUP BY ALL""")
def _(w):
    log = event_log(w)
    picked = {  # state, seconds and measure of each kind
        "pipeline_run": ("status", "duration_seconds", F.length("error_message")), "dataset_event": ("status", F.lit(0.0), "parquet_files"),
        "quality_event": ("status", F.lit(0.0), "failed_rows"), "coverage_snapshot": ("status", "coverage_rate", "missing_count"),
        "download_attempt": ("outcome", "duration_seconds", "retry_number")}
    frames = []
    for kind, (state, seconds, measure) in picked.items():
        seconds, measure = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)) for c in (seconds, measure))
        frames.append(log[kind].select(
            F.lit(kind).alias("kind"), "layer", F.col(state).alias("state"), "written_at", seconds.cast("double").alias("s"), measure.cast("long").alias("m")))
    return audit.union_all(frames).groupBy("kind", "layer", "state").agg(
        F.count(F.lit(1)).alias("n"), F.min("written_at").alias("first_written"), F.sum("s").alias("seconds"), F.sum("m").alias("measure"))


def _manifests(w):
    root = scratch(w, "manifests")
    fixtures.manifests(w.spark, w.sf_dir).write.option("timestampNTZFormat", sinks.MICROSECONDS).json(root)
    return files.read_manifests(w.spark, root, fixtures.MANIFEST_DDL, one_per_file=False)


register("read_manifests", lambda w: audit.manifest_runs(_manifests(w)), f"""
SELECT coalesce(CASE WHEN event_id % 2 = 0 THEN concat('m-', event_id) END, concat('r-', event_id)) AS execution_id,
  ['bronze', 'silver', 'gold', 'ml'][1 + user_id % 4] AS layer, status, ts AS started_at,
  ts + INTERVAL 1 SECOND * (event_id % 90) AS finished_at,
  {rnd('CASE WHEN event_id % 3 = 0 THEN value ELSE event_id % 90 END', 'duration_seconds')},
  {rnd('CASE WHEN user_id % 4 = 0 THEN event_id % 10 END', 'source_files')},
  {rnd("CASE user_id % 4 WHEN 0 THEN event_id % 9 WHEN 1 THEN event_id % 9 WHEN 2 THEN event_id % 30 ELSE event_id % 4 END", 'processed_files')},
  {rnd("CASE WHEN user_id % 4 < 2 THEN event_id % 4 WHEN user_id % 4 = 2 THEN event_id % 5 ELSE event_id % 3 END", 'failed_files')},
  {rnd('event_id * 10', 'rows_input')},
  {rnd('''CASE WHEN event_id % 17 = 0 THEN 0.5
    WHEN user_id % 4 = 0 THEN (event_id % 4) / nullif(event_id % 10, 0)
    WHEN user_id % 4 = 2 THEN (event_id % 5) / nullif(event_id % 30 + event_id % 5, 0)
    WHEN user_id % 4 = 3 THEN (event_id % 3) / nullif(event_id % 4 + event_id % 3, 0) END''', 'error_rate')}
FROM log""")
register("manifest_errors", lambda w: audit.manifest_errors(_manifests(w)).select("execution_id", "status", "error_type", "error_message", "subject"), """
SELECT coalesce(CASE WHEN event_id % 2 = 0 THEN concat('m-', event_id) END, concat('r-', event_id)) AS execution_id, s AS status,
  coalesce(t, 'UnknownError') AS error_type, coalesce(msg, '') AS error_message, f AS subject FROM (
  SELECT event_id, status AS s, CASE WHEN event_id % 6 = 0 THEN 'IOError' END AS t, NULL AS msg, concat('f-', event_id) AS f FROM log
  UNION ALL SELECT event_id, 'READY', NULL, CASE WHEN event_id % 10 = 0 THEN 'late' END, concat('g-', event_id) FROM log)
WHERE s = 'FAILED' OR t IS NOT NULL OR msg IS NOT NULL""")
