"""Contracts, expected periods, coverage and the checks that become quality events."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.clean import resolve
from fareflow.spec import DEFAULT_SCOPES, FIELDS, ServiceScope

PERIOD = ("service", "year", "month")
# Response codes of the file server.
NOT_PUBLISHED_CODES = (404, 410)
TEMPORARY_CODES = (202, 403, 429, 500, 502, 503, 504)
TEMPORARY_MESSAGES = ("HTML", "Firma Parquet inválida", "Archivo incompleto")


# --- contracts ---------------------------------------------------------------

def type_name(text: str) -> str:
    """Spark's names for one integer type, spelled one way; parameters are kept."""
    base, bracket, rest = text.strip().lower().partition("(")
    return {"int": "integer", "bigint": "long", "smallint": "short", "tinyint": "byte"}.get(base, base) + bracket + rest


def schema_hash(df: DataFrame) -> str:
    """Hash of names and types; the order of columns and the case of their names don't count."""
    columns = sorted(f"{f.name.lower()}:{type_name(f.dataType.simpleString())}" for f in df.schema.fields)
    return hashlib.sha256("\n".join(columns).encode()).hexdigest()


def contract_problems(df: DataFrame, service: str) -> list[tuple]:
    """(problem, field, column, observed, accepted) from the schema alone."""
    fields, problems = FIELDS[service], []
    for f in fields:
        column = resolve(df.columns, f.aliases)
        if column is None:
            problems.append(("MISSING_REQUIRED" if f.required else "MISSING_OPTIONAL", f.name, None, None, None))
        elif f.required:
            observed = type_name(df.schema[column].dataType.simpleString())
            accepted = [type_name(t) for t in f.accepted]
            if not any(observed == a or observed.startswith(a + "(") for a in accepted):
                problems.append(("TYPE_MISMATCH", f.name, column, observed, ",".join(accepted)))
    known = {a.lower() for f in fields for a in f.aliases}
    problems += [("NEW_COLUMN", None, c, None, None) for c in df.columns if c.lower() not in known]
    return problems


def contract_check(df: DataFrame, service: str) -> DataFrame:
    """Differences between a raw table and its contract, with the rows they concern and the hash of the schema found."""
    report = df.sparkSession.createDataFrame(
        [(service, *p) for p in contract_problems(df, service)],
        "service string, problem string, field string, column string, observed string, accepted string",
    )
    return report.withColumn("rows", df.agg(F.count(F.lit(1))).scalar()).withColumn("schema_hash", F.lit(schema_hash(df)))


# --- periods -----------------------------------------------------------------

def scope_table(spark: SparkSession, first_year: int, last_year: int,
                scopes: dict[str, ServiceScope] = DEFAULT_SCOPES) -> DataFrame:
    def month(p: tuple[int, int]) -> int:
        return p[0] * 100 + p[1]

    rows = [(s, month(v.available_from), month(v.scope_from), month(v.scope_to), first_year, last_year)
            for s, v in scopes.items()]
    return spark.createDataFrame(rows, "service string, available_from int, scope_from int, scope_to int, "
                                       "first_year int, last_year int")


def expected_periods(scopes: DataFrame, months: Sequence[int] = range(1, 13)) -> DataFrame:
    """Every service, year and month asked for, and whether it lies in the service's scope."""
    grid = scopes.withColumn("year", F.explode(F.sequence("first_year", "last_year"))).withColumn(
        "month", F.explode(F.array(*[F.lit(m) for m in sorted(set(months))]))
    )
    period = F.col("year") * 100 + F.col("month")
    inside = (period >= F.col("available_from")) & period.between(F.col("scope_from"), F.col("scope_to"))
    return grid.select(*PERIOD, inside.alias("applicable"))


def availability_status() -> Column:
    """What a probe of the remote file says about its publication."""
    return (
        F.when(F.col("available"), "AVAILABLE").when(F.col("probe_failed"), "FAILED_TO_PROBE")
        .when(F.col("status_code").isin(*NOT_PUBLISHED_CODES), "NOT_PUBLISHED_YET").otherwise("DEFERRED_REMOTE_ACCESS")
    )


def failure_class(status_code: Column, message: Column) -> Column:
    """Whether a failed download is worth trying again later."""
    temporary = status_code.isin(*TEMPORARY_CODES)
    for text in TEMPORARY_MESSAGES:
        temporary = temporary | message.contains(text)
    return F.when(F.coalesce(temporary, F.lit(False)), "DEFERRED_REMOTE_ACCESS").otherwise("FAILED")


def latest_availability(probes: DataFrame) -> DataFrame:
    return probes.groupBy(*PERIOD).agg(F.max_by(availability_status(), "checked_at").alias("availability"))


def period_states(expected: DataFrame, registry: DataFrame, probes: DataFrame) -> DataFrame:
    """State of each expected period from the file registry and the latest probe."""
    ready = registry.filter("status = 'READY' AND outputs_exist").select(*PERIOD, "sha256").withColumn("ready_file", F.lit(True))
    state = (
        F.when(~F.col("applicable"), "NOT_APPLICABLE").when(F.col("ready_file"), "READY")
        .when(F.col("availability") == "NOT_PUBLISHED_YET", "NOT_PUBLISHED")
        .when(F.col("availability").isin("DEFERRED_REMOTE_ACCESS", "FAILED_TO_PROBE"), "DEFERRED").otherwise("NOT_READY")
    )
    keys = list(PERIOD)
    return expected.join(ready, keys, "left").join(latest_availability(probes), keys, "left").select(
        *PERIOD, state.alias("state"), "sha256"
    )


def coverage(states: DataFrame, by: Sequence[str] = (), not_published_is_missing: bool = False) -> DataFrame:
    """Ready periods over those that could be ready. Periods are calendar months, so the list of missing ones is short."""
    state = F.col("state")
    exempt = ["READY", "NOT_APPLICABLE"] + ([] if not_published_is_missing else ["NOT_PUBLISHED"])
    period = F.format_string("%s-%04d-%02d", *PERIOD)
    counts = states.groupBy(*by).agg(
        F.count(F.lit(1)).alias("expected_count"), F.count_if(state == "READY").alias("ready_count"),
        F.count_if(state == "NOT_APPLICABLE").alias("not_applicable_count"),
        F.count_if(state == "NOT_PUBLISHED").alias("not_published_count"),
        F.count_if(state == "DEFERRED").alias("deferred_count"),
        F.array_sort(F.collect_list(F.when(~state.isin(*exempt), period))).alias("missing"),
    )
    excluded = F.col("not_applicable_count") + (F.lit(0) if not_published_is_missing else F.col("not_published_count"))
    scope = F.greatest(F.col("expected_count") - excluded, F.lit(0))
    complete = (F.size("missing") == 0) & (F.col("ready_count") >= scope)
    return counts.withColumns({
        "missing_count": F.size("missing"),
        "coverage_rate": F.when(scope > 0, F.col("ready_count") / scope),
        "status": F.when(scope == 0, "NO_SCOPE").when(complete, "COMPLETE").otherwise("PARTIAL"),
    })


def missing_periods(expected: DataFrame, registry: DataFrame) -> DataFrame:
    """Applicable periods without a ready file."""
    return expected.filter("applicable").select(*PERIOD).join(
        registry.filter("status = 'READY'").select(*PERIOD), list(PERIOD), "left_anti"
    )


def plan_summary(states: DataFrame, processed: DataFrame) -> DataFrame:
    """What a run would do: periods expected, ready, missing, already done with the same hash, and pending."""
    done = processed.filter("status = 'READY' AND outputs_exist").select(*PERIOD, "sha256").withColumn("done", F.lit(True))
    state = F.col("state")
    ready = F.count_if(state == "READY")
    already = F.count_if((state == "READY") & F.coalesce("done", F.lit(False)))
    return states.join(done, [*PERIOD, "sha256"], "left").groupBy("service").agg(
        F.count(F.lit(1)).alias("expected_periods"), ready.alias("ready_periods"),
        F.count_if(state.isin("NOT_READY", "DEFERRED")).alias("missing_periods"),
        already.alias("already_processed_periods"),
        F.greatest(ready - already, F.lit(0)).alias("pending_periods"),
    )


# --- reconciliation ----------------------------------------------------------

def reconcile_silver(counts: DataFrame, raw_counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Read rows against accepted plus rejected, and against the raw file where its size is known."""
    split_ok = F.col("rows_read") == F.col("rows_valid") + F.col("rows_rejected")
    status = (
        F.when(~split_ok, "UNBALANCED").when(F.col("raw_rows").isNull(), "MATCHED_WITHOUT_BRONZE_METADATA")
        .when(F.col("raw_rows") == F.col("rows_read"), "MATCHED").otherwise("METADATA_MISMATCH")
    )
    return counts.join(raw_counts, list(keys), "left").withColumn("reconciliation_status", status)


def reconcile_gold(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts per period on both sides of a load; a side without the period counts as unknown."""
    left = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    right = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("target_rows"))
    gap = F.col("target_rows") - F.col("source_rows")
    return left.join(right, list(keys), "full").withColumns({
        "difference": gap, "status": F.when(gap == 0, "MATCHED").otherwise("FAILED"),
    })


# --- dataset rules -----------------------------------------------------------

EVENT_COLUMNS = ("layer", "dataset_name", "rule_code", "dimension", "severity", "status", "expected", "actual", "failed_rows")


def quality_events(df: DataFrame, layer: str, code: str, dimension: str, dataset: Column | str, passed: Column,
                   expected: Column | str, actual: Column, failed: Column, severity: str = "ERROR") -> DataFrame:
    """One quality event per row of a table of counts."""
    def text(value) -> Column:
        return F.lit(value) if isinstance(value, str) else value.cast("string")

    columns = {
        "layer": F.lit(layer), "dataset_name": text(dataset), "rule_code": F.lit(code), "dimension": F.lit(dimension),
        "severity": F.lit(severity), "status": F.when(passed, "PASSED").otherwise("FAILED"), "expected": text(expected),
        "actual": text(actual), "failed_rows": F.when(passed, F.lit(0)).otherwise(failed).cast("long"),
    }
    return df.select(*[v.alias(k) for k, v in columns.items()])


def bronze_events(files: DataFrame, cover: DataFrame) -> DataFrame:
    """Contract, content and processing of each file, and whether all expected files are there."""
    name, rows, status = F.col("file_name"), F.col("rows"), F.col("status")
    parts = [
        quality_events(files, "bronze", "BRONZE_SCHEMA_CONTRACT", "validity", name, F.col("contract_ok"),
                       "required columns and compatible types", F.col("contract_ok"), rows),
        quality_events(files, "bronze", "BRONZE_NON_EMPTY_PARQUET", "completeness", name, rows > 0, "> 0 rows", rows, F.lit(1)),
        quality_events(files.filter(status.isin("FAILED", "DEFERRED_REMOTE_ACCESS")), "bronze", "BRONZE_FILE_PROCESSING",
                       "availability", name, F.lit(False), "READY", status, F.lit(None)),
        expected_ready(cover, "bronze", "BRONZE_EXPECTED_DATASETS_READY"),
    ]
    return _union(parts)


def expected_ready(cover: DataFrame, layer: str, code: str) -> DataFrame:
    in_scope = F.greatest(F.col("expected_count") - F.col("not_applicable_count") - F.col("not_published_count"), F.lit(0))
    return quality_events(cover, layer, code, "completeness", f"{layer}_layer", F.col("missing_count") == 0, in_scope,
                          F.col("ready_count"), F.col("missing_count"))


def silver_events(reconciled: DataFrame, skipped: DataFrame, failed: DataFrame, cover: DataFrame) -> DataFrame:
    dataset = F.concat("service_type", F.lit("_trips"))
    accounted = F.col("rows_valid") + F.col("rows_rejected")
    gap = F.abs(F.col("rows_read") - accounted)
    of_file = F.concat("service", F.lit("_trips"))
    return _union([
        quality_events(reconciled, "silver", "SILVER_ROW_RECONCILIATION", "reconciliation", dataset, gap == 0,
                       F.col("rows_read"), accounted, gap),
        quality_events(skipped, "silver", "SILVER_IDEMPOTENT_OUTPUTS_PRESENT", "completeness", of_file, F.lit(True),
                       "curated, rejected and master Parquet present", F.lit(True), F.lit(0)),
        quality_events(failed, "silver", "SILVER_PARTITION_PROCESSING", "reliability", of_file, F.lit(False),
                       "READY", F.col("status"), F.lit(None)),
        expected_ready(cover, "silver", "SILVER_EXPECTED_PARTITIONS_READY"),
    ])


def gold_events(reconciled: DataFrame, datasets: DataFrame) -> DataFrame:
    """Row reconciliation of the fact, files behind each dataset, and datasets without any."""
    files = F.col("parquet_files")
    present = datasets.agg(F.count(F.lit(1)).alias("n"), F.count_if(files > 0).alias("there"))
    missing = F.col("n") - F.col("there")
    return _union([
        quality_events(reconciled, "gold", "GOLD_SILVER_ROW_RECONCILIATION", "reconciliation", "fact_trip_activity",
                       F.coalesce(F.col("difference") == 0, F.lit(False)), F.col("source_rows"), F.col("target_rows"),
                       F.abs("difference")),
        quality_events(datasets, "gold", "GOLD_PHYSICAL_PARQUET", "completeness", F.col("dataset_name"), files > 0,
                       "> 0 parquet files", files, F.lit(1)),
        quality_events(present, "gold", "GOLD_EXPECTED_DATASETS_PRESENT", "completeness", "gold_layer", missing == 0,
                       F.col("n"), F.col("there"), missing),
    ])


def ml_events(models: DataFrame) -> DataFrame:
    """Training, splits and metrics per model. Only models with time splits can have empty ones."""
    name, trained = F.col("model_name"), F.col("status") == "SUCCESS"
    splits = F.least("training_rows", "validation_rows", "test_rows")
    sizes = F.concat_ws("/", *[F.col(f"{s}_rows").cast("string") for s in ("training", "validation", "test")])
    total = models.agg(F.count(F.lit(1)).alias("n"), F.count_if(trained).alias("done"))
    return _union([
        quality_events(models.filter(~trained), "ml", "ML_MODEL_TRAINING", "reliability", name, F.lit(False), "SUCCESS",
                       F.col("status"), F.lit(None)),
        quality_events(models.filter(trained & F.col("has_splits")), "ml", "ML_TEMPORAL_SPLITS_NON_EMPTY", "completeness",
                       name, splits > 0, "training, validation and test > 0", sizes, F.lit(1)),
        quality_events(models.filter(trained), "ml", "ML_METRICS_RECORDED", "observability", name, F.col("metric_count") > 0,
                       "> 0 metrics", F.col("metric_count"), F.lit(1)),
        quality_events(total, "ml", "ML_EXPECTED_MODELS_TRAINED", "completeness", "ml_layer", F.col("n") == F.col("done"),
                       F.col("n"), F.col("done"), F.col("n") - F.col("done")),
    ])


def reference_events(zones: DataFrame, bases: DataFrame, min_zones: int = 260) -> DataFrame:
    """Lookups must be complete enough to judge trips by."""
    rows = F.col("rows")
    counted = [df.agg(F.count(F.lit(1)).alias("rows")) for df in (zones, bases)]
    return _union([
        quality_events(counted[0], "silver", "REFERENCE_ZONES_COMPLETE", "completeness", "taxi_zones", rows >= min_zones,
                       f">= {min_zones} rows", rows, F.lit(min_zones) - rows),
        quality_events(counted[1], "silver", "REFERENCE_BASES_PRESENT", "completeness", "base_lookup", rows > 0,
                       "> 0 rows", rows, F.lit(1)),
    ])


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part)
    return whole
