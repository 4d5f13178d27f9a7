"""Sources, sinks, contracts, periods, coverage and dataset rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.audit import scratch
from checks.blocks import BLOCKS, MART_BLOCKS, SERVICES, rnd
from checks.registry import query, register
from checks.silver import PERIOD, PERIOD_SQL, all_flagged
from fareflow.operators import quality
from fareflow.plans import ingestion, marts, trips
from fareflow.sources import file_facts, files, fixtures, sinks

from fareflow.streaming.incremental import incremental_trips

_P = list(ingestion.PERIOD)


def _registry(w):
    return fixtures.file_registry(w.spark, w.sf_dir)


def _expected(registry):
    return ingestion.expected_periods(fixtures.period_scopes(registry))


def _states(w):
    registry = _registry(w)
    return ingestion.period_states(_expected(registry), registry, fixtures.probe_results(registry))


BLOCKS["registry"] = """
SELECT *, sha256(concat_ws('|', service, year, month, rows)) AS sha256,
  CASE WHEN month % 5 = 0 THEN 'FAILED' ELSE 'READY' END AS status, month % 7 <> 0 AS outputs_exist
FROM (SELECT ['yellow', 'green', 'fhv', 'fhvhv'][1 + l_orderkey % 4] AS service, CAST(year(o_orderdate) AS INT) AS year,
    CAST(month(o_orderdate) AS INT) AS month, count(*) AS rows, max(o_orderdate) AS ingested_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""
BLOCKS["probes"] = """
SELECT *, code = 200 AS available, CASE WHEN code = 200 THEN 'AVAILABLE' WHEN probe_failed THEN 'FAILED_TO_PROBE'
  WHEN code IN (404, 410) THEN 'NOT_PUBLISHED_YET' ELSE 'DEFERRED_REMOTE_ACCESS' END AS availability
FROM (SELECT service, year, month, k, ingested_at + INTERVAL 1 HOUR * k AS checked_at, (rows + k) % 11 = 0 AS probe_failed,
    CASE (month + k * year) % 6 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN 410 ELSE 200 END AS code
  FROM registry, (VALUES (1), (2)) t(k))"""
BLOCKS["expected"] = """
SELECT service, CAST(y AS INT) AS year, CAST(m AS INT) AS month,
  y * 100 + m >= lo AND y * 100 + m >= lo + 2 AND y * 100 + m <= hi AS applicable
FROM (SELECT service, min(year * 100 + month) AS lo, max(year * 100 + month) AS hi, min(year) AS y0, max(year) AS y1
      FROM registry GROUP BY service), range(1900, 2100) t(y), range(1, 13) u(m) WHERE y BETWEEN y0 AND y1"""
BLOCKS["states"] = """
SELECT e.service, e.year, e.month, r.sha256, CASE WHEN NOT applicable THEN 'NOT_APPLICABLE' WHEN r.service IS NOT NULL THEN 'READY'
  WHEN p.availability = 'NOT_PUBLISHED_YET' THEN 'NOT_PUBLISHED'
  WHEN p.availability IN ('DEFERRED_REMOTE_ACCESS', 'FAILED_TO_PROBE') THEN 'DEFERRED' ELSE 'NOT_READY' END AS state
FROM expected e LEFT JOIN (SELECT * FROM registry WHERE status = 'READY' AND outputs_exist) r USING (service, year, month)
LEFT JOIN (SELECT * FROM probes WHERE k = 2) p USING (service, year, month)"""

register("expected_periods", lambda w: _expected(_registry(w)), "SELECT * FROM expected")
register("availability_status", lambda w: fixtures.probe_results(_registry(w)).select(
    *_P, "status_code", ingestion.availability_status().alias("availability")),
    "SELECT service, year, month, CAST(code AS INT) AS status_code, availability FROM probes")
register("failure_class", lambda w: fixtures.probe_results(_registry(w)).select(
    *_P, "checked_at", ingestion.failure_class(F.col("status_code"), F.when(F.col("probe_failed"), "Archivo incompleto")).alias("failure")),
    """SELECT service, year, month, checked_at, CASE WHEN code = 503 OR probe_failed THEN 'DEFERRED_REMOTE_ACCESS' ELSE 'FAILED' END
  AS failure FROM probes""")
register("period_coverage_join", _states, "SELECT * FROM states")
_MISSING = "state IN ('DEFERRED', 'NOT_READY')"
register("coverage", lambda w: ingestion.coverage(_states(w), ["service"]), f"""
SELECT service, expected_count, ready_count, not_applicable_count, not_published_count, deferred_count,
  array_to_string(missing, '|') AS missing, CAST(len(missing) AS INT) AS missing_count,
  {rnd('CASE WHEN scope > 0 THEN ready_count / scope END', 'coverage_rate')},
  CASE WHEN scope = 0 THEN 'NO_SCOPE' WHEN len(missing) = 0 AND ready_count >= scope THEN 'COMPLETE' ELSE 'PARTIAL' END AS status
FROM (SELECT *, greatest(expected_count - not_applicable_count - not_published_count, 0) AS scope FROM (
  SELECT service, count(*) AS expected_count, count(*) FILTER (state = 'READY') AS ready_count,
    count(*) FILTER (state = 'NOT_APPLICABLE') AS not_applicable_count, count(*) FILTER (state = 'NOT_PUBLISHED') AS not_published_count,
    count(*) FILTER (state = 'DEFERRED') AS deferred_count,
    list_sort(coalesce(list(printf('%s-%04d-%02d', service, year, month)) FILTER ({_MISSING}), [])) AS missing
  FROM states GROUP BY service))""")
register("missing_periods", lambda w: ingestion.missing_periods(_expected(_registry(w)), _registry(w)), """
SELECT service, year, month FROM expected WHERE applicable EXCEPT SELECT service, year, month FROM registry WHERE status = 'READY'""")
register("plan_summary", lambda w: ingestion.plan_summary(
    _states(w), sinks.merge_registry(_registry(w), fixtures.incoming_files(_registry(w)).filter("month % 4 = 0").withColumns({
        "rows": F.lit(0).cast("long"), "ingested_at": F.lit(None).cast("timestamp_ntz"), "status": F.lit("READY"),
        "outputs_exist": F.lit(True)}))), f"""
SELECT service, count(*) AS expected_periods, count(*) FILTER (state = 'READY') AS ready_periods,
  count(*) FILTER ({_MISSING}) AS missing_periods,
  count(*) FILTER (state = 'READY' AND month % 4 <> 0) AS already_processed_periods,
  count(*) FILTER (state = 'READY' AND month % 4 = 0) AS pending_periods FROM states GROUP BY service""")

# --- registry ----------------------------------------------------------------

_NEW_SHA = "CASE WHEN month % 4 = 0 THEN sha256(concat(sha256, 'new')) ELSE sha256 END"
register("pending_files", lambda w: sinks.pending_files(fixtures.incoming_files(_registry(w)), _registry(w)),
         f"SELECT service, year, month, {_NEW_SHA} AS sha256 FROM registry WHERE month % 4 = 0 OR status <> 'READY' OR NOT outputs_exist")


@query("merge_registry", f"""
SELECT service, year, month, {_NEW_SHA} AS sha256, CASE WHEN month % 4 = 0 THEN 'READY' ELSE status END AS status FROM registry""")
def _(w):
    registry = _registry(w).select(*_P, "sha256", "status")
    processed = fixtures.incoming_files(registry).filter("month % 4 = 0").withColumn("status", F.lit("READY"))
    return sinks.merge_registry(registry, processed)


@query("version_history", f"""
SELECT service, year, month, sha256, is_current, CASE WHEN is_current THEN 'CURRENT' ELSE 'ARCHIVED' END AS version_state FROM (
  SELECT service, year, month, sha256, month % 4 <> 0 AS is_current FROM registry UNION ALL
  SELECT service, year, month, {_NEW_SHA}, false FROM registry WHERE month % 4 = 0 UNION ALL
  SELECT service, year, month, sha256, true FROM registry WHERE month % 4 = 0)""")
def _(w):
    first = _registry(w).select(*_P, "sha256", "ingested_at")
    again = fixtures.incoming_files(first).join(first.drop("sha256"), _P).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY"))
    back = again.select(*_P, F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).toDF(*_P, "ingested_at").join(
        first.drop("ingested_at"), _P)  # the first content once more
    return sinks.version_history(first.unionByName(again).unionByName(back)).drop("ingested_at")


# --- contracts ---------------------------------------------------------------

@query("contract_check", """
SELECT 'yellow' AS service, problem, field, col AS column, observed, accepted, n AS rows, sha256(concat_ws(chr(10), 'airport_fee:double',
  'cbd_congestion_fee:double', 'congestion_surcharge:double', 'fare_amount:double', 'improvement_surcharge:double', 'mta_tax:double',
  'passenger_count:double', 'payment_type:long', 'pulocationid:string', 'ratecodeid:long', 'store_and_fwd_flag:string', 'surge:double',
  'tip_amount:double', 'tolls_amount:double', 'total_amount:double', 'tpep_dropoff_datetime:timestamp_ntz',
  'tpep_pickup_datetime:timestamp_ntz', 'trip_distance:double', 'vendorid:integer')) AS schema_hash
FROM (VALUES ('MISSING_REQUIRED', 'dropoff_location_id', NULL, NULL, NULL),
  ('TYPE_MISMATCH', 'pickup_location_id', 'PULocationID', 'string', 'byte,short,integer,integer,long'),
  ('MISSING_OPTIONAL', 'extra', NULL, NULL, NULL), ('NEW_COLUMN', NULL, 'surge', NULL, NULL)) v(problem, field, col, observed, accepted),
  (SELECT count(*) AS n FROM raw WHERE service_type = 'yellow')""")
def _(w):
    raw = w.raw("yellow").drop("source_year", "source_month", "source_record")
    drifted = raw.drop("DOLocationID", "extra").withColumns({
        "PULocationID": F.col("PULocationID").cast("string"), "surge": F.lit(1.0)})
    return ingestion.contract_check(drifted, "yellow")


# --- reconciliation and dataset rules ----------------------------------------

BLOCKS["silver_counts"] = """
SELECT service_type, source_year, source_month, count(*) AS rows_read, count(*) FILTER (n_errors = 0) AS rows_valid,
  count(*) FILTER (n_errors > 0) AS rows_rejected, count(*) FILTER (n_warnings > 0) AS warning_rows FROM all_trips GROUP BY ALL"""


def _silver_reconciled(w):
    counts = quality.quality_counts(all_flagged(w), PERIOD)
    raw = [w.raw(s).groupBy("source_year", "source_month").agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("service_type", F.lit(s))
           for s in SERVICES[:3]]
    return ingestion.reconcile_silver(counts, raw[0].unionByName(raw[1]).unionByName(raw[2]), PERIOD)


register("reconcile_silver", _silver_reconciled, f"""
SELECT {PERIOD_SQL}, rows_read, rows_valid, rows_rejected, warning_rows,
  CASE WHEN service_type <> 'fhvhv' THEN rows_read END AS raw_rows,
  CASE WHEN service_type <> 'fhvhv' THEN 'MATCHED' ELSE 'MATCHED_WITHOUT_BRONZE_METADATA' END AS reconciliation_status
FROM silver_counts""")


def _gold_reconciled(w):
    master = w.master()
    kept = w.fact("trip_activity").filter("NOT (service_type = 'fhv' AND source_month = 2)")
    return ingestion.reconcile_gold(master, kept, PERIOD)


BLOCKS["gold_counts"] = """
SELECT *, CASE WHEN service_type = 'fhv' AND source_month = 2 THEN NULL ELSE source_rows END AS target_rows
FROM (SELECT service_type, source_year, source_month, count(*) AS source_rows FROM master GROUP BY ALL)"""
register("reconcile_gold", _gold_reconciled, """
SELECT *, target_rows - source_rows AS difference, CASE WHEN target_rows = source_rows THEN 'MATCHED' ELSE 'FAILED' END AS status
FROM gold_counts""")


def _event_sql(layer, code, dimension, dataset, passed, expected, actual, failed, source, severity="ERROR"):
    return f"""SELECT '{layer}' AS layer, {dataset} AS dataset_name, '{code}' AS rule_code, '{dimension}' AS dimension,
  '{severity}' AS severity, CASE WHEN {passed} THEN 'PASSED' ELSE 'FAILED' END AS status, CAST({expected} AS VARCHAR) AS expected,
  CAST({actual} AS VARCHAR) AS actual, CAST(CASE WHEN {passed} THEN 0 ELSE {failed} END AS BIGINT) AS failed_rows FROM {source}"""


BLOCKS["cover_all"] = f"""
SELECT count(*) AS expected_count, count(*) FILTER (state = 'READY') AS ready_count,
  count(*) FILTER (state = 'NOT_APPLICABLE') AS not_applicable_count,
  count(*) FILTER (state = 'NOT_PUBLISHED') AS not_published_count, count(*) FILTER ({_MISSING}) AS missing_count FROM states"""


def _expected_sql(layer, code):
    return _event_sql(layer, code, "completeness", f"'{layer}_layer'", "missing_count = 0",
                      "expected_count - not_applicable_count - not_published_count", "ready_count", "missing_count", "cover_all")


_FILE = "concat(service, '_tripdata_', year, '-', lpad(CAST(month AS VARCHAR), 2, '0'), '.parquet')"


def _bronze_files(w):
    name = F.format_string("%s_tripdata_%04d-%02d.parquet", *_P)
    return _registry(w).withColumns({"file_name": name, "contract_ok": F.col("month") % 11 != 0})


register("dataset_rules_bronze", lambda w: ingestion.bronze_events(_bronze_files(w), ingestion.coverage(_states(w))), " UNION ALL ".join([
    _event_sql("bronze", "BRONZE_SCHEMA_CONTRACT", "validity", _FILE, "month % 11 <> 0", "'required columns and compatible types'",
               "month % 11 <> 0", "rows", "registry"),
    _event_sql("bronze", "BRONZE_NON_EMPTY_PARQUET", "completeness", _FILE, "rows > 0", "'> 0 rows'", "rows", "1", "registry"),
    _event_sql("bronze", "BRONZE_FILE_PROCESSING", "availability", _FILE, "false", "'READY'", "status", "NULL",
               "registry WHERE status = 'FAILED'"),
    _expected_sql("bronze", "BRONZE_EXPECTED_DATASETS_READY"),
]))


def _silver_rules(w):
    registry = _registry(w)
    done = registry.filter("status = 'READY' AND outputs_exist")
    return ingestion.silver_events(_silver_reconciled(w), done, registry.filter("status = 'FAILED'"), ingestion.coverage(_states(w)))


register("dataset_rules_silver", _silver_rules, " UNION ALL ".join([
    _event_sql("silver", "SILVER_ROW_RECONCILIATION", "reconciliation", "concat(service_type, '_trips')",
               "rows_read = rows_valid + rows_rejected", "rows_read", "rows_valid + rows_rejected", "1", "silver_counts"),
    _event_sql("silver", "SILVER_IDEMPOTENT_OUTPUTS_PRESENT", "completeness", "concat(service, '_trips')", "true",
               "'curated, rejected and master Parquet present'", "true", "0", "registry WHERE status = 'READY' AND outputs_exist"),
    _event_sql("silver", "SILVER_PARTITION_PROCESSING", "reliability", "concat(service, '_trips')", "false", "'READY'", "status",
               "NULL", "registry WHERE status = 'FAILED'"),
    _expected_sql("silver", "SILVER_EXPECTED_PARTITIONS_READY"),
]))


def _gold_rules(w):
    per_service = w.master().groupBy("service_type").agg(F.countDistinct("source_month").alias("n"))
    datasets = per_service.selectExpr("concat('fact_', service_type) AS dataset_name", "CASE WHEN service_type = 'fhv' THEN 0 ELSE n END AS parquet_files")
    return ingestion.gold_events(_gold_reconciled(w), datasets)


BLOCKS["gold_datasets"] = """
SELECT concat('fact_', service_type) AS dataset_name, CASE WHEN service_type = 'fhv' THEN 0 ELSE count(DISTINCT source_month) END
  AS parquet_files FROM master GROUP BY service_type"""
register("dataset_rules_gold", _gold_rules, " UNION ALL ".join([
    _event_sql("gold", "GOLD_SILVER_ROW_RECONCILIATION", "reconciliation", "'fact_trip_activity'",
               "coalesce(target_rows = source_rows, false)", "source_rows", "target_rows", "abs(target_rows - source_rows)", "gold_counts"),
    _event_sql("gold", "GOLD_PHYSICAL_PARQUET", "completeness", "dataset_name", "parquet_files > 0", "'> 0 parquet files'",
               "parquet_files", "1", "gold_datasets"),
    _event_sql("gold", "GOLD_EXPECTED_DATASETS_PRESENT", "completeness", "'gold_layer'", "n = there", "n", "there", "n - there",
               "(SELECT count(*) AS n, count(*) FILTER (parquet_files > 0) AS there FROM gold_datasets)"),
]))


def _models(w):
    sizes = w.table("events").groupBy("event_type").agg(
        *[F.count_if(F.expr(f"event_id % 7 = {i}")).alias(f"{s}_rows") for i, s in enumerate(("training", "validation", "test"))],
        F.count(F.lit(1)).alias("metric_count"))
    return sizes.selectExpr("event_type AS model_name", "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status",
                            "training_rows", "CASE WHEN event_type = 'click' THEN 0 ELSE validation_rows END AS validation_rows",
                            "test_rows", "metric_count", "event_type <> 'view' AS has_splits")


BLOCKS["models"] = """
SELECT event_type AS model_name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  count(*) FILTER (event_id % 7 = 0) AS a, CASE WHEN event_type = 'click' THEN 0 ELSE count(*) FILTER (event_id % 7 = 1) END AS b,
  count(*) FILTER (event_id % 7 = 2) AS c, count(*) AS metric_count FROM events GROUP BY event_type"""
register("dataset_rules_ml", lambda w: ingestion.ml_events(_models(w)), " UNION ALL ".join([
    _event_sql("ml", "ML_MODEL_TRAINING", "reliability", "model_name", "false", "'SUCCESS'", "status", "NULL", "models WHERE status <> 'SUCCESS'"),
    _event_sql("ml", "ML_TEMPORAL_SPLITS_NON_EMPTY", "completeness", "model_name", "least(a, b, c) > 0",
               "'training, validation and test > 0'", "concat_ws('/', a, b, c)", "1", "models WHERE status = 'SUCCESS' AND model_name <> 'view'"),
    _event_sql("ml", "ML_METRICS_RECORDED", "observability", "model_name", "metric_count > 0", "'> 0 metrics'", "metric_count", "1",
               "models WHERE status = 'SUCCESS'"),
    _event_sql("ml", "ML_EXPECTED_MODELS_TRAINED", "completeness", "'ml_layer'", "n = done", "n", "done", "n - done",
               "(SELECT count(*) AS n, count(*) FILTER (status = 'SUCCESS') AS done FROM models)"),
]))
register("reference_completeness", lambda w: ingestion.reference_events(w.references().zones, w.references().bases), " UNION ALL ".join([
    _event_sql("silver", "REFERENCE_ZONES_COMPLETE", "completeness", "'taxi_zones'", "n >= 260", "'>= 260 rows'", "n", "260 - n",
               "(SELECT count(*) AS n FROM zones)"),
    _event_sql("silver", "REFERENCE_BASES_PRESENT", "completeness", "'base_lookup'", "n > 0", "'> 0 rows'", "n", "1",
               "(SELECT count(*) AS n FROM bases)"),
]))

# --- scans and sinks ---------------------------------------------------------


@query("scan_trips", f"""
SELECT service_type AS source_service, CAST(source_year AS INT) AS source_year, CAST(source_month AS INT) AS source_month,
  concat('yellow_tripdata_', source_year, '-', lpad(CAST(source_month AS VARCHAR), 2, '0'), '.parquet') AS source_file,
  count(*) AS n, count(*) AS records, {rnd('sum(dist)', 'miles')} FROM raw WHERE service_type = 'yellow' GROUP BY ALL""")
def _(w):
    root = scratch(w, "raw")
    raw = w.raw("yellow").drop("source_record")
    named = raw.withColumn("file", F.format_string("yellow_tripdata_%04d-%02d.parquet", "source_year", "source_month"))
    sinks.write_partitions(named.drop("source_year", "source_month"), root, ["file"])
    scanned = files.scan_trips(w.spark, root)
    return scanned.groupBy("source_service", "source_year", "source_month", "source_file").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("source_record").alias("records"), F.sum("trip_distance").alias("miles"))


@query("scan_partitioned", """
SELECT service_type, source_year, count(*) AS n FROM master WHERE service_type = 'green' AND source_year >= 1998 GROUP BY ALL""")
def _(w):
    root = scratch(w, "activity")
    sinks.write_partitions(w.fact("trip_activity"), root, ["service_type", "source_year"])
    green = files.scan_partitioned(w.spark, root, (F.col("service_type") == "green") & (F.col("source_year") >= 1998))
    return green.groupBy("service_type", "source_year").agg(F.count(F.lit(1)).alias("n"))


@query("scan_union_by_name", """
SELECT part, count(*) AS n, count(status) AS statuses, count(priority) AS priorities FROM (
  SELECT 'a' AS part, o_orderstatus AS status, NULL AS priority FROM orders UNION ALL SELECT 'b', NULL, o_orderpriority FROM orders)
GROUP BY part""")
def _(w):
    root = scratch(w, "evolving")
    orders = w.table("orders")
    sinks.write_dataset(orders.select("o_orderkey", F.col("o_orderstatus").alias("status")), f"{root}/part=a")
    sinks.write_dataset(orders.select("o_orderkey", F.col("o_orderpriority").alias("priority")), f"{root}/part=b")
    return files.scan_union_by_name(w.spark, root).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.count("status").alias("statuses"), F.count("priority").alias("priorities"))


@query("empty_like", "SELECT service_type, count(*) AS n FROM master GROUP BY ALL")
def _(w):
    fact = w.fact("trip_activity")
    return files.empty_like(fact).unionByName(fact).groupBy("service_type").agg(F.count(F.lit(1)).alias("n"))


@query("reference_csv_bases", """
SELECT base_license_number, base_name, doing_business_as, base_type, status, CAST(NULL AS VARCHAR) AS telephone FROM bases""")
def _(w):
    root = scratch(w, "bases")
    bases = w.references().bases
    odd = bases.select(
        F.concat(F.lit(" "), F.lower("base_license_number"), F.lit(" ")).alias("License Number"), F.col("base_name").alias("Base Name"),
        F.col("doing_business_as").alias("DBA"), F.col("base_type").alias("Type"), F.col("status").alias("STATUS"))
    doubled = odd.unionByName(odd).unionByName(odd.withColumn("License Number", F.lit(None).cast("string")))
    doubled.write.option("header", True).csv(root)
    return files.normalize_bases(files.reference_csv(w.spark, root))


@query("reference_csv_zones", """
SELECT location_id, borough, zone_name, service_zone, location_id IN (1, 132, 138) AS is_airport,
  CASE location_id WHEN 1 THEN 'Newark Liberty International Airport' WHEN 132 THEN 'John F. Kennedy International Airport'
    WHEN 138 THEN 'LaGuardia Airport' END AS airport_name FROM zones""")
def _(w):
    root = scratch(w, "zones")
    zones = w.references().zones
    zones.select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone_name").alias("Zone"),
                 "service_zone").write.option("header", True).csv(root)
    return files.normalize_zones(files.reference_csv(w.spark, root))


register("reference_key_present",
         lambda w: files.normalize_zones(w.references().zones.select(
             F.when(F.col("location_id") % 10 != 0, F.col("location_id").cast("string")).alias("LocationID"),
             F.col("borough").alias("Borough"), F.col("zone_name").alias("Zone"), "service_zone")).select("location_id", "zone_name"),
         "SELECT location_id, zone_name FROM zones WHERE location_id % 10 <> 0")
register("distinct_by_key",
         lambda w: files.normalize_bases(w.references().bases.unionByName(w.references().bases)).select("base_license_number", "base_name"),
         "SELECT base_license_number, base_name FROM bases")

register("file_fingerprint", lambda w: file_facts.file_fingerprint(w.spark, w.sf_dir))


@query("schema_history", """
WITH periods AS (SELECT DISTINCT service_type AS service, source_year AS year, source_month AS month,
    CASE WHEN source_year < 1997 THEN 1 WHEN source_year < 1999 THEN 2 WHEN source_year < 2000 THEN 3 ELSE 4 END AS era FROM raw),
firsts AS (SELECT service, era, min(year * 100 + month) AS p FROM periods GROUP BY ALL)
SELECT service, CAST(p // 100 AS INT) AS year, CAST(p % 100 AS INT) AS month, 1 AS schemas_in_period,
  CAST(CASE era WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 1 END AS INT) AS n_columns,
  CASE era WHEN 1 THEN 'source_record' WHEN 2 THEN 'surge' ELSE '' END AS added, CASE era WHEN 4 THEN 'surge' ELSE '' END AS removed,
  CASE era WHEN 3 THEN 'surge:int64' ELSE '' END AS retyped FROM firsts""")
def _(w):
    root, period = scratch(w, "drifting"), ["service", "year", "month"]
    trips_ = [w.raw(s).select("source_record", F.lit(s).alias("service"), F.col("source_year").alias("year"), F.col("source_month").alias("month"))
              for s in SERVICES]
    whole = sinks.staged(trips_[0].unionByName(trips_[1]).unionByName(trips_[2]).unionByName(trips_[3]), "raw-periods")
    for where, surge in (("year < 1997", None), ("year IN (1997, 1998)", "int"), ("year = 1999", "bigint"), ("year >= 2000", None)):
        part = whole.filter(where)
        sinks.write_partitions(part if surge is None else part.withColumn("surge", F.col("month").cast(surge)), root, period)
    facts = file_facts.file_facts(w.spark, root, "columns")
    return file_facts.schema_history(file_facts.file_schemas(facts)).drop("schema_hash", "previous_hash", "files").withColumn(
        "schemas_in_period", F.col("schemas_in_period").cast("int"))


def _inventories(w):
    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    return reduce(DataFrame.unionByName, [files.dataset_inventory(w.table(n), n, "raw") for n in names])


register("dataset_inventory", lambda w: _inventories(w).drop("latest_modified_at"))

_HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
BLOCKS["links"] = r"""
SELECT page_id, position, link, lower(regexp_extract(link, '^https?://([^/:?#]+)', 1)) AS host FROM (
  SELECT page_id, position, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
    WHEN starts_with(href, '//') THEN regexp_extract(url, '^(https?:)', 1) || href
    WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || href
    WHEN starts_with(href, '#') THEN regexp_extract(url, '^([^#]*)', 1) || href
    WHEN starts_with(href, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || href
    WHEN href = '' THEN url
    ELSE CASE WHEN ends_with(folder, '/') THEN folder ELSE folder || '/' END || href END AS link
  FROM (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+(?:/[^?#]*/|/)?)', 1) AS folder, trim(h[i]) AS href, i - 1 AS position
    FROM (SELECT page_id, url, regexp_extract_all(html, '""" + _HREF.replace("'", "''") + r"""', 1) AS h FROM pages),
      unnest(range(1, len(h) + 1)) t(i)))
WHERE host <> ''"""
register("links_from_pages", lambda w: files.links_from_pages(w.table("pages")),
         "SELECT page_id, CAST(position AS INT) AS position, link, host FROM links")
_HOSTS = ("m.ththth.example.net", "ththre.example.com")
register("links_to_hosts", lambda w: files.links_from_pages(w.table("pages"), _HOSTS).groupBy("host").agg(F.count(F.lit(1)).alias("n")),
         f"SELECT host, count(*) AS n FROM links WHERE host IN {_HOSTS} GROUP BY ALL")


@query("trip_file_candidates", """
SELECT service, year, month, concat('https://files.example.org/d/', service, '_tripdata_', year, '-',
  lpad(CAST(month AS VARCHAR), 2, '0'), '.parquet') AS url,
  concat(service, '_tripdata_', year, '-', lpad(CAST(month AS VARCHAR), 2, '0'), '.parquet') AS file_name FROM registry""")
def _(w):
    name = F.format_string("%s_tripdata_%04d-%02d.parquet", *_P)
    anchor = F.concat(F.lit('<p><A class="x" HREF="../d/'), name, F.lit('">f</A><a href="/about">a</a></p>'))
    pages = _registry(w).select(F.xxhash64(*_P).alias("page_id"), F.lit("https://files.example.org/d/").alias("url"), F.concat(
        F.lit('<a href="'), name, F.lit('?old=1">old</a>'), F.lit('<a href="/d/'), name, F.lit('">new</a>'), anchor).alias("html"))
    return files.trip_file_candidates(files.links_from_pages(pages, ["files.example.org"]))


@query("write_split", "SELECT 'curated' AS part, source_year, count(*) AS n FROM fhv_trips WHERE n_errors = 0 GROUP BY ALL UNION ALL "
                      "SELECT 'rejected', source_year, count(*) FROM fhv_trips WHERE n_errors > 0 GROUP BY ALL")
def _(w):
    root = sinks.write_split(w.flagged("fhv"), scratch(w, "split"), ["source_year"])
    parts = [sinks.split_part(w.spark, root, n).select(F.lit(n).alias("part"), F.col("source_year").cast("long").alias("source_year"))
             for n in ("curated", "rejected")]
    return parts[0].unionByName(parts[1]).groupBy("part", "source_year").agg(F.count(F.lit(1)).alias("n"))


@query("write_fact", f"""
SELECT service_type, source_year, count(*) AS n, {rnd('sum(total_amount)', 'total')} FROM financial GROUP BY ALL""")
def _(w):
    path = scratch(w, "fact")
    fact = w.fact("taxi_financial")
    sinks.write_fact(fact, path, ("service_type", "source_year"))
    # writing one service again replaces only its own partitions
    sinks.write_fact(fact.filter("service_type = 'green'"), path, ("service_type", "source_year"))
    return w.spark.read.parquet(path).groupBy("service_type", "source_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total"))


@query("write_dataset", "SELECT source_year, source_month, service_type, trip_count FROM m_executive")
def _(w):
    path = scratch(w, "mart")
    for _ in range(2):
        sinks.write_dataset(w.mart("executive_monthly"), path)
    return w.spark.read.parquet(path).select("source_year", "source_month", "service_type", "trip_count")


@query("incremental_trips", """
SELECT CAST(source_year AS INT) AS source_year, count(*) AS n, CAST(sum(n_warnings) AS BIGINT) AS warnings
FROM fhv_trips WHERE n_errors = 0 GROUP BY source_year""")
def _(w):
    root = scratch(w, "stream")
    source, target = f"{root}/raw", f"{root}/trips"
    refs = w.references()
    raw = w.raw("fhv")

    def accepted(df):
        return quality.accepted(trips.flagged_trips(df, "fhv", refs))

    for part in ("source_year <= 1998", "source_year > 1998"):
        sinks.write_partitions(raw.filter(part), source, ["source_year"])
        incremental_trips(w.spark, source, target, f"{root}/checkpoint", accepted)
    return w.spark.read.parquet(target).groupBy("source_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quality_warning_count").alias("warnings"))


@query("publish_marts", " UNION ALL ".join(
    f"SELECT '{name}' AS mart, count(*) AS rows FROM {block}" for name, block in MART_BLOCKS.items()))
def _(w):
    root = scratch(w, "marts")
    paths = marts.publish_marts(w.facts(), w.dim_zone(), root)
    sizes = [w.spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).withColumn("mart", F.lit(n)) for n, p in paths.items()]
    whole = sizes[0]
    for size in sizes[1:]:
        whole = whole.unionByName(size)
    return whole
