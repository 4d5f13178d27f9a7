"""Adapters from the star-schema test tables to raw trips, lookups and run logs.

An integer ``h`` per line spreads the injected defects, as FIXTURES.md describes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import prepare


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    reader = prepare(spark).read
    if path not in _SCHEMAS:
        _SCHEMAS[path] = reader.parquet(path).schema
    return reader.schema(_SCHEMAS[path]).parquet(path)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order date; every 101st ``h`` arrives twice."""
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey")  # as the join below needs it where it shuffles
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return (
        joined.withColumn("h", F.expr("l_partkey * 37 + l_linenumber * 101 + l_suppkey * 13"))
        .withColumn("copy_no", F.explode(F.expr("sequence(1, if(h % 101 = 0, 2, 1))")))
    )


_TIMED = {
    "pickup": """CASE WHEN h % 211 = 0 THEN NULL WHEN h % 97 = 0 THEN o_orderdate + INTERVAL '40' DAY
                 ELSE o_orderdate + INTERVAL '1' MINUTE * (h % 1440) END""",
    "dur": """CAST((l_quantity - 2) * 60 * (1 + l_linenumber) AS BIGINT)
              + CASE WHEN h % 89 = 0 THEN 100000 ELSE 0 END""",
    "dist": """CASE WHEN h % 227 = 0 THEN NULL WHEN h % 83 = 0 THEN 1500D
               ELSE CAST(floor(l_quantity * l_discount * 400) AS DOUBLE) / 100D END""",
    "fare": "CASE WHEN h % 79 = 0 THEN -1 ELSE 1 END * CAST(floor(l_extendedprice / 2.5D) AS DOUBLE) / 100D",
    "pu_id": "CAST(1 + l_partkey % 268 AS INT)",
    "do_id": "CAST(1 + (l_partkey * 3 + l_suppkey) % 266 AS INT)",
}
_RAW = {
    "dropoff": "CASE WHEN h % 199 = 0 THEN NULL ELSE pickup + INTERVAL '1' SECOND * dur END",
    "tip": "CASE WHEN h % 73 = 0 THEN fare + 60 ELSE CAST(floor(fare * l_tax * 400) AS DOUBLE) / 100D END",
    "tolls": "CAST(CASE WHEN h % 71 = 0 THEN 45 ELSE 0 END AS DOUBLE)",
    "extra": "CAST(CASE WHEN h % 67 = 0 THEN -1 ELSE h % 3 END AS DOUBLE)",
    "passenger_count": """CASE WHEN h % 61 = 0 THEN NULL WHEN h % 59 = 0 THEN 0D WHEN h % 53 = 0 THEN 9D
                          ELSE CAST(l_linenumber AS DOUBLE) END""",
    "vendor": "CASE l_suppkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 7 END",
    "rate_code": "CAST(1 + l_linenumber AS BIGINT)",
    "payment": "CAST(l_linenumber AS BIGINT)",
    "trip_type": "CAST(l_linenumber % 3 AS BIGINT)",
    "flag_text": "CASE h % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'n' WHEN 2 THEN ' N ' WHEN 3 THEN 'X' END",
    "sr_flag": "CASE h % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '1.0' WHEN 3 THEN 'X' END",
    "base_num": "CASE WHEN h % 47 = 0 THEN NULL ELSE concat(' b', lpad(CAST(l_suppkey AS STRING), 5, '0'), ' ') END",
    "base_num2": "concat('B', lpad(CAST((l_suppkey + 1) % 1000 AS STRING), 5, '0'))",
    "hv_license": """CASE WHEN h % 43 = 0 THEN NULL ELSE CASE l_suppkey % 5 WHEN 0 THEN 'HV0002'
                     WHEN 1 THEN 'HV0003' WHEN 2 THEN 'HV0004' WHEN 3 THEN 'HV0005' ELSE 'HV9999' END END""",
    "request_ts": """CASE WHEN h % 41 = 0 THEN pickup + INTERVAL '60' SECOND
                     ELSE pickup - INTERVAL '1' SECOND * (h % 1500) END""",
    "on_scene_ts": """CASE WHEN h % 31 = 0 THEN NULL WHEN h % 37 = 0 THEN pickup + INTERVAL '30' SECOND
                      ELSE pickup - INTERVAL '1' SECOND * (h % 300) END""",
    "trip_time": "CASE WHEN h % 29 = 0 THEN 0 WHEN h % 23 = 0 THEN dur + 700 ELSE dur END",
    "share_match": "CASE h % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'q' END",
    "wav_req": "CASE h % 7 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'Z' END",
    "wav_match": "CASE h % 11 WHEN 0 THEN 'Y' WHEN 1 THEN 'Z' ELSE 'N' END",
    "access_flag": "CASE h % 17 WHEN 0 THEN 'Y' WHEN 1 THEN 'Z' ELSE 'N' END",
    "total_present": "CASE WHEN h % 229 = 0 THEN NULL ELSE 1 END",
}
_COMMON = {
    "source_year": "year(o_orderdate)",
    "source_month": "month(o_orderdate)",
    "source_record": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, to_date(l_shipdate), copy_no)",
}
_RESIDUE = {"yellow": 0, "green": 1, "fhv": 2, "fhvhv": 3}


def _taxi_names(prefix: str) -> dict[str, str]:
    return {
        "VendorID": "vendor",
        f"{prefix}_pickup_datetime": "pickup",
        f"{prefix}_dropoff_datetime": "dropoff",
        "passenger_count": "passenger_count",
        "trip_distance": "dist",
        "RatecodeID": "rate_code",
        "store_and_fwd_flag": "flag_text",
        "PULocationID": "pu_id",
        "DOLocationID": "do_id",
        "payment_type": "payment",
        "fare_amount": "fare",
        "extra": "extra",
        "mta_tax": "0.5D",
        "tip_amount": "tip",
        "tolls_amount": "tolls",
        "improvement_surcharge": "1.0D",
        "congestion_surcharge": "2.5D",
        "cbd_congestion_fee": "0.0D",
        "total_amount": "CASE WHEN total_present = 1 THEN fare + tip + tolls + extra + 5.75D END",
    }


_NAMES = {
    "yellow": {**_taxi_names("tpep"), "Airport_fee": "1.75D"},
    "green": {**_taxi_names("lpep"), "trip_type": "trip_type", "ehail_fee": "0.0D"},
    "fhv": {
        "dispatching_base_num": "base_num",
        "pickup_datetime": "pickup",
        "dropOff_datetime": "dropoff",
        "PUlocationID": "CAST(pu_id AS DOUBLE)",
        "DOlocationID": "CAST(do_id AS DOUBLE)",
        "SR_Flag": "sr_flag",
        "Affiliated_base_number": "base_num2",
    },
    "fhvhv": {
        "hvfhs_license_num": "hv_license",
        "dispatching_base_num": "base_num",
        "originating_base_num": "base_num2",
        "request_datetime": "request_ts",
        "on_scene_datetime": "on_scene_ts",
        "pickup_datetime": "pickup",
        "dropoff_datetime": "dropoff",
        "PULocationID": "pu_id",
        "DOLocationID": "do_id",
        "trip_miles": "dist",
        "trip_time": "trip_time",
        "base_passenger_fare": "fare",
        "tolls": "tolls",
        "bcf": "0.75D",
        "sales_tax": "extra",
        "congestion_surcharge": "2.75D",
        "airport_fee": "2.5D",
        "tips": "tip",
        "driver_pay": "fare",
        "shared_request_flag": "flag_text",
        "shared_match_flag": "share_match",
        "access_a_ride_flag": "access_flag",
        "wav_request_flag": "wav_req",
        "wav_match_flag": "wav_match",
    },
}


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def raw_trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw table of one service, all periods, under its published column names."""
    lines = _lines(spark, sf_dir).filter(F.expr(f"l_orderkey % 4 = {_RESIDUE[service]}"))
    wide = lines.selectExpr("*", *_named(_TIMED)).selectExpr("*", *_named(_RAW))
    return wide.selectExpr(*_named(_NAMES[service]), *_named(_COMMON))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones 1..263, each belonging to a nation and so to a region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    homes = nation.join(region, nation.n_regionkey == region.r_regionkey)
    ids = F.expr("filter(sequence(0, 263), i -> i > 0 AND i % 25 = n_nationkey)")
    return homes.select(F.explode(ids).alias("location_id"), "r_name").selectExpr(
        "location_id",
        "r_name AS borough",
        "concat('Zone ', location_id) AS zone_name",
        "CASE location_id % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone' ELSE 'Airports' END AS service_zone",
    )


def bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").filter("s_suppkey % 10 <> 9").selectExpr(
        "concat('B', lpad(CAST(s_suppkey AS STRING), 5, '0')) AS base_license_number",
        "s_name AS base_name",
        "concat('DBA ', s_name) AS doing_business_as",
        "CASE s_suppkey % 3 WHEN 0 THEN 'BLACK-CAR' WHEN 1 THEN 'LIVERY' ELSE 'LUXURY' END AS base_type",
        "CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status",
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream as trip activity on five zones and four services."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts AS pickup_datetime",
        "CAST(1 + user_id % 5 AS INT) AS pickup_zone_key",
        "CASE user_id % 4 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' WHEN 2 THEN 'fhv' ELSE 'fhvhv' END AS service_type",
        "CAST(1 AS BIGINT) AS trip_count",
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream as a run log: patches of pipeline runs in write order."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts AS written_at",
        "concat('run-', user_id) AS execution_id",
        """CASE WHEN event_id % 13 = 0 THEN 'unknown'
                ELSE element_at(array('bronze', 'silver', 'gold', 'ml'), CAST(1 + user_id % 4 AS INT)) END AS layer""",
        """CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'RUNNING' WHEN 'view' THEN 'SUCCESS'
                           ELSE 'PARTIAL_SUCCESS' END AS status""",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS duration_seconds",
        "CASE WHEN event_id % 7 = 0 THEN ts END AS started_at",
        "CASE WHEN event_id % 11 = 0 THEN ts END AS finished_at",
        "map(event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END, 'last', CAST(event_id AS DOUBLE)) AS metrics",
        "CAST(event_id % 4 AS INT) AS attempt_number",
        "concat('RULE_', event_id % 6) AS rule_code",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 4 END AS affected_rows",
        "user_id",
        "event_type",
        "value",
        "ts",
    )


# --- ingestion and audit records --------------------------------------------

_SERVICE = "element_at(array('yellow', 'green', 'fhv', 'fhvhv'), CAST(1 + {0} % 4 AS INT))"


def file_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per service and month of the order lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    counted = lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        f"{_SERVICE.format('l_orderkey')} AS service", "year(o_orderdate) AS year", "month(o_orderdate) AS month",
        "o_orderdate",
    ).groupBy("service", "year", "month").agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderdate").alias("ingested_at"))
    return counted.selectExpr(
        "*", "sha2(concat_ws('|', service, year, month, rows), 256) AS sha256",
        "CASE WHEN month % 5 = 0 THEN 'FAILED' ELSE 'READY' END AS status", "month % 7 <> 0 AS outputs_exist",
    )


def probe_results(registry: DataFrame) -> DataFrame:
    """Two probes of every file."""
    twice = registry.selectExpr("service", "year", "month", "rows", "ingested_at", "explode(array(1, 2)) AS k")
    code = "CASE (month + k * year) % 6 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN 410 ELSE 200 END"
    return twice.selectExpr(
        "service", "year", "month", f"{code} AS status_code", f"{code} = 200 AS available",
        "(rows + k) % 11 = 0 AS probe_failed", "ingested_at + INTERVAL '1' HOUR * k AS checked_at",
    )


def incoming_files(registry: DataFrame) -> DataFrame:
    """Files offered again; every fourth month with new content."""
    return registry.selectExpr(
        "service", "year", "month",
        "CASE WHEN month % 4 = 0 THEN sha2(concat(sha256, 'new'), 256) ELSE sha256 END AS sha256",
    )


def period_scopes(registry: DataFrame) -> DataFrame:
    """Scope of each service: from its third month on record to its last."""
    return registry.groupBy("service").agg(
        F.expr("CAST(min(year * 100 + month) AS INT)").alias("available_from"),
        F.expr("CAST(min(year * 100 + month) + 2 AS INT)").alias("scope_from"),
        F.expr("CAST(max(year * 100 + month) AS INT)").alias("scope_to"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log(spark, sf_dir).selectExpr("*", f"{_SERVICE.format('user_id')} AS service", "1 + user_id % 12 AS m")


def download_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id", "execution_id", "'bronze' AS layer", "service", "2024 AS year", "m AS month",
        "CAST(event_id % 4 + 1 AS INT) AS attempt_number",
        "CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'error' THEN 'EXHAUSTED' ELSE 'RETRY' END AS outcome",
        "CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'error' THEN 'EXHAUSTED' ELSE 'RETRY' END AS status",
        "duration_seconds", "value * 1000 AS bytes_downloaded", "ts AS attempted_at",
    )


def legacy_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id", "execution_id", "service", "rule_code", "affected_rows", "ts AS recorded_at",
        "CASE WHEN event_id % 3 = 0 THEN 'ERROR' ELSE 'WARNING' END AS severity",
    )


def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id", "concat('q-', event_id % 997) AS quality_id", "execution_id", "layer",
        "concat(service, '_trips') AS dataset_name", "rule_code", "status", "ts AS checked_at",
        "CAST(affected_rows AS DOUBLE) AS failed_rows",
        "map('service', service, 'year', '2024', 'month', CAST(m AS STRING)) AS context",
    )


def dataset_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id", "execution_id", "layer", "concat(service, '_trips') AS dataset_name", "status", "ts AS recorded_at",
        "event_id % 9 AS parquet_files", "value AS bytes_on_disk",
    )


def coverage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr("event_id", "execution_id", "layer", "ts AS checked_at", "event_id % 4 AS missing_count")


def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "execution_id",
        "element_at(array('READY', 'FAILED', 'SKIPPED_UNCHANGED', 'READY'), CAST(1 + event_id % 4 AS INT)) AS status",
        "CAST(event_id % 3 AS INT) AS attempt_count", "event_id % 1000 AS rows_read", "value * 1000 AS bytes_downloaded",
        "CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS duration_seconds",
    )


def stage_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id AS attempt_id", "execution_id", "layer", "event_type AS stage", "concat('s', event_id % 3) AS subject",
        "ts AS started_at",
    )


def stage_finishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter("event_id % 4 <> 0").selectExpr(
        "event_id AS attempt_id", "ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) AS finished_at", "status",
    )


MANIFEST_DDL = (
    "summary struct<execution_id: string, run_id: string, layer: string, status: string, started_at: timestamp_ntz, "
    "finished_at: timestamp_ntz, duration_seconds: double, source_files: bigint, processed_files: bigint, "
    "ready_files: bigint, failed_files: bigint, datasets_built: bigint, failed_datasets: bigint, trained_models: bigint, "
    "failed_models: bigint, rows_read: bigint, error_rate: double>, "
    "files array<struct<file_name: string, status: string, error_type: string, error_message: string>>"
)


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested run manifest per event; each layer fills its own counters."""
    def only(layer: str, value: str) -> str:
        return f"CASE WHEN user_id % 4 = {layer} THEN {value} END"

    return _events(spark, sf_dir).selectExpr(
        "named_struct('execution_id', CASE WHEN event_id % 2 = 0 THEN concat('m-', event_id) END, "
        "'run_id', concat('r-', event_id), "
        "'layer', element_at(array('bronze', 'silver', 'gold', 'ml'), CAST(1 + user_id % 4 AS INT)), 'status', status, "
        "'started_at', ts, 'finished_at', ts + INTERVAL '1' SECOND * (event_id % 90), "
        "'duration_seconds', CASE WHEN event_id % 3 = 0 THEN value END, "
        f"'source_files', {only('0', 'event_id % 10')}, 'processed_files', {only('1', 'event_id % 9')}, "
        f"'ready_files', {only('0', 'event_id % 9')}, 'failed_files', CASE WHEN user_id % 4 < 2 THEN event_id % 4 END, "
        f"'datasets_built', {only('2', 'event_id % 30')}, 'failed_datasets', {only('2', 'event_id % 5')}, "
        f"'trained_models', {only('3', 'event_id % 4')}, 'failed_models', {only('3', 'event_id % 3')}, "
        "'rows_read', event_id * 10, 'error_rate', CASE WHEN event_id % 17 = 0 THEN 0.5D END) AS summary",
        "array(named_struct('file_name', concat('f-', event_id), 'status', status, 'error_type', "
        "CASE WHEN event_id % 6 = 0 THEN 'IOError' END, 'error_message', CAST(NULL AS STRING)), "
        "named_struct('file_name', concat('g-', event_id), 'status', 'READY', 'error_type', CAST(NULL AS STRING), "
        "'error_message', CASE WHEN event_id % 10 = 0 THEN 'late' END)) AS files",
    )
