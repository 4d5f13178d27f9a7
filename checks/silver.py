"""Raw trips to flagged trips: column builders, rules, lookups, master."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.blocks import SERVICES, rnd, rounded
from checks.registry import query, register
from fareflow.functions import clean as c
from fareflow.operators import quality
from fareflow.plans import trips
from fareflow.spec import SERVICE_KEYS


def _counted(df, *by):
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


# --- column builders ---------------------------------------------------------

@query("col_from_aliases", """
SELECT pu_id AS zone, CAST(dist AS DOUBLE) AS miles, CAST(NULL AS VARCHAR) AS absent, CAST(0 AS DOUBLE) AS fee,
  count(*) AS n
FROM raw WHERE service_type = 'green' GROUP BY ALL""".replace("CAST(dist AS DOUBLE)", "round(dist + 1e-9, 6)"))
def _(w):
    raw = w.raw("green")
    return _counted(raw.select(
        c.typed(raw, ["pulocationid"], "int").alias("zone"),
        c.typed(raw, ["TRIP_DISTANCE"], "double").alias("miles"),
        c.typed(raw, ["no_such_column"], "string").alias("absent"),
        c.typed(raw, ["Airport_fee", "airport_fee"], "double", 0.0).alias("fee"),
    ), "zone", "miles", "absent", "fee")


@query("bad_values_become_null", """
SELECT sr_flag, count(*) AS n, count(TRY_CAST(sr_flag AS DOUBLE)) AS as_double, count(TRY_CAST(base_num AS INT)) AS as_int
FROM raw WHERE service_type = 'fhv' GROUP BY ALL""")
def _(w):
    raw = w.raw("fhv")
    return raw.groupBy(F.col("SR_Flag").alias("sr_flag")).agg(
        F.count(F.lit(1)).alias("n"), F.count(c.typed(raw, ["sr_flag"], "double")).alias("as_double"),
        F.count(c.typed(raw, ["dispatching_base_num"], "int")).alias("as_int"))


@query("normalize_string", """
SELECT flag_text AS raw_text, upper(trim(flag_text)) AS code, count(*) AS n FROM raw WHERE service_type = 'yellow'
GROUP BY ALL""")
def _(w):
    raw = F.col("store_and_fwd_flag")
    return _counted(w.raw("yellow").select(raw.alias("raw_text"), c.code_text(raw).alias("code")), "raw_text", "code")


@query("normalize_yn", """
SELECT CASE WHEN upper(trim(flag_text)) IN ('Y', 'N') THEN upper(trim(flag_text)) END AS yn, count(*) AS n
FROM raw WHERE service_type = 'yellow' GROUP BY ALL""")
def _(w):
    return _counted(w.raw("yellow").select(c.yes_no(F.col("store_and_fwd_flag")).alias("yn")), "yn")


@query("normalize_boolean", """
SELECT sr_flag, CASE WHEN upper(trim(sr_flag)) IN ('Y', 'YES', 'TRUE', '1') THEN true
  WHEN upper(trim(sr_flag)) IN ('N', 'NO', 'FALSE', '0') THEN false END AS truth, count(*) AS n
FROM raw WHERE service_type = 'fhv' GROUP BY ALL""")
def _(w):
    return _counted(w.raw("fhv").select(F.col("SR_Flag").alias("sr_flag"), c.truth(F.col("SR_Flag")).alias("truth")),
                    "sr_flag", "truth")


_DOMAINS = """vendor_id, {0} AS vendor_normalized, rate_code_id, {1} AS rate_code_normalized, payment_type,
  {2} AS payment_type_normalized, store_and_fwd_flag, {3} AS store_flag_normalized, trip_type"""
_DOMAIN_KEYS = ["vendor_id", "vendor_normalized", "rate_code_id", "rate_code_normalized", "payment_type",
                "payment_type_normalized", "store_and_fwd_flag", "store_flag_normalized", "trip_type"]
register("domain_or_default",
         lambda w: _counted(trips.standardize(w.raw("yellow"), "yellow").unionByName(
             trips.standardize(w.raw("green"), "green")), "service_type", *_DOMAIN_KEYS),
         f"""SELECT service_type, {_DOMAINS.format('bad_vendor', 'bad_rate', 'bad_payment', 'bad_store')}, count(*) AS n
FROM (SELECT * FROM yellow_typed UNION ALL BY NAME SELECT * FROM green_typed) GROUP BY ALL""")

register("impute_passengers",
         lambda w: _counted(trips.standardize(w.raw("yellow"), "yellow"), "passenger_count", "passenger_count_imputed"),
         "SELECT passenger_count, passenger_count_imputed, count(*) AS n FROM yellow_typed GROUP BY ALL")

_MONEY = "extra mta_tax tip_amount tolls_amount improvement_surcharge congestion_surcharge airport_fee cbd_congestion_fee"
register("default_money",
         lambda w: trips.standardize(w.raw("green"), "green").groupBy("source_year").agg(
             *[F.sum(m).alias(m) for m in _MONEY.split()], F.count("fare_amount").alias("fares"),
             F.count("total_amount").alias("totals")),
         f"""SELECT CAST(source_year AS INT) AS source_year, {', '.join(rnd(f'sum({m})', m) for m in _MONEY.split())},
  count(fare_amount) AS fares, count(total_amount) AS totals FROM green_typed GROUP BY source_year""")

register("trip_duration_seconds",
         lambda w: trips.standardize(w.raw("fhv"), "fhv").select("source_record", "trip_duration_seconds"),
         "SELECT source_record, CAST(trip_duration_seconds AS BIGINT) AS trip_duration_seconds FROM fhv_typed")

_RATIOS = "average_speed_mph fare_per_mile tip_percentage revenue_per_minute"
register("ratios",
         lambda w: trips.standardize(w.raw("yellow"), "yellow").select("source_record", *_RATIOS.split()),
         f"SELECT source_record, {rounded(_RATIOS)} FROM yellow_typed")

register("airport_flag",
         lambda w: _counted(trips.standardize(w.raw("fhv"), "fhv"), "pickup_location_id", "airport_trip_flag"),
         "SELECT pickup_location_id, airport_trip_flag, count(*) AS n FROM fhv_typed GROUP BY ALL")

_CALENDAR = ["pickup_date", "dropoff_date", "pickup_hour", "pickup_day_of_week", "weekend_trip_flag", "night_trip_flag"]
register("temporal_attrs",
         lambda w: _counted(trips.standardize(w.raw("green"), "green"), *_CALENDAR),
         f"SELECT {', '.join(_CALENDAR)}, count(*) AS n FROM green_typed GROUP BY ALL")


def _each(sql: str) -> str:
    """``sql`` for every service, with {s} for its name."""
    return " UNION ALL ".join(sql.format(s=s) for s in SERVICES)


@query("lineage", _each("""
SELECT '{s}' AS service, concat('feed-', source_year, '-', source_month, '-', length(source_record) % 2, '.parquet') AS source_file,
  sha256(concat('feed-', source_year, '-', source_month, '-', length(source_record) % 2, '.parquet')) AS bronze_sha256,
  CAST(source_year AS INT) AS source_year, CAST(source_month AS INT) AS source_month, 'run-1' AS silver_execution_id,
  count(*) AS n, true AS stamped
FROM {s}_trips WHERE n_errors = 0 GROUP BY ALL"""))
def _(w):
    # two files a period, with names and checksums of their own, carried to the master
    part = F.length("source_record") % 2

    def carried(service: str) -> DataFrame:
        raw = w.raw(service).withColumn("source_file", F.concat_ws(
            "", F.lit("feed-"), "source_year", F.lit("-"), "source_month", F.lit("-"), part, F.lit(".parquet")))
        sums = raw.select("source_file").distinct().withColumn("sha256", F.sha2("source_file", 256))
        df = trips.service_master(raw, service, w.references(), "run-1", checksums=sums)
        return df.groupBy(F.lit(service).alias("service"), "source_file", "bronze_sha256", "source_year", "source_month", "silver_execution_id").agg(
            F.count(F.lit(1)).alias("n"), F.bool_and(F.col("silver_processed_at").isNotNull()).alias("stamped"))
    return reduce(DataFrame.unionByName, map(carried, SERVICES))


for _s in SERVICES:
    register(f"business_id_{_s}",
             lambda w, s=_s: trips.standardize(w.raw(s), s).select("source_record", "trip_business_id"),
             f"SELECT source_record, trip_business_id FROM {_s}_typed")

register("hv_company",
         lambda w: _counted(trips.standardize(w.raw("fhvhv"), "fhvhv"), "hvfhs_license_num", "hvfhs_company_name"),
         "SELECT hvfhs_license_num, hvfhs_company_name, count(*) AS n FROM fhvhv_typed GROUP BY ALL")

register("hv_waits",
         lambda w: trips.standardize(w.raw("fhvhv"), "fhvhv").select(
             "source_record", "request_to_pickup_seconds", "driver_wait_seconds"),
         """SELECT source_record, CAST(request_to_pickup_seconds AS BIGINT) AS request_to_pickup_seconds,
  CAST(driver_wait_seconds AS BIGINT) AS driver_wait_seconds FROM fhvhv_typed""")

_FLAGS = ["shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag",
          "shared_requested", "shared_matched", "access_a_ride", "wav_requested", "wav_matched"]
register("hv_flags", lambda w: _counted(trips.standardize(w.raw("fhvhv"), "fhvhv"), *_FLAGS),
         f"SELECT {', '.join(_FLAGS)}, count(*) AS n FROM fhvhv_typed GROUP BY ALL")

register("fhv_shared_flag",
         lambda w: _counted(trips.standardize(w.raw("fhv"), "fhv"), "shared_ride_flag_raw", "shared_ride_flag",
                            "shared_matched"),
         """SELECT sr_text AS shared_ride_flag_raw, shared_ride_flag, shared_matched, count(*) AS n
FROM fhv_typed GROUP BY ALL""")


# --- whole services ----------------------------------------------------------

_TYPED = {
    "yellow": "vendor_id rate_code_id payment_type store_and_fwd_flag passenger_count trip_distance fare_amount "
              "total_amount average_speed_mph tip_percentage trip_type",
    "green": "vendor_id rate_code_id payment_type store_and_fwd_flag passenger_count trip_distance fare_amount "
             "total_amount average_speed_mph tip_percentage trip_type ehail_fee",
    "fhv": "dispatching_base_num affiliated_base_number shared_ride_flag shared_matched",
    "fhvhv": "hvfhs_license_num hvfhs_company_name dispatching_base_num originating_base_num request_datetime "
             "on_scene_datetime trip_miles average_speed_mph base_passenger_fare driver_pay sales_tax "
             "black_car_fund tips tolls shared_requested shared_matched access_a_ride wav_requested wav_matched",
}
_DOUBLES = {"trip_distance", "fare_amount", "total_amount", "average_speed_mph", "tip_percentage", "ehail_fee",
            "trip_miles", "base_passenger_fare", "driver_pay", "sales_tax", "black_car_fund", "tips", "tolls"}
_CODE_SQL = """array_to_string(error_codes, '|') AS quality_error_codes,
  array_to_string(warning_codes, '|') AS quality_warning_codes, CAST(n_errors AS INT) AS quality_error_count,
  CAST(n_warnings AS INT) AS quality_warning_count, quality_status"""
_CODES = ["quality_error_codes", "quality_warning_codes", "quality_error_count", "quality_warning_count", "quality_status"]


def _typed_sql(service: str) -> str:
    return ", ".join(rnd(n) if n in _DOUBLES else n for n in _TYPED[service].split())


def _time_sql() -> str:
    return "pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, trip_business_id, source_record"


_TIME = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "trip_business_id",
         "source_record"]
for _s in SERVICES:
    register(f"transform_{_s}",
             lambda w, s=_s: trips.transform(w.raw(s), s).select(*_TIME, *_TYPED[s].split(), *_CODES),
             f"SELECT {_time_sql()}, {_typed_sql(_s)}, {_CODE_SQL} FROM {_s}_own")
    register(f"flagged_{_s}",
             lambda w, s=_s: w.flagged(s).select("source_record", "pickup_zone_name", "dropoff_borough", *_CODES),
             f"SELECT source_record, pickup_zone_name, dropoff_borough, {_CODE_SQL} FROM {_s}_trips")
    register(f"rule_counts_{_s}",
             lambda w, s=_s: quality.rule_counts(w.flagged_stage(s)),
             f"""SELECT rule_code, severity, count(*) AS affected_rows FROM (
  SELECT unnest(error_codes) AS rule_code, 'ERROR' AS severity FROM {_s}_trips UNION ALL
  SELECT unnest(warning_codes), 'WARNING' FROM {_s}_trips) GROUP BY ALL""")


@query("add_null_columns", """
SELECT CAST(source_year AS INT) AS source_year, CAST(NULL AS VARCHAR) AS pickup_zone_name, count(*) AS n
FROM raw WHERE service_type = 'fhv' GROUP BY ALL""")
def _(w):
    df = trips.with_null_columns(w.raw("fhv"), {"pickup_zone_name": "string", "source_year": "int"})
    return _counted(df, "source_year", "pickup_zone_name")


_MASTER_ROUND = """trip_distance average_speed_mph fare_amount extra mta_tax tip_amount tolls_amount
improvement_surcharge total_amount congestion_surcharge airport_fee cbd_congestion_fee black_car_fund sales_tax
driver_pay fare_per_mile tip_percentage revenue_per_minute""".split()
_MASTER_KEEP = [n for n in trips.MASTER_COLUMNS
                if n not in ("bronze_sha256", "bronze_execution_id", "silver_execution_id", "silver_processed_at")]
register("to_master", lambda w: w.live_master().select(*_MASTER_KEEP),
         "SELECT " + ", ".join(rnd(n) if n in _MASTER_ROUND else n for n in _MASTER_KEEP) + " FROM master")


# --- rule engine -------------------------------------------------------------

@query("apply_rules", "SELECT quality_status, array_to_string(error_codes, '|') AS codes, count(*) AS n "
                      "FROM fhv_own GROUP BY ALL")
def _(w):
    flagged = trips.transform(w.raw("fhv"), "fhv")
    return _counted(flagged.select("quality_status", F.array_join("quality_error_codes", "|").alias("codes")),
                    "quality_status", "codes")


@query("append_quality_rules", f"SELECT source_record, {_CODE_SQL} FROM yellow_trips")
def _(w):
    own = trips.transform(w.raw("yellow"), "yellow")
    zoned = trips.join_zones(own, w.references().zones)
    return quality.flag_more(zoned, trips.ZONE_RULES).select("source_record", *_CODES)


@query("split_valid_rejected", _each("""
SELECT '{s}' AS service, 'valid' AS part, count(*) AS n FROM {s}_trips WHERE n_errors = 0 UNION ALL
SELECT '{s}', 'rejected', count(*) FROM {s}_trips WHERE n_errors > 0"""))
def _(w):
    parts = [part(w.flagged_stage(s)).select(F.lit(s).alias("service"), F.lit(name).alias("part"))
             for s in SERVICES for name, part in (("valid", quality.accepted), ("rejected", quality.rejected))]
    return _counted(reduce(DataFrame.unionByName, parts), "service", "part")


_PERIOD_COUNTS = """CAST(count(*) AS BIGINT) AS rows_read, CAST(count(*) FILTER (n_errors = 0) AS BIGINT) AS rows_valid,
  CAST(count(*) FILTER (n_errors > 0) AS BIGINT) AS rows_rejected,
  CAST(count(*) FILTER (n_warnings > 0) AS BIGINT) AS warning_rows"""


def all_flagged(w):
    keep = ["service_type", "source_year", "source_month", *_CODES]
    parts = [w.flagged_stage(s).select(*keep) for s in SERVICE_KEYS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


PERIOD = ["service_type", "source_year", "source_month"]
PERIOD_SQL = "service_type, CAST(source_year AS INT) AS source_year, CAST(source_month AS INT) AS source_month"
register("quality_counts", lambda w: quality.quality_counts(all_flagged(w), PERIOD),
         f"SELECT {PERIOD_SQL}, {_PERIOD_COUNTS} FROM all_trips GROUP BY ALL")


@query("dedupe_rank", _each("SELECT '{s}' AS service, source_record, repeat_rank > 1 AS is_repeat FROM {s}_ranked"))
def _(w):
    return reduce(DataFrame.unionByName, [
        trips.flag_repeats(trips.standardize(w.raw(s), s)).select(F.lit(s).alias("service"), "source_record", "is_repeat") for s in SERVICES])


@query("eq_null_safe", """
SELECT shared_matched IS NOT DISTINCT FROM true AND shared_requested IS NOT DISTINCT FROM false AS shared_odd,
  wav_matched IS NOT DISTINCT FROM true AND wav_requested IS NOT DISTINCT FROM false AS wav_odd, count(*) AS n
FROM fhvhv_typed GROUP BY ALL""")
def _(w):
    by_code = {r.code: F.expr(r.predicate) for r in trips.service_rules("fhvhv")}
    df = trips.standardize(w.raw("fhvhv"), "fhvhv").select(
        by_code["SHARED_MATCH_WITHOUT_REQUEST"].alias("shared_odd"), by_code["WAV_MATCH_WITHOUT_REQUEST"].alias("wav_odd"))
    return _counted(df, "shared_odd", "wav_odd")


# --- lookups -----------------------------------------------------------------

_ZONED = ["pickup_zone_name", "pickup_borough", "pickup_service_zone", "dropoff_borough"]


@query("zone_enrich", _each(f"SELECT '{{s}}' AS service, {', '.join(_ZONED)}, count(*) AS n FROM {{s}}_zoned GROUP BY ALL"))
def _(w):
    return reduce(DataFrame.unionByName, [
        _counted(trips.join_zones(trips.standardize(w.raw(s), s), w.references().zones).withColumn("service", F.lit(s)), "service", *_ZONED)
        for s in SERVICES])


_BASED = ["dispatching_base_num", "dispatching_base_name", "dispatching_base_dba", "dispatching_base_type",
          "dispatching_base_status"]
for _s, _other in (("fhv", "affiliated_base_name"), ("fhvhv", "originating_base_name")):
    register(f"base_enrich_{_s}",
             lambda w, s=_s, o=_other: _counted(
                 trips.join_bases(trips.standardize(w.raw(s), s), w.references().bases), *_BASED, o),
             f"SELECT {', '.join(_BASED)}, {_other}, count(*) AS n FROM {_s}_zoned GROUP BY ALL")


# --- scalar functions --------------------------------------------------------

@query("scalars_string", """
SELECT upper(trim(c_name)) AS up, CAST(length(c_mktsegment) AS INT) AS len,
  concat_ws('||', c_name, c_mktsegment) AS joined, sha256(c_name) AS sha, printf('%02d:00', c_custkey % 24) AS label
FROM customer""")
def _(w):
    return w.table("customer").select(
        F.upper(F.trim("c_name")).alias("up"), F.length("c_mktsegment").alias("len"),
        F.concat_ws("||", "c_name", "c_mktsegment").alias("joined"), F.sha2("c_name", 256).alias("sha"),
        F.format_string("%02d:00", F.col("c_custkey") % 24).alias("label"))


@query("scalars_datetime", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(hour(o_orderdate) AS INT) AS hh,
  CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow, CAST(quarter(o_orderdate) AS INT) AS q,
  CAST(weekofyear(o_orderdate) AS INT) AS wk, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  last_day(o_orderdate) AS month_end, CAST(o_orderdate + INTERVAL 3 DAY AS DATE) AS later,
  date_trunc('hour', o_orderdate + INTERVAL 95 MINUTE) AS hour_start,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS key, strftime(o_orderdate, '%Y-%m') AS ym,
  CAST(datediff('second', o_orderdate, o_orderdate + INTERVAL 90 MINUTE) AS BIGINT) AS gap,
  o_orderdate + INTERVAL 24 HOUR AS next_day
FROM orders""")
def _(w):
    at = F.col("o_orderdate")
    return w.table("orders").select(
        "o_orderkey", F.to_date(at).alias("day"), F.hour(at).alias("hh"), F.dayofweek(at).alias("dow"),
        F.quarter(at).alias("q"), F.weekofyear(at).alias("wk"), F.trunc(at, "month").alias("month_start"),
        F.last_day(at).alias("month_end"), F.date_add(at, 3).alias("later"),
        c.hour_start(at + F.expr("INTERVAL 95 MINUTES")).alias("hour_start"), c.date_key(at).alias("key"),
        F.date_format(at, "yyyy-MM").alias("ym"),
        c.seconds_between(at, at + F.expr("INTERVAL 90 MINUTES")).alias("gap"),
        F.timestamp_add("HOUR", F.lit(24), at).alias("next_day"))


@query("scalars_math", f"""
SELECT l_linenumber, {rnd("sum(abs(l_discount - l_tax))", "a")}, {rnd("sum(round(l_quantity / 2))", "r")},
  {rnd("sum(greatest(l_discount, l_tax, CASE WHEN l_linenumber % 2 = 0 THEN 0.05 END))", "g")},
  {rnd("sum(pow(l_discount, 2))", "p")}, {rnd("sqrt(avg(pow(l_tax, 2)))", "s")}
FROM lineitem GROUP BY l_linenumber""")
def _(w):
    d, t = F.col("l_discount"), F.col("l_tax")
    sometimes = F.when(F.col("l_linenumber") % 2 == 0, F.lit(0.05))
    return w.table("lineitem").groupBy("l_linenumber").agg(
        F.sum(F.abs(d - t)).alias("a"), F.sum(F.round(F.col("l_quantity") / 2)).alias("r"),
        F.sum(F.greatest(d, t, sometimes)).alias("g"), F.sum(F.pow(d, F.lit(2))).alias("p"),
        F.sqrt(F.avg(F.pow(t, F.lit(2)))).alias("s"))


@query("scalars_array_map", """
SELECT p_partkey, array_to_string(list_filter([p_brand, CASE WHEN p_size > 20 THEN p_type END], lambda x: x IS NOT NULL), '|')
  AS kept, CAST(CASE WHEN p_size > 20 THEN 2 ELSE 1 END AS INT) AS n,
  CAST(len(list_distinct([p_size % 3, p_size % 2, p_size % 3])) AS INT) AS distinct_n,
  [p_size, p_size + 1, p_size + 2][2] AS second,
  CASE p_size % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'mid' END AS named
FROM part""")
def _(w):
    size = F.col("p_size")
    kept = F.filter(F.array("p_brand", F.when(size > 20, F.col("p_type"))), lambda x: x.isNotNull())
    return w.table("part").select(
        "p_partkey", F.array_join(kept, "|").alias("kept"), F.size(kept).alias("n"),
        F.size(F.array_distinct(F.concat(F.array(size % 3, size % 2), F.array(size % 3)))).alias("distinct_n"),
        F.element_at(F.array(size, size + 1, size + 2), 2).alias("second"),
        c.lookup(size % 3, {0: "low", 1: "mid"}).alias("named"))
