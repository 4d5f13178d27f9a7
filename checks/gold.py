"""Facts, dimensions and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.blocks import MART_BLOCKS, rnd, rounded
from checks.registry import query, register
from fareflow.functions import clean as c
from fareflow.plans import marts, star
from fareflow.sources.sinks import staged

_ROUNDED = {
    "average_duration_seconds", "average_distance_miles", "average_speed_mph", "service_share", "fare_amount",
    "tip_amount", "tolls_amount", "total_amount", "average_total_amount", "average_tip_percentage",
    "average_fare_per_mile", "average_revenue_per_minute", "average_tip_amount", "median_tip_percentage",
    "congestion_index", "zone_service_share", "average_request_to_pickup_seconds", "average_driver_wait_seconds",
    "average_driver_pay", "shared_match_rate", "wav_match_rate",
}


def mart_columns(name: str) -> list[str]:
    mart = marts.MARTS[name]
    columns = [*mart.keys, *mart.measures, *mart.ratios]
    if mart.share:
        columns += list(mart.share[:2])
    for end in mart.labels:
        columns.append(f"{end}_zone_name")
        if mart.label_borough:
            columns.append(f"{end}_borough")
    return ["provider_code" if n == "provider_key" else n for n in columns]


def mart_sql(name: str) -> str:
    columns = [rnd(n) if n in _ROUNDED else n for n in mart_columns(name)]
    return f"SELECT {', '.join(columns)} FROM {MART_BLOCKS[name]}"


def _mart(name: str):
    def build(w):
        mart = marts.MARTS[name]
        if "provider_key" not in mart.keys:
            return w.mart(name)
        # The hashed key exists in Spark only; its code stands in for it.
        coded = w.fact(mart.fact).withColumn(
            "provider_key", F.coalesce("hvfhs_license_num", "dispatching_base_num", "originating_base_num"))
        return marts.build_mart(name, {mart.fact: coded}, w.dim_zone()).withColumnRenamed("provider_key", "provider_code")
    return build


for _name in marts.MARTS:
    register(f"mart_{_name}", _mart(_name), mart_sql(_name))
    if marts.rolls_up(_name):
        register(
            f"rollup_{_name}",
            lambda w, n=_name: marts.roll_up_mart(n, marts.activity_rollup(w.fact("trip_activity")), w.dim_zone()),
            mart_sql(_name),
        )
    if _name in marts.PERCENTILE_MARTS and _name != "hvfhv_service_quality":
        register(
            f"rollup_{_name}",
            lambda w, n=_name: marts.roll_up_percentiles(n, w.values(marts.PERCENTILE_MARTS[n]), w.dim_zone()), mart_sql(_name))


@query("rollup_hvfhv_service_quality", mart_sql("hvfhv_service_quality"))
def _(w):
    coded = w.fact("hvfhv_operations").withColumn(
        "provider_key", F.coalesce("hvfhs_license_num", "dispatching_base_num", "originating_base_num"))
    values = staged(marts.value_counts("hvfhv_waits", coded), "coded-waits")
    return marts.roll_up_percentiles("hvfhv_service_quality", values, w.dim_zone()).withColumnRenamed("provider_key", "provider_code")


# --- dimensions --------------------------------------------------------------

@query("date_dim", """
WITH span AS (SELECT date_trunc('year', min(o_orderdate)) AS a, max(o_orderdate) AS b FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, make_date(CAST(year(b) AS INT), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS full_date FROM span)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date, CAST(year(full_date) AS INT) AS year,
  CAST(quarter(full_date) AS INT) AS quarter, CAST(month(full_date) AS INT) AS month_number,
  strftime(full_date, '%B') AS month_name, strftime(full_date, '%Y-%m') AS year_month,
  CAST(weekofyear(full_date) AS INT) AS week_number, CAST(day(full_date) AS INT) AS day_of_month,
  CAST(dayofweek(full_date) + 1 AS INT) AS day_of_week_number, strftime(full_date, '%A') AS day_of_week_name,
  dayofweek(full_date) IN (0, 6) AS is_weekend, day(full_date) = 1 AS is_month_start,
  full_date = last_day(full_date) AS is_month_end
FROM days""")
def _(w):
    return star.dim_date_of(w.table("orders"), "o_orderdate")


_BAND = """CASE WHEN pickup_time_key <= 5 THEN 'MADRUGADA' WHEN pickup_time_key <= 11 THEN 'MANANA'
  WHEN pickup_time_key <= 16 THEN 'TARDE' WHEN pickup_time_key <= 21 THEN 'PICO_NOCTURNO' ELSE 'NOCHE' END"""


@query("time_dim", f"""
SELECT pickup_time_key AS time_key, printf('%02d:00', pickup_time_key) AS hour_label, {_BAND} AS time_band,
  pickup_time_key IN (7, 8, 9, 16, 17, 18, 19) AS is_peak_hour, pickup_time_key <= 5 OR pickup_time_key >= 22 AS is_night,
  CAST(sum(trip_count) AS BIGINT) AS trips
FROM activity GROUP BY ALL""")
def _(w):
    trips = w.fact("trip_activity").groupBy(F.col("pickup_time_key").alias("time_key")).agg(F.sum("trip_count").alias("trips"))
    return trips.join(star.dim_time(w.spark), "time_key").drop("hour")


@query("service_dim", """
SELECT service_key, CASE service_key WHEN 1 THEN 'Yellow Taxi' WHEN 2 THEN 'Green Taxi' WHEN 3 THEN 'For-Hire Vehicle'
  ELSE 'High Volume FHV' END AS service_name,
  CASE WHEN service_key <= 2 THEN 'TAXI' WHEN service_key = 3 THEN 'FHV' ELSE 'HVFHV' END AS service_category,
  service_key <> 3 AS supports_financial_analysis, service_key <= 2 AS supports_passenger_analysis,
  service_key >= 3 AS supports_shared_ride_analysis, service_key = 4 AS supports_accessibility_analysis,
  CAST(sum(trip_count) AS BIGINT) AS trips
FROM activity GROUP BY service_key""")
def _(w):
    trips = w.fact("trip_activity").groupBy("service_key").agg(F.sum("trip_count").alias("trips"))
    return trips.join(star.dim_service(w.spark).drop("service_code"), "service_key")


@query("payment_type_dim", f"""
SELECT payment_type_key, CASE payment_type_key WHEN 0 THEN 'Flex Fare' WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
  WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
  WHEN -1 THEN 'Not applicable' END AS payment_type_name, payment_type_key = 1 AS is_electronic,
  {rnd('sum(total_amount)', 'revenue')}
FROM financial GROUP BY payment_type_key""")
def _(w):
    money = w.fact("taxi_financial").groupBy("payment_type_key").agg(F.sum("total_amount").alias("revenue"))
    return money.join(star.dim_payment_type(w.spark), "payment_type_key", "left")


@query("rate_code_dim", f"""
SELECT rate_code_key, CASE rate_code_key WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
  WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' WHEN 99 THEN 'Null/unknown'
  WHEN -1 THEN 'Not applicable' END AS rate_code_name, rate_code_key IN (2, 3) AS is_airport_rate,
  rate_code_key = 5 AS is_negotiated_rate, {rnd('avg(fare_amount)', 'average_fare')}
FROM financial GROUP BY rate_code_key""")
def _(w):
    money = w.fact("taxi_financial").groupBy("rate_code_key").agg(F.avg("fare_amount").alias("average_fare"))
    return money.join(star.dim_rate_code(w.spark), "rate_code_key", "left")


@query("trip_type_dim", """
SELECT trip_type_key, CASE trip_type_key WHEN 1 THEN 'Street-hail' WHEN 2 THEN 'Dispatch' ELSE 'Not applicable' END
  AS trip_type_name, count(*) AS trips
FROM financial GROUP BY trip_type_key""")
def _(w):
    n = w.fact("taxi_financial").groupBy("trip_type_key").agg(F.count(F.lit(1)).alias("trips"))
    return n.join(star.dim_trip_type(w.spark), "trip_type_key", "left")


register("dim_zone", lambda w: w.dim_zone(), "SELECT * FROM dim_zone")

register("dim_provider", lambda w: star.dim_provider(w.master()).drop("provider_key"), """
WITH named AS (SELECT service_type, coalesce(vendor_id_or_license, dispatching_base_num, originating_base_num) AS provider_code,
  coalesce(hvfhs_company_name, dispatching_base_name, dispatching_base_dba, vendor_id_or_license, dispatching_base_num,
           originating_base_num) AS provider_name, dispatching_base_num, originating_base_num, affiliated_base_num
  FROM master)
SELECT provider_code, provider_name, CASE WHEN service_type IN ('yellow', 'green') THEN 'TAXI_VENDOR'
  WHEN service_type = 'fhvhv' THEN 'HVFHS' ELSE 'FHV_BASE' END AS provider_type, service_type,
  dispatching_base_num, originating_base_num, affiliated_base_num
FROM (SELECT *, row_number() OVER (PARTITION BY service_type, provider_code ORDER BY provider_name NULLS FIRST,
  dispatching_base_num NULLS FIRST, originating_base_num NULLS FIRST, affiliated_base_num NULLS FIRST) AS rn
  FROM named WHERE provider_code IS NOT NULL) WHERE rn = 1""")

register("provider_key", lambda w: star.dim_provider(w.master()).select("provider_key", "service_type", "provider_code"))


@query("service_key", "SELECT service_type, service_id AS service_key, count(*) AS n FROM master GROUP BY ALL")
def _(w):
    return w.master().select("service_type", c.service_key(F.col("service_type")).alias("service_key")) \
        .groupBy("service_type", "service_key").agg(F.count(F.lit(1)).alias("n"))


@query("date_key", """
SELECT pickup_date, CAST(strftime(pickup_date, '%Y%m%d') AS INT) AS date_key, count(*) AS n FROM master GROUP BY ALL""")
def _(w):
    return w.master().select("pickup_date", c.date_key(F.col("pickup_date")).alias("date_key")) \
        .groupBy("pickup_date", "date_key").agg(F.count(F.lit(1)).alias("n"))


@query("service_label", """
SELECT CASE service_type WHEN 'yellow' THEN 'Yellow' WHEN 'green' THEN 'Green' WHEN 'fhv' THEN 'FHV'
  WHEN 'fhvhv' THEN 'HVFHV' END AS service_label, count(*) AS n FROM master GROUP BY ALL""")
def _(w):
    return w.master().groupBy(c.service_label(F.col("service_type")).alias("service_label")).agg(F.count(F.lit(1)).alias("n"))


@query("to_numeric", f"""
SELECT o_orderpriority, {rnd("sum(TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE))", "digit")},
  count(TRY_CAST(o_orderpriority AS DOUBLE)) AS whole FROM orders GROUP BY ALL""")
def _(w):
    return w.table("orders").groupBy("o_orderpriority").agg(
        F.sum(c.numeric(F.substring("o_orderpriority", 1, 1))).alias("digit"),
        F.count(c.numeric(F.col("o_orderpriority"))).alias("whole"))


# --- facts -------------------------------------------------------------------

_FACTS = {
    "trip_activity": ("activity", "trip_distance_miles average_speed_mph"),
    "taxi_financial": ("financial", "fare_amount extra_amount mta_tax_amount tip_amount tolls_amount improvement_surcharge "
                       "congestion_surcharge airport_fee cbd_congestion_fee total_amount fare_per_mile tip_percentage "
                       "revenue_per_minute trip_distance_miles"),
    "hvfhv_operations": ("hv_ops", "trip_miles base_passenger_fare tolls black_car_fund sales_tax congestion_surcharge "
                         "airport_fee cbd_congestion_fee tips driver_pay passenger_charge_amount"),
}
for _name, (_block, _doubles) in _FACTS.items():
    register(f"fact_{_name}",
             lambda w, n=_name: w.fact(n).drop("provider_key", "silver_execution_id", "silver_processed_at"),
             f"SELECT * EXCLUDE (provider_code) REPLACE ({rounded(_doubles)}) FROM {_block}")


@query("service_filter", "SELECT count(*) AS n FROM master WHERE service_type IN ('yellow', 'green')")
def _(w):
    return w.master().filter(F.col("service_type").isin("yellow", "green")).agg(F.count(F.lit(1)).alias("n"))


@query("card_only", f"SELECT time_key, {rnd('avg(tip_amount)', 'tip')} FROM financial WHERE payment_type_key = 1 GROUP BY ALL")
def _(w):
    return w.fact("taxi_financial").filter("payment_type_key = 1").groupBy("time_key").agg(F.avg("tip_amount").alias("tip"))


@query("zone_labels", """
SELECT pz.zone_name AS pickup_zone_name, pz.borough AS pickup_borough, count(*) AS n
FROM activity a LEFT JOIN dim_zone pz ON pz.zone_key = a.pickup_zone_key GROUP BY ALL""")
def _(w):
    n = w.fact("trip_activity").groupBy("pickup_zone_key").agg(F.count(F.lit(1)).alias("n"))
    return n.join(marts.zone_labels(w.dim_zone(), "pickup"), "pickup_zone_key", "left").drop("pickup_zone_key")


@query("od_route_efficiency", mart_sql("route_efficiency"))
def _(w):
    return marts.route_view(w.mart("od_routes"))


@query("share_denominator", """
SELECT source_year, source_month, pickup_zone_key, max(zone_total_trip_count) AS total,
  round(sum(zone_service_share) + 1e-9, 6) AS shares
FROM m_competition GROUP BY ALL""")
def _(w):
    return w.mart("service_competition").groupBy("source_year", "source_month", "pickup_zone_key").agg(
        F.max("zone_total_trip_count").alias("total"), F.sum("zone_service_share").alias("shares"))


@query("activity_rollup", """
SELECT source_year, source_month, service_type, pickup_zone_key, airport_trip_flag,
  CAST(pickup_datetime AS DATE) AS event_date, CAST(dayofweek(pickup_datetime) + 1 AS INT) AS day_of_week,
  CAST(hour(pickup_datetime) AS INT) AS hour_of_day, CAST(sum(trip_count) AS BIGINT) AS trip_count__sum,
  CAST(sum(trip_duration_seconds) AS BIGINT) AS trip_duration_seconds__sum
FROM activity GROUP BY ALL""")
def _(w):
    return marts.activity_rollup(w.fact("trip_activity")).select(
        *marts.ROLLUP_KEYS, "trip_count__sum", "trip_duration_seconds__sum")
