"""Conformed dimensions and the three facts. Facts are narrow projections of the master."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions import clean as c
from fareflow.spec import AIRPORT_ZONES, SERVICE_KEYS, TAXI_SERVICES, QualityLimits

# Members of the small dimensions.
SERVICE_ROWS = [
    (1, "yellow", "Yellow Taxi", "TAXI", True, True, False, False),
    (2, "green", "Green Taxi", "TAXI", True, True, False, False),
    (3, "fhv", "For-Hire Vehicle", "FHV", False, False, True, False),
    (4, "fhvhv", "High Volume FHV", "HVFHV", True, False, True, True),
]
PAYMENT_ROWS = [
    (0, "Flex Fare", False), (1, "Credit card", True), (2, "Cash", False), (3, "No charge", False),
    (4, "Dispute", False), (5, "Unknown", False), (6, "Voided trip", False), (-1, "Not applicable", False),
]
RATE_ROWS = [
    (1, "Standard rate", False, False), (2, "JFK", True, False), (3, "Newark", True, False),
    (4, "Nassau or Westchester", False, False), (5, "Negotiated fare", False, True),
    (6, "Group ride", False, False), (99, "Null/unknown", False, False), (-1, "Not applicable", False, False),
]
TRIP_TYPE_ROWS = [(1, "Street-hail"), (2, "Dispatch"), (-1, "Not applicable")]
# Last hour of each band, and its name.
TIME_BANDS = [(5, "MADRUGADA"), (11, "MANANA"), (16, "TARDE"), (21, "PICO_NOCTURNO"), (23, "NOCHE")]


def dim_service(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SERVICE_ROWS,
        "service_key int, service_code string, service_name string, service_category string, "
        "supports_financial_analysis boolean, supports_passenger_analysis boolean, "
        "supports_shared_ride_analysis boolean, supports_accessibility_analysis boolean",
    )


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENT_ROWS, "payment_type_key int, payment_type_name string, is_electronic boolean")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RATE_ROWS, "rate_code_key int, rate_code_name string, is_airport_rate boolean, is_negotiated_rate boolean"
    )


def dim_trip_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRIP_TYPE_ROWS, "trip_type_key int, trip_type_name string")


def _describe_days(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        c.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_number"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week_number"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        c.is_weekend(day).alias("is_weekend"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
    )


def dim_date(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per calendar day of the given years."""
    first = date(first_year, 1, 1)
    n_days = (date(last_year + 1, 1, 1) - first).days
    return _describe_days(spark.range(n_days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")))


def dim_date_of(df: DataFrame, column: str) -> DataFrame:
    """Calendar of the whole years a column covers."""
    span = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = F.sequence(F.trunc("first", "year"), F.last_day(F.make_date(F.year("last"), F.lit(12), F.lit(1))))
    return _describe_days(span.filter("first IS NOT NULL").select(F.explode(days).alias("full_date")))


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("id").cast("int")
    band = F.coalesce(*[F.when(hour <= last, name) for last, name in TIME_BANDS])
    return spark.range(24).select(
        hour.alias("time_key"),
        hour.alias("hour"),
        F.format_string("%02d:00", hour).alias("hour_label"),
        band.alias("time_band"),
        hour.isin(7, 8, 9, 16, 17, 18, 19).alias("is_peak_hour"),
        (~hour.between(6, 21)).alias("is_night"),
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    """One row per zone id of the lookup."""
    zone = F.col("location_id").cast("int")
    rest = ("zone_name", "borough", "service_zone")
    return (
        zones.filter(zone.isNotNull())
        .groupBy(zone.alias("zone_key")).agg(F.min(F.struct(*rest)).alias("z"))
        .select(
            "zone_key", F.col("zone_key").alias("location_id"), *[F.col(f"z.{r}").alias(r) for r in rest],
            F.col("zone_key").isin(*AIRPORT_ZONES).alias("is_airport"),
            c.lookup(F.col("zone_key"), AIRPORT_ZONES).alias("airport_name"),
        )
    )


def dim_provider(master: DataFrame) -> DataFrame:
    """One row per service and provider code.

    Attributes come from the provider's smallest (name, bases) combination, so a
    rerun picks the same ones.
    """
    name = F.coalesce("hvfhs_company_name", "dispatching_base_name", "dispatching_base_dba", c.provider_code())
    attributes = F.struct(
        name.alias("provider_name"), "dispatching_base_num", "originating_base_num", "affiliated_base_num"
    )
    service = F.col("service_type")
    kind = F.when(service.isin(*TAXI_SERVICES), "TAXI_VENDOR").when(service == "fhvhv", "HVFHS").otherwise("FHV_BASE")
    return (
        master.select(service, c.provider_code().alias("provider_code"), attributes.alias("a"))
        .filter("provider_code IS NOT NULL")
        .groupBy("service_type", "provider_code").agg(F.min("a").alias("a"))
        .select(
            c.provider_key(service, F.col("provider_code")).alias("provider_key"),
            "provider_code", "a.provider_name", kind.alias("provider_type"), "service_type",
            "a.dispatching_base_num", "a.originating_base_num", "a.affiliated_base_num",
        )
    )


# --- facts -------------------------------------------------------------------
# SQL over the master for columns that are not a master column of their name.

def _day(column: str) -> str:
    return f"CAST(date_format({column}, 'yyyyMMdd') AS INT)"


_PROVIDER = "coalesce(vendor_id_or_license, dispatching_base_num, originating_base_num)"
# What adds up to a passenger's charge.
_CHARGED = ("fare_amount", "tolls_amount", "black_car_fund", "sales_tax", "congestion_surcharge", "airport_fee",
            "cbd_congestion_fee", "tip_amount")
_SOURCES = {
    "trip_key": "trip_business_id",
    "service_key": "service_id",
    "pickup_zone_key": "pickup_location_id",
    "dropoff_zone_key": "dropoff_location_id",
    "provider_key": f"CASE WHEN {_PROVIDER} IS NOT NULL THEN abs(xxhash64(service_type, {_PROVIDER})) END",
    "date_key": _day("pickup_date"),
    "time_key": "pickup_hour",
    "pickup_date_key": _day("pickup_date"),
    "pickup_time_key": "pickup_hour",
    "dropoff_date_key": _day("dropoff_date"),
    "dropoff_time_key": "hour(dropoff_datetime)",
    "request_date_key": _day("request_datetime"),
    "request_time_key": "hour(request_datetime)",
    "trip_distance_miles": "trip_distance",
    "payment_type_key": "coalesce(payment_type, -1)",
    "rate_code_key": "coalesce(rate_code_id, -1)",
    "trip_type_key": "coalesce(trip_type, -1)",
    "extra_amount": "extra",
    "mta_tax_amount": "mta_tax",
    "hvfhs_license_num": "vendor_id_or_license",
    "trip_miles": "trip_distance",
    "trip_time_seconds": "reported_trip_time_seconds",
    "base_passenger_fare": "fare_amount",
    "tolls": "tolls_amount",
    "tips": "tip_amount",
    "passenger_charge_amount": " + ".join(f"coalesce({n}, 0D)" for n in _CHARGED),
}
# The facts' columns in the contract's order.
_ACTIVITY = (
    "trip_key", "pickup_date_key", "pickup_time_key", "dropoff_date_key", "dropoff_time_key", "service_key",
    "service_type", "pickup_zone_key", "dropoff_zone_key", "provider_key", "trip_count", "pickup_datetime",
    "dropoff_datetime", "trip_duration_seconds", "trip_distance_miles", "passenger_count", "average_speed_mph",
    "weekend_trip_flag", "night_trip_flag", "airport_trip_flag", "quality_warning_count", "quality_status",
    "source_year", "source_month", "silver_execution_id", "silver_processed_at",
)
_FINANCIAL = (
    "trip_key", "date_key", "time_key", "service_key", "service_type", "pickup_zone_key", "dropoff_zone_key",
    "provider_key", "payment_type_key", "rate_code_key", "trip_type_key", "fare_amount", "extra_amount",
    "mta_tax_amount", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "total_amount", "fare_per_mile", "tip_percentage", "revenue_per_minute",
    "trip_distance_miles", "trip_duration_seconds", "airport_trip_flag", "trip_count", "source_year", "source_month",
)
_OPERATIONS = (
    "trip_key", "request_date_key", "request_time_key", "pickup_date_key", "pickup_time_key", "service_key",
    "service_type", "pickup_zone_key", "dropoff_zone_key", "provider_key", "hvfhs_license_num", "hvfhs_company_name",
    "dispatching_base_num", "originating_base_num", "request_datetime", "on_scene_datetime", "pickup_datetime",
    "dropoff_datetime", "trip_miles", "trip_time_seconds", "trip_duration_seconds", "request_to_pickup_seconds",
    "driver_wait_seconds", "base_passenger_fare", "tolls", "black_car_fund", "sales_tax", "congestion_surcharge",
    "airport_fee", "cbd_congestion_fee", "tips", "driver_pay", "passenger_charge_amount", "shared_requested",
    "shared_matched", "access_a_ride", "wav_requested", "wav_matched", "airport_trip_flag", "weekend_trip_flag",
    "night_trip_flag", "trip_count", "source_year", "source_month",
)


def _project(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.selectExpr(*[f"{_SOURCES.get(name, name)} AS {name}" for name in columns])


def fact_trip_activity(master: DataFrame) -> DataFrame:
    """One row per accepted trip with the attributes all services share."""
    return _project(master, _ACTIVITY)


def fact_taxi_financial(master: DataFrame) -> DataFrame:
    """Money of taxi trips; a missing dimension member is key -1."""
    return _project(master.filter(F.col("service_type").isin(*TAXI_SERVICES)), _FINANCIAL)


def fact_hvfhv_operations(master: DataFrame) -> DataFrame:
    """High-volume trips with waits, flags and money; null charges count as zero in the total."""
    return _project(master.filter("service_type = 'fhvhv'"), _OPERATIONS)


# The services a fact is about; no other trips are needed to build it.
FACT_SERVICES = {"trip_activity": tuple(SERVICE_KEYS), "taxi_financial": TAXI_SERVICES, "hvfhv_operations": ("fhvhv",)}
FACTS = {
    "trip_activity": fact_trip_activity,
    "taxi_financial": fact_taxi_financial,
    "hvfhv_operations": fact_hvfhv_operations,
}


def facts(master: DataFrame) -> dict[str, DataFrame]:
    return {name: build(master) for name, build in FACTS.items()}
