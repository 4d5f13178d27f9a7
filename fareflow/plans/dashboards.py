"""Report queries over the marts: KPIs, rankings, matrices and model views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.functions import clean as c
from fareflow.operators.keyed import at_least_quantile, top, weighted_mean
from fareflow.spec import PARTIAL_COVERAGE_YEARS, SERVICE_LABELS, Scope


def in_scope(df: DataFrame, scope: Scope, year: str = "source_year", month: str = "source_month",
             service: str = "service_type") -> DataFrame:
    """Rows of the selection. An empty choice, or a column the table lacks, does not restrict."""
    for column, chosen in ((year, scope.years), (month, scope.months), (service, scope.services)):
        if chosen and column in df.columns:
            df = df.filter(F.col(column).isin(*chosen))
    return df


def labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("service_label", c.service_label(F.col("service_type")))


def total(column: str) -> Column:
    """Sum that is zero, not null, when nothing is there."""
    return F.coalesce(F.sum(column), F.lit(0))


def named(df: DataFrame, *keys: str) -> DataFrame:
    """Grouping that drops null keys."""
    return df.dropna(subset=list(keys))


# --- overview ----------------------------------------------------------------

def monthly_totals(executive: DataFrame) -> DataFrame:
    return executive.groupBy("source_year", "source_month").agg(F.sum("trip_count").alias("trip_count"))


def month_over_month(executive: DataFrame) -> DataFrame:
    """Change between the two latest months; null with fewer than two or an empty earlier one."""
    period = F.struct("source_year", "source_month")
    latest = monthly_totals(executive).orderBy(F.desc("source_year"), F.desc("source_month")).limit(2)
    pair = latest.agg(
        F.max_by("trip_count", period).alias("last_month"), F.min_by("trip_count", period).alias("prior_month"),
        F.count(F.lit(1)).alias("n"),
    )
    change = F.when((F.col("n") == 2) & (F.col("prior_month") != 0),
                    (F.col("last_month") - F.col("prior_month")) / F.col("prior_month"))
    return pair.select("last_month", F.when(F.col("n") == 2, F.col("prior_month")).alias("prior_month"), change.alias("change"))


def previous_month(executive: DataFrame) -> DataFrame:
    """Each month beside the one before it. One row per calendar month, so one task suffices."""
    return monthly_totals(executive).withColumn(
        "previous_trip_count", F.lag("trip_count").over(Window.orderBy("source_year", "source_month"))
    )


def overview_kpis(executive: DataFrame) -> DataFrame:
    means = ("average_duration_seconds", "average_distance_miles", "average_speed_mph")
    change = month_over_month(executive).select("change").scalar()
    return executive.agg(
        total("trip_count").alias("trip_count"), *[weighted_mean(m, "trip_count").alias(m) for m in means]
    ).withColumn("month_change", change)


def share_by_service(executive: DataFrame) -> DataFrame:
    return labelled(executive).groupBy("service_label").agg(total("trip_count").alias("trip_count"))


def monthly_trend(executive: DataFrame) -> DataFrame:
    return labelled(executive).select(
        F.make_date("source_year", "source_month", F.lit(1)).alias("period"), "service_label", "trip_count"
    ).orderBy("period", "service_label")


def daily_trend(daily: DataFrame, scope: Scope = Scope()) -> DataFrame:
    dated = daily.withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
    return labelled(in_scope(dated, scope, "year", "month")).select("event_date", "service_label", "trip_count").orderBy(
        "event_date", "service_label"
    )


def home_kpis(executive: DataFrame) -> DataFrame:
    """Trips (null when there are none at all), services and years on record."""
    return executive.agg(
        F.sum("trip_count").alias("trip_count"), F.countDistinct("service_type").alias("services"),
        F.countDistinct("source_year").alias("years"),
    )


def coverage_note(executive: DataFrame, years: Sequence[int]) -> DataFrame:
    """Selected years each service has no data for."""
    covered = executive.groupBy("service_type").agg(F.collect_set("source_year").alias("covered"))
    wanted = F.array(*[F.lit(y) for y in years])
    missing = F.array_sort(F.array_except(wanted, F.col("covered")))
    return labelled(covered.withColumn("missing_years", missing).filter(F.size("missing_years") > 0)).drop("covered")


def declared_coverage(executive: DataFrame, years: Sequence[int], declared: dict[str, Sequence[int]]) -> DataFrame:
    """Selected years outside the declared coverage of partly covered services, and the trips that are left out with them.

    Such years count as not available, never as zero. A service that is declared but has no data at all is not reported.
    """
    wanted = F.array(*[F.lit(y) for y in sorted(set(years))])
    covered = F.coalesce(*[F.when(F.col("service_type") == s, F.array(*[F.lit(int(y)) for y in ys])) for s, ys in declared.items()],
                         wanted)
    outside = ~F.array_contains(covered, F.col("source_year").cast("int"))
    gaps = executive.groupBy("service_type").agg(
        F.coalesce(F.sum(F.when(F.array_contains(wanted, F.col("source_year").cast("int")) & outside, F.col("trip_count"))), F.lit(0)).alias("trips_left_out"))
    missing = F.array_sort(F.array_except(wanted, covered))
    return labelled(gaps.withColumn("missing_years", missing).filter(F.size("missing_years") > 0))


def declared_gaps(scope: Scope) -> dict[str, list[int]]:
    """Selected years outside the declared coverage of partially covered services."""
    return {
        SERVICE_LABELS[s]: sorted(set(scope.years) - set(available))
        for s, available in PARTIAL_COVERAGE_YEARS.items()
        if s in scope.services and set(scope.years) - set(available)
    }


# --- geography ---------------------------------------------------------------

def zone_rank(zone_demand: DataFrame) -> DataFrame:
    return zone_demand.groupBy("pickup_zone_name", "pickup_borough").agg(F.sum("pickup_trip_count").alias("pickup_trip_count"))


def top_zones(zone_demand: DataFrame, n: int = 15) -> DataFrame:
    return top(zone_rank(zone_demand), n, F.desc("pickup_trip_count"), F.asc("pickup_zone_name"), F.asc("pickup_borough"))


def borough_rank(zone_demand: DataFrame) -> DataFrame:
    return zone_demand.groupBy("pickup_borough").agg(F.sum("pickup_trip_count").alias("pickup_trip_count")).orderBy(
        F.desc("pickup_trip_count"), "pickup_borough"
    )


_CORRIDOR = ("pickup_zone_name", "dropoff_zone_name", "pickup_borough", "dropoff_borough")


def corridors(routes: DataFrame) -> DataFrame:
    return routes.groupBy(*_CORRIDOR).agg(
        F.sum("trip_count").alias("trip_count"), F.avg("average_speed_mph").alias("average_speed_mph")
    )


def top_corridors(routes: DataFrame, n: int = 20) -> DataFrame:
    return top(corridors(routes), n, F.desc("trip_count"), *[F.asc(k) for k in _CORRIDOR])


def _leader(df: DataFrame, names: Column, measure: str) -> Column:
    """Name with the largest measure; the first in name order wins a tie."""
    return df.agg(F.min_by(names, F.struct(-F.col(measure), names))).scalar()


def geo_kpis(zone_demand: DataFrame, routes: DataFrame) -> DataFrame:
    zones, lanes = zone_rank(zone_demand), corridors(routes)
    route = F.concat_ws(" → ", "pickup_zone_name", "dropoff_zone_name")
    return zones.agg(F.countDistinct("pickup_zone_name").alias("active_zones")).withColumns({
        "top_zone": _leader(zones, F.col("pickup_zone_name"), "pickup_trip_count"),
        "top_borough": _leader(borough_rank(zone_demand), F.col("pickup_borough"), "pickup_trip_count"),
        "top_route": _leader(lanes, route, "trip_count"),
    })


def borough_matrix(routes: DataFrame, boroughs: Sequence[str] | None = None) -> DataFrame:
    """Pickup by dropoff borough, all that occur unless some are asked for; a pair without trips is zero."""
    wanted = None if boroughs is None else list(boroughs)
    return routes.groupBy("pickup_borough").pivot("dropoff_borough", wanted).agg(F.sum("trip_count")).fillna(0)


# --- time --------------------------------------------------------------------

def _peak(heat: DataFrame, column: str) -> DataFrame:
    sums = heat.groupBy(column).agg(F.sum("trip_count").alias("n"))
    return sums.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(column), F.max("n").alias("n"))


def temporal_kpis(heat: DataFrame, executive: DataFrame) -> DataFrame:
    """Busiest hour and weekday with their trips, mean duration and mean speed."""
    hour, day = _peak(heat, "hour_of_day"), _peak(heat, "day_of_week")
    return heat.agg(weighted_mean("average_duration_seconds", "trip_count").alias("average_duration_seconds")).withColumns({
        "peak_hour": hour.select("hour_of_day").scalar(),
        "peak_hour_trips": hour.select("n").scalar(),
        "peak_day": day.select("day_of_week").scalar(),
        "peak_day_trips": day.select("n").scalar(),
        "average_speed_mph": executive.agg(weighted_mean("average_speed_mph", "trip_count")).scalar(),
    })


def peak_hour(heat: DataFrame) -> DataFrame:
    return _peak(heat, "hour_of_day")


def peak_day(heat: DataFrame) -> DataFrame:
    return _peak(heat, "day_of_week")


def day_hour_matrix(heat: DataFrame) -> DataFrame:
    return heat.groupBy("day_of_week").pivot("hour_of_day", list(range(24))).agg(F.sum("trip_count")).fillna(0)


def hour_by_service(heat: DataFrame) -> DataFrame:
    return labelled(heat).groupBy("service_label", "hour_of_day").agg(F.sum("trip_count").alias("trip_count"))


def hourly_efficiency(operations: DataFrame) -> DataFrame:
    """Hour profile per service: trips, and means of the monthly speed and p95, in one aggregate."""
    return labelled(operations).groupBy("service_label", "hour_of_day").agg(
        F.sum("trip_count").alias("trip_count"), F.avg("average_speed_mph").alias("average_speed_mph"),
        F.avg("p95_duration_seconds").alias("p95_duration_seconds"),
        (F.avg("p95_duration_seconds") / 60.0).alias("p95_minutes"),
    )


# --- money -------------------------------------------------------------------

def finance_kpis(financial: DataFrame) -> DataFrame:
    revenue = total("total_amount")
    return financial.agg(
        total("trip_count").alias("trip_count"), revenue.alias("revenue"),
        weighted_mean("average_total_amount", "trip_count").alias("average_ticket"),
        weighted_mean("average_tip_percentage", "trip_count").alias("average_tip_percentage"),
        F.when(revenue != 0, total("tolls_amount") / revenue).alias("toll_share"),
    )


def money_composition(financial: DataFrame) -> DataFrame:
    """Fare, tip and toll totals as rows."""
    parts = financial.agg(*[total(n).alias(n) for n in ("fare_amount", "tip_amount", "tolls_amount")])
    return parts.selectExpr(
        "stack(3, 'Tarifa', fare_amount, 'Propina', tip_amount, 'Peajes', tolls_amount) AS (component, amount)"
    )


def zone_profitability(drivers: DataFrame, floor: float = 0.50) -> DataFrame:
    means = ("average_total_amount", "average_fare_per_mile", "average_revenue_per_minute", "average_tip_percentage")
    zones = drivers.groupBy("pickup_zone_name", "pickup_borough").agg(
        F.sum("trip_count").alias("trip_count"), *[F.avg(m).alias(m) for m in means]
    )
    return at_least_quantile(zones, "trip_count", floor)


def tip_by_hour(tips: DataFrame) -> DataFrame:
    return named(tips, "time_key").groupBy("time_key").agg(
        F.avg("average_tip_percentage").alias("average_tip_percentage"),
        F.avg("median_tip_percentage").alias("median_tip_percentage"),
        total("credit_card_trip_count").alias("credit_card_trip_count"),
    ).orderBy("time_key")


# --- efficiency --------------------------------------------------------------

def slow_routes(routes: DataFrame, mph: float = 8.0) -> DataFrame:
    return routes.agg(F.count_if(F.col("average_speed_mph") < mph).alias("slow_routes"))


def efficiency_kpis(operations: DataFrame, routes: DataFrame) -> DataFrame:
    means = ("average_speed_mph", "average_duration_seconds", "p95_duration_seconds")
    return operations.agg(*[weighted_mean(m, "trip_count").alias(m) for m in means]).withColumn(
        "slow_routes", slow_routes(routes).scalar()
    )


def slowest_routes(routes: DataFrame, floor: float = 0.60, n: int = 20) -> DataFrame:
    """Slowest of the busier routes."""
    keys = ("pickup_zone_name", "dropoff_zone_name", "service_label")
    lanes = labelled(routes).groupBy(*keys).agg(
        F.sum("trip_count").alias("trip_count"),
        *[F.avg(m).alias(m) for m in ("average_speed_mph", "average_duration_seconds", "average_distance_miles")],
    )
    busy = at_least_quantile(lanes, "trip_count", floor)
    return top(busy, n, F.col("average_speed_mph").asc_nulls_last(), F.desc("trip_count"), *[F.asc(k) for k in keys])


def most_congested_zones(congestion: DataFrame, floor: float = 0.60, n: int = 15) -> DataFrame:
    zones = congestion.groupBy("pickup_zone_name", "pickup_borough").agg(
        F.sum("trip_count").alias("trip_count"), F.avg("congestion_index").alias("congestion_index"),
        F.avg("average_speed_mph").alias("average_speed_mph"),
    )
    busy = at_least_quantile(zones, "trip_count", floor).filter("congestion_index IS NOT NULL")
    return top(busy, n, F.desc("congestion_index"), F.asc("pickup_zone_name"), F.asc("pickup_borough"))


# --- competition -------------------------------------------------------------

def zone_service(competition: DataFrame) -> DataFrame:
    return labelled(competition).groupBy("pickup_zone_key", "pickup_zone_name", "pickup_borough", "service_label").agg(
        F.sum("pickup_trip_count").alias("pickup_trip_count")
    )


def dominant_service(competition: DataFrame) -> DataFrame:
    """Leading service per zone; the first by label wins a tie."""
    label, trips = F.col("service_label"), F.col("pickup_trip_count")
    return named(zone_service(competition), "pickup_zone_key").groupBy("pickup_zone_key").agg(
        F.min_by(label, F.struct(-trips, label)).alias("dominant_service"), F.max(trips).alias("dominant_trips"),
        F.count(label).alias("services"),
    )


def competition_kpis(competition: DataFrame) -> DataFrame:
    lead = dominant_service(competition)
    services = labelled(competition).groupBy("service_label").agg(F.sum("pickup_trip_count").alias("n"))
    held = lead.groupBy("dominant_service").agg(F.count(F.lit(1)).alias("zones"))
    return lead.agg(
        F.count(F.lit(1)).alias("zones"), F.count_if(F.col("services") >= 3).alias("multimodal_zones")
    ).withColumns({
        "leader": _leader(services, F.col("service_label"), "n"),
        "concentration": F.try_divide(held.agg(F.max("zones")).scalar(), F.col("zones")),
    })


_LABELS = tuple(SERVICE_LABELS.values())
MAX_SERVICES = 200  # columns that a matrix may gain


def zone_service_matrix(competition: DataFrame) -> DataFrame:
    """Trips and shares per zone and service; ties go to the earlier service column.

    Services beyond the known ones follow them by name; the mart has one row per zone and service, so they are few.
    """
    keys = ("pickup_zone_key", "pickup_zone_name", "pickup_borough")
    long = named(labelled(competition), *keys)
    others = long.filter(~F.col("service_label").isin(*_LABELS)).select("service_label").distinct().orderBy("service_label")
    added = [r["service_label"] for r in others.limit(MAX_SERVICES + 1).collect()]
    if len(added) > MAX_SERVICES:
        raise ValueError(f"more than {MAX_SERVICES} services beyond the known ones can't be columns")
    labels = [*_LABELS, *added]
    wide = long.groupBy(*keys).pivot("service_label", labels).agg(F.sum("pickup_trip_count")).fillna(0)
    counts = [F.col(f"`{s}`") for s in labels]
    wide = wide.withColumn("total", sum(counts[1:], counts[0]))
    wide = wide.withColumns({
        **{f"{s}_share": F.try_divide(c, F.col("total")) for s, c in zip(labels, counts)},
        "dominant_service": F.coalesce(*[F.when(c == F.greatest(*counts), s) for s, c in zip(labels, counts)]),
    })
    return wide.withColumn("dominant_share", F.greatest(*[F.col(f"`{s}_share`") for s in labels]))


def dominance_table(competition: DataFrame, n: int = 30) -> DataFrame:
    table = zone_service_matrix(competition).select(
        "pickup_zone_name", "pickup_borough", "dominant_service", "dominant_share", "total")
    return top(table, n, F.desc("dominant_share"), F.desc("total"), F.asc("pickup_zone_name"))


# --- model views -------------------------------------------------------------

def forecast_series(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("forecast_timestamp").agg(
        *[F.sum(n).alias(n) for n in ("predicted_trip_count", "lower_bound", "upper_bound")]
    ).orderBy("forecast_timestamp")


def forecast_levels(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("demand_level").agg(F.sum("predicted_trip_count").alias("predicted_trip_count"))


def forecast_top_zones(predictions: DataFrame, n: int = 15) -> DataFrame:
    zones = predictions.groupBy("pickup_zone_name", "pickup_borough").agg(
        F.sum("predicted_trip_count").alias("predicted_trip_count"))
    return top(zones, n, F.desc("predicted_trip_count"), F.asc("pickup_zone_name"), F.asc("pickup_borough"))


def forecast_peak(predictions: DataFrame) -> DataFrame:
    row = F.struct("forecast_timestamp", "pickup_zone_name", "service_type", "predicted_trip_count")
    return predictions.agg(F.max_by(row, F.struct("predicted_trip_count", "forecast_timestamp", "pickup_zone_name",
                                                  "service_type")).alias("peak")).select("peak.*")


def segment_sizes(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("segment_name").agg(
        F.countDistinct("zone_key").alias("zone_count"), F.sum("total_pickups").alias("total_pickups")
    ).orderBy("zone_count", "segment_name")


def silhouette_by_k(metrics: DataFrame) -> DataFrame:
    k = F.regexp_extract("metric_name", r"^silhouette_k_(\d+)$", 1)
    return metrics.filter(k != "").select(k.try_cast("int").alias("k"), F.col("metric_value").alias("silhouette")).orderBy("k")


RADAR = ("night_trip_share", "weekend_trip_share", "airport_trip_share", "service_diversity",
         "demand_coefficient_of_variation")


def min_max_normalised(df: DataFrame, columns: Sequence[str] = RADAR) -> DataFrame:
    """Each column scaled to 0..1 over the whole table; a constant column becomes 0.5."""
    bounds = df.agg(F.struct(
        *[F.min(n).cast("double").alias(f"{n}_min") for n in columns],
        *[F.max(n).cast("double").alias(f"{n}_max") for n in columns],
    )).scalar()
    held = df.withColumn("_bounds", bounds)

    def scaled(name: str) -> Column:
        low, high = F.col(f"_bounds.{name}_min"), F.col(f"_bounds.{name}_max")
        return F.when(low == high, F.lit(0.5)).otherwise((F.col(name) - low) / F.nullif(high - low, F.lit(0.0)))

    return held.withColumns({n: scaled(n) for n in columns}).drop("_bounds")


def risk_kpis(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.avg((F.col("risk_probability") >= 0.60).cast("double")).alias("high_risk_share"),
        F.avg("request_to_pickup_seconds").alias("average_wait_seconds"),
    )


def risk_top_zones(predictions: DataFrame, floor: float = 0.50, n: int = 15) -> DataFrame:
    zones = predictions.groupBy("pickup_zone_name", "pickup_borough").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("risk_probability").alias("average_risk"),
        F.avg("request_to_pickup_seconds").alias("average_wait_seconds"))
    return top(at_least_quantile(zones, "trips", floor), n, F.desc(F.round("average_risk", 9)), F.asc("pickup_zone_name"),
               F.asc("pickup_borough"))


def risk_levels(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("predicted_risk_level").agg(F.count(F.lit(1)).alias("trips"))


def top_risk_trips(predictions: DataFrame, n: int = 30) -> DataFrame:
    shown = predictions.select("trip_key", "request_datetime", "pickup_zone_name", "pickup_borough", "hvfhs_company_name",
                               "request_to_pickup_seconds", "risk_probability", "predicted_risk_level")
    return top(shown, n, F.desc("risk_probability"), F.asc("trip_key"))


def top_importance(importance: DataFrame, n: int = 20) -> DataFrame:
    return top(importance, n, F.desc("importance"), F.asc("feature_name"))
