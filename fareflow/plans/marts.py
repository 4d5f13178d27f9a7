"""Seventeen marts, declared as grain and measures.

Each mart aggregates a fact by its integer keys and only then looks up zone
names. Averages are kept as sum and count, so the marts without percentiles can
also be rolled up from one shared pre-aggregate instead of rescanning the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.sources.sinks import write_dataset



@dataclass(frozen=True)
class Measure:
    kind: str  # sum, avg, flag (count of true), median, p95
    source: str

    def direct(self) -> Column:
        col = F.col(self.source)
        if self.kind == "sum":
            return F.sum(col)
        if self.kind == "avg":
            return F.avg(col)
        if self.kind == "flag":
            return F.sum(col.cast("long"))
        return F.percentile_approx(col, {"median": 0.5, "p95": 0.95}[self.kind])

    def rolled_up(self) -> Column:
        if self.kind == "avg":
            return F.try_divide(F.sum(f"{self.source}__sum"), F.sum(f"{self.source}__n"))
        return F.sum(f"{self.source}__sum")


@dataclass(frozen=True)
class Mart:
    fact: str
    keys: tuple[str, ...]
    measures: dict[str, Measure]
    where: str | None = None
    labels: tuple[str, ...] = ()  # ends whose zone name and borough are looked up
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)  # name -> (top, positive bottom)
    share: tuple[str, str, str, tuple[str, ...]] | None = None  # ratio, total, counted, within
    label_borough: bool = True


def _sum(source: str) -> Measure:
    return Measure("sum", source)


def _avg(source: str) -> Measure:
    return Measure("avg", source)


_PERIOD = ("source_year", "source_month")
_MONTHLY = (*_PERIOD, "service_type")
_TRIPS = {"trip_count": _sum("trip_count")}
_DURATION = {"average_duration_seconds": _avg("trip_duration_seconds")}
_DISTANCE = {"average_distance_miles": _avg("trip_distance_miles")}
_SPEED = {"average_speed_mph": _avg("average_speed_mph")}
_P95 = {"p95_duration_seconds": Measure("p95", "trip_duration_seconds")}
_ZONE_DEMAND = {"pickup_trip_count": _sum("trip_count"), **_DURATION, **_DISTANCE, **_SPEED}
_EXECUTIVE = {
    **_TRIPS, **_DURATION, **_DISTANCE, **_SPEED,
    "airport_trip_count": Measure("flag", "airport_trip_flag"),
    "quality_warning_count": _sum("quality_warning_count"),
}
_OD = dict(fact="trip_activity", keys=(*_MONTHLY, "pickup_zone_key", "dropoff_zone_key"),
           measures={**_TRIPS, **_DURATION, **_DISTANCE, **_SPEED}, labels=("pickup", "dropoff"))
_PROVIDER = (*_PERIOD, "provider_key", "hvfhs_company_name")

MARTS: dict[str, Mart] = {
    "executive_monthly": Mart("trip_activity", _MONTHLY, _EXECUTIVE),
    "service_share": Mart(
        "trip_activity", _MONTHLY, _EXECUTIVE,
        share=("service_share", "all_services_trip_count", "trip_count", _PERIOD),
    ),
    "daily_demand": Mart("trip_activity", ("event_date", "service_type"), _TRIPS),
    "zone_demand": Mart("trip_activity", (*_MONTHLY, "pickup_zone_key"), _ZONE_DEMAND, labels=("pickup",)),
    "od_routes": Mart(**_OD),
    "time_heatmap": Mart("trip_activity", ("service_type", "day_of_week", "hour_of_day"), {**_TRIPS, **_DURATION}),
    "financial_profile": Mart("taxi_financial", _MONTHLY, {
        **_TRIPS,
        **{n: _sum(n) for n in ("fare_amount", "tip_amount", "tolls_amount", "total_amount")},
        "average_total_amount": _avg("total_amount"),
        "average_tip_percentage": _avg("tip_percentage"),
    }),
    "airport_activity": Mart("trip_activity", (*_MONTHLY, "airport_trip_flag"), {**_TRIPS, **_DURATION, **_DISTANCE}),
    "profitability_drivers": Mart(
        "taxi_financial", (*_MONTHLY, "pickup_zone_key", "time_key", "airport_trip_flag"),
        {
            **_TRIPS,
            "average_total_amount": _avg("total_amount"),
            "average_fare_per_mile": _avg("fare_per_mile"),
            "average_revenue_per_minute": _avg("revenue_per_minute"),
            "average_tip_percentage": _avg("tip_percentage"),
        },
        labels=("pickup",),
    ),
    # Cash tips are never recorded, so only card trips say anything about tips.
    "tip_behavior": Mart(
        "taxi_financial", (*_MONTHLY, "pickup_zone_key", "time_key"),
        {
            "credit_card_trip_count": _sum("trip_count"),
            "average_tip_amount": _avg("tip_amount"),
            "average_tip_percentage": _avg("tip_percentage"),
            "median_tip_percentage": Measure("median", "tip_percentage"),
        },
        where="payment_type_key = 1", labels=("pickup",),
    ),
    "operational_efficiency": Mart("trip_activity", (*_MONTHLY, "hour_of_day"), {**_TRIPS, **_DURATION, **_P95, **_SPEED}),
    "route_efficiency": Mart(**_OD, label_borough=False),
    "zone_congestion": Mart(
        "trip_activity", (*_MONTHLY, "pickup_zone_key", "hour_of_day"), {**_TRIPS, **_SPEED, **_DURATION, **_P95},
        labels=("pickup",), ratios={"congestion_index": ("p95_duration_seconds", "average_speed_mph")},
    ),
    "service_competition": Mart(
        "trip_activity", (*_MONTHLY, "pickup_zone_key"), _ZONE_DEMAND, labels=("pickup",),
        share=("zone_service_share", "zone_total_trip_count", "pickup_trip_count", (*_PERIOD, "pickup_zone_key")),
    ),
    "hvfhv_service_quality": Mart(
        "hvfhv_operations", (*_PROVIDER, "pickup_zone_key", "request_time_key"),
        {
            **_TRIPS,
            "average_request_to_pickup_seconds": _avg("request_to_pickup_seconds"),
            "p95_request_to_pickup_seconds": Measure("p95", "request_to_pickup_seconds"),
            "average_driver_wait_seconds": _avg("driver_wait_seconds"),
            "average_driver_pay": _avg("driver_pay"),
        },
        labels=("pickup",),
    ),
    "shared_ride_performance": Mart(
        "hvfhv_operations", _PROVIDER,
        {
            **_TRIPS,
            "shared_requested_count": Measure("flag", "shared_requested"),
            "shared_matched_count": Measure("flag", "shared_matched"),
        },
        ratios={"shared_match_rate": ("shared_matched_count", "shared_requested_count")},
    ),
    "accessibility_performance": Mart(
        "hvfhv_operations", _PROVIDER,
        {
            **_TRIPS,
            "access_a_ride_count": Measure("flag", "access_a_ride"),
            "wav_requested_count": Measure("flag", "wav_requested"),
            "wav_matched_count": Measure("flag", "wav_matched"),
        },
        ratios={"wav_match_rate": ("wav_matched_count", "wav_requested_count")},
    ),
}

# Grain columns that are computed from the pickup time rather than stored.
_TIME_KEYS = {
    "event_date": lambda: F.to_date("pickup_datetime"),
    "day_of_week": lambda: F.dayofweek("pickup_datetime"),
    "hour_of_day": lambda: F.hour("pickup_datetime"),
}


def _grain(keys: Sequence[str], stored: bool) -> list[Column]:
    return [F.col(k) if stored or k not in _TIME_KEYS else _TIME_KEYS[k]().alias(k) for k in keys]


def zone_labels(dim_zone: DataFrame, end: str, borough: bool = True) -> DataFrame:
    """Zone names keyed for one end of a trip; Spark broadcasts them as long as they are small."""
    wanted = [F.col("zone_key").alias(f"{end}_zone_key"), F.col("zone_name").alias(f"{end}_zone_name")]
    if borough:
        wanted.append(F.col("borough").alias(f"{end}_borough"))
    return dim_zone.select(*wanted)


def positive_ratio(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom))


def _finish(mart: Mart, df: DataFrame, dim_zone: DataFrame | None) -> DataFrame:
    if mart.share:
        name, total, counted, within = mart.share
        # A null zone key has no total, as an equality join would leave it.
        known = F.lit(True)
        for key in within:
            known = known & F.col(key).isNotNull()
        df = df.withColumn(total, F.when(known, F.sum(counted).over(Window.partitionBy(*within))))
        df = df.withColumn(name, positive_ratio(counted, total))
    for name, (top, bottom) in mart.ratios.items():
        df = df.withColumn(name, positive_ratio(top, bottom))
    for end in mart.labels:
        df = df.join(zone_labels(dim_zone, end, mart.label_borough), f"{end}_zone_key", "left")
    return df


def build_mart(name: str, facts: dict[str, DataFrame], dim_zone: DataFrame) -> DataFrame:
    mart = MARTS[name]
    fact = facts[mart.fact]
    if mart.where:
        fact = fact.filter(mart.where)
    grouped = fact.groupBy(*_grain(mart.keys, stored=False)).agg(
        *[m.direct().alias(alias) for alias, m in mart.measures.items()]
    )
    return _finish(mart, grouped, dim_zone)


def build_marts(facts: dict[str, DataFrame], dim_zone: DataFrame) -> dict[str, DataFrame]:
    return {name: build_mart(name, facts, dim_zone) for name in MARTS}


# --- shared pre-aggregate ----------------------------------------------------

ROLLUP_KEYS = ("source_year", "source_month", "service_type", "pickup_zone_key", "airport_trip_flag",
               "event_date", "day_of_week", "hour_of_day")
_ROLLUP_SUMS = ("trip_count", "trip_duration_seconds", "trip_distance_miles", "average_speed_mph",
                "quality_warning_count")


def activity_rollup(trip_activity: DataFrame) -> DataFrame:
    """Sums and counts per zone, hour, service and airport flag: one scan that feeds many marts.

    Write it out once (``write_dataset``) and roll the marts up from the copy.
    """
    sums = [
        *[F.sum(s).alias(f"{s}__sum") for s in _ROLLUP_SUMS],
        *[F.count(s).alias(f"{s}__n") for s in _ROLLUP_SUMS],
        F.sum(F.col("airport_trip_flag").cast("long")).alias("airport_trip_flag__sum"),
    ]
    return trip_activity.groupBy(*_grain(ROLLUP_KEYS, stored=False)).agg(*sums)


def rolls_up(name: str) -> bool:
    mart = MARTS[name]
    return (
        mart.fact == "trip_activity" and mart.where is None and set(mart.keys) <= set(ROLLUP_KEYS)
        and all(m.kind in ("sum", "avg", "flag") for m in mart.measures.values())
    )


def roll_up_mart(name: str, rollup: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """The same mart from the shared pre-aggregate."""
    mart = MARTS[name]
    grouped = rollup.groupBy(*_grain(mart.keys, stored=True)).agg(
        *[m.rolled_up().alias(alias) for alias, m in mart.measures.items()]
    )
    return _finish(mart, grouped, dim_zone)


# --- percentiles from counts of values -----------------------------------------

@dataclass(frozen=True)
class ValueCounts:
    """Pre-aggregate with a row per key and value: exact percentiles of the value can be read off it at any coarser grain."""

    fact: str
    keys: tuple[str, ...]
    value: str
    sums: tuple[str, ...]
    where: str | None = None


VALUE_COUNTS = {
    "activity": ValueCounts("trip_activity", ROLLUP_KEYS, "trip_duration_seconds", _ROLLUP_SUMS),
    "card_tips": ValueCounts(
        "taxi_financial", MARTS["tip_behavior"].keys, "tip_percentage", ("trip_count", "tip_amount", "tip_percentage"),
        MARTS["tip_behavior"].where),
    "hvfhv_waits": ValueCounts(
        "hvfhv_operations", MARTS["hvfhv_service_quality"].keys, "request_to_pickup_seconds",
        ("trip_count", "request_to_pickup_seconds", "driver_wait_seconds", "driver_pay")),
}
PERCENTILE_MARTS = {"tip_behavior": "card_tips", "operational_efficiency": "activity", "zone_congestion": "activity",
                    "hvfhv_service_quality": "hvfhv_waits"}
_SHARES = {"median": 0.5, "p95": 0.95}


def value_counts(name: str, fact: DataFrame) -> DataFrame:
    """Sums and counts per key and value. Durations and waits are whole seconds, so trips share values.

    Write it out once; marts with and without percentiles are rolled up from the copy.
    """
    spec = VALUE_COUNTS[name]
    if spec.where:
        fact = fact.filter(spec.where)
    sums = [F.sum(s).alias(f"{s}__sum") for s in spec.sums] + [F.count(s).alias(f"{s}__n") for s in spec.sums]
    flags = [F.sum(F.col("airport_trip_flag").cast("long")).alias("airport_trip_flag__sum")] if "airport_trip_flag" in spec.keys else []
    return fact.groupBy(*_grain(spec.keys, stored=False), F.col(spec.value).alias("value")).agg(*sums, *flags, F.count(spec.value).alias("value__n"))


def rollup_of_values(values: DataFrame) -> DataFrame:
    """The shared pre-aggregate without values."""
    measures = [c for c in values.columns if "__" in c and c != "value__n"]
    return values.groupBy(*ROLLUP_KEYS).agg(*[F.sum(c).alias(c) for c in measures])


def roll_up_percentiles(name: str, values: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """A mart with exact percentiles from counts of values.

    A percentile is the least value up to which the running count reaches its share. The running count goes over a group's
    distinct values, which are bounded by their domain, and never over its trips.
    """
    mart = MARTS[name]
    sums = sorted({c for m in mart.measures.values() if m.kind not in _SHARES for c in (f"{m.source}__sum", f"{m.source}__n")} & set(values.columns))
    merged = values.groupBy(*_grain(mart.keys, stored=True), "value").agg(*[F.sum(c).alias(c) for c in (*sums, "value__n")])
    group = Window.partitionBy(*mart.keys)
    merged = merged.withColumns({"_up_to": F.sum("value__n").over(group.orderBy("value")), "_all": F.sum("value__n").over(group)})

    def measure(m: Measure) -> Column:
        if m.kind not in _SHARES:
            return m.rolled_up()
        rank = F.greatest(F.ceil(F.lit(_SHARES[m.kind]) * F.col("_all")), F.lit(1))
        return F.min(F.when(F.col("_up_to") >= rank, F.col("value")))

    return _finish(mart, merged.groupBy(*mart.keys).agg(*[measure(m).alias(alias) for alias, m in mart.measures.items()]), dim_zone)


def publish_marts(facts: dict[str, DataFrame], dim_zone: DataFrame, root: str) -> dict[str, str]:
    """Write all marts. Each fact is scanned once for its counts of values, and marts with percentiles and the shared
    pre-aggregate are rolled up from these.

    Only the OD marts and those of the smaller facts without percentiles go back to their fact.
    """
    read = dim_zone.sparkSession.read
    values, paths = {}, {}
    for name, spec in VALUE_COUNTS.items():
        write_dataset(value_counts(name, facts[spec.fact]), f"{root}/{name}_values")
        values[name] = read.parquet(f"{root}/{name}_values")
    write_dataset(rollup_of_values(values["activity"]), f"{root}/activity_rollup")
    rollup = read.parquet(f"{root}/activity_rollup")
    for name in MARTS:
        if name == "route_efficiency":  # a view of the OD mart, which is written by then
            mart = route_view(read.parquet(paths["od_routes"]))
        elif rolls_up(name):
            mart = roll_up_mart(name, rollup, dim_zone)
        elif name in PERCENTILE_MARTS:
            mart = roll_up_percentiles(name, values[PERCENTILE_MARTS[name]], dim_zone)
        else:
            mart = build_mart(name, facts, dim_zone)
        paths[name] = f"{root}/{name}"
        write_dataset(mart, paths[name])
    return paths


def route_view(od_routes: DataFrame) -> DataFrame:
    """Route efficiency is the OD mart without boroughs."""
    return od_routes.drop("pickup_borough", "dropoff_borough")
