"""Fixed values and parameters: services, field contracts, thresholds, model settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# Service codes and their keys.
SERVICE_KEYS = {"yellow": 1, "green": 2, "fhv": 3, "fhvhv": 4}
TAXI_SERVICES = ("yellow", "green")
SERVICE_LABELS = {"yellow": "Yellow", "green": "Green", "fhv": "FHV", "fhvhv": "HVFHV"}
HV_COMPANIES = {"HV0002": "Juno", "HV0003": "Uber", "HV0004": "Via", "HV0005": "Lyft"}
VENDORS = {"yellow": (1, 2, 6, 7), "green": (1, 2, 6)}
RATE_CODES = (1, 2, 3, 4, 5, 6, 99)
AIRPORT_ZONES = {1: "EWR", 132: "JFK", 138: "LGA"}
PEAK_HOURS = (7, 8, 9, 16, 17, 18, 19)
NULL_MARK = "∅"


@dataclass(frozen=True)
class QualityLimits:
    location_min: int = 1
    location_max: int = 265
    taxi_max_hours: int = 12
    fhv_max_hours: int = 24
    max_passengers: int = 7
    max_miles: int = 1000
    max_total: int = 400
    impute_passengers: bool = True
    reject_zero_distance: bool = False
    reject_negative_components: bool = True
    store_flags: tuple[str, ...] = ("Y", "N")
    yes_no: tuple[str, ...] = ("Y", "N")


@dataclass(frozen=True)
class Field:
    """One logical input field: where it may be found, its type and its default."""

    name: str
    type: str
    aliases: tuple[str, ...]
    accepted: tuple[str, ...] = ()
    default: object = None

    @property
    def required(self) -> bool:
        return bool(self.accepted)


_WHEN = ("timestamp", "timestamp_ntz")
_INTS = ("byte", "short", "int", "integer", "long")
_TEXT = ("string",)


def _money(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, "double", (n,), default=0.0) for n in names)


def _taxi(prefix: str) -> tuple[Field, ...]:
    return (
        Field("pickup_datetime", "timestamp_ntz", (f"{prefix}_pickup_datetime",), _WHEN),
        Field("dropoff_datetime", "timestamp_ntz", (f"{prefix}_dropoff_datetime",), _WHEN),
        Field("pickup_location_id", "int", ("PULocationID",), _INTS),
        Field("dropoff_location_id", "int", ("DOLocationID",), _INTS),
        Field("vendor_id", "bigint", ("VendorID",)),
        Field("passenger_count", "double", ("passenger_count",)),
        Field("trip_distance", "double", ("trip_distance",)),
        Field("rate_code_id", "bigint", ("RatecodeID",)),
        Field("store_and_fwd_flag", "string", ("store_and_fwd_flag",)),
        Field("payment_type", "bigint", ("payment_type",)),
        Field("fare_amount", "double", ("fare_amount",)),
        Field("total_amount", "double", ("total_amount",)),
        *_money("extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
                "congestion_surcharge", "airport_fee", "cbd_congestion_fee"),
    )


# Alias lookup ignores case, so one spelling per distinct name is enough.
FIELDS: dict[str, tuple[Field, ...]] = {
    "yellow": _taxi("tpep"),
    "green": (
        *_taxi("lpep"),
        Field("trip_type", "bigint", ("trip_type",)),
        Field("ehail_fee", "double", ("ehail_fee",), default=0.0),
    ),
    "fhv": (
        Field("dispatching_base_num", "string", ("dispatching_base_num",), _TEXT),
        Field("pickup_datetime", "timestamp_ntz", ("pickup_datetime",), _WHEN),
        Field("dropoff_datetime", "timestamp_ntz", ("dropOff_datetime",), _WHEN),
        Field("pickup_location_id", "int", ("PUlocationID",), (*_INTS, "double")),
        Field("dropoff_location_id", "int", ("DOlocationID",), (*_INTS, "double")),
        Field("shared_ride_flag", "string", ("SR_Flag",)),
        Field("affiliated_base_number", "string", ("Affiliated_base_number",)),
    ),
    "fhvhv": (
        Field("hvfhs_license_num", "string", ("hvfhs_license_num",), _TEXT),
        Field("dispatching_base_num", "string", ("dispatching_base_num",), _TEXT),
        Field("request_datetime", "timestamp_ntz", ("request_datetime",), _WHEN),
        Field("pickup_datetime", "timestamp_ntz", ("pickup_datetime",), _WHEN),
        Field("dropoff_datetime", "timestamp_ntz", ("dropoff_datetime",), _WHEN),
        Field("pickup_location_id", "int", ("PULocationID",), _INTS),
        Field("dropoff_location_id", "int", ("DOLocationID",), _INTS),
        Field("originating_base_num", "string", ("originating_base_num",)),
        Field("on_scene_datetime", "timestamp_ntz", ("on_scene_datetime",)),
        Field("trip_miles", "double", ("trip_miles",)),
        Field("trip_time", "bigint", ("trip_time",)),
        *_money("base_passenger_fare", "tolls"),
        Field("black_car_fund", "double", ("bcf",), default=0.0),
        *_money("sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay"),
        Field("shared_request_flag", "string", ("shared_request_flag",)),
        Field("shared_match_flag", "string", ("shared_match_flag",)),
        Field("access_a_ride_flag", "string", ("access_a_ride_flag",)),
        Field("wav_request_flag", "string", ("wav_request_flag",)),
        Field("wav_match_flag", "string", ("wav_match_flag",)),
        *_money("cbd_congestion_fee"),
    ),
}

HV_MONEY = ("base_passenger_fare", "tolls", "black_car_fund", "sales_tax", "congestion_surcharge",
            "airport_fee", "tips", "driver_pay", "cbd_congestion_fee")
TAXI_COMPONENTS = ("extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
                   "congestion_surcharge", "airport_fee", "cbd_congestion_fee")
HV_FLAGS = {  # raw flag -> boolean column
    "shared_request_flag": "shared_requested",
    "shared_match_flag": "shared_matched",
    "access_a_ride_flag": "access_a_ride",
    "wav_request_flag": "wav_requested",
    "wav_match_flag": "wav_matched",
}

# Attributes that identify a trip, per service, in hashing order.
IDENTITY = {
    "yellow": ("service_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
               "dropoff_location_id", "vendor_id", "trip_distance", "total_amount"),
    "fhv": ("service_type", "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
            "pickup_location_id", "dropoff_location_id"),
    "fhvhv": ("service_type", "hvfhs_license_num", "dispatching_base_num", "request_datetime",
              "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
              "trip_miles", "base_passenger_fare"),
}
IDENTITY["green"] = IDENTITY["yellow"]


@dataclass(frozen=True)
class ForecastSettings:
    train_start: str = "2023-01-01 00:00:00"
    train_end: str = "2025-06-30 23:00:00"
    validation_end: str = "2025-09-30 23:00:00"
    test_end: str = "2025-12-31 23:00:00"
    horizon_hours: int = 24
    min_active_hours: int = 168
    min_total_trips: int = 500
    zscore: float = 3.0
    algorithms: tuple[str, ...] = ("gbt", "random_forest", "poisson_glr")
    gbt_iterations: int = 60
    gbt_depth: int = 8
    forest_trees: int = 80
    forest_depth: int = 12
    glr_iterations: int = 60
    regularisation: float = 0.05
    seed: int = 42


@dataclass(frozen=True)
class SegmentSettings:
    k_min: int = 3
    k_max: int = 8
    iterations: int = 50
    seed: int = 42


@dataclass(frozen=True)
class WaitRiskSettings:
    train_end: str = "2023-08-31 23:59:59"
    validation_end: str = "2023-10-31 23:59:59"
    test_end: str = "2023-12-31 23:59:59"
    threshold_seconds: int = 600
    algorithms: tuple[str, ...] = ("logistic_regression", "random_forest", "gbt")
    logistic_iterations: int = 80
    forest_trees: int = 100
    forest_depth: int = 12
    gbt_iterations: int = 70
    gbt_depth: int = 8
    regularisation: float = 0.05
    seed: int = 42


@dataclass(frozen=True)
class ServiceScope:
    """First published period and the bounded window a project works on."""

    available_from: tuple[int, int] = (2019, 1)
    scope_from: tuple[int, int] = (2023, 1)
    scope_to: tuple[int, int] = (2026, 12)


DEFAULT_SCOPES = {
    "yellow": ServiceScope(),
    "green": ServiceScope(),
    "fhv": ServiceScope(),
    "fhvhv": ServiceScope(available_from=(2019, 2)),
}
PARTIAL_COVERAGE_YEARS = {"fhvhv": (2023,)}


@dataclass(frozen=True)
class Scope:
    """Dashboard selection; an empty tuple means no restriction."""

    years: tuple[int, ...] = field(default=())
    months: tuple[int, ...] = field(default=())
    services: tuple[str, ...] = field(default=())
