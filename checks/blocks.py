"""DuckDB SQL building blocks; a statement pulls in the blocks it names."""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}


def compose(final: str) -> str:
    """Prefix ``final`` with the blocks it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_][a-z0-9_]*", text)):
            if word in BLOCKS and word not in ordered and BLOCKS[word] is not text:
                visit(BLOCKS[word])
                if word not in ordered:
                    ordered.append(word)

    visit(final)
    ctes = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in ordered)
    if not ctes:
        return final
    text = final.strip()
    return f"WITH {ctes},\n{text[4:]}" if text.startswith("WITH") else f"WITH {ctes}\n{text}"


def rnd(expression: str, name: str | None = None) -> str:
    """Six digits, shifted off the halfway points as on the Spark side."""
    return f"round(CAST({expression} AS DOUBLE) + 1e-9, 6) AS {name or expression}"


def rounded(names: str) -> str:
    return ", ".join(rnd(n) for n in names.split())


BLOCKS["b_base"] = """
SELECT l.*, o.o_orderdate, year(o.o_orderdate) AS source_year, month(o.o_orderdate) AS source_month,
       l.l_partkey * 37 + l.l_linenumber * 101 + l.l_suppkey * 13 AS h
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

BLOCKS["b_replayed"] = """
SELECT *, 1 AS copy_no FROM b_base UNION ALL SELECT *, 2 AS copy_no FROM b_base WHERE h % 101 = 0"""

BLOCKS["b_timed"] = """
SELECT *,
  CASE l_orderkey % 4 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' WHEN 2 THEN 'fhv' ELSE 'fhvhv' END AS service_type,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE), copy_no) AS source_record,
  CASE WHEN h % 211 = 0 THEN NULL WHEN h % 97 = 0 THEN o_orderdate + INTERVAL '40' DAY
       ELSE o_orderdate + INTERVAL '1' MINUTE * (h % 1440) END AS pickup,
  CAST((l_quantity - 2) * 60 * (1 + l_linenumber) AS BIGINT) + CASE WHEN h % 89 = 0 THEN 100000 ELSE 0 END AS dur,
  CAST(1 + l_partkey % 268 AS INT) AS pu_id,
  CAST(1 + (l_partkey * 3 + l_suppkey) % 266 AS INT) AS do_id,
  CASE WHEN h % 227 = 0 THEN NULL WHEN h % 83 = 0 THEN CAST(1500 AS DOUBLE)
       ELSE CAST(floor(l_quantity * l_discount * 400) AS DOUBLE) / CAST(100 AS DOUBLE) END AS dist,
  CASE WHEN h % 79 = 0 THEN -1 ELSE 1 END
    * CAST(floor(l_extendedprice / 2.5) AS DOUBLE) / CAST(100 AS DOUBLE) AS fare
FROM b_replayed"""

BLOCKS["raw"] = """
SELECT service_type, source_year, source_month, source_record, pickup,
  CASE WHEN h % 199 = 0 THEN NULL ELSE pickup + INTERVAL '1' SECOND * dur END AS dropoff, pu_id, do_id, dist, fare,
  CASE WHEN h % 73 = 0 THEN fare + 60
       ELSE CAST(floor(fare * l_tax * 400) AS DOUBLE) / CAST(100 AS DOUBLE) END AS tip,
  CAST(CASE WHEN h % 71 = 0 THEN 45 ELSE 0 END AS DOUBLE) AS tolls,
  CAST(CASE WHEN h % 67 = 0 THEN -1 ELSE h % 3 END AS DOUBLE) AS extra,
  CASE WHEN h % 61 = 0 THEN NULL WHEN h % 59 = 0 THEN CAST(0 AS DOUBLE) WHEN h % 53 = 0 THEN CAST(9 AS DOUBLE)
       ELSE CAST(l_linenumber AS DOUBLE) END AS passengers,
  CASE l_suppkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 7 END AS vendor,
  CAST(1 + l_linenumber AS BIGINT) AS rate_code, CAST(l_linenumber AS BIGINT) AS payment,
  CAST(l_linenumber % 3 AS BIGINT) AS raw_trip_type,
  CASE h % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'n' WHEN 2 THEN ' N ' WHEN 3 THEN 'X' END AS flag_text,
  CASE h % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '1.0' WHEN 3 THEN 'X' END AS sr_flag,
  CASE WHEN h % 47 = 0 THEN NULL ELSE concat(' b', lpad(CAST(l_suppkey AS VARCHAR), 5, '0'), ' ') END AS base_num,
  concat('B', lpad(CAST((l_suppkey + 1) % 1000 AS VARCHAR), 5, '0')) AS base_num2,
  CASE WHEN h % 43 = 0 THEN NULL ELSE CASE l_suppkey % 5 WHEN 0 THEN 'HV0002' WHEN 1 THEN 'HV0003'
       WHEN 2 THEN 'HV0004' WHEN 3 THEN 'HV0005' ELSE 'HV9999' END END AS hv_license,
  CASE WHEN h % 41 = 0 THEN pickup + INTERVAL '60' SECOND ELSE pickup - INTERVAL '1' SECOND * (h % 1500) END
    AS request_ts,
  CASE WHEN h % 31 = 0 THEN NULL WHEN h % 37 = 0 THEN pickup + INTERVAL '30' SECOND
       ELSE pickup - INTERVAL '1' SECOND * (h % 300) END AS on_scene_ts,
  CASE WHEN h % 29 = 0 THEN 0 WHEN h % 23 = 0 THEN dur + 700 ELSE dur END AS trip_time,
  CASE h % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'q' END AS share_match,
  CASE h % 7 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'Z' END AS wav_req,
  CASE h % 11 WHEN 0 THEN 'Y' WHEN 1 THEN 'Z' ELSE 'N' END AS wav_match,
  CASE h % 17 WHEN 0 THEN 'Y' WHEN 1 THEN 'Z' ELSE 'N' END AS access_flag,
  CASE WHEN h % 229 = 0 THEN NULL ELSE 1 END AS total_present
FROM b_timed"""

BLOCKS["zones"] = """
SELECT CAST(i AS INT) AS location_id, r_name AS borough, concat('Zone ', i) AS zone_name,
  CASE i % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone' ELSE 'Airports' END AS service_zone
FROM range(1, 264) t(i) JOIN nation ON n_nationkey = i % 25 JOIN region ON r_regionkey = n_regionkey"""

BLOCKS["bases"] = """
SELECT concat('B', lpad(CAST(s_suppkey AS VARCHAR), 5, '0')) AS base_license_number, s_name AS base_name,
  concat('DBA ', s_name) AS doing_business_as,
  CASE s_suppkey % 3 WHEN 0 THEN 'BLACK-CAR' WHEN 1 THEN 'LIVERY' ELSE 'LUXURY' END AS base_type,
  CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status
FROM supplier WHERE s_suppkey % 10 <> 9"""

BLOCKS["dim_zone"] = """
SELECT location_id AS zone_key, location_id, zone_name, borough, service_zone,
  location_id IN (1, 132, 138) AS is_airport,
  CASE location_id WHEN 1 THEN 'EWR' WHEN 132 THEN 'JFK' WHEN 138 THEN 'LGA' END AS airport_name
FROM zones"""

_TIME = """
  datediff('second', pickup, dropoff) AS trip_duration_seconds,
  pu_id IN (1, 132, 138) OR do_id IN (1, 132, 138) AS airport_trip_flag,
  CAST(pickup AS DATE) AS pickup_date, CAST(dropoff AS DATE) AS dropoff_date,
  CAST(hour(pickup) AS INT) AS pickup_hour, CAST(dayofweek(pickup) + 1 AS INT) AS pickup_day_of_week,
  dayofweek(pickup) IN (0, 6) AS weekend_trip_flag,
  hour(pickup) < 6 OR hour(pickup) >= 22 AS night_trip_flag,
  pickup AS pickup_datetime, dropoff AS dropoff_datetime, pu_id AS pickup_location_id,
  do_id AS dropoff_location_id"""


def _identity(*names: str) -> str:
    parts = ", ".join(f"coalesce(CAST({n} AS VARCHAR), '∅')" for n in names)
    return f"sha256(concat_ws('||', {parts}))"


def _codes(pairs: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for code, cond in pairs)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


_COMMON = lambda hours: [
    ("MISSING_PICKUP_DATETIME", "pickup_datetime IS NULL"),
    ("MISSING_DROPOFF_DATETIME", "dropoff_datetime IS NULL"),
    ("INVALID_DATE_ORDER", "trip_duration_seconds <= 0"),
    ("DURATION_ABOVE_LIMIT", f"trip_duration_seconds > {hours} * 3600"),
    ("PICKUP_OUTSIDE_SOURCE_PERIOD",
     "pickup_datetime IS NOT NULL AND (year(pickup_datetime) <> source_year OR month(pickup_datetime) <> source_month)"),
    ("INVALID_PICKUP_LOCATION", "pickup_location_id IS NULL OR NOT (pickup_location_id BETWEEN 1 AND 265)"),
    ("INVALID_DROPOFF_LOCATION", "dropoff_location_id IS NULL OR NOT (dropoff_location_id BETWEEN 1 AND 265)"),
]
_REPEAT = ("DUPLICATE_TRIP", "repeat_rank > 1")
_ZONES = [
    ("PICKUP_ZONE_NOT_IN_LOOKUP", "pickup_location_id IS NOT NULL AND pickup_zone_name IS NULL"),
    ("DROPOFF_ZONE_NOT_IN_LOOKUP", "dropoff_location_id IS NOT NULL AND dropoff_zone_name IS NULL"),
]
_NO_BASE = ("MISSING_DISPATCHING_BASE", "dispatching_base_num IS NULL OR length(dispatching_base_num) = 0")
_COMPONENTS = ["extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
               "airport_fee", "cbd_congestion_fee"]
_HV_MONEY = ["base_passenger_fare", "tolls", "black_car_fund", "sales_tax", "congestion_surcharge", "airport_fee",
             "tips", "driver_pay", "cbd_congestion_fee"]


def _either(columns: list[str]) -> str:
    return " OR ".join(f"{c} < 0" for c in columns)


_TAXI_ERRORS = [
    ("PASSENGER_COUNT_OUT_OF_RANGE", "passenger_count < 0 OR passenger_count > 7"),
    ("INVALID_TRIP_DISTANCE", "trip_distance IS NULL OR trip_distance < 0 OR trip_distance > 1000"),
    ("NEGATIVE_FARE_AMOUNT", "fare_amount IS NULL OR fare_amount < 0"),
    ("NON_POSITIVE_TOTAL_AMOUNT", "total_amount IS NULL OR total_amount <= 0"),
    ("TOTAL_AMOUNT_ABOVE_LIMIT", "total_amount > 400"),
    ("NEGATIVE_COMPONENT_AMOUNT", _either(_COMPONENTS)),
]
_TAXI_WARNINGS = [
    ("PASSENGER_COUNT_IMPUTED", "passenger_count_imputed"),
    ("ZERO_TRIP_DISTANCE", "trip_distance = 0"),
    ("TIP_EXCEEDS_FARE", "tip_amount > 50 AND tip_amount > fare_amount"),
    ("SUSPICIOUS_TOLL_AMOUNT", "tolls_amount > 40 AND trip_distance < 5"),
    ("INVALID_VENDOR_NORMALIZED", "bad_vendor"),
    ("INVALID_RATE_CODE_NORMALIZED", "bad_rate"),
    ("INVALID_PAYMENT_TYPE_NORMALIZED", "bad_payment"),
    ("INVALID_STORE_FLAG_NORMALIZED", "bad_store"),
]
_HV_ERRORS = [
    ("MISSING_HVFHS_LICENSE", "hvfhs_license_num IS NULL OR length(hvfhs_license_num) = 0"),
    _NO_BASE,
    ("REQUEST_AFTER_PICKUP", "request_datetime IS NULL OR request_datetime > pickup_datetime"),
    ("NEGATIVE_REQUEST_TO_PICKUP", "request_to_pickup_seconds < 0"),
    ("INVALID_TRIP_MILES", "trip_miles IS NULL OR trip_miles < 0 OR trip_miles > 1000"),
    ("INVALID_TRIP_TIME", "trip_time IS NULL OR trip_time <= 0"),
    ("NEGATIVE_FINANCIAL_AMOUNT", _either(_HV_MONEY)),
]
_HV_RAW = ["shared_request", "shared_match", "access_a_ride", "wav_request", "wav_match"]
_HV_WARNINGS = [
    ("UNKNOWN_HVFHS_LICENSE", "hvfhs_license_num IS NOT NULL AND hvfhs_company_name IS NULL"),
    ("ON_SCENE_AFTER_PICKUP", "on_scene_datetime IS NOT NULL AND on_scene_datetime > pickup_datetime"),
    ("NEGATIVE_DRIVER_WAIT", "driver_wait_seconds < 0"),
    ("TRIP_TIME_MISMATCH", "abs(trip_time - trip_duration_seconds) > 600"),
    ("SHARED_MATCH_WITHOUT_REQUEST",
     "shared_matched IS NOT DISTINCT FROM true AND shared_requested IS NOT DISTINCT FROM false"),
    ("WAV_MATCH_WITHOUT_REQUEST", "wav_matched IS NOT DISTINCT FROM true AND wav_requested IS NOT DISTINCT FROM false"),
    *[(f"INVALID_{n.upper()}_FLAG", f"{n}_text IS NOT NULL AND {n}_text NOT IN ('Y', 'N')") for n in _HV_RAW],
]


def _taxi_typed(service: str, vendors: str) -> str:
    green = service == "green"
    trip_type = "CASE WHEN raw_trip_type IN (1, 2) THEN raw_trip_type END" if green else "CAST(NULL AS BIGINT)"
    bad_type = "raw_trip_type IS NULL OR raw_trip_type NOT IN (1, 2)" if green else "false"
    return f"""
SELECT *, {_identity('service_type', 'pickup_datetime', 'dropoff_datetime', 'pickup_location_id',
                     'dropoff_location_id', 'vendor_id', 'trip_distance', 'total_amount')} AS trip_business_id,
  CASE WHEN trip_duration_seconds > 0 AND trip_distance >= 0
       THEN trip_distance / (trip_duration_seconds / 3600.0::DOUBLE) END AS average_speed_mph,
  CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile,
  CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100.0::DOUBLE END AS tip_percentage,
  CASE WHEN trip_duration_seconds > 0 THEN total_amount / (trip_duration_seconds / 60.0::DOUBLE) END
    AS revenue_per_minute
FROM (SELECT service_type, source_year, source_month, source_record, {_TIME},
  CAST(CASE WHEN vendor IN {vendors} THEN vendor ELSE 99 END AS INT) AS vendor_id,
  vendor IS NULL OR vendor NOT IN {vendors} AS bad_vendor,
  CAST(CASE WHEN rate_code IN (1, 2, 3, 4, 5, 6, 99) THEN rate_code ELSE 99 END AS INT) AS rate_code_id,
  rate_code IS NULL OR rate_code NOT IN (1, 2, 3, 4, 5, 6, 99) AS bad_rate,
  CAST(CASE WHEN payment BETWEEN 0 AND 6 THEN payment ELSE 5 END AS INT) AS payment_type,
  payment IS NULL OR payment NOT BETWEEN 0 AND 6 AS bad_payment,
  CASE WHEN upper(trim(flag_text)) IN ('Y', 'N') THEN upper(trim(flag_text)) ELSE 'N' END AS store_and_fwd_flag,
  flag_text IS NULL OR upper(trim(flag_text)) NOT IN ('Y', 'N') AS bad_store,
  passengers IS NULL OR passengers = 0 AS passenger_count_imputed,
  CAST(CASE WHEN passengers IS NULL OR passengers = 0 THEN 1 ELSE round(passengers) END AS INT) AS passenger_count,
  dist AS trip_distance, fare AS fare_amount, extra, 0.5::DOUBLE AS mta_tax, tip AS tip_amount,
  tolls AS tolls_amount, 1.0::DOUBLE AS improvement_surcharge, 2.5::DOUBLE AS congestion_surcharge,
  {'0.0' if green else '1.75'}::DOUBLE AS airport_fee, 0.0::DOUBLE AS cbd_congestion_fee,
  CASE WHEN total_present = 1 THEN fare + tip + tolls + extra + 5.75::DOUBLE END AS total_amount,
  {trip_type} AS trip_type, {bad_type} AS bad_trip_type,
  {'0.0::DOUBLE' if green else 'CAST(NULL AS DOUBLE)'} AS ehail_fee
FROM raw WHERE service_type = '{service}')"""


_RANKED = """
SELECT *, row_number() OVER (PARTITION BY source_year, source_month, trip_business_id ORDER BY source_record)
  AS repeat_rank FROM {0}"""
_ZONED = """
SELECT t.*, p.zone_name AS pickup_zone_name, p.borough AS pickup_borough, p.service_zone AS pickup_service_zone,
  d.zone_name AS dropoff_zone_name, d.borough AS dropoff_borough, d.service_zone AS dropoff_service_zone{1}
FROM {0} t LEFT JOIN zones p ON p.location_id = t.pickup_location_id
LEFT JOIN zones d ON d.location_id = t.dropoff_location_id{2}"""


def _flagged(source: str, errors, warnings) -> str:
    return f"""
SELECT *, len(error_codes) AS n_errors, len(warning_codes) AS n_warnings,
  CASE WHEN len(error_codes) > 0 THEN 'REJECTED' WHEN len(warning_codes) > 0 THEN 'WARNING' ELSE 'VALID' END
    AS quality_status
FROM (SELECT *, {_codes(errors)} AS error_codes, {_codes(warnings)} AS warning_codes FROM {source})"""


for _s, _v in (("yellow", "(1, 2, 6, 7)"), ("green", "(1, 2, 6)")):
    _common = _COMMON(12)
    _order = _common + _TAXI_ERRORS + [_REPEAT]
    _warn = _TAXI_WARNINGS + ([("INVALID_TRIP_TYPE", "bad_trip_type")] if _s == "green" else [])
    BLOCKS[f"{_s}_typed"] = _taxi_typed(_s, _v)
    BLOCKS[f"{_s}_ranked"] = _RANKED.format(f"{_s}_typed")
    BLOCKS[f"{_s}_zoned"] = _ZONED.format(f"{_s}_ranked", "", "")
    BLOCKS[f"{_s}_own"] = _flagged(f"{_s}_ranked", _order, _warn)
    BLOCKS[f"{_s}_trips"] = _flagged(f"{_s}_zoned", _order + _ZONES, _warn)

BLOCKS["fhv_typed"] = f"""
SELECT *, shared_ride_flag AS shared_matched,
  {_identity('service_type', 'dispatching_base_num', 'pickup_datetime', 'dropoff_datetime', 'pickup_location_id',
             'dropoff_location_id')} AS trip_business_id
FROM (SELECT service_type, source_year, source_month, source_record, {_TIME},
  upper(trim(base_num)) AS dispatching_base_num, upper(trim(base_num2)) AS affiliated_base_number,
  upper(trim(sr_flag)) AS sr_text,
  CASE WHEN trim(sr_flag) IN ('1', '1.0') THEN true
       WHEN sr_flag IS NULL OR trim(sr_flag) IN ('0', '0.0') THEN false END AS shared_ride_flag
FROM raw WHERE service_type = 'fhv')"""


def _truth(column: str) -> str:
    return f"CASE upper(trim({column})) WHEN 'Y' THEN true WHEN 'N' THEN false END"


def _known(column: str) -> str:
    return f"CASE WHEN upper(trim({column})) IN ('Y', 'N') THEN upper(trim({column})) END"


_HV_SOURCE = dict(zip(_HV_RAW, ["flag_text", "share_match", "access_flag", "wav_req", "wav_match"]))
_HV_TRUE = dict(zip(_HV_RAW, ["shared_requested", "shared_matched", "access_a_ride", "wav_requested", "wav_matched"]))
_HV_FLAG_SQL = ", ".join(
    f"upper(trim({src})) AS {n}_text, {_known(src)} AS {n}_flag, {_truth(src)} AS {_HV_TRUE[n]}"
    for n, src in _HV_SOURCE.items()
)
BLOCKS["fhvhv_typed"] = f"""
SELECT *, {_identity('service_type', 'hvfhs_license_num', 'dispatching_base_num', 'request_datetime',
                     'pickup_datetime', 'dropoff_datetime', 'pickup_location_id', 'dropoff_location_id', 'trip_miles',
                     'base_passenger_fare')} AS trip_business_id,
  CASE WHEN trip_duration_seconds > 0 AND trip_miles >= 0
       THEN trip_miles / (trip_duration_seconds / 3600.0::DOUBLE) END AS average_speed_mph
FROM (SELECT service_type, source_year, source_month, source_record, {_TIME},
  upper(trim(hv_license)) AS hvfhs_license_num, upper(trim(base_num)) AS dispatching_base_num,
  upper(trim(base_num2)) AS originating_base_num, request_ts AS request_datetime, on_scene_ts AS on_scene_datetime,
  dist AS trip_miles, trip_time, fare AS base_passenger_fare, tolls, 0.75::DOUBLE AS black_car_fund,
  extra AS sales_tax, 2.75::DOUBLE AS congestion_surcharge, 2.5::DOUBLE AS airport_fee, tip AS tips,
  fare AS driver_pay, 0.0::DOUBLE AS cbd_congestion_fee, {_HV_FLAG_SQL},
  CASE hv_license WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber' WHEN 'HV0004' THEN 'Via'
       WHEN 'HV0005' THEN 'Lyft' END AS hvfhs_company_name,
  datediff('second', request_ts, pickup) AS request_to_pickup_seconds,
  datediff('second', on_scene_ts, pickup) AS driver_wait_seconds
FROM raw WHERE service_type = 'fhvhv')"""

_DISPATCH = """, db.base_name AS dispatching_base_name, db.doing_business_as AS dispatching_base_dba,
  db.base_type AS dispatching_base_type, db.status AS dispatching_base_status, ob.base_name AS {0}_name"""
_DISPATCH_JOIN = """
LEFT JOIN bases db ON db.base_license_number = t.dispatching_base_num
LEFT JOIN bases ob ON ob.base_license_number = t.{0}"""
_MISSING = lambda number, prefix: (
    f"{prefix.upper()}_NOT_IN_CURRENT_LOOKUP", f"{number} IS NOT NULL AND {prefix}_name IS NULL")

for _s, _number, _prefix, _err, _warn in (
    ("fhv", "affiliated_base_number", "affiliated_base", [_NO_BASE],
     [("INVALID_SHARED_RIDE_FLAG", "sr_text IS NOT NULL AND sr_text NOT IN ('0', '0.0', '1', '1.0')")]),
    ("fhvhv", "originating_base_num", "originating_base", _HV_ERRORS, _HV_WARNINGS),
):
    _order = _COMMON(24) + _err + [_REPEAT]
    BLOCKS[f"{_s}_ranked"] = _RANKED.format(f"{_s}_typed")
    BLOCKS[f"{_s}_zoned"] = _ZONED.format(f"{_s}_ranked", _DISPATCH.format(_prefix), _DISPATCH_JOIN.format(_number))
    BLOCKS[f"{_s}_own"] = _flagged(f"{_s}_ranked", _order, _warn)
    BLOCKS[f"{_s}_trips"] = _flagged(
        f"{_s}_zoned", _order + _ZONES,
        _warn + [_MISSING("dispatching_base_num", "dispatching_base"), _MISSING(_number, _prefix)],
    )

SERVICES = ("yellow", "green", "fhv", "fhvhv")
BLOCKS["all_trips"] = " UNION ALL ".join(
    f"SELECT service_type, source_year, source_month, error_codes, warning_codes, n_errors, n_warnings FROM {s}_trips"
    for s in SERVICES
)

# Conformed columns a service fills from its own names; the rest is null.
_MASTER_TYPES = {
    "vendor_id_or_license": "VARCHAR", "hvfhs_company_name": "VARCHAR", "dispatching_base_num": "VARCHAR",
    "dispatching_base_name": "VARCHAR", "dispatching_base_dba": "VARCHAR", "dispatching_base_type": "VARCHAR",
    "originating_base_num": "VARCHAR", "originating_base_name": "VARCHAR", "affiliated_base_num": "VARCHAR",
    "affiliated_base_name": "VARCHAR", "request_datetime": "TIMESTAMP", "on_scene_datetime": "TIMESTAMP",
    "passenger_count": "INT", "trip_distance": "DOUBLE", "reported_trip_time_seconds": "BIGINT",
    "request_to_pickup_seconds": "BIGINT", "driver_wait_seconds": "BIGINT", "average_speed_mph": "DOUBLE",
    "rate_code_id": "INT", "payment_type": "INT", "trip_type": "INT", "fare_amount": "DOUBLE", "extra": "DOUBLE",
    "mta_tax": "DOUBLE", "tip_amount": "DOUBLE", "tolls_amount": "DOUBLE", "improvement_surcharge": "DOUBLE",
    "total_amount": "DOUBLE", "congestion_surcharge": "DOUBLE", "airport_fee": "DOUBLE",
    "cbd_congestion_fee": "DOUBLE", "black_car_fund": "DOUBLE", "sales_tax": "DOUBLE", "driver_pay": "DOUBLE",
    "fare_per_mile": "DOUBLE", "tip_percentage": "DOUBLE", "revenue_per_minute": "DOUBLE",
    "store_and_fwd_flag": "VARCHAR", "shared_requested": "BOOLEAN", "shared_matched": "BOOLEAN",
    "access_a_ride": "BOOLEAN", "wav_requested": "BOOLEAN", "wav_matched": "BOOLEAN",
}
_TAXI_HAS = {n: n for n in (
    "passenger_count trip_distance average_speed_mph rate_code_id payment_type trip_type fare_amount extra mta_tax "
    "tip_amount tolls_amount improvement_surcharge total_amount congestion_surcharge airport_fee cbd_congestion_fee "
    "fare_per_mile tip_percentage revenue_per_minute store_and_fwd_flag").split()} | {"vendor_id_or_license": "vendor_id"}
_BASE_HAS = {n: n for n in ("dispatching_base_num dispatching_base_name dispatching_base_dba dispatching_base_type "
                            "shared_matched").split()}
_HAS = {
    "yellow": _TAXI_HAS,
    "green": _TAXI_HAS,
    "fhv": _BASE_HAS | {"vendor_id_or_license": "dispatching_base_num", "affiliated_base_num": "affiliated_base_number",
                        "affiliated_base_name": "affiliated_base_name"},
    "fhvhv": _BASE_HAS | {n: n for n in (
        "hvfhs_company_name originating_base_num originating_base_name request_datetime on_scene_datetime "
        "request_to_pickup_seconds driver_wait_seconds average_speed_mph congestion_surcharge airport_fee "
        "cbd_congestion_fee black_car_fund sales_tax driver_pay shared_requested access_a_ride wav_requested "
        "wav_matched").split()} | {
        "vendor_id_or_license": "hvfhs_license_num", "trip_distance": "trip_miles", "fare_amount": "base_passenger_fare",
        "tip_amount": "tips", "tolls_amount": "tolls", "reported_trip_time_seconds": "trip_time"},
}
_ALWAYS = """trip_business_id, pickup_datetime, dropoff_datetime, pickup_date, dropoff_date, pickup_hour,
  pickup_day_of_week, weekend_trip_flag, night_trip_flag, pickup_location_id, pickup_zone_name, pickup_borough,
  pickup_service_zone, dropoff_location_id, dropoff_zone_name, dropoff_borough, dropoff_service_zone,
  CAST(trip_duration_seconds AS BIGINT) AS trip_duration_seconds, airport_trip_flag, quality_status,
  array_to_string(warning_codes, '|') AS quality_warning_codes, CAST(n_warnings AS INT) AS quality_warning_count,
  CAST(source_year AS INT) AS source_year, CAST(source_month AS INT) AS source_month"""


def _conform(service: str, key: int) -> str:
    own = ", ".join(f"CAST({_HAS[service].get(n, 'NULL')} AS {t}) AS {n}" for n, t in _MASTER_TYPES.items())
    file = f"concat('{service}_tripdata_', lpad(CAST(source_year AS VARCHAR), 4, '0'), '-', " \
           "lpad(CAST(source_month AS VARCHAR), 2, '0'), '.parquet')"
    return (f"SELECT CAST({key} AS INT) AS service_id, '{service}' AS service_type, CAST(1 AS BIGINT) AS trip_count, "
            f"{_ALWAYS}, {own}, {file} AS source_file FROM {service}_trips WHERE n_errors = 0")


for _k, _s in enumerate(SERVICES, 1):
    BLOCKS[f"{_s}_master"] = _conform(_s, _k)
BLOCKS["master"] = " UNION ALL ".join(f"SELECT * FROM {s}_master" for s in SERVICES)

_DATE_KEY = "CAST(strftime({0}, '%Y%m%d') AS INT)"
_FACT_KEYS = """trip_business_id AS trip_key, service_id AS service_key, service_type,
  pickup_location_id AS pickup_zone_key, dropoff_location_id AS dropoff_zone_key,
  coalesce(vendor_id_or_license, dispatching_base_num, originating_base_num) AS provider_code"""
BLOCKS["activity"] = f"""
SELECT {_FACT_KEYS}, {_DATE_KEY.format('pickup_date')} AS pickup_date_key, pickup_hour AS pickup_time_key,
  {_DATE_KEY.format('dropoff_date')} AS dropoff_date_key, CAST(hour(dropoff_datetime) AS INT) AS dropoff_time_key,
  trip_count, pickup_datetime, dropoff_datetime, trip_duration_seconds, trip_distance AS trip_distance_miles,
  passenger_count, average_speed_mph, weekend_trip_flag, night_trip_flag, airport_trip_flag, quality_warning_count,
  quality_status, source_year, source_month
FROM master"""
BLOCKS["financial"] = f"""
SELECT {_FACT_KEYS}, {_DATE_KEY.format('pickup_date')} AS date_key, pickup_hour AS time_key,
  coalesce(payment_type, -1) AS payment_type_key, coalesce(rate_code_id, -1) AS rate_code_key,
  coalesce(trip_type, -1) AS trip_type_key, fare_amount, extra AS extra_amount, mta_tax AS mta_tax_amount, tip_amount,
  tolls_amount, improvement_surcharge, congestion_surcharge, airport_fee, cbd_congestion_fee, total_amount,
  fare_per_mile, tip_percentage, revenue_per_minute, trip_distance AS trip_distance_miles, trip_duration_seconds,
  airport_trip_flag, trip_count, source_year, source_month
FROM master WHERE service_type IN ('yellow', 'green')"""
BLOCKS["hv_ops"] = f"""
SELECT {_FACT_KEYS}, {_DATE_KEY.format('request_datetime')} AS request_date_key,
  CAST(hour(request_datetime) AS INT) AS request_time_key, {_DATE_KEY.format('pickup_date')} AS pickup_date_key,
  pickup_hour AS pickup_time_key, vendor_id_or_license AS hvfhs_license_num, hvfhs_company_name,
  dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime,
  trip_distance AS trip_miles, reported_trip_time_seconds AS trip_time_seconds, trip_duration_seconds,
  request_to_pickup_seconds, driver_wait_seconds, fare_amount AS base_passenger_fare, tolls_amount AS tolls,
  black_car_fund, sales_tax, congestion_surcharge, airport_fee, cbd_congestion_fee, tip_amount AS tips, driver_pay,
  coalesce(fare_amount, 0) + coalesce(tolls_amount, 0) + coalesce(black_car_fund, 0) + coalesce(sales_tax, 0)
    + coalesce(congestion_surcharge, 0) + coalesce(airport_fee, 0) + coalesce(cbd_congestion_fee, 0)
    + coalesce(tip_amount, 0) AS passenger_charge_amount,
  shared_requested, shared_matched, access_a_ride, wav_requested, wav_matched, airport_trip_flag, weekend_trip_flag,
  night_trip_flag, trip_count, source_year, source_month
FROM master WHERE service_type = 'fhvhv'"""

# Marts with their exact (unrounded) values, reused by the report queries.
_Z = "LEFT JOIN dim_zone pz ON pz.zone_key = a.pickup_zone_key"
_ZCOLS = "a.pickup_zone_key, pz.zone_name AS pickup_zone_name, pz.borough AS pickup_borough"
_DCOLS = "a.dropoff_zone_key, dz.zone_name AS dropoff_zone_name, dz.borough AS dropoff_borough"
_P = "source_year, source_month"
_AVG3 = """avg(trip_duration_seconds) AS average_duration_seconds, avg(trip_distance_miles) AS average_distance_miles,
  avg(average_speed_mph) AS average_speed_mph"""
_N = "CAST(sum(trip_count) AS BIGINT) AS trip_count"
BLOCKS["m_executive"] = f"""
SELECT {_P}, service_type, {_N}, {_AVG3},
  CAST(sum(CAST(airport_trip_flag AS BIGINT)) AS BIGINT) AS airport_trip_count,
  CAST(sum(quality_warning_count) AS BIGINT) AS quality_warning_count
FROM activity GROUP BY ALL"""
BLOCKS["m_share"] = f"""
SELECT e.*, t.n AS all_services_trip_count, CASE WHEN t.n > 0 THEN e.trip_count / t.n END AS service_share
FROM m_executive e LEFT JOIN
  (SELECT {_P}, CAST(sum(trip_count) AS BIGINT) AS n FROM activity GROUP BY ALL) t USING ({_P})"""
BLOCKS["m_daily"] = f"SELECT CAST(pickup_datetime AS DATE) AS event_date, service_type, {_N} FROM activity GROUP BY ALL"
BLOCKS["m_zone"] = f"""
SELECT {_P}, service_type, {_ZCOLS}, CAST(sum(trip_count) AS BIGINT) AS pickup_trip_count, {_AVG3}
FROM activity a {_Z} GROUP BY ALL"""
BLOCKS["m_routes"] = f"""
SELECT {_P}, service_type, {_ZCOLS}, {_DCOLS}, {_N}, {_AVG3}
FROM activity a {_Z} LEFT JOIN dim_zone dz ON dz.zone_key = a.dropoff_zone_key GROUP BY ALL"""
BLOCKS["m_heat"] = f"""
SELECT service_type, CAST(dayofweek(pickup_datetime) + 1 AS INT) AS day_of_week,
  CAST(hour(pickup_datetime) AS INT) AS hour_of_day, {_N}, avg(trip_duration_seconds) AS average_duration_seconds
FROM activity GROUP BY ALL"""
BLOCKS["m_financial"] = f"""
SELECT {_P}, service_type, {_N}, sum(fare_amount) AS fare_amount, sum(tip_amount) AS tip_amount,
  sum(tolls_amount) AS tolls_amount, sum(total_amount) AS total_amount, avg(total_amount) AS average_total_amount,
  avg(tip_percentage) AS average_tip_percentage
FROM financial GROUP BY ALL"""
BLOCKS["m_airport"] = f"""
SELECT {_P}, service_type, airport_trip_flag, {_N}, avg(trip_duration_seconds) AS average_duration_seconds,
  avg(trip_distance_miles) AS average_distance_miles
FROM activity GROUP BY ALL"""
BLOCKS["m_profit"] = f"""
SELECT service_type, {_P}, {_ZCOLS}, time_key, airport_trip_flag, {_N}, avg(total_amount) AS average_total_amount,
  avg(fare_per_mile) AS average_fare_per_mile, avg(revenue_per_minute) AS average_revenue_per_minute,
  avg(tip_percentage) AS average_tip_percentage
FROM financial a {_Z} GROUP BY ALL"""
BLOCKS["m_tips"] = f"""
SELECT service_type, {_P}, {_ZCOLS}, time_key, CAST(sum(trip_count) AS BIGINT) AS credit_card_trip_count,
  avg(tip_amount) AS average_tip_amount, avg(tip_percentage) AS average_tip_percentage,
  quantile_disc(tip_percentage, 0.5) AS median_tip_percentage
FROM financial a {_Z} WHERE payment_type_key = 1 GROUP BY ALL"""
BLOCKS["m_ops"] = f"""
SELECT service_type, {_P}, CAST(hour(pickup_datetime) AS INT) AS hour_of_day, {_N},
  avg(trip_duration_seconds) AS average_duration_seconds,
  quantile_disc(trip_duration_seconds, 0.95) AS p95_duration_seconds, avg(average_speed_mph) AS average_speed_mph
FROM activity GROUP BY ALL"""
BLOCKS["m_route_view"] = f"""
SELECT {_P}, service_type, pickup_zone_key, pickup_zone_name, dropoff_zone_key, dropoff_zone_name, trip_count,
  average_duration_seconds, average_distance_miles, average_speed_mph FROM m_routes"""
BLOCKS["m_congestion"] = f"""
SELECT *, CASE WHEN average_speed_mph > 0 THEN p95_duration_seconds / average_speed_mph END AS congestion_index
FROM (SELECT {_P}, service_type, {_ZCOLS}, CAST(hour(pickup_datetime) AS INT) AS hour_of_day, {_N},
  avg(average_speed_mph) AS average_speed_mph, avg(trip_duration_seconds) AS average_duration_seconds,
  quantile_disc(trip_duration_seconds, 0.95) AS p95_duration_seconds
  FROM activity a {_Z} GROUP BY ALL)"""
BLOCKS["m_competition"] = f"""
SELECT z.*, t.n AS zone_total_trip_count, CASE WHEN t.n > 0 THEN z.pickup_trip_count / t.n END AS zone_service_share
FROM m_zone z LEFT JOIN
  (SELECT {_P}, pickup_zone_key, CAST(sum(trip_count) AS BIGINT) AS n FROM activity GROUP BY ALL) t
  USING ({_P}, pickup_zone_key)"""
BLOCKS["m_hv_quality"] = f"""
SELECT {_P}, provider_code, hvfhs_company_name, {_ZCOLS}, request_time_key, {_N},
  avg(request_to_pickup_seconds) AS average_request_to_pickup_seconds,
  quantile_disc(request_to_pickup_seconds, 0.95) AS p95_request_to_pickup_seconds,
  avg(driver_wait_seconds) AS average_driver_wait_seconds, avg(driver_pay) AS average_driver_pay
FROM hv_ops a {_Z} GROUP BY ALL"""


def _flags(*names: str) -> str:
    return ", ".join(f"CAST(sum(CAST({n} AS BIGINT)) AS BIGINT) AS {n}_count" for n in names)


BLOCKS["m_shared"] = f"""
SELECT *, CASE WHEN shared_requested_count > 0 THEN shared_matched_count / shared_requested_count END
  AS shared_match_rate
FROM (SELECT {_P}, provider_code, hvfhs_company_name, {_N}, {_flags('shared_requested', 'shared_matched')}
  FROM hv_ops GROUP BY ALL)"""
BLOCKS["m_access"] = f"""
SELECT *, CASE WHEN wav_requested_count > 0 THEN wav_matched_count / wav_requested_count END AS wav_match_rate
FROM (SELECT {_P}, provider_code, hvfhs_company_name, {_N}, {_flags('access_a_ride', 'wav_requested', 'wav_matched')}
  FROM hv_ops GROUP BY ALL)"""
MART_BLOCKS = {
    "executive_monthly": "m_executive", "service_share": "m_share", "daily_demand": "m_daily", "zone_demand": "m_zone",
    "od_routes": "m_routes", "time_heatmap": "m_heat", "financial_profile": "m_financial",
    "airport_activity": "m_airport", "profitability_drivers": "m_profit", "tip_behavior": "m_tips",
    "operational_efficiency": "m_ops", "route_efficiency": "m_route_view", "zone_congestion": "m_congestion",
    "service_competition": "m_competition", "hvfhv_service_quality": "m_hv_quality",
    "shared_ride_performance": "m_shared", "accessibility_performance": "m_access",
}
