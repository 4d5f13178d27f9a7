"""Features, metrics, forecast, segmentation and wait risk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks.blocks import BLOCKS, rnd, rounded
from checks.registry import query, register
from fareflow.plans import features, forecast, learning, segments, wait_risk
from fareflow.plans.workspace import FORECAST, WAIT_RISK
from fareflow.sources import fixtures
from fareflow.sources.sinks import save_model
from fareflow.session import shared_dir

BLOCKS["event_trips"] = """
SELECT ts AS pickup_datetime, CAST(1 + user_id % 5 AS INT) AS pickup_zone_key,
  CASE user_id % 4 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' WHEN 2 THEN 'fhv' ELSE 'fhvhv' END AS service_type,
  1 AS trip_count FROM events"""
_HOURLY = """
SELECT pickup_zone_key AS pickup_location_id, service_type, date_trunc('hour', pickup_datetime) AS event_timestamp,
  CAST(sum(trip_count) AS DOUBLE) AS trip_count FROM {0} GROUP BY ALL"""
BLOCKS["event_hours"] = _HOURLY.format("event_trips")
BLOCKS["trip_hours"] = _HOURLY.format("activity")

_LAG_JOIN = """LEFT JOIN {0} l{1} ON l{1}.pickup_location_id = h.pickup_location_id AND l{1}.service_type = h.service_type
  AND l{1}.event_timestamp + INTERVAL {1} HOUR = h.event_timestamp"""
_SERIES_WINDOW = ("OVER (PARTITION BY pickup_location_id, service_type ORDER BY epoch(event_timestamp) "
                  "RANGE BETWEEN {0} PRECEDING AND 1 PRECEDING)")
_NAMES = {1: "lag_1_hour", 2: "lag_2_hours", 24: "lag_24_hours", 48: "lag_48_hours", 168: "lag_168_hours"}


def _lagged(hours: str) -> str:
    """Lags as self joins, rolling statistics as range windows."""
    joins = "\n".join(_LAG_JOIN.format(hours, n) for n in _NAMES)
    lags = ", ".join(f"l{n}.trip_count AS {name}" for n, name in _NAMES.items())
    means = ", ".join(f"avg(trip_count) {_SERIES_WINDOW.format(n * 3600)} AS rolling_mean_{n}h" for n in (6, 24, 168))
    return f"""
SELECT r.*, z.zone_name AS pickup_zone_name, z.borough AS pickup_borough, z.is_airport AS airport_zone_flag,
  lag_24_hours AS same_hour_previous_day, lag_168_hours AS same_hour_previous_week,
  CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INT) AS event_hour,
  CAST(hour(event_timestamp) AS INT) AS hour_of_day, CAST(dayofweek(event_timestamp) + 1 AS INT) AS day_of_week,
  CAST(month(event_timestamp) AS INT) AS month, dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
  hour(event_timestamp) IN (7, 8, 9, 16, 17, 18, 19) AS is_peak_hour
FROM (SELECT *, {means}, stddev_pop(trip_count) {_SERIES_WINDOW.format(86400)} AS rolling_stddev_24h
  FROM (SELECT h.*, {lags} FROM {hours} h {joins})) r
LEFT JOIN dim_zone z ON z.zone_key = r.pickup_location_id"""


BLOCKS["event_features"] = _lagged("event_hours")
BLOCKS["trip_features"] = _lagged("trip_hours")
_FRACTIONS = "rolling_mean_6h rolling_mean_24h rolling_mean_168h rolling_stddev_24h"
_DEMAND = ", ".join(rnd(n) if n in _FRACTIONS.split() else n for n in features.DEMAND_COLUMNS)

register("zone_hourly_demand_features", lambda w: w.event_features(), f"SELECT {_DEMAND} FROM event_features")
register("zone_hourly_demand_features_trips",
         lambda w: features.zone_hourly_demand_features(w.fact("trip_activity"), w.dim_zone()),
         f"SELECT {_DEMAND} FROM trip_features")
_RISK = """
SELECT request_to_pickup_seconds AS wait, CASE WHEN request_to_pickup_seconds > 600 THEN 1 ELSE 0 END AS label,
  (request_to_pickup_seconds * 7 + driver_wait_seconds) % 101 AS score FROM hv_ops
WHERE request_to_pickup_seconds IS NOT NULL AND driver_wait_seconds IS NOT NULL"""


@query("classifier_metrics", f"""
WITH risk AS ({_RISK}), counts AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM risk GROUP BY score),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM counts WINDOW w AS (ORDER BY score DESC)),
areas AS (SELECT sum(pos * (coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), tp / (tp + fp)) + tp / (tp + fp)) / 2) / sum(pos) AS auc_pr,
  sum(neg * (tp - pos + tp) / 2) / (sum(pos) * sum(neg)) AS auc_roc FROM curve),
cells AS (SELECT count(*) FILTER (label = 1 AND score >= 50) AS tp, count(*) FILTER (label = 0 AND score >= 50) AS fp,
  count(*) FILTER (label = 1 AND score < 50) AS fn, count(*) FILTER (label = 0 AND score < 50) AS tn, count(*) AS n FROM risk),
parts AS (SELECT *, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0 FROM cells)
SELECT {rnd('auc_pr')}, {rnd('auc_roc')}, {rnd('((tp + fn) * 2 * p1 * r1 / (p1 + r1) + (tn + fp) * 2 * p0 * r0 / (p0 + r0)) / n', 'f1')},
  {rnd('((tp + fn) * p1 + (tn + fp) * p0) / n', 'precision')}, {rnd('((tp + fn) * r1 + (tn + fp) * r0) / n', 'recall')},
  {rnd('(tp + tn) / n', 'accuracy')} FROM areas, parts""")
def _(w):
    waits = w.fact("hvfhv_operations").filter("request_to_pickup_seconds IS NOT NULL AND driver_wait_seconds IS NOT NULL")
    score = (F.col("request_to_pickup_seconds") * 7 + F.col("driver_wait_seconds")) % 101
    return learning.curve_metrics(waits.select(
        score.cast("double").alias("score"), (F.col("request_to_pickup_seconds") > 600).cast("double").alias("label"),
        (score >= 50).cast("double").alias("prediction")))


register("zone_hour_counts", lambda w: features.zone_hour_counts(fixtures.event_trips(w.spark, w.sf_dir)),
         "SELECT * FROM event_hours")


@query("exact_lag", "SELECT pickup_location_id, service_type, event_timestamp, lag_24_hours, lag_168_hours FROM event_features")
def _(w):
    counts = features.zone_hour_counts(fixtures.event_trips(w.spark, w.sf_dir))
    return counts.withColumns({"lag_24_hours": features.exact_lag(24), "lag_168_hours": features.exact_lag(168)}).drop("trip_count")


@query("rolling_mean", f"SELECT pickup_location_id, service_type, event_timestamp, {rounded('rolling_mean_6h rolling_mean_24h')} FROM event_features")
def _(w):
    counts = features.zone_hour_counts(fixtures.event_trips(w.spark, w.sf_dir))
    return counts.withColumns({f"rolling_mean_{h}h": F.avg("trip_count").over(features.trailing(h)) for h in (6, 24)}).drop("trip_count")


@query("rolling_stddev_24h", f"SELECT pickup_location_id, service_type, event_timestamp, {rnd('rolling_stddev_24h')} FROM event_features")
def _(w):
    counts = features.zone_hour_counts(fixtures.event_trips(w.spark, w.sf_dir))
    return counts.withColumn("rolling_stddev_24h", F.stddev_pop("trip_count").over(features.trailing(24))).drop("trip_count")


# --- zone profiles -----------------------------------------------------------

BLOCKS["p_pickup"] = """
SELECT pickup_zone_key AS zone_key, CAST(sum(trip_count) AS BIGINT) AS total_pickups,
  avg(trip_duration_seconds) AS average_duration_seconds, avg(trip_distance_miles) AS average_distance_miles,
  avg(average_speed_mph) AS average_speed_mph, avg(CAST(night_trip_flag AS INT)) AS night_trip_share,
  avg(CAST(weekend_trip_flag AS INT)) AS weekend_trip_share, avg(CAST(airport_trip_flag AS INT)) AS airport_trip_share,
  CAST(sum(CASE WHEN service_type = 'yellow' THEN trip_count ELSE 0 END) AS BIGINT) AS yellow_trips,
  CAST(sum(CASE WHEN service_type = 'green' THEN trip_count ELSE 0 END) AS BIGINT) AS green_trips,
  CAST(sum(CASE WHEN service_type = 'fhv' THEN trip_count ELSE 0 END) AS BIGINT) AS fhv_trips,
  CAST(sum(CASE WHEN service_type = 'fhvhv' THEN trip_count ELSE 0 END) AS BIGINT) AS fhvhv_trips,
  CAST(count(DISTINCT service_type) AS BIGINT) AS service_diversity
FROM activity GROUP BY 1"""
BLOCKS["p_dropoff"] = """
SELECT dropoff_zone_key AS zone_key, CAST(sum(trip_count) AS BIGINT) AS total_dropoffs FROM activity GROUP BY 1"""
BLOCKS["p_spread"] = """
SELECT *, CASE WHEN average_hourly_demand > 0 THEN demand_stddev / average_hourly_demand END
  AS demand_coefficient_of_variation
FROM (SELECT zone_key, count(event_hour) AS active_hours, stddev_pop(n) AS demand_stddev, avg(n) AS average_hourly_demand
  FROM (SELECT pickup_zone_key AS zone_key, date_trunc('hour', pickup_datetime) AS event_hour, sum(trip_count) AS n
        FROM activity GROUP BY ALL) GROUP BY zone_key)"""
BLOCKS["p_wait"] = """
SELECT pickup_zone_key AS zone_key, avg(request_to_pickup_seconds) AS average_request_to_pickup_seconds,
  avg(CAST(shared_matched AS INT)) AS shared_match_share, avg(CAST(wav_matched AS INT)) AS wav_match_share
FROM hv_ops GROUP BY 1"""
_SHARE = ", ".join(
    f"CASE WHEN coalesce(total_pickups, 0) > 0 THEN {s}_trips / total_pickups ELSE 0.0 END AS {s}_share"
    for s in ("yellow", "green", "fhv", "fhvhv"))
BLOCKS["zone_profiles"] = f"""
SELECT z.zone_key, z.location_id, z.zone_name, z.borough, z.service_zone, z.is_airport,
  coalesce(total_pickups, 0) AS total_pickups, coalesce(total_dropoffs, 0) AS total_dropoffs,
  coalesce(service_diversity, 0) AS service_diversity, coalesce(active_hours, 0) AS active_hours,
  average_duration_seconds, average_distance_miles, average_speed_mph, night_trip_share, weekend_trip_share,
  airport_trip_share, demand_stddev, average_hourly_demand, demand_coefficient_of_variation,
  average_request_to_pickup_seconds, shared_match_share, wav_match_share, {_SHARE}
FROM dim_zone z LEFT JOIN p_pickup USING (zone_key) LEFT JOIN p_dropoff USING (zone_key)
LEFT JOIN p_spread USING (zone_key) LEFT JOIN p_wait USING (zone_key)"""
_PROFILE_DOUBLES = """average_duration_seconds average_distance_miles average_speed_mph night_trip_share
weekend_trip_share airport_trip_share demand_stddev average_hourly_demand demand_coefficient_of_variation
average_request_to_pickup_seconds shared_match_share wav_match_share yellow_share green_share fhv_share fhvhv_share"""
_SPREAD = "demand_stddev average_hourly_demand demand_coefficient_of_variation"
_WAIT = "average_request_to_pickup_seconds shared_match_share wav_match_share"
_PICKUP = "average_duration_seconds average_distance_miles average_speed_mph night_trip_share weekend_trip_share airport_trip_share"

register("zone_profile_features", lambda w: w.zone_profiles(), f"SELECT * REPLACE ({rounded(_PROFILE_DOUBLES)}) FROM zone_profiles")
register("zone_pickup_profile", lambda w: features.pickup_profile(features.zone_hours(w.fact("trip_activity"))),
         f"SELECT * REPLACE ({rounded(_PICKUP)}) FROM p_pickup")
register("zone_dropoff_count", lambda w: features.dropoff_profile(features.zone_hours(w.fact("trip_activity"))), "SELECT * FROM p_dropoff")
register("zone_variability", lambda w: features.variability_profile(features.zone_hours(w.fact("trip_activity"))),
         f"SELECT * REPLACE ({rounded(_SPREAD)}) FROM p_spread")
register("zone_wait_profile", lambda w: features.wait_profile(w.fact("hvfhv_operations")),
         f"SELECT * REPLACE ({rounded(_WAIT)}) FROM p_wait")
register("profile_star", lambda w: w.zone_profiles().groupBy("borough").agg(
    F.count(F.lit(1)).alias("zones"), F.sum("total_pickups").alias("pickups"), F.sum("total_dropoffs").alias("dropoffs")),
    """SELECT borough, count(*) AS zones, CAST(sum(total_pickups) AS BIGINT) AS pickups,
  CAST(sum(total_dropoffs) AS BIGINT) AS dropoffs FROM zone_profiles GROUP BY borough""")

# --- wait features -----------------------------------------------------------

BLOCKS["wait_features"] = """
SELECT trip_key, request_datetime, CAST(hour(request_datetime) AS INT) AS request_hour,
  CAST(dayofweek(request_datetime) + 1 AS INT) AS request_day_of_week, CAST(month(request_datetime) AS INT) AS request_month,
  dayofweek(request_datetime) IN (0, 6) AS is_weekend,
  hour(request_datetime) IN (7, 8, 9, 16, 17, 18, 19) AS is_peak_hour, pickup_zone_key, z.zone_name AS pickup_zone_name,
  z.borough AS pickup_borough, z.is_airport AS airport_zone_flag, hvfhs_license_num, hvfhs_company_name,
  coalesce(shared_requested, false) AS shared_requested, coalesce(access_a_ride, false) AS access_a_ride,
  coalesce(wav_requested, false) AS wav_requested, request_to_pickup_seconds, source_year, source_month
FROM hv_ops LEFT JOIN dim_zone z ON z.zone_key = pickup_zone_key
WHERE request_datetime IS NOT NULL AND request_to_pickup_seconds IS NOT NULL AND request_to_pickup_seconds >= 0"""
register("hvfhv_wait_features", lambda w: w.wait_features().drop("provider_key"), "SELECT * FROM wait_features")
register("wait_rows", lambda w: features.wait_rows(w.fact("hvfhv_operations")).agg(F.count(F.lit(1)).alias("n")),
         "SELECT count(*) AS n FROM wait_features")
register("wait_zone_join", lambda w: w.wait_features().groupBy("pickup_borough", "airport_zone_flag").agg(F.count(F.lit(1)).alias("n")),
         "SELECT pickup_borough, airport_zone_flag, count(*) AS n FROM wait_features GROUP BY ALL")

# --- preparation -------------------------------------------------------------

_FLAG = "CAST(CAST(coalesce({0}, false) AS INT) AS DOUBLE) AS {0}_num"
_LAG_ZERO = ", ".join(f"coalesce({n}, 0) AS {n}" for n in [*_NAMES.values(), *_FRACTIONS.split()])
BLOCKS["event_prepared"] = f"""
SELECT * REPLACE ({_LAG_ZERO}, coalesce(pickup_borough, 'UNKNOWN') AS pickup_borough),
  CAST(pickup_location_id AS VARCHAR) AS pickup_zone_code,
  {', '.join(_FLAG.format(n) for n in ('is_weekend', 'is_peak_hour', 'airport_zone_flag'))}
FROM event_features"""
register("prepare_forecast", lambda w: forecast.prepare(w.event_features()),
         f"SELECT * REPLACE ({rounded(_FRACTIONS)}) FROM event_prepared")
_WAIT_FLAGS = ("is_weekend", "is_peak_hour", "airport_zone_flag", "shared_requested", "access_a_ride", "wav_requested")
BLOCKS["wait_prepared"] = f"""
SELECT * REPLACE (coalesce(pickup_borough, 'UNKNOWN') AS pickup_borough,
  coalesce(hvfhs_license_num, 'UNKNOWN') AS hvfhs_license_num),
  CAST(request_to_pickup_seconds >= 600 AS INT)::DOUBLE AS excessive_wait_flag,
  CAST(pickup_zone_key AS VARCHAR) AS pickup_zone_code, {', '.join(_FLAG.format(n) for n in _WAIT_FLAGS)}
FROM wait_features"""
register("prepare_wait", lambda w: wait_risk.prepare(w.wait_features(), WAIT_RISK).drop("provider_key"),
         "SELECT * FROM wait_prepared")

BLOCKS["active_series"] = """
SELECT pickup_location_id, service_type FROM event_features GROUP BY ALL
HAVING count(event_timestamp) >= 168 AND sum(trip_count) >= 200"""
register("active_series", lambda w: forecast.active_series(w.event_features(), FORECAST), "SELECT * FROM active_series")
register("active_inner",
         lambda w: forecast.keep_active(w.event_features(), FORECAST).select(*features.SERIES, "event_timestamp", "trip_count"),
         """SELECT pickup_location_id, service_type, event_timestamp, trip_count
FROM event_features JOIN active_series USING (pickup_location_id, service_type)""")

_SPLIT = """CASE WHEN event_timestamp <= TIMESTAMP '2024-01-20 23:00:00' THEN 'train'
  WHEN event_timestamp <= TIMESTAMP '2024-01-25 23:00:00' THEN 'validation'
  WHEN event_timestamp <= TIMESTAMP '2024-01-30 23:00:00' THEN 'test' END"""


@query("temporal_split", f"""
SELECT split, count(*) AS rows, min(event_timestamp) AS first, max(event_timestamp) AS last
FROM (SELECT {_SPLIT} AS split, event_timestamp FROM event_features WHERE event_timestamp >= TIMESTAMP '2024-01-01')
WHERE split IS NOT NULL GROUP BY split""")
def _(w):
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"))
        .withColumn("split", F.lit(name))
        for name, df in zip(("train", "validation", "test"), forecast.splits(w.event_features(), FORECAST))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register("split_non_empty", lambda w: forecast.split_sizes(w.event_features(), FORECAST), f"""
SELECT split, count(*) AS rows
FROM (SELECT {_SPLIT} AS split FROM event_features WHERE event_timestamp >= TIMESTAMP '2024-01-01')
WHERE split IS NOT NULL GROUP BY split""")
_WAIT_SPLIT = """CASE WHEN request_datetime <= TIMESTAMP '1998-12-31 23:59:59' THEN 'train'
  WHEN request_datetime <= TIMESTAMP '2000-06-30 23:59:59' THEN 'validation'
  WHEN request_datetime <= TIMESTAMP '2001-08-01 23:59:59' THEN 'test' END"""
register("split_classes", lambda w: wait_risk.split_sizes(wait_risk.prepare(w.wait_features(), WAIT_RISK), WAIT_RISK), f"""
SELECT split, excessive_wait_flag, count(*) AS rows
FROM (SELECT {_WAIT_SPLIT} AS split, excessive_wait_flag FROM wait_prepared) WHERE split IS NOT NULL GROUP BY ALL""")
register("class_weights", lambda w: learning.class_weights(wait_risk.prepare(w.wait_features(), WAIT_RISK), wait_risk.LABEL), f"""
SELECT excessive_wait_flag, rows, {rnd('sum(rows) OVER () / (2.0 * rows)', 'class_weight')}
FROM (SELECT excessive_wait_flag, count(*) AS rows FROM wait_prepared GROUP BY ALL)""")

# --- metrics on a seasonal-naive prediction ----------------------------------

_NAIVE = lambda w: w.event_features().filter("lag_24_hours IS NOT NULL").withColumn("prediction", F.col("lag_24_hours"))
BLOCKS["naive"] = "SELECT *, trip_count - lag_24_hours AS residual FROM event_features WHERE lag_24_hours IS NOT NULL"
_ERRORS = f"""SELECT {rnd('avg(abs(residual))', 'mae')}, {rnd('sqrt(avg(residual * residual))', 'rmse')},
  {rnd('sum(abs(residual)) / greatest(sum(abs(trip_count)), 1)', 'wape')} FROM naive"""
register("regression_metrics", lambda w: learning.regression_metrics(_NAIVE(w)), _ERRORS)
register("baseline_metrics", lambda w: learning.baseline_metrics(w.event_features(), "lag_24_hours"), _ERRORS)
register("residual_stats", lambda w: forecast.residual_spread(_NAIVE(w).withColumn("residual", F.expr("trip_count - prediction"))),
         f"SELECT pickup_location_id, service_type, {rnd('stddev_pop(residual)', 'residual_stddev')} FROM naive GROUP BY ALL")
BLOCKS["anomalies"] = """
SELECT *, abs(deviation_score) >= 3 AS anomaly_flag,
  CASE WHEN deviation_score >= 3 THEN 'DEMAND_SURGE' WHEN deviation_score <= -3 THEN 'DEMAND_DROP' ELSE 'NORMAL' END
    AS anomaly_type,
  CASE WHEN abs(deviation_score) >= 5 THEN 'CRITICAL' WHEN abs(deviation_score) >= 4 THEN 'HIGH'
       WHEN abs(deviation_score) >= 3 THEN 'ELEVATED' ELSE 'NORMAL' END AS severity
FROM (SELECT event_timestamp, pickup_location_id, pickup_zone_name, pickup_borough, service_type,
  trip_count AS observed_trip_count, lag_24_hours AS expected_trip_count, residual,
  residual / coalesce(CASE WHEN s.sd > 0 THEN s.sd END,
    (SELECT coalesce(nullif(stddev_pop(residual), 0), 1) FROM naive)) AS deviation_score
  FROM naive LEFT JOIN (SELECT pickup_location_id, service_type, stddev_pop(residual) AS sd FROM naive GROUP BY ALL) s
  USING (pickup_location_id, service_type))"""
register("demand_anomalies", lambda w: forecast.demand_anomalies(_NAIVE(w)),
         f"SELECT * REPLACE ({rnd('deviation_score')}) FROM anomalies")


@query("top_anomalies", f"""
SELECT pickup_location_id, service_type, event_timestamp, {rnd('deviation_score')} FROM anomalies WHERE anomaly_flag
ORDER BY round(abs(deviation_score), 6) DESC, event_timestamp, pickup_location_id, service_type LIMIT 30""")
def _(w):
    return forecast.demand_anomalies(_NAIVE(w)).filter("anomaly_flag").orderBy(
        F.round(F.abs("deviation_score"), 6).desc(), "event_timestamp", "pickup_location_id", "service_type"
    ).limit(30).select("pickup_location_id", "service_type", "event_timestamp", "deviation_score")


@query("demand_thresholds", """
SELECT pickup_location_id, service_type, quantile_disc(trip_count, 0.5) AS median, quantile_disc(trip_count, 0.75) AS high,
  quantile_disc(trip_count, 0.9) AS critical FROM event_features GROUP BY ALL""")
def _(w):
    q = F.col("demand_quantiles")
    return forecast.demand_thresholds(w.event_features()).select(
        *features.SERIES, q[0].alias("median"), q[1].alias("high"), q[2].alias("critical"))


register("key_stats_join",
         lambda w: _NAIVE(w).withColumn("residual", F.expr("trip_count - prediction")).join(
             forecast.residual_spread(_NAIVE(w).withColumn("residual", F.expr("trip_count - prediction"))),
             list(features.SERIES), "left").select(*features.SERIES, "event_timestamp", "residual", "residual_stddev"),
         f"""SELECT n.pickup_location_id, n.service_type, event_timestamp, residual, {rnd('s.sd', 'residual_stddev')}
FROM naive n LEFT JOIN (SELECT pickup_location_id, service_type, stddev_pop(residual) AS sd FROM naive GROUP BY ALL) s
USING (pickup_location_id, service_type)""")

register("error_quantile", lambda w: forecast.error_quantile(_NAIVE(w)))

# --- coming hours ------------------------------------------------------------

BLOCKS["latest_hour"] = "SELECT max(event_timestamp) AS latest FROM event_features"
BLOCKS["recent"] = """
SELECT pickup_location_id, service_type,
  avg(trip_count) FILTER (event_timestamp > latest - INTERVAL 6 HOUR) AS rolling_mean_6h,
  avg(trip_count) FILTER (event_timestamp > latest - INTERVAL 24 HOUR) AS rolling_mean_24h,
  avg(trip_count) AS rolling_mean_168h,
  stddev_pop(trip_count) FILTER (event_timestamp > latest - INTERVAL 24 HOUR) AS rolling_stddev_24h
FROM event_features, latest_hour WHERE event_timestamp > latest - INTERVAL 168 HOUR GROUP BY ALL"""
register("recent_rolling", lambda w: forecast.recent_history(w.event_features()).drop("past"),
         f"SELECT pickup_location_id, service_type, {rounded(_FRACTIONS)} FROM recent")
_AHEAD_JOIN = "\n".join(
    f"""LEFT JOIN event_hours l{n} ON l{n}.pickup_location_id = a.pickup_location_id AND l{n}.service_type = a.service_type
  AND l{n}.event_timestamp + INTERVAL {n} HOUR = a.event_timestamp""" for n in _NAMES)
BLOCKS["ahead"] = """
SELECT pickup_location_id, pickup_zone_name, pickup_borough, service_type, airport_zone_flag, active_hours, total_trips,
  CAST(horizon_hour AS INT) AS horizon_hour, latest + INTERVAL 1 HOUR * horizon_hour AS event_timestamp
FROM (SELECT pickup_location_id, pickup_zone_name, pickup_borough, service_type, airport_zone_flag,
        count(event_timestamp) AS active_hours, sum(trip_count) AS total_trips FROM event_features GROUP BY ALL),
  latest_hour, range(1, 25) t(horizon_hour)"""
BLOCKS["future"] = f"""
SELECT a.*, coalesce(l1.trip_count, l24.trip_count, l168.trip_count, rolling_mean_168h, 0) AS lag_1_hour,
  coalesce(l2.trip_count, l24.trip_count, l168.trip_count, rolling_mean_168h, 0) AS lag_2_hours,
  coalesce(l24.trip_count, l168.trip_count, rolling_mean_168h, 0) AS lag_24_hours,
  coalesce(l48.trip_count, l168.trip_count, rolling_mean_168h, 0) AS lag_48_hours,
  coalesce(l168.trip_count, rolling_mean_168h, 0) AS lag_168_hours,
  rolling_mean_6h, rolling_mean_24h, rolling_mean_168h, rolling_stddev_24h
FROM ahead a LEFT JOIN recent r ON r.pickup_location_id = a.pickup_location_id AND r.service_type = a.service_type
{_AHEAD_JOIN}"""
_FUTURE = ["pickup_location_id", "service_type", "horizon_hour", "event_timestamp", *_NAMES.values(), *_FRACTIONS.split()]
register("future_frame", lambda w: forecast.future_frame(w.event_features(), 24).select(*_FUTURE),
         "SELECT " + ", ".join(n if n in _FUTURE[:4] else rnd(n) for n in _FUTURE) + " FROM future")
register("horizon_grid",
         lambda w: forecast.future_frame(w.event_features(), 24).select(
             "pickup_location_id", "service_type", "horizon_hour", "event_timestamp", "active_hours", "total_trips"),
         "SELECT pickup_location_id, service_type, horizon_hour, event_timestamp, active_hours, total_trips FROM ahead")
register("future_lags",
         lambda w: forecast.future_frame(w.event_features(), 24).groupBy("service_type", "horizon_hour").agg(
             *[F.sum(n).alias(n) for n in _NAMES.values()]),
         "SELECT service_type, horizon_hour, " + ", ".join(rnd(f"sum({n})", n) for n in _NAMES.values())
         + " FROM future GROUP BY ALL")

# --- fitted models (no SQL counterpart) --------------------------------------

register("forecast_output", lambda w: w.forecast()["predictions"].drop("generated_at"))
register("forecast_candidates", lambda w: w.forecast()["candidates"])
register("forecast_metrics", lambda w: w.forecast()["metrics"])
register("forecast_test", lambda w: w.forecast()["test"])
register("forecast_anomalies", lambda w: w.forecast()["anomalies"])
register("segment_assignments", lambda w: w.segments()["assignments"])
register("segment_profiles", lambda w: w.segments()["profiles"])
register("segment_metrics", lambda w: w.segments()["metrics"])
register("wait_risk_predictions", lambda w: w.wait_risk()["predictions"].drop("generated_at"))
register("wait_risk_candidates", lambda w: w.wait_risk()["candidates"])
register("wait_risk_metrics", lambda w: w.wait_risk()["metrics"])
register("wait_risk_importance", lambda w: w.wait_risk()["importance"])


@query("feature_pipeline")
def _(w):
    df = forecast.prepare(w.event_features())
    stages = learning.feature_pipeline(forecast.NUMERIC, forecast.CATEGORICAL, forecast.regressor("poisson_glr", FORECAST))
    from pyspark.ml import Pipeline
    encoded = Pipeline(stages=stages.getStages()[:-1]).fit(df).transform(df)
    from pyspark.ml.functions import vector_to_array
    return encoded.select(*features.SERIES, "event_timestamp", F.size(vector_to_array("features")).alias("slots"))


@query("save_model")
def _(w):
    copy = f"{shared_dir(w.spark)}/fareflow/model-copy"
    save_model(PipelineModel.load(w.segments()["model_path"]), copy)
    zones = segments.active_zones(w.zone_profiles())
    return PipelineModel.load(copy).transform(zones).select("zone_key", "cluster_id")
