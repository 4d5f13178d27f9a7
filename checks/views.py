"""Views of model outputs, fed by what SQL can say: the seasonal-naive prediction, a risk and a segment by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.blocks import BLOCKS, rnd
from checks.registry import query, register
from fareflow.plans.forecast import graded
from fareflow.plans import dashboards as d
from fareflow.plans import forecast, segments
from fareflow.plans.wait_risk import LEVELS

# --- forecast: the value a week before, with the naive forecast's own error ------------------------

_ERROR = "(SELECT quantile_disc(abs(residual), 0.9) FROM naive)"
BLOCKS["outlook"] = f"""
SELECT f.event_timestamp AS forecast_timestamp, f.horizon_hour, f.pickup_location_id, f.pickup_zone_name, f.pickup_borough, f.service_type,
  round(greatest(lag_168_hours, 0), 6) AS predicted_trip_count, greatest(round(greatest(lag_168_hours, 0), 6) - {_ERROR}, 0) AS lower_bound,
  round(greatest(lag_168_hours, 0), 6) + {_ERROR} AS upper_bound,
  CASE WHEN round(lag_168_hours, 6) > critical THEN 'CRITICAL' WHEN round(lag_168_hours, 6) > high THEN 'HIGH'
    WHEN round(lag_168_hours, 6) > median THEN 'NORMAL' ELSE 'LOW' END AS demand_level
FROM future f LEFT JOIN (SELECT pickup_location_id, service_type, quantile_disc(trip_count, 0.5) AS median,
    quantile_disc(trip_count, 0.75) AS high, quantile_disc(trip_count, 0.9) AS critical FROM event_features GROUP BY ALL) q
  ON q.pickup_location_id = f.pickup_location_id AND q.service_type = f.service_type"""


def _naive(w):
    return w.event_features().filter("lag_24_hours IS NOT NULL").withColumn("prediction", F.col("lag_24_hours"))


def _outlook(w):
    history = w.event_features()
    ahead = forecast.future_frame(history, 24).withColumn("prediction", F.round("lag_168_hours", 6))
    width = forecast.error_quantile(_naive(w)).first()[0]
    return forecast.forecast_output(ahead, forecast.demand_thresholds(history), width, "naive").drop("model_id", "generated_at")


register("naive_error_quantile", lambda w: forecast.error_quantile(_naive(w)), f"SELECT {rnd(_ERROR, 'error_quantile')}")
_BOUNDS = ("predicted_trip_count", "lower_bound", "upper_bound")
_SUMS = ", ".join(rnd(f"sum({c})", c) for c in _BOUNDS)
register("naive_forecast_output", _outlook, f"SELECT * REPLACE ({', '.join(rnd(c) for c in _BOUNDS)}) FROM outlook")
register("naive_forecast_series", lambda w: d.forecast_series(_outlook(w)), f"SELECT forecast_timestamp, {_SUMS} FROM outlook GROUP BY ALL")
register("naive_forecast_levels", lambda w: d.forecast_levels(_outlook(w)),
         f"SELECT demand_level, {rnd('sum(predicted_trip_count)', 'predicted_trip_count')} FROM outlook GROUP BY ALL")
register("naive_forecast_top_zones", lambda w: d.forecast_top_zones(_outlook(w)), f"""
SELECT pickup_zone_name, pickup_borough, {rnd('sum(predicted_trip_count)', 'predicted_trip_count')} FROM outlook GROUP BY ALL
ORDER BY sum(predicted_trip_count) DESC, pickup_zone_name, pickup_borough LIMIT 15""")
register("naive_forecast_peak", lambda w: d.forecast_peak(_outlook(w)), f"""
SELECT forecast_timestamp, pickup_zone_name, service_type, {rnd('predicted_trip_count')} FROM outlook t
ORDER BY t.predicted_trip_count DESC, forecast_timestamp DESC, pickup_zone_name DESC, service_type DESC LIMIT 1""")


@query("naive_forecast_anomalies", f"""
SELECT pickup_location_id, service_type, event_timestamp, observed_trip_count, {rnd('deviation_score')}, anomaly_type FROM anomalies WHERE anomaly_flag""")
def _(w):
    return forecast.demand_anomalies(_naive(w)).filter("anomaly_flag").select(
        "pickup_location_id", "service_type", "event_timestamp", "observed_trip_count", "deviation_score", "anomaly_type")


# --- waiting risk by rule ------------------------------------------------------------------------

BLOCKS["ruled_risk"] = """
SELECT *, CASE WHEN risk_probability >= 0.8 THEN 'CRITICAL' WHEN risk_probability >= 0.6 THEN 'HIGH' WHEN risk_probability >= 0.4 THEN 'ELEVATED'
  ELSE 'NORMAL' END AS predicted_risk_level
FROM (SELECT *, CAST(request_to_pickup_seconds * 7 % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS risk_probability FROM wait_features)"""


def _risk(w):
    risk = (F.col("request_to_pickup_seconds") * 7 % 101).cast("double") / 100.0
    return w.wait_features().withColumn("risk_probability", risk).withColumn(
        "predicted_risk_level", graded(F.col("risk_probability"), LEVELS, "NORMAL"))


register("ruled_risk_kpis", lambda w: d.risk_kpis(_risk(w)), f"""
SELECT {rnd('avg(CASE WHEN risk_probability >= 0.6 THEN 1.0 ELSE 0.0 END)', 'high_risk_share')},
  {rnd('avg(request_to_pickup_seconds)', 'average_wait_seconds')} FROM ruled_risk""")
register("ruled_risk_levels", lambda w: d.risk_levels(_risk(w)), "SELECT predicted_risk_level, count(*) AS trips FROM ruled_risk GROUP BY ALL")
register("ruled_risk_top_zones", lambda w: d.risk_top_zones(_risk(w)), f"""
WITH risk_zones AS (SELECT pickup_zone_name, pickup_borough, count(*) AS trips, avg(risk_probability) AS average_risk,
  avg(request_to_pickup_seconds) AS average_wait_seconds FROM ruled_risk GROUP BY ALL)
SELECT pickup_zone_name, pickup_borough, trips, {rnd('average_risk')}, {rnd('average_wait_seconds')} FROM risk_zones z
WHERE trips >= (SELECT quantile_cont(trips, 0.5) FROM risk_zones) ORDER BY round(z.average_risk, 9) DESC, pickup_zone_name, pickup_borough LIMIT 15""")
register("ruled_top_risk_trips", lambda w: d.top_risk_trips(_risk(w)), """
SELECT trip_key, request_datetime, pickup_zone_name, pickup_borough, hvfhs_company_name, request_to_pickup_seconds, risk_probability,
  predicted_risk_level FROM ruled_risk ORDER BY risk_probability DESC, trip_key LIMIT 30""")
register("ruled_top_importance", lambda w: d.top_importance(
    w.wait_features().groupBy(F.concat_ws("=", F.lit("zone"), F.col("pickup_zone_key").cast("string")).alias("feature_name"))
    .agg(F.round(F.avg("request_to_pickup_seconds"), 3).alias("importance"))), """
SELECT concat_ws('=', 'zone', pickup_zone_key) AS feature_name, round(avg(request_to_pickup_seconds), 3) AS importance
FROM wait_features GROUP BY ALL ORDER BY importance DESC, feature_name LIMIT 20""")

# --- segments by rule ----------------------------------------------------------------------------

BLOCKS["ruled_segments"] = "SELECT *, CAST(zone_key % 4 AS INT) AS cluster_id, concat('segment ', zone_key % 4) AS segment_name FROM zone_profiles"


def _segments(w):
    cluster = (F.col("zone_key") % 4).cast("int")
    return w.zone_profiles().withColumns({"cluster_id": cluster, "segment_name": F.concat(F.lit("segment "), cluster.cast("string"))})


register("ruled_segment_sizes", lambda w: d.segment_sizes(_segments(w)), """
SELECT segment_name, count(DISTINCT zone_key) AS zone_count, CAST(sum(total_pickups) AS BIGINT) AS total_pickups FROM ruled_segments GROUP BY ALL""")
_MEANS = ", ".join(f"avg({c}) AS {c}" for c in d.RADAR)
_SCALED = ", ".join(
    f"round(CASE WHEN min({n}) OVER () = max({n}) OVER () THEN 0.5 ELSE ({n} - min({n}) OVER ()) / "
    f"(max({n}) OVER () - min({n}) OVER ()) END + 1e-9, 6) AS {n}" for n in d.RADAR)
register("ruled_segment_radar", lambda w: d.min_max_normalised(segments.cluster_profile(_segments(w))).select("cluster_id", *d.RADAR),
         f"SELECT cluster_id, {_SCALED} FROM (SELECT cluster_id, {_MEANS} FROM ruled_segments GROUP BY cluster_id)")


@query("ruled_silhouette_by_k", f"""
SELECT CAST(zone_key % 7 + 2 AS INT) AS k, {rnd('avg(total_pickups)', 'silhouette')} FROM zone_profiles GROUP BY 1""")
def _(w):
    k = (F.col("zone_key") % 7 + 2).cast("string")
    scored = w.zone_profiles().groupBy(F.concat(F.lit("silhouette_k_"), k).alias("metric_name")).agg(F.avg("total_pickups").alias("metric_value"))
    other = scored.select(F.lit("selected_k").alias("metric_name"), "metric_value")
    return d.silhouette_by_k(scored.unionByName(other))
