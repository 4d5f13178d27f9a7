"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.blocks import BLOCKS, rnd, rounded
from checks.registry import query, register
from fareflow.operators.keyed import at_least_quantile, weighted_mean
from fareflow.plans import dashboards as d
from fareflow.spec import SERVICE_KEYS, Scope

_LABEL = """CASE service_type WHEN 'yellow' THEN 'Yellow' WHEN 'green' THEN 'Green' WHEN 'fhv' THEN 'FHV'
  ELSE 'HVFHV' END"""


def _weighted(value: str, weight: str = "trip_count") -> str:
    return f"CASE WHEN sum({weight}) > 0 THEN coalesce(sum({value} * {weight}), 0) / sum({weight}) END"


def _n(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


# --- overview ----------------------------------------------------------------

BLOCKS["month_totals"] = "SELECT source_year, source_month, sum(trip_count) AS n FROM m_executive GROUP BY ALL"
BLOCKS["latest_months"] = "SELECT * FROM month_totals ORDER BY source_year DESC, source_month DESC LIMIT 2"
BLOCKS["change"] = """
SELECT CAST(arg_max(n, source_year * 100 + source_month) AS BIGINT) AS last_month,
  CAST(arg_min(n, source_year * 100 + source_month) AS BIGINT) AS prior_month FROM latest_months"""
_CHANGE = "(last_month - prior_month) / prior_month"
register("month_over_month", lambda w: d.month_over_month(w.stored_mart("executive_monthly")),
         f"SELECT last_month, prior_month, {rnd(_CHANGE, 'change')} FROM change")
register("previous_month", lambda w: d.previous_month(w.stored_mart("executive_monthly")), f"""
SELECT source_year, source_month, {_n('n', 'trip_count')},
  {_n('lag(n) OVER (ORDER BY source_year, source_month)', 'previous_trip_count')} FROM month_totals""")
_MEANS = ("average_duration_seconds", "average_distance_miles", "average_speed_mph")
register("overview_kpis", lambda w: d.overview_kpis(w.stored_mart("executive_monthly")), f"""
SELECT {_n('sum(trip_count)', 'trip_count')}, {', '.join(rnd(_weighted(m), m) for m in _MEANS)},
  (SELECT {rnd(_CHANGE, 'x')} FROM change) AS month_change FROM m_executive""")


@query("weighted_mean", f"SELECT service_type, {rnd(_weighted('average_speed_mph'), 'speed')} FROM m_executive GROUP BY ALL")
def _(w):
    return w.stored_mart("executive_monthly").groupBy("service_type").agg(weighted_mean("average_speed_mph", "trip_count").alias("speed"))


register("share_by_service", lambda w: d.share_by_service(w.stored_mart("executive_monthly")),
         f"SELECT {_LABEL} AS service_label, {_n('sum(trip_count)', 'trip_count')} FROM m_executive GROUP BY ALL")
register("monthly_trend", lambda w: d.monthly_trend(w.stored_mart("executive_monthly")),
         f"SELECT make_date(source_year, source_month, 1) AS period, {_LABEL} AS service_label, trip_count FROM m_executive")
_SCOPE = Scope(years=(1997, 1998), months=(1, 2, 3), services=("yellow", "fhvhv"))
register("daily_trend", lambda w: d.daily_trend(w.stored_mart("daily_demand"), _SCOPE), f"""
SELECT event_date, {_LABEL} AS service_label, trip_count FROM m_daily
WHERE year(event_date) IN (1997, 1998) AND month(event_date) IN (1, 2, 3) AND service_type IN ('yellow', 'fhvhv')""")
register("apply_scope", lambda w: d.in_scope(w.stored_mart("zone_demand"), _SCOPE).groupBy("service_type").agg(
    F.sum("pickup_trip_count").alias("trips")), f"""
SELECT service_type, {_n('sum(pickup_trip_count)', 'trips')} FROM m_zone
WHERE source_year IN (1997, 1998) AND source_month IN (1, 2, 3) AND service_type IN ('yellow', 'fhvhv') GROUP BY ALL""")
register("home_kpis", lambda w: d.home_kpis(w.stored_mart("executive_monthly")), f"""
SELECT {_n('sum(trip_count)', 'trip_count')}, count(DISTINCT service_type) AS services,
  count(DISTINCT source_year) AS years FROM m_executive""")
register("coverage_note", lambda w: d.coverage_note(w.stored_mart("executive_monthly"), range(1993, 2003)), f"""
SELECT service_type, array_to_string(list_sort(list_filter([1993, 1994, 1995, 1996, 1997, 1998, 1999, 2000, 2001, 2002],
  lambda y: NOT list_contains(covered, y))), '|') AS missing_years, {_LABEL} AS service_label
FROM (SELECT service_type, list(DISTINCT source_year) AS covered FROM m_executive GROUP BY ALL)
WHERE missing_years <> ''""")
register("declared_coverage", lambda w: d.declared_coverage(
    w.stored_mart("executive_monthly"), range(1995, 2003), {"fhvhv": (1996, 1997), "green": (1995, 1996, 1997, 1998)}), f"""
WITH selected AS (SELECT *, CASE service_type WHEN 'fhvhv' THEN [1996, 1997] WHEN 'green' THEN [1995, 1996, 1997, 1998]
    ELSE range(1995, 2003) END AS declared FROM m_executive)
SELECT service_type, {_LABEL} AS service_label, CASE service_type WHEN 'fhvhv' THEN '1995|1998|1999|2000|2001|2002'
    ELSE '1999|2000|2001|2002' END AS missing_years,
  CAST(coalesce(sum(trip_count) FILTER (NOT list_contains(declared, source_year) AND source_year BETWEEN 1995 AND 2002), 0) AS BIGINT) AS trips_left_out
FROM selected WHERE service_type IN ('fhvhv', 'green') GROUP BY service_type""")

# --- geography ---------------------------------------------------------------

BLOCKS["zone_rank"] = """
SELECT pickup_zone_name, pickup_borough, CAST(sum(pickup_trip_count) AS BIGINT) AS pickup_trip_count FROM m_zone GROUP BY ALL"""
BLOCKS["borough_rank"] = """
SELECT pickup_borough, CAST(sum(pickup_trip_count) AS BIGINT) AS pickup_trip_count FROM m_zone GROUP BY ALL"""
BLOCKS["corridors"] = """
SELECT pickup_zone_name, dropoff_zone_name, pickup_borough, dropoff_borough, CAST(sum(trip_count) AS BIGINT) AS trip_count,
  avg(average_speed_mph) AS average_speed_mph FROM m_routes GROUP BY ALL"""
register("top_zones", lambda w: d.top_zones(w.stored_mart("zone_demand")),
         "SELECT * FROM zone_rank ORDER BY pickup_trip_count DESC, pickup_zone_name, pickup_borough LIMIT 15")
register("borough_rank", lambda w: d.borough_rank(w.stored_mart("zone_demand")), "SELECT * FROM borough_rank")
register("top_corridors", lambda w: d.top_corridors(w.stored_mart("od_routes")), f"""
SELECT * REPLACE ({rnd('average_speed_mph')}) FROM corridors
ORDER BY trip_count DESC, pickup_zone_name, dropoff_zone_name, pickup_borough, dropoff_borough LIMIT 20""")
register("geo_kpis", lambda w: d.geo_kpis(w.stored_mart("zone_demand"), w.stored_mart("od_routes")), """
SELECT (SELECT count(DISTINCT pickup_zone_name) FROM zone_rank) AS active_zones,
  (SELECT pickup_zone_name FROM zone_rank ORDER BY pickup_trip_count DESC, pickup_zone_name LIMIT 1) AS top_zone,
  (SELECT pickup_borough FROM borough_rank ORDER BY pickup_trip_count DESC, pickup_borough LIMIT 1) AS top_borough,
  (SELECT concat(pickup_zone_name, ' → ', dropoff_zone_name) FROM corridors
   ORDER BY trip_count DESC, concat(pickup_zone_name, ' → ', dropoff_zone_name) LIMIT 1) AS top_route""")
_BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
_MATRIX = ", ".join(
    f"CAST(coalesce(sum(trip_count) FILTER (dropoff_borough = '{b}'), 0) AS BIGINT) AS \"{b}\"" for b in _BOROUGHS)
register("pivot_borough_matrix", lambda w: d.borough_matrix(w.stored_mart("od_routes")),
         f"SELECT pickup_borough, {_MATRIX} FROM m_routes GROUP BY ALL")

# --- time --------------------------------------------------------------------

_HOURS = ", ".join(f"CAST(coalesce(sum(trip_count) FILTER (hour_of_day = {h}), 0) AS BIGINT) AS \"{h}\"" for h in range(24))
register("pivot_day_hour", lambda w: d.day_hour_matrix(w.stored_mart("time_heatmap")),
         f"SELECT day_of_week, {_HOURS} FROM m_heat GROUP BY ALL")
for _name, _column in (("peak_hour", "hour_of_day"), ("peak_day", "day_of_week")):
    BLOCKS[_name] = (f"SELECT {_column}, {_n('sum(trip_count)', 'n')} FROM m_heat GROUP BY ALL "
                     f"ORDER BY n DESC, {_column} LIMIT 1")
    register(_name, lambda w, f=getattr(d, _name): f(w.stored_mart("time_heatmap")), f"SELECT * FROM {_name}")
register("temporal_profile", lambda w: d.temporal_kpis(w.stored_mart("time_heatmap"), w.stored_mart("executive_monthly")), f"""
SELECT {rnd(_weighted('average_duration_seconds'), 'average_duration_seconds')},
  (SELECT hour_of_day FROM peak_hour) AS peak_hour, (SELECT n FROM peak_hour) AS peak_hour_trips,
  (SELECT day_of_week FROM peak_day) AS peak_day, (SELECT n FROM peak_day) AS peak_day_trips,
  (SELECT {rnd(_weighted('average_speed_mph'), 'x')} FROM m_executive) AS average_speed_mph FROM m_heat""")
register("hour_by_service", lambda w: d.hour_by_service(w.stored_mart("time_heatmap")),
         f"SELECT {_LABEL} AS service_label, hour_of_day, {_n('sum(trip_count)', 'trip_count')} FROM m_heat GROUP BY ALL")
register("hour_p95_merge", lambda w: d.hourly_efficiency(w.stored_mart("operational_efficiency")), f"""
SELECT h.service_label, h.hour_of_day, {_n('n', 'trip_count')}, {rnd('speed', 'average_speed_mph')},
  {rnd('p95', 'p95_duration_seconds')}, {rnd('p95 / 60.0', 'p95_minutes')}
FROM (SELECT {_LABEL} AS service_label, hour_of_day, sum(trip_count) AS n, avg(average_speed_mph) AS speed
      FROM m_ops GROUP BY ALL) h
LEFT JOIN (SELECT {_LABEL} AS service_label, hour_of_day, avg(p95_duration_seconds) AS p95 FROM m_ops GROUP BY ALL) p
  USING (service_label, hour_of_day)""")

# --- money -------------------------------------------------------------------

register("finance_kpis", lambda w: d.finance_kpis(w.stored_mart("financial_profile")), f"""
SELECT {_n('sum(trip_count)', 'trip_count')}, {rnd('sum(total_amount)', 'revenue')},
  {rnd(_weighted('average_total_amount'), 'average_ticket')},
  {rnd(_weighted('average_tip_percentage'), 'average_tip_percentage')},
  {rnd('sum(tolls_amount) / sum(total_amount)', 'toll_share')} FROM m_financial""")
register("money_composition", lambda w: d.money_composition(w.stored_mart("financial_profile")), f"""
SELECT 'Tarifa' AS component, {rnd('sum(fare_amount)', 'amount')} FROM m_financial UNION ALL
SELECT 'Propina', {rnd('sum(tip_amount)', 'amount')} FROM m_financial UNION ALL
SELECT 'Peajes', {rnd('sum(tolls_amount)', 'amount')} FROM m_financial""")
_PROFIT = "average_total_amount average_fare_per_mile average_revenue_per_minute average_tip_percentage"
BLOCKS["profit_zones"] = f"""
SELECT pickup_zone_name, pickup_borough, CAST(sum(trip_count) AS BIGINT) AS trip_count,
  {', '.join(f'avg({m}) AS {m}' for m in _PROFIT.split())} FROM m_profit GROUP BY ALL"""
register("zone_profitability", lambda w: d.zone_profitability(w.stored_mart("profitability_drivers")), f"""
SELECT * REPLACE ({rounded(_PROFIT)}) FROM profit_zones
WHERE trip_count >= (SELECT quantile_cont(trip_count, 0.5) FROM profit_zones)""")
register("volume_floor", lambda w: at_least_quantile(d.zone_rank(w.stored_mart("zone_demand")), "pickup_trip_count", 0.60), """
SELECT * FROM zone_rank WHERE pickup_trip_count >= (SELECT quantile_cont(pickup_trip_count, 0.6) FROM zone_rank)""")
register("tip_by_hour", lambda w: d.tip_by_hour(w.stored_mart("tip_behavior")), f"""
SELECT time_key, {rnd('avg(average_tip_percentage)', 'average_tip_percentage')},
  {rnd('avg(median_tip_percentage)', 'median_tip_percentage')},
  {_n('sum(credit_card_trip_count)', 'credit_card_trip_count')}
FROM m_tips WHERE time_key IS NOT NULL GROUP BY time_key""")

# --- efficiency --------------------------------------------------------------

register("slow_routes", lambda w: d.slow_routes(w.stored_mart("route_efficiency")),
         "SELECT count(*) AS slow_routes FROM m_route_view WHERE average_speed_mph < 8")
_EFFICIENCY = ("average_speed_mph", "average_duration_seconds", "p95_duration_seconds")
register("efficiency", lambda w: d.efficiency_kpis(w.stored_mart("operational_efficiency"), w.stored_mart("route_efficiency")), f"""
SELECT {', '.join(rnd(_weighted(m), m) for m in _EFFICIENCY)},
  (SELECT count(*) FROM m_route_view WHERE average_speed_mph < 8) AS slow_routes FROM m_ops""")
_LANE = "average_speed_mph average_duration_seconds average_distance_miles"
BLOCKS["lanes"] = f"""
SELECT pickup_zone_name, dropoff_zone_name, {_LABEL} AS service_label, CAST(sum(trip_count) AS BIGINT) AS trip_count,
  {', '.join(f'avg({m}) AS {m}' for m in _LANE.split())} FROM m_route_view GROUP BY ALL"""
register("slowest_routes", lambda w: d.slowest_routes(w.stored_mart("route_efficiency")), f"""
SELECT * REPLACE ({rounded(_LANE)}) FROM (SELECT * FROM lanes
WHERE trip_count >= (SELECT quantile_cont(trip_count, 0.6) FROM lanes)
ORDER BY average_speed_mph NULLS LAST, trip_count DESC, pickup_zone_name, dropoff_zone_name, service_label LIMIT 20)""")
BLOCKS["congested"] = """
SELECT pickup_zone_name, pickup_borough, CAST(sum(trip_count) AS BIGINT) AS trip_count,
  avg(congestion_index) AS congestion_index, avg(average_speed_mph) AS average_speed_mph FROM m_congestion GROUP BY ALL"""
register("most_congested_zones", lambda w: d.most_congested_zones(w.stored_mart("zone_congestion")), f"""
SELECT * REPLACE ({rounded('congestion_index average_speed_mph')}) FROM (SELECT * FROM congested
WHERE trip_count >= (SELECT quantile_cont(trip_count, 0.6) FROM congested) AND congestion_index IS NOT NULL
ORDER BY congestion_index DESC, pickup_zone_name, pickup_borough LIMIT 15)""")

# --- competition -------------------------------------------------------------

BLOCKS["zone_service"] = f"""
SELECT pickup_zone_key, pickup_zone_name, pickup_borough, {_LABEL} AS service_label,
  CAST(sum(pickup_trip_count) AS BIGINT) AS n FROM m_competition GROUP BY ALL"""
BLOCKS["dominant"] = """
SELECT pickup_zone_key, service_label AS dominant_service, n AS dominant_trips, services FROM (
  SELECT *, row_number() OVER (PARTITION BY pickup_zone_key ORDER BY n DESC, service_label) AS rn,
    count(*) OVER (PARTITION BY pickup_zone_key) AS services
  FROM zone_service WHERE pickup_zone_key IS NOT NULL) WHERE rn = 1"""
register("argmax_per_group", lambda w: d.dominant_service(w.stored_mart("service_competition")), "SELECT * FROM dominant")
register("competition", lambda w: d.competition_kpis(w.stored_mart("service_competition")), f"""
SELECT count(*) AS zones, count(*) FILTER (services >= 3) AS multimodal_zones,
  (SELECT service_label FROM zone_service GROUP BY service_label ORDER BY sum(n) DESC, service_label LIMIT 1) AS leader,
  {rnd('(SELECT max(c) FROM (SELECT count(*) AS c FROM dominant GROUP BY dominant_service)) / count(*)', 'concentration')}
FROM dominant""")
_S = ("Yellow", "Green", "FHV", "HVFHV")
BLOCKS["service_matrix"] = f"""
SELECT *, {', '.join(f'"{s}" / nullif(total, 0) AS "{s}_share"' for s in _S)},
  CASE greatest("Yellow", "Green", "FHV", "HVFHV") {' '.join(f'WHEN "{s}" THEN {chr(39)}{s}{chr(39)}' for s in _S)} END
    AS dominant_service,
  greatest("Yellow", "Green", "FHV", "HVFHV") / nullif(total, 0) AS dominant_share
FROM (SELECT *, CAST("Yellow" + "Green" + "FHV" + "HVFHV" AS BIGINT) AS total FROM (
  SELECT pickup_zone_key, pickup_zone_name, pickup_borough,
    {', '.join(f'CAST(coalesce(sum(n) FILTER (service_label = {chr(39)}{s}{chr(39)}), 0) AS BIGINT) AS "{s}"' for s in _S)}
  FROM zone_service GROUP BY 1, 2, 3))"""
_SHARES = ", ".join(f'round("{s}_share" + 1e-9, 6) AS "{s}_share"' for s in _S)
register("pivot_zone_service", lambda w: d.zone_service_matrix(w.stored_mart("service_competition")),
         f"SELECT * REPLACE ({_SHARES}, {rnd('dominant_share')}) FROM service_matrix")
register("dominance_table", lambda w: d.dominance_table(w.stored_mart("service_competition")), f"""
SELECT pickup_zone_name, pickup_borough, dominant_service, {rnd('dominant_share')}, total FROM service_matrix t
ORDER BY t.dominant_share DESC, total DESC, pickup_zone_name LIMIT 30""")

# --- set operations ----------------------------------------------------------


@query("union_by_name", "SELECT service_type, count(*) AS n FROM raw GROUP BY ALL")
def _(w):
    parts = [w.raw(s).select(F.lit(s).alias("service_type")) for s in SERVICE_KEYS]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("service_type").agg(F.count(F.lit(1)).alias("n"))


# --- model views -------------------------------------------------------------

register("forecast_series", lambda w: d.forecast_series(w.forecast()["predictions"]))
register("forecast_levels", lambda w: d.forecast_levels(w.forecast()["predictions"]))
register("forecast_top_zones", lambda w: d.forecast_top_zones(w.forecast()["predictions"]))
register("forecast_peak", lambda w: d.forecast_peak(w.forecast()["predictions"]))
register("forecast_top_anomalies", lambda w: w.forecast()["anomalies"].filter("anomaly_flag").orderBy(
    F.desc(F.abs("deviation_score")), "event_timestamp", "pickup_location_id").limit(30))
register("segment_sizes", lambda w: d.segment_sizes(w.segments()["assignments"]))
register("silhouette_by_k", lambda w: d.silhouette_by_k(w.segments()["metrics"]))
register("segment_radar", lambda w: d.min_max_normalised(w.segments()["profiles"]).select("cluster_id", "segment_name", *d.RADAR))
register("risk_kpis", lambda w: d.risk_kpis(w.wait_risk()["predictions"]))
register("risk_top_zones", lambda w: d.risk_top_zones(w.wait_risk()["predictions"]))
register("risk_levels", lambda w: d.risk_levels(w.wait_risk()["predictions"]))
register("top_risk_trips", lambda w: d.top_risk_trips(w.wait_risk()["predictions"]))
register("top_importance", lambda w: d.top_importance(w.wait_risk()["importance"]))

_SCALED = ", ".join(
    f"round(CASE WHEN min({n}) OVER () = max({n}) OVER () THEN 0.5 ELSE ({n} - min({n}) OVER ()) / "
    f"(max({n}) OVER () - min({n}) OVER ()) END + 1e-9, 6) AS {n}" for n in d.RADAR)
register("min_max_normalised", lambda w: d.min_max_normalised(w.zone_profiles()).select("zone_key", *d.RADAR),
         f"SELECT zone_key, {_SCALED} FROM zone_profiles")
