"""Marts, features and rankings: invariants and brute-force checks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareflow.operators import order
from fareflow.operators.keyed import at_least_quantile, latest_by
from fareflow.plans import dashboards, features, forecast, learning, marts, segments, star


def test_mart_trips_add_up_to_the_fact(medium):
    n = medium.fact("trip_activity").count()
    for name, column in (("executive_monthly", "trip_count"), ("od_routes", "trip_count"), ("zone_demand", "pickup_trip_count"),
                         ("time_heatmap", "trip_count"), ("daily_demand", "trip_count")):
        assert medium.mart(name).agg(F.sum(column)).first()[0] == n


def test_shares_add_up_to_one(medium):
    worst = medium.mart("service_share").groupBy("source_year", "source_month").agg(
        F.abs(F.sum("service_share") - 1).alias("gap")).agg(F.max("gap")).first()[0]
    assert worst < 1e-9


def test_null_zone_has_no_share(spark):
    fact = spark.createDataFrame(
        [(2023, 1, "yellow", None, 1, 60, 1.0, 1.0), (2023, 1, "green", 7, 1, 60, 1.0, 1.0)],
        "source_year int, source_month int, service_type string, pickup_zone_key int, trip_count bigint, "
        "trip_duration_seconds bigint, trip_distance_miles double, average_speed_mph double")
    zone = spark.createDataFrame([(7, "Z", "B")], "zone_key int, zone_name string, borough string")
    rows = {r.pickup_zone_key: r for r in marts.build_mart("service_competition", {"trip_activity": fact}, zone).collect()}
    assert rows[None].zone_service_share is None and rows[None].zone_total_trip_count is None
    assert rows[7].zone_service_share == 1.0


def test_rolled_up_marts_equal_direct_ones(small):
    rollup = marts.activity_rollup(small.fact("trip_activity"))
    names = [n for n in marts.MARTS if marts.rolls_up(n)]
    assert {"executive_monthly", "daily_demand", "zone_demand"} <= set(names)
    for name in names:
        direct = small.mart(name)
        again = marts.roll_up_mart(name, rollup, small.dim_zone()).select(*direct.columns)
        def key(rows):
            return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in rows)
        assert key(direct.collect()) == key(again.collect()), name


def test_labels_are_joined_after_aggregation(medium):
    plan = medium.mart("zone_demand")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("Aggregate")


def test_provider_keys_are_unique(medium):
    dim = star.dim_provider(medium.master())
    assert dim.count() == dim.select("provider_key").distinct().count()


def _series(spark, points):
    start = datetime(2024, 1, 1)
    rows = [(7, "yellow", start + timedelta(hours=h), float(n)) for h, n in points]
    return spark.createDataFrame(rows, "pickup_location_id int, service_type string, event_timestamp timestamp_ntz, trip_count double")


def test_exact_lag_respects_gaps(spark):
    df = _series(spark, [(0, 5), (1, 6), (3, 8), (24, 9)])
    out = {r.event_timestamp.hour + 24 * (r.event_timestamp.day - 1): r for r in df.withColumns({
        "one": features.exact_lag(1), "day": features.exact_lag(24), "mean": F.avg("trip_count").over(features.trailing(6))}).collect()}
    assert out[1].one == 5 and out[3].one is None and out[24].day == 5 and out[24].mean is None
    assert out[3].mean == pytest.approx(5.5) and out[0].mean is None


def test_all_history_shares_one_sort(medium):
    plan = medium.event_features()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1


def test_future_lags_fall_back(spark):
    df = _series(spark, [(0, 5), (170, 7), (190, 3)]).withColumns({
        "pickup_zone_name": F.lit("Z"), "pickup_borough": F.lit("B"), "airport_zone_flag": F.lit(False)})
    out = {r.horizon_hour: r for r in forecast.future_frame(df, 24).collect()}
    assert len(out) == 24
    assert out[1].lag_1_hour == 3  # hour 190
    assert out[4].lag_24_hours == 7  # hour 170
    assert out[4].lag_1_hour == 7  # not seen, so the day before
    assert out[2].lag_1_hour == pytest.approx(5.0)  # nothing seen: mean of the last 168 hours
    assert out[1].rolling_mean_24h == pytest.approx(5.0)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(10.0, 8.0), (0.0, 1.0), (4.0, None)], "trip_count double, prediction double")
    m = learning.numbers(learning.regression_metrics(df))
    assert m == pytest.approx({"mae": 1.5, "rmse": 2.5 ** 0.5, "wape": 3 / 14})
    empty = learning.numbers(learning.baseline_metrics(df.filter("false"), "prediction"))
    assert empty["wape"] == float("inf")


def test_class_weights_need_both_classes(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "y double")
    weights = {r.y: r.class_weight for r in learning.class_weights(df, "y").collect()}
    assert weights == pytest.approx({0.0: 4 / 6, 1.0: 2.0})
    with pytest.raises(ValueError):
        learning.weighted(df.filter("y = 0"), "y")


def test_segment_names_are_unique():
    measures = [m for m, _ in segments.LEADERS]
    profiles = [{"cluster_id": i, **{m: float(i) for m in measures}} for i in range(8)]
    names = segments.segment_names(profiles)
    assert len(set(names.values())) == 8 and names[7] == segments.LEADERS[0][1]


def test_anomaly_levels(spark):
    base = [(7, "yellow", datetime(2024, 1, 1, h % 24), 10.0, 10.0 + (1 if h % 2 else -1)) for h in range(24)]
    rows = base + [(7, "yellow", datetime(2024, 1, 2), 60.0, 10.0)]
    df = spark.createDataFrame(rows, "pickup_location_id int, service_type string, event_timestamp timestamp_ntz, trip_count double, prediction double")
    df = df.withColumns({"pickup_zone_name": F.lit("Z"), "pickup_borough": F.lit("B")})
    flagged = forecast.demand_anomalies(df).filter("anomaly_flag").collect()
    # residuals: 24 of size one around zero and one of 50, so the spread is sqrt(100.96 - 4)
    assert [(r.anomaly_type, r.severity) for r in flagged] == [("DEMAND_SURGE", "CRITICAL")]
    assert flagged[0].deviation_score == pytest.approx(50 / 96.96 ** 0.5)


def test_model_choice_survives_a_failing_candidate(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer

    df = spark.createDataFrame([(1.0, 1.0)], "trip_count double, prediction double")
    def make(name):
        text = "SELECT * FROM __THIS__" if name == "good" else "SELECT missing FROM __THIS__"
        return Pipeline(stages=[SQLTransformer(statement=text)])
    fitted = learning.fit_candidates(["bad", "good"], make, df, lambda p: learning.numbers(learning.regression_metrics(p)), df)
    assert [c.algorithm for c in fitted] == ["good"]
    with pytest.raises(RuntimeError):
        learning.fit_candidates(["bad"], make, df, lambda p: learning.numbers(learning.regression_metrics(p)), df)


def test_min_max_of_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    rows = dashboards.min_max_normalised(df, ["a", "b"]).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.5), (1.0, 0.5)]


def test_quantile_floor_is_linear(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 10)], "n int")
    assert sorted(r.n for r in at_least_quantile(df, "n", 0.5).collect()) == [3, 10]


def test_month_change_needs_two_months(spark):
    ddl = "source_year int, source_month int, trip_count bigint"
    one = spark.createDataFrame([(2023, 1, 5)], ddl)
    assert dashboards.month_over_month(one).first().change is None
    two = spark.createDataFrame([(2022, 12, 4), (2023, 1, 5), (2021, 5, 9)], ddl)
    assert dashboards.month_over_month(two).first().change == pytest.approx(0.25)


def test_latest_keeps_null_keys_apart_and_nulls_lose(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), (None, 2, "z")], "k string, t int, v string")
    assert {(r.k, r.v) for r in latest_by(df, ["k"], ["t", "v"]).collect()} == {("a", "x"), (None, "z")}


@pytest.fixture
def many_ranges(spark):
    """Small tables stay in several ranges."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_numbers_cross_range_partitions(spark, many_ranges):
    start = datetime(2024, 1, 1)
    rows = [("a", i, start + timedelta(minutes=i % 50)) for i in range(400)] + [(None, 900 + i, start) for i in range(3)] + [("b", 999, None)]
    df = spark.createDataFrame(rows, "k string, id int, at timestamp_ntz")
    out = order.numbered(df, ["k"], ["at", "id"], "n")
    want = {i: n for n, (_, i, _) in enumerate(sorted(rows[:400], key=lambda r: (r[2], r[1])), 1)} | {900: 1, 901: 2, 902: 3, 999: 1}
    assert {r.id: r.n for r in out.collect()} == want
    assert len({r[0] for r in order.in_ranges(df, ["k", "at", "id"], "t").select(order.PART).distinct().collect()}) > 2
    assert order.numbered(df.limit(0), ["k"], ["at"], "n").count() == 0


def test_exact_quantiles_select_by_rank(spark, many_ranges):
    rng = random.Random(7)
    for values in ([], [4.5], [1.0, 2.0], [rng.choice([0.1, 0.1, rng.random(), float(rng.randint(-3, 3))]) for _ in range(501)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        got = {r.share: r.value for r in order.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.951, 1.0]).collect()}
        for share, value in got.items():
            at = sorted(values)
            where = share * (len(at) - 1)
            low, high = int(where), min(int(where) + 1, len(at) - 1)
            assert value == (pytest.approx(at[low] + (at[high] - at[low]) * (where - low), rel=1e-12) if at else None)
        assert len(got) == 5
    plan = order.exact_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
