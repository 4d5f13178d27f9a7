"""Row examples per service and the rule engine."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareflow.operators import keyed, quality
from fareflow.plans import trips
from fareflow.session import prepare
from fareflow.sources import sinks
from fareflow.spec import QualityLimits


def at(hour, minute=0, second=0, day=5, month=1):
    return datetime(2023, month, day, hour, minute, second)


def raw(spark, ddl, rows, year=2023, month=1):
    df = spark.createDataFrame(rows, ddl)
    return df.withColumns({
        "source_year": F.lit(year), "source_month": F.lit(month), "source_record": F.lpad(F.monotonically_increasing_id().cast("string"), 12, "0")})


YELLOW = """VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double,
trip_distance double, RatecodeID int, store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type int,
fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
total_amount double, congestion_surcharge double, Airport_fee double, cbd_congestion_fee double"""


def yellow(start, end, **other):
    row = dict(v=1, a=start, b=end, p=1.0, d=5.0, r=1, s="N", pu=132, do=10, pay=1, fare=20.0, extra=0.0, mta=0.5, tip=3.0,
               tolls=0.0, imp=1.0, total=27.0, cong=2.5, air=0.0, cbd=0.0)
    row.update(other)
    return tuple(row.values())


def zones(spark):
    return spark.createDataFrame(
        [(132, "Queens", "JFK Airport", "Airports"), (10, "Queens", "Baisley Park", "Boro Zone")],
        "location_id int, borough string, zone_name string, service_zone string")


def bases(spark):
    return spark.createDataFrame(
        [("B00001", "Base One", "One", "BLACK-CAR", "Active")],
        "base_license_number string, base_name string, doing_business_as string, base_type string, status string")


def refs(spark):
    return trips.References(zones(spark), bases(spark))


def codes(row):
    return set(row.quality_error_codes), set(row.quality_warning_codes)


def test_yellow_valid_and_reversed_dates(spark):
    df = raw(spark, YELLOW, [yellow(at(10), at(10, 30)), yellow(at(11), at(10, 30))])
    good, bad = trips.flagged_trips(df, "yellow", refs(spark)).orderBy("pickup_datetime").collect()
    assert (good.quality_status, good.pickup_hour, good.airport_trip_flag) == ("VALID", 10, True)
    assert good.tip_percentage == pytest.approx(15.0)
    assert good.average_speed_mph == pytest.approx(10.0)
    assert good.pickup_zone_name == "JFK Airport"
    assert "INVALID_DATE_ORDER" in codes(bad)[0] and bad.quality_status == "REJECTED"


def test_missing_tip_is_unknown_but_costs_nothing(spark):
    row = trips.flagged_trips(raw(spark, YELLOW, [yellow(at(10), at(11), tip=None)]), "yellow", None).first()
    assert row.tip_amount == 0.0 and row.tip_percentage is None


def test_unparsable_pickup_becomes_a_rule_not_an_error(spark):
    df = raw(spark, YELLOW.replace("tpep_pickup_datetime timestamp_ntz", "tpep_pickup_datetime string"),
             [yellow("bad", at(10))])
    assert "MISSING_PICKUP_DATETIME" in codes(trips.flagged_trips(df, "yellow", None).first())[0]


def test_alias_case_and_absent_columns(spark):
    df = raw(spark, YELLOW, [yellow(at(10), at(11))]).withColumnRenamed("PULocationID", "pulocationid").drop("cbd_congestion_fee")
    row = trips.flagged_trips(df, "yellow", None).first()
    assert row.pickup_location_id == 132 and row.cbd_congestion_fee == 0.0


def test_green_imputation_night_and_trip_type(spark):
    ddl = YELLOW.replace("tpep", "lpep") + ", trip_type int, ehail_fee double"
    row = (*yellow(at(23), at(23, 30), p=0.0, s="n"), 9, None)
    out = trips.flagged_trips(raw(spark, ddl, [row]), "green", None).first()
    assert out.passenger_count == 1 and out.night_trip_flag and out.store_and_fwd_flag == "N" and out.trip_type is None
    assert {"PASSENGER_COUNT_IMPUTED", "INVALID_TRIP_TYPE"} <= codes(out)[1]


FHV = """dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, PUlocationID double,
DOlocationID double, SR_Flag string, Affiliated_base_number string"""


def test_fhv_flag_and_base(spark):
    df = raw(spark, FHV, [(" b00001 ", at(10), at(11), 132.0, 10.0, "X", "B99999"), ("B00001", at(12), at(13), 132.0, 10.0, "1", None)])
    odd, shared = trips.flagged_trips(df, "fhv", refs(spark)).orderBy("pickup_datetime").collect()
    assert odd.dispatching_base_num == "B00001" and odd.dispatching_base_name == "Base One"
    assert odd.shared_ride_flag is None
    assert codes(odd)[1] == {"INVALID_SHARED_RIDE_FLAG", "AFFILIATED_BASE_NOT_IN_CURRENT_LOOKUP"}
    assert shared.shared_matched is True and shared.quality_status == "VALID"
    whole = trips.service_master(df, "fhv", refs(spark)).orderBy("pickup_datetime").collect()
    assert [r.service_id for r in whole] == [3, 3] and whole[1].shared_matched is True
    assert whole[0].pickup_zone_name == "JFK Airport" and whole[0].vendor_id_or_license == "B00001"


HV = """hvfhs_license_num string, dispatching_base_num string, originating_base_num string, request_datetime timestamp_ntz,
on_scene_datetime timestamp_ntz, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int,
DOLocationID int, trip_miles double, trip_time bigint, base_passenger_fare double, tolls double, bcf double,
sales_tax double, congestion_surcharge double, airport_fee double, tips double, driver_pay double,
shared_request_flag string, shared_match_flag string, access_a_ride_flag string, wav_request_flag string, wav_match_flag string"""


def test_fhvhv_company_and_waits(spark):
    row = ("HV0003", "B00001", "B00001", at(9, 55), at(9, 58), at(10), at(10, 30), 132, 10, 5.0, 1800, 20.0, 0.0, 0.5, 1.0, 2.75,
           0.0, 3.0, 15.0, "N", "Y", "N", "N", "N")
    out = trips.flagged_trips(raw(spark, HV, [row]), "fhvhv", refs(spark)).first()
    assert (out.hvfhs_company_name, out.request_to_pickup_seconds, out.driver_wait_seconds) == ("Uber", 300, 120)
    assert codes(out) == (set(), {"SHARED_MATCH_WITHOUT_REQUEST"})
    assert out.cbd_congestion_fee == 0.0


def test_first_record_of_a_repeat_stays(spark):
    df = raw(spark, YELLOW, [yellow(at(10), at(11))] * 3 + [yellow(at(12), at(13))])
    out = trips.flagged_trips(df, "yellow", None).orderBy("source_record").collect()
    assert ["DUPLICATE_TRIP" in r.quality_error_codes for r in out] == [False, True, True, False]


def test_repeat_of_a_rejected_trip_is_still_a_repeat(spark):
    df = raw(spark, YELLOW, [yellow(at(11), at(10))] * 2)
    out = trips.flagged_trips(df, "yellow", None).orderBy("source_record").collect()
    assert ["DUPLICATE_TRIP" in r.quality_error_codes for r in out] == [False, True]


def test_one_id_holding_most_rows_is_not_shuffled_to_one_task(spark):
    """Repeats are found by a combinable aggregate, so a hot id arrives as one row per map task."""
    df = raw(spark, YELLOW, [yellow(at(10), at(11))]).drop("source_record").crossJoin(
        spark.range(20000)).withColumn("source_record", F.lpad(F.col("id").cast("string"), 12, "0")).drop("id")
    groups = trips.repeated_trips(df, "yellow")
    assert [(r.first_record) for r in groups.collect()] == ["0" * 12]
    out = trips.flagged_trips(df, "yellow", None)
    assert out.filter("array_contains(quality_error_codes, 'DUPLICATE_TRIP')").count() == 19999
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_written_copies_mark_what_groups_mark(spark):
    """Also with null keys, records without a name and rows that come twice whole."""
    rows = [("a", 1, "r1"), ("a", 1, "r2"), ("a", 1, "r2"), ("a", 2, "r3"), ("b", 1, "r1"), ("b", 1, "r1"), (None, 1, "r4"),
            (None, 1, "r5"), ("c", None, "r6"), ("c", None, "r7"), ("d", 1, None), ("d", 1, "r8"), ("d", 1, "r9")]
    df = spark.createDataFrame(rows, "id string, month int, record string")
    keys = ["id", "month"]
    copies = sinks.staged(keyed.later_copies(df, keys, "record"), "copies")
    assert copies.count() == 2  # r2 of a, r9 of d
    marked = [keyed.mark_copies(df, copies, keys, "record"),
              keyed.mark_repeats(df, keyed.repeat_groups(df, keys, "record"), keys, "record")]
    written, grouped = [sorted(map(str, m.select("id", "month", "record", "is_repeat").collect())) for m in marked]
    assert written == grouped and sum("is_repeat=True" in r for r in written) == 3


def test_wide_trips_stay_where_they_are(spark, small):
    """Shuffles deal order lines, never conformed trips, also where only lookups of known size are broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        copies = small.repeats("fhvhv", small.version())
        wide = trips.service_master(small.raw("fhvhv"), "fhvhv", small.references(), repeats=copies)
        plan = wide._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for line in plan if "Exchange hashpartitioning" in line]
    assert shuffles and all("orderkey" in line for line in shuffles)


def test_only_the_services_of_a_fact_are_built(spark, tmp_path):
    from fareflow.plans import workspace

    made = []

    def part(service):
        return lambda: made.append(service) or spark.createDataFrame([(service, 1)], "service_type string, n int")

    def read(*services):
        df = workspace.stored_by(spark, "parts", str(tmp_path), "service_type", {s: part(s) for s in services})
        return sorted((r.service_type, r.n) for r in df.collect())

    assert read("green") == [("green", 1)] and made == ["green"]
    assert read("fhv") == [("fhv", 1)] and read("green", "fhv", "yellow") == [("fhv", 1), ("green", 1), ("yellow", 1)]
    assert made == ["green", "fhv", "yellow"]


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    def shuffled():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before = shuffled()
    dealt = prepare(spark).range(10000).groupBy((F.col("id") % 977).alias("k")).agg(F.sum("id").alias("n"))
    assert sinks.staged(dealt, "dealt").count() == 977
    until = time.time() + 30
    while (left := {n for n in shuffled() - before if n.endswith(".data")}) and time.time() < until:
        time.sleep(0.5)
    assert not left


def test_null_condition_does_not_fire(spark):
    df = spark.createDataFrame([(None,), (3,)], "x int")
    rules = [quality.Rule("BIG", quality.ERROR, "x > 2"), quality.Rule("SMALL", quality.WARNING, "x < 9")]
    out = {r.x: r for r in quality.flag(df, rules).collect()}
    assert out[None].quality_status == "VALID" and out[3].quality_error_codes == ["BIG"]
    more = quality.flag_more(quality.flag(df, rules), [quality.Rule("BIG", quality.ERROR, "x = 3"), quality.Rule("NEW", quality.ERROR, "x = 3")])
    assert {r.x: r for r in more.collect()}[3].quality_error_codes == ["BIG", "NEW"]


def test_limits_are_parameters(spark):
    df = raw(spark, YELLOW, [yellow(at(10), at(11), d=0.0, p=None)])
    strict = QualityLimits(reject_zero_distance=True, impute_passengers=False)
    out = trips.flagged_trips(df, "yellow", None, strict).first()
    assert "ZERO_TRIP_DISTANCE" in out.quality_error_codes and out.passenger_count is None
    assert "PASSENGER_COUNT_IMPUTED" in out.quality_warning_codes


GOLDEN = {  # rows per rule code at sf0.01 (FIXTURES.md 2.4)
    "yellow": {"DUPLICATE_TRIP": 156, "TOTAL_AMOUNT_ABOVE_LIMIT": 2962, "PICKUP_ZONE_NOT_IN_LOOKUP": 258},
    "fhvhv": {"DUPLICATE_TRIP": 115, "TRIP_TIME_MISMATCH": 1054, "WAV_MATCH_WITHOUT_REQUEST": 163},
}


@pytest.mark.parametrize("service", GOLDEN)
def test_golden_rule_counts(medium, service):
    found = {r.rule_code: r.affected_rows for r in quality.rule_counts(medium.flagged(service)).collect()}
    assert {k: found[k] for k in GOLDEN[service]} == GOLDEN[service]


def test_source_records_are_unique(medium):
    df = medium.raw("yellow")
    assert df.count() == df.select("source_record").distinct().count() == 15349


def test_master_contract(medium):
    from fareflow.plans.trips import MASTER_COLUMNS

    master = medium.master()
    assert sorted(master.columns) == sorted(MASTER_COLUMNS)
    assert len(MASTER_COLUMNS) == len(set(MASTER_COLUMNS))
