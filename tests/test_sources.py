"""Files in and out, streaming, contracts and periods."""

from datetime import datetime
from types import SimpleNamespace
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from fareflow.operators import quality
from fareflow.plans import audit, ingestion, star, trips
from fareflow.session import shared_dir
from fareflow.sources import files, sinks
from fareflow.spec import DEFAULT_SCOPES, Scope, ServiceScope
from fareflow.streaming.incremental import incremental_trips


@pytest.fixture
def folder(spark, tmp_path):
    return str(tmp_path)


class Session:
    """Just what the folder choice looks at."""

    def __init__(self, master, named=None):
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")
        self.conf = SimpleNamespace(get=lambda key, default: named if key == "spark.checkpoint.dir" and named else default)


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert shared_dir(Session("spark://host:7077", "hdfs://shared/dir/")) == "hdfs://shared/dir"
    with pytest.raises(ValueError):
        shared_dir(Session("spark://host:7077"))


def test_fact_write_replaces_only_its_partitions(spark, folder):
    path = f"{folder}/fact"
    df = spark.range(10).selectExpr("id", "IF(id < 5, 'yellow', 'green') AS service_type", "2023 AS source_year", "1 AS source_month")
    sinks.write_fact(df, path)
    sinks.write_fact(df.filter("service_type = 'green'").limit(2), path)
    assert {r[0]: r[1] for r in spark.read.parquet(path).groupBy("service_type").count().collect()} == {"yellow": 5, "green": 2}
    with pytest.raises(ValueError):
        sinks.write_fact(df.filter("false"), path)


def test_scan_reads_period_and_order_from_files(spark, folder):
    for month in (1, 2):
        spark.range(4).coalesce(1).write.parquet(f"{folder}/green_tripdata_2023-{month:02d}.parquet")
    df = files.scan_trips(spark, f"{folder}/green_tripdata_2023-01.parquet", f"{folder}/green_tripdata_2023-02.parquet")
    rows = df.orderBy("source_month", "source_record").collect()
    assert [(r.source_service, r.source_year, r.source_month, r.id) for r in rows] == [
        ("green", 2023, m, i) for m in (1, 2) for i in range(4)]


def test_partition_filter_prunes(spark, folder):
    spark.range(10).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(folder + "/p")
    plan = files.scan_partitioned(spark, folder + "/p", F.col("part") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_malformed_log_lines_are_skipped(spark, folder):
    with open(f"{folder}/log.json", "w") as f:
        f.write('{"event_id": 1, "execution_id": "r", "written_at": "2024-01-01T00:00:00"}\nnot json\n'
                '{"event_id": 2, "execution_id": "r", "written_at": "2024-01-02T00:00:00"}\n')
    assert [r.event_id for r in files.read_event_log(spark, folder).orderBy("event_id").collect()] == [1, 2]
    assert [r.event_id for r in files.read_event_log(spark, folder, newest=1).collect()] == [2]


def test_run_replay_merges_patches(spark):
    ddl = "event_id int, execution_id string, layer string, status string, duration_seconds double, started_at timestamp_ntz, " \
          "finished_at timestamp_ntz, metrics map<string,double>"
    log = spark.sql(f"""SELECT * FROM VALUES
      (1, 'r', 'gold', 'RUNNING', null, timestamp_ntz'2024-01-01 00:00:00', null, map('a', 1D, 'b', 2D)),
      (2, 'r', 'unknown', 'SUCCESS', null, null, timestamp_ntz'2024-01-01 00:01:30', map('a', 5D)),
      (3, '', 'gold', 'FAILED', null, null, null, null) AS t({', '.join(c.split()[0] for c in ddl.split(', '))})""")
    row, = audit.run_state(log, ["layer", "status", "duration_seconds", "started_at", "finished_at"], ["event_id"], ["metrics"]).collect()
    assert (row.layer, row.status, row.duration_seconds, row.metrics) == ("gold", "SUCCESS", 90.0, {"a": 5.0, "b": 2.0})


def test_page_links_name_monthly_files(spark):
    html = ('<a href="x/yellow_tripdata_2023-01.parquet">1</a><a href="/y/Green_tripdata_2023-02.parquet">2</a>'
            '<a href="https://other.org/fhv_tripdata_2023-03.parquet">3</a><a href="/z/yellow_tripdata_2023-01.parquet">4</a>'
            '<a href="/about.html">5</a>')
    pages = spark.createDataFrame([(1, "https://host.org/data/page", html)], "page_id int, url string, html string")
    found = files.trip_file_candidates(files.links_from_pages(pages, ["host.org"]))
    assert {(r.service, r.year, r.month, r.url) for r in found.collect()} == {
        ("yellow", 2023, 1, "https://host.org/z/yellow_tripdata_2023-01.parquet"),
        ("green", 2023, 2, "https://host.org/y/Green_tripdata_2023-02.parquet")}


def test_contract_reports_every_problem(spark):
    df = spark.createDataFrame([], "TPEP_PICKUP_DATETIME timestamp, tpep_dropoff_datetime timestamp_ntz, PULocationID bigint, DOLocationID double, surge int")
    found = {(p[0], p[1] or p[2]) for p in ingestion.contract_problems(df, "yellow") if p[0] != "MISSING_OPTIONAL"}
    assert found == {("TYPE_MISMATCH", "dropoff_location_id"), ("NEW_COLUMN", "surge")}
    fhv = spark.createDataFrame([], "dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp, PUlocationID double")
    assert ("MISSING_REQUIRED", "dropoff_location_id", None, None, None) in ingestion.contract_problems(fhv, "fhv")
    assert ingestion.type_name("DECIMAL(10,2)") == "decimal(10,2)" and ingestion.type_name("bigint") == "long"


def test_expected_periods_follow_the_scope(spark):
    grid = ingestion.expected_periods(ingestion.scope_table(spark, 2018, 2019, {"fhvhv": ServiceScope((2019, 2), (2018, 1), (2019, 6))}))
    assert grid.count() == 24 and grid.filter("applicable").count() == 5
    assert ingestion.expected_periods(ingestion.scope_table(spark, 2023, 2025), [1, 2]).count() == 4 * 3 * 2
    assert set(DEFAULT_SCOPES) == {"yellow", "green", "fhv", "fhvhv"}


def test_coverage_denominators(spark):
    states = spark.createDataFrame(
        [("yellow", 2023, m, s) for m, s in enumerate(["READY", "NOT_APPLICABLE", "NOT_PUBLISHED", "NOT_READY"], 1)],
        "service string, year int, month int, state string")
    row = ingestion.coverage(states).first()
    assert (row.coverage_rate, row.status, row.missing) == (0.5, "PARTIAL", ["yellow-2023-04"])
    strict = ingestion.coverage(states, not_published_is_missing=True).first()
    assert strict.coverage_rate == pytest.approx(1 / 3) and strict.missing_count == 2
    assert ingestion.coverage(states.filter("month = 2")).first().status == "NO_SCOPE"
    assert ingestion.coverage(states.filter("month <= 3")).first().status == "COMPLETE"


def test_declared_partial_coverage():
    from fareflow.plans.dashboards import declared_gaps

    assert declared_gaps(Scope((2023, 2024, 2025), (), ("yellow", "fhvhv"))) == {"HVFHV": [2024, 2025]}
    assert declared_gaps(Scope((2023,), (), ("fhvhv",))) == {}


def test_stream_equals_batch_and_rebuilds_only_touched_periods(spark, small, folder):
    refs = small.references()
    raw = small.raw("fhv")
    source, target = f"{folder}/raw", f"{folder}/trips"

    def curated(df):
        return quality.accepted(trips.flagged_trips(df, "fhv", refs))

    def arrive(df):
        df.coalesce(1).write.mode("append").partitionBy("source_year").parquet(source)
        incremental_trips(spark, source, target, f"{folder}/checkpoint", curated)

    # every period arrives in two files, so the second must not lose the first
    arrive(raw.filter("hash(source_record) % 2 = 0"))
    first = spark.read.parquet(target).count()
    arrive(raw.filter("hash(source_record) % 2 <> 0"))
    streamed = spark.read.parquet(target)
    batch = curated(raw)
    assert first < streamed.count() == batch.count()
    assert streamed.select("source_record").exceptAll(batch.select("source_record")).count() == 0
    incremental_trips(spark, source, target, f"{folder}/checkpoint", curated)
    assert spark.read.parquet(target).count() == batch.count()


def test_split_reconciles(spark, small, folder):
    flagged = small.flagged("green")
    root = sinks.write_split(flagged, folder, ["source_year"])
    sizes = {n: sinks.split_part(spark, root, n).count() for n in ("curated", "rejected")}
    assert spark.read.parquet(root).count() == sizes["curated"] + sizes["rejected"] == flagged.count()


def test_links_resolve_like_a_browser(spark):
    base = "https://h.example/a/b/c.html?k=1#z"
    hrefs = ["../d/x", "./e", "x", "&amp;y=1", "/a/../b/./c", "//o.org/z", "?q=1", "#f", "", "http://u.v/a/../b", "..", "../..", "../../../g", "a/b/../"]
    forms = ['<a class=q href="{}">', "<A\n HREF='{}'>", "<a data-href=no href={}>"]
    html = "".join(forms[i % 3 if h else 0].format(h) for i, h in enumerate(hrefs))
    out = files.links_from_pages(spark.createDataFrame([(1, base, html)], "page_id long, url string, html string")).orderBy("position").collect()
    assert [r.link for r in out] == [urljoin(base, h.replace("&amp;", "&")) for h in hrefs]


def test_a_version_that_returns_is_current(spark):
    at = [datetime(2024, 1, d) for d in range(1, 6)]
    rows = [("yellow", 2024, 1, s, t) for s, t in zip("ABBA", at)] + [("green", 2024, 1, "A", at[0])]
    df = spark.createDataFrame(rows, "service string, year int, month int, sha256 string, ingested_at timestamp_ntz")
    out = {(r.service, r.ingested_at.day): (r.sha256, r.version_state) for r in sinks.version_history(df).collect()}
    assert out == {("yellow", 1): ("A", "ARCHIVED"), ("yellow", 2): ("B", "ARCHIVED"), ("yellow", 4): ("A", "CURRENT"), ("green", 1): ("A", "CURRENT")}


def test_unknown_statuses_count_as_finished_and_not_good(spark):
    runs = spark.createDataFrame([("SUCCESS",), (None,), ("running",)], "status string")
    assert audit.finished_runs(runs).count() == 2
    assert audit.success_rate(runs).first().success_rate == 0.5


def test_zone_csv_must_have_its_columns(spark):
    raw = spark.createDataFrame([("1", "x")], "LocationID string, Borough string")
    with pytest.raises(ValueError, match="Zone"):
        files.normalize_zones(raw)


def test_freshness_without_and_with_preferred_columns(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 2))], "id long, seen timestamp_ntz")
    assert audit.freshness(df).first().fresh_at is None
    assert audit.freshness(df, preferred="seen").first().fresh_at == datetime(2024, 1, 2)


def test_zones_beyond_the_usual_range_keep_their_names(spark):
    zones = spark.createDataFrame([(1, "A", "x", "s"), (300, "B", "y", "s")], "location_id int, zone_name string, borough string, service_zone string")
    ends = spark.createDataFrame([(300, 1)], "pickup_location_id int, dropoff_location_id int")
    row = trips.join_zones(ends, zones).first()
    assert (row.pickup_zone_name, row.dropoff_zone_name) == ("B", "A")
    assert {r.zone_key for r in star.dim_zone(zones).collect()} == {1, 300}
