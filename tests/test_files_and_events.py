"""File facts in blocks, schema drift, deliveries by content, event rows, splits, percentiles and classifier metrics."""

import hashlib
import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.plans import dashboards, events, learning, marts
from fareflow.sources import file_facts, files, sinks
from fareflow.streaming.incremental import file_states, incremental_trips, read_registry

SMALL = "/root/testdata/sf0.001"


def test_file_facts_stream_in_blocks(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/deep/_temporary")
    contents = {"a.bin": os.urandom(100_003), "deep/b.parquet": b"PAR1" + os.urandom(5000) + b"PAR1", "empty": b"", "short": b"PAR1",
                "deep/_temporary/x": b"no", ".hidden": b"no"}
    for name, body in contents.items():
        with open(f"{root}/{name}", "wb") as file:
            file.write(body)
    shown = {n.split("/")[-1]: b for n, b in contents.items() if "_temporary" not in n and n[0] != "."}
    for path in (root, f"file://{root}"):
        out = {r.file_name: r for r in file_facts.file_fingerprint(spark, path, block_bytes=1024).collect()}
        assert set(out) == set(shown)
        for name, body in shown.items():
            assert (out[name].bytes, out[name].sha256) == (len(body), hashlib.sha256(body).hexdigest())
            assert out[name].parquet_signature == (name == "b.parquet") and out[name].large_enough == (len(body) >= 12)
    assert file_facts.file_facts(spark, f"{root}/a.bin").count() == 1
    dealt = file_facts.file_facts(spark, root, "hash", deal_bytes=6000)
    assert dealt.rdd.getNumPartitions() > 1 and "content" not in dealt.columns
    with pytest.raises(Exception, match="nowhere"):
        file_facts.file_facts(spark, f"{root}/nowhere").collect()


def test_facts_of_all_tables_of_a_folder(spark):
    out = {r.file_name: r for r in file_facts.file_fingerprint(spark, SMALL).collect()}
    assert set(out) == set(os.listdir(SMALL)) and all(r.parquet_signature for r in out.values())
    with open(f"{SMALL}/orders.parquet", "rb") as file:
        assert out["orders.parquet"].sha256 == hashlib.sha256(file.read()).hexdigest()


def test_schema_history(spark, tmp_path):
    root = str(tmp_path)
    for name, ddl in (("yellow_tripdata_2023-01", "a int, B string"), ("yellow_tripdata_2023-02", "b string, A int"),
                      ("yellow_tripdata_2023-04", "a bigint, b string, c double"), ("yellow_tripdata_2023-05", "b string, c double"),
                      ("fhvhv_tripdata_2023-01", "a int"), ("other", "z int")):
        spark.createDataFrame([], ddl).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    with open(f"{root}/green_tripdata_2023-01.parquet", "wb") as file:
        file.write(b"not parquet")
    schemas = file_facts.file_schemas(file_facts.file_facts(spark, root, "columns"))
    rows = {(r.service, r.month): r for r in file_facts.schema_history(schemas).collect()}
    assert set(rows) == {("yellow", 1), ("yellow", 4), ("yellow", 5), ("fhvhv", 1)}
    assert rows["yellow", 1].added == ["a", "b"] and rows["yellow", 1].previous_hash is None
    april = rows["yellow", 4]
    assert (april.added, april.removed, april.retyped) == (["c"], [], ["a:int64"]) and april.previous_hash == rows["yellow", 1].schema_hash
    assert (rows["yellow", 5].added, rows["yellow", 5].removed, rows["yellow", 5].retyped) == ([], ["a"], [])


def test_deliveries_by_content(spark, tmp_path):
    source, target, registry, runs = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/registry", []

    def deliver(number, name, ids):
        folder = f"{source}/delivery={number}/source_year=2023/source_month=1"
        spark.createDataFrame([(i,) for i in ids], "id int").coalesce(1).write.parquet(f"{tmp_path}/made-{number}-{name}")
        os.makedirs(folder, exist_ok=True)
        made = next(f for f in os.listdir(f"{tmp_path}/made-{number}-{name}") if f.startswith("part-"))
        with open(f"{tmp_path}/made-{number}-{name}/{made}", "rb") as a, open(f"{folder}/{name}.parquet", "wb") as b:
            b.write(a.read())

    def run():
        def transform(df):
            runs.append(1)
            return df.drop("delivery")
        incremental_trips(spark, source, target, f"{tmp_path}/checkpoint", transform, registry)
        return sorted(r.id for r in spark.read.parquet(target).collect())

    deliver(1, "a", [1, 2])
    deliver(1, "b", [3])
    assert run() == [1, 2, 3] and len(runs) == 1
    deliver(2, "a", [1, 2])  # unchanged: nothing is rebuilt
    deliver(2, "again", [3])  # the same content under another name
    assert run() == [1, 2, 3] and len(runs) == 1
    deliver(3, "a", [1, 2, 9])  # a new version of a
    assert run() == [1, 2, 3, 9] and len(runs) == 2
    assert run() == [1, 2, 3, 9] and len(runs) == 2
    states = {(r.file_name, r.batch_id): r.state for r in file_states(read_registry(spark, registry)).collect()}
    assert sorted(states.values()) == ["ARCHIVED", "ARCHIVED", "CURRENT", "CURRENT", "REPEATED"]


def test_event_rows_have_their_kind_s_shape(spark, tmp_path):
    at = datetime(2025, 1, 1)
    runs = spark.createDataFrame([("r1", "bronze", at, at + timedelta(seconds=90, milliseconds=500), "x" * 5000)],
                                 "execution_id string, layer string, started_at timestamp_ntz, finished_at timestamp_ntz, error_message string")
    start, end, fail = (f.first() for f in (events.runs_started(runs), events.runs_finished(runs), events.runs_finished(runs, failed=True)))
    assert (start.status, start.event_action, start.updated_at) == ("RUNNING", "START", at)
    assert (end.status, end.duration_seconds, fail.status, len(fail.error_message)) == ("SUCCESS", 90.5, "FAILED", 4000)
    assert len({start.event_id, end.event_id, fail.event_id}) == 3 and events.runs_finished(runs).first().event_id == end.event_id
    attempts = spark.createDataFrame([("r1", "yellow", 2025, 1, 3, "SUCCESS", 2.0, 2048), ("r1", "yellow", 2025, 1, 1, "RETRY", None, None)],
                                     "execution_id string, service string, year int, month int, attempt_number int, outcome string, duration_seconds double, bytes_downloaded bigint")
    got = {r.attempt_number: r for r in events.download_attempts(attempts).collect()}
    assert (got[3].retry_number, got[3].throughput_bytes_per_second, got[3].layer) == (2, 1024.0, "bronze")
    assert got[1].retry_number == 0 and got[1].throughput_bytes_per_second is None and got[1].attempted_at is not None
    counts = spark.createDataFrame([("r", "bronze", 3, 2, 0, 1, []), ("r", "gold", 1, 0, 0, 1, None), ("r", "ml", 3, 2, 0, 0, ["x"])],
                                   "execution_id string, layer string, expected_count int, ready_count int, not_applicable_count int, not_published_count int, missing array<string>")
    got = {r.layer: (r.status, r.coverage_rate, r.missing_count) for r in events.coverage_snapshots(counts).collect()}
    assert got == {"bronze": ("COMPLETE", 1.0, 0), "gold": ("NO_SCOPE", None, 0), "ml": ("PARTIAL", pytest.approx(2 / 3), 1)}
    assert events.coverage_snapshots(counts, True).filter("layer = 'bronze'").first().status == "PARTIAL"
    for kind, frame in (("download_attempt", events.download_attempts(attempts)), ("pipeline_run", events.runs_started(runs))):
        events.append(frame, str(tmp_path), kind)
        back = events.read(spark, str(tmp_path), [kind])[kind]
        assert back.count() == frame.count() and back.columns[:-1] == [c for c in frame.columns if c != "layer"] + ["written_at"] or set(back.columns) >= set(frame.columns)
    lines = [json.loads(line) for d, _, names in os.walk(f"{tmp_path}/pipeline_run") for n in names if n.endswith(".json") for line in open(f"{d}/{n}")]
    assert lines[0]["event_action"] == "START"
    with pytest.raises(ValueError):
        events.append(attempts, str(tmp_path), "download_attempt")


def test_split_is_one_write_without_a_shuffle(spark, tmp_path):
    flagged = spark.range(100).selectExpr("id", "CAST(id % 3 AS INT) AS source_year", "IF(id % 10 = 0, 1, 0) AS quality_error_count")
    root = sinks.write_split(flagged, f"{tmp_path}/split", ["source_year"])
    parts = {n: {r.id for r in sinks.split_part(spark, root, n).collect()} for n in ("curated", "rejected")}
    assert parts["rejected"] == set(range(0, 100, 10)) and parts["curated"] == set(range(100)) - parts["rejected"]
    sinks.write_split(flagged.filter("source_year = 1").withColumn("quality_error_count", F.lit(0)), root, ["source_year"])
    assert {r.id for r in sinks.split_part(spark, root, "rejected").collect()} == {i for i in range(0, 100, 10) if i % 3 != 1}
    plan = flagged.withColumn("outcome", F.lit("x")).sortWithinPartitions("source_year", "outcome")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_percentiles_from_counts_of_values(small):
    for name, source in marts.PERCENTILE_MARTS.items():
        mart = marts.MARTS[name]
        direct = small.mart(name)
        counted = marts.roll_up_percentiles(name, small.values(source), small.dim_zone()).select(direct.columns)

        def rounded(df):
            return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
        assert mart.measures and rounded(direct).exceptAll(rounded(counted)).count() == 0 and direct.count() == counted.count()
    rolled = marts.rollup_of_values(small.values("activity"))
    assert rolled.count() == marts.activity_rollup(small.fact("trip_activity")).count()


def test_curve_metrics_equal_the_evaluators(spark):
    rng = random.Random(3)
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("rawPrediction", VectorUDT()), T.StructField("prediction", T.DoubleType())])
    rows = []
    for _ in range(600):
        score = round(rng.random(), 2)
        rows.append((float(rng.random() < score), Vectors.dense([-score, score]), float(score > 0.6)))
    df = spark.createDataFrame(rows, schema)
    binary, multi = BinaryClassificationEvaluator(), MulticlassClassificationEvaluator()
    want = {"auc_pr": binary.evaluate(df, {binary.metricName: "areaUnderPR"}), "auc_roc": binary.evaluate(df, {binary.metricName: "areaUnderROC"})}
    want |= {k: multi.evaluate(df, {multi.metricName: m}) for k, m in
             {"f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall", "accuracy": "accuracy"}.items()}
    assert learning.classification_metrics(df, "label") == pytest.approx(want, abs=1e-9)
    assert set(learning.classification_metrics(df.limit(0), "label").values()) == {0.0}


def test_references_need_their_key_and_tell_their_source(spark, tmp_path):
    with pytest.raises(ValueError):
        files.normalize_bases(spark.createDataFrame([("x",)], "`Base Name` string"))
    with open(f"{tmp_path}/z.csv", "w") as file:
        file.write("x\n")
    facts = file_facts.file_facts(spark, f"{tmp_path}/z.csv", "hash")
    row = files.with_provenance(spark.range(1).toDF("location_id"), "https://h.example/z.csv", facts).first()
    assert (row.source_url, row.source_sha256) == ("https://h.example/z.csv", hashlib.sha256(b"x\n").hexdigest()) and row.refreshed_at


def test_declared_coverage(spark):
    executive = spark.createDataFrame([("fhvhv", 2023, 5), ("fhvhv", 2024, 7), ("yellow", 2024, 9)], "service_type string, source_year int, trip_count bigint")
    row, = dashboards.declared_coverage(executive, (2023, 2024, 2025), {"fhvhv": (2023,)}).collect()
    assert (row.service_type, row.missing_years, row.trips_left_out) == ("fhvhv", [2024, 2025], 7)
    assert dashboards.declared_coverage(executive, (2023,), {"fhvhv": (2023,)}).count() == 0
