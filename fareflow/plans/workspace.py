"""Stages over one set of input tables; the master is written once and read by everything after it."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.plans import features, forecast, marts, segments, star, trips, wait_risk
from fareflow.plans.learning import metrics_frame, release
from fareflow.session import prepare, shared_dir
from fareflow.sources import fixtures
from fareflow.sources.sinks import save_model, write_dataset, write_partitions
from fareflow.spec import SERVICE_KEYS, ForecastSettings, SegmentSettings, WaitRiskSettings

_STORED: dict[tuple, str] = {}
_INPUTS = ("lineitem", "orders", "nation", "region", "supplier")


def _fingerprint(spark: SparkSession, sf_dir: str, tables=_INPUTS) -> str:
    """Paths, sizes and times of the input files; changed inputs mean a new copy."""
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in tables])
    # A sum of hashes: order does not matter and no list of files is gathered.
    state = files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"))
    return "-".join(str(v) for v in state.agg(F.count("h"), F.sum("h")).first())


def stored(spark: SparkSession, name: str, version: str, parts, keys=()) -> DataFrame:
    """Write a stage to the shared folder once per session and read it back.

    ``parts`` yields the frames that make up the stage; each is its own write
    into its own partitions. A lost executor then costs a re-read, not a
    recomputation of the lineage.
    """
    slot = (spark.sparkContext.applicationId, name, version)
    if slot not in _STORED:
        short = hashlib.sha256(version.encode()).hexdigest()[:12]
        path = f"{shared_dir(spark)}/fareflow/{name}-{short}-{uuid.uuid4().hex[:8]}"
        for part in parts:
            write_partitions(part, path, keys)
        _STORED[slot] = path
    return spark.read.parquet(_STORED[slot])


def stored_by(spark: SparkSession, name: str, version: str, key: str, parts: dict) -> DataFrame:
    """Like ``stored``, for a stage with a folder per value of ``key``; only the parts asked for are made.

    ``parts`` has a value's frame as a function without arguments. Rows stay in the tasks that made them, so nothing is
    shuffled for the write. Other parts of the stage that are there already are not read.
    """
    app = spark.sparkContext.applicationId
    root, schema = _STORED.get((app, name, version), (None, None))
    for value, build in parts.items():
        if (app, name, version, value) not in _STORED:
            part = build()
            if root is None:
                root, schema = f"{shared_dir(spark)}/fareflow/{name}-{uuid.uuid4().hex[:8]}", part.schema
                _STORED[app, name, version] = root, schema
            part.drop(key).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{key}={value}")
            _STORED[app, name, version, value] = root
    return spark.read.schema(schema).parquet(root).filter(F.col(key).isin(*parts))


def forget_stored() -> None:
    """Build every stage anew from here on."""
    _STORED.clear()


def stored_outputs(spark: SparkSession, name: str, version: str, build) -> dict[str, DataFrame]:
    """Write the named outputs of one run to the shared folder once per session and read them back."""
    slot = (spark.sparkContext.applicationId, name, version)
    if slot not in _STORED:
        root = f"{shared_dir(spark)}/fareflow/{name}-{uuid.uuid4().hex[:8]}"
        outputs, model, cached = build()
        for key, df in outputs.items():
            write_dataset(df, f"{root}/{key}")
        save_model(model, f"{root}/model")
        release(cached)
        _STORED[slot] = root, tuple(outputs)
    root, names = _STORED[slot]
    return {n: spark.read.parquet(f"{root}/{n}") for n in names} | {"model_path": f"{root}/model"}


# Date cuts that fit the time span of the test tables, and the least trips of a series in it; all else is as in production.
FORECAST = ForecastSettings(
    train_start="2024-01-01 00:00:00", train_end="2024-01-20 23:00:00", validation_end="2024-01-25 23:00:00",
    test_end="2024-01-30 23:00:00", min_total_trips=200,
)
WAIT_RISK = WaitRiskSettings(
    train_end="1998-12-31 23:59:59", validation_end="2000-06-30 23:59:59", test_end="2001-08-01 23:59:59",
)
SEGMENTS = SegmentSettings()


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir.rstrip("/")
        self._versions: dict[tuple, str] = {}

    def version(self, tables=_INPUTS) -> str:
        """Fingerprint of the input files, taken once per workspace."""
        if tables not in self._versions:
            self._versions[tables] = _fingerprint(self.spark, self.sf_dir, tables)
        return self._versions[tables]

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def raw(self, service: str) -> DataFrame:
        return fixtures.raw_trips(self.spark, self.sf_dir, service)

    def raws(self) -> dict[str, DataFrame]:
        return {s: self.raw(s) for s in SERVICE_KEYS}

    def references(self) -> trips.References:
        """Lookups from written copies: Spark knows their size, and so joins small ones without moving the trips."""
        def lookup(make):
            return stored(self.spark, make.__name__, self.version(), (m(self.spark, self.sf_dir) for m in [make]))

        return trips.References(lookup(fixtures.zones), lookup(fixtures.bases))

    def flagged(self, service: str) -> DataFrame:
        """Rules over the raw trips; repeated ids come from the stored stage, so the wide rows are built once."""
        repeats = self.repeats(service, self.version())
        return trips.flagged_trips(self.raw(service), service, self.references(), repeats=repeats)

    def flagged_stage(self, service: str) -> DataFrame:
        """Flagged trips from their written copy: what reports on rules and outcomes read of them."""
        kept = (self.flagged(s).select(*trips.OUTCOME_COLUMNS) for s in [service])
        return stored(self.spark, f"flagged-{service}", self.version(), kept)

    def live_master(self) -> DataFrame:
        return trips.master(self.raws(), self.references())

    def repeats(self, service: str, version: str) -> DataFrame:
        """Copies of trips of one service; made from the identifying columns when they are not stored yet."""
        copies = (trips.copied_trips(self.raw(s), s) for s in [service])
        return stored(self.spark, f"repeats-{service}", version, copies)

    def master(self, services=tuple(SERVICE_KEYS)) -> DataFrame:
        """Conformed trips of ``services`` from the written copy, a folder per service.

        Two narrow-to-wide passes per service: the first finds copies from
        the identifying columns, the second does all the rest without a shuffle
        of its own as long as the lookups and copies are small.
        """
        version, refs = self.version(), self.references()

        def part(service: str):
            return lambda: trips.service_master(self.raw(service), service, refs, repeats=self.repeats(service, version))

        return stored_by(self.spark, "master", version, "service_type", {s: part(s) for s in services})

    def dim_zone(self) -> DataFrame:
        return star.dim_zone(fixtures.zones(self.spark, self.sf_dir))

    def facts(self) -> dict[str, DataFrame]:
        return star.facts(self.master())

    def fact(self, name: str) -> DataFrame:
        return star.FACTS[name](self.master(star.FACT_SERVICES[name]))

    def mart(self, name: str) -> DataFrame:
        fact = marts.MARTS[name].fact
        return marts.build_mart(name, {fact: self.fact(fact)}, self.dim_zone())

    def stored_mart(self, name: str) -> DataFrame:
        """A mart from its written copy; reports read it several times over."""
        version = self.version()
        return stored(self.spark, f"mart-{name}", version, (self.mart(n) for n in [name]))

    def values(self, name: str) -> DataFrame:
        """Counts of values of a fact from their written copy."""
        version, fact = self.version(), marts.VALUE_COUNTS[name].fact
        return stored(self.spark, f"values-{name}", version, (marts.value_counts(n, self.fact(fact)) for n in [name]))

    # --- features and models -------------------------------------------------

    def event_features(self) -> DataFrame:
        """Hourly demand features of the event stream."""
        return features.zone_hourly_demand_features(fixtures.event_trips(self.spark, self.sf_dir), self.dim_zone())

    def zone_profiles(self) -> DataFrame:
        return features.zone_profile_features(self.fact("trip_activity"), self.fact("hvfhv_operations"), self.dim_zone())

    def wait_features(self) -> DataFrame:
        return features.hvfhv_wait_features(self.fact("hvfhv_operations"), self.dim_zone())

    def _candidates(self, name: str, candidates) -> DataFrame:
        frames = [metrics_frame(self.spark, name, c.algorithm, c.metrics) for c in candidates]
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    def forecast(self) -> dict[str, DataFrame]:
        def run():
            r = forecast.train_forecast(self.event_features(), FORECAST)
            keep = [*features.SERIES, "event_timestamp", "pickup_zone_name", "pickup_borough", "trip_count", "prediction"]
            return {
                "predictions": r.predictions, "anomalies": r.anomalies, "metrics": r.metric_rows,
                "candidates": self._candidates("forecast", r.candidates), "test": r.test.select(*keep),
            }, r.model, r.cached
        return stored_outputs(self.spark, "forecast", self.version(("events",)), run)

    def segments(self) -> dict[str, DataFrame]:
        def run():
            r = segments.train_segments(self.zone_profiles(), SEGMENTS)
            return {"assignments": r.assignments, "profiles": r.profiles, "metrics": r.metric_rows}, r.model, r.cached
        return stored_outputs(self.spark, "segments", self.version(), run)

    def wait_risk(self) -> dict[str, DataFrame]:
        def run():
            r = wait_risk.train_wait_risk(self.wait_features(), WAIT_RISK)
            return {
                "predictions": r.predictions, "importance": r.importance, "metrics": r.metric_rows,
                "candidates": self._candidates("wait-risk", r.candidates),
            }, r.model, r.cached
        return stored_outputs(self.spark, "wait-risk", self.version(), run)
