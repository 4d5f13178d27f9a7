"""Zone segments: k-means over zone profiles, k chosen by silhouette, readable names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.plans import learning as ml
from fareflow.spec import SERVICE_KEYS, SegmentSettings

FEATURES = (
    "total_pickups", "total_dropoffs", "average_duration_seconds", "average_distance_miles", "average_speed_mph",
    "night_trip_share", "weekend_trip_share", "airport_trip_share", *[f"{s}_share" for s in SERVICE_KEYS],
    "service_diversity", "demand_coefficient_of_variation", "average_request_to_pickup_seconds",
    "shared_match_share", "wav_match_share",
)
# The label a cluster earns by leading in a measure, in order of precedence.
LEADERS = (
    ("airport_trip_share", "Zonas aeroportuarias"),
    ("total_pickups", "Núcleos de alta demanda"),
    ("night_trip_share", "Centros de actividad nocturna"),
    ("service_diversity", "Mercados multimodales"),
    ("weekend_trip_share", "Zonas recreativas de fin de semana"),
    ("average_request_to_pickup_seconds", "Zonas con fricción de recogida"),
)
# Names of the segments that lead in nothing, and of those beyond.
OTHERS = (
    "Corredores residenciales estables",
    "Zonas emergentes",
    "Zonas de baja actividad",
    "Corredores de demanda variable",
)
BEYOND = "Perfil territorial"


def active_zones(profiles: DataFrame) -> DataFrame:
    return profiles.fillna(0.0, subset=list(FEATURES)).filter("total_pickups > 0")


def pipeline(k: int, s: SegmentSettings) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        KMeans(featuresCol="features", predictionCol="cluster_id", k=k, maxIter=s.iterations, seed=s.seed),
    ])


def cluster_profile(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster_id").agg(
        F.count("zone_key").alias("zone_count"), *[F.avg(f).alias(f) for f in FEATURES]
    )


def segment_names(profiles: list[dict]) -> dict[int, str]:
    """A unique name per cluster (at most eight of them, so this runs on the driver)."""
    free = sorted(profiles, key=lambda p: p["cluster_id"])
    names: dict[int, str] = {}
    for measure, label in LEADERS:
        if free:
            leader = max(free, key=lambda p: p[measure] or 0.0)
            names[leader["cluster_id"]] = label
            free.remove(leader)
    labels = [*OTHERS, *(f"{BEYOND} {n}" for n in range(len(OTHERS) + 1, len(free) + 1))]
    names.update((p["cluster_id"], label) for p, label in zip(free, labels))
    return names


@dataclass
class SegmentRun:
    k: int
    model: PipelineModel
    metrics: dict[str, float]
    assignments: DataFrame
    profiles: DataFrame
    metric_rows: DataFrame
    cached: tuple[DataFrame, ...] = ()


def train_segments(profiles: DataFrame, s: SegmentSettings) -> SegmentRun:
    """One row per zone of the lookup, whatever the trip volume, so every k is cheap to try."""
    zones = active_zones(profiles).persist()
    n = zones.count()
    if n <= s.k_min:
        raise ValueError(f"{n} active zones are too few for {s.k_min} segments")
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id")
    models, scores = {}, {}
    for k in range(s.k_min, min(s.k_max, n - 1) + 1):
        models[k] = pipeline(k, s).fit(zones)
        scores[k] = float(judge.evaluate(models[k].transform(zones)))
    best = max(scores, key=lambda k: (scores[k], -k))
    assigned = models[best].transform(zones)
    per_cluster = cluster_profile(assigned)
    names = segment_names([r.asDict() for r in per_cluster.collect()])
    named = zones.sparkSession.createDataFrame(sorted(names.items()), "cluster_id int, segment_name string")
    metrics = {"best_k": float(best), "silhouette": scores[best]}
    metrics.update({f"silhouette_k_{k}": v for k, v in scores.items()})
    described = ("zone_key", "location_id", "zone_name", "borough", "service_zone", "is_airport")
    return SegmentRun(
        best, models[best], metrics,
        assigned.join(F.broadcast(named), "cluster_id", "left").select(
            *described, "cluster_id", "segment_name", *FEATURES),
        per_cluster.join(F.broadcast(named), "cluster_id", "left"),
        ml.metrics_frame(zones.sparkSession, "segmentation", "kmeans", metrics),
        (zones,),
    )
