"""Shared model work: feature encoding, metrics, class weights, model choice."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.operators.order import PART, in_ranges, sum_before
from fareflow.sources.sinks import staged

log = logging.getLogger(__name__)
METRICS_DDL = "model_name string, algorithm string, metric_name string, metric_value double"


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], estimator: Estimator) -> Pipeline:
    """Index, one-hot and assemble; unseen categories and nulls are kept."""
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_ohe" for c in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features", handleInvalid="keep"),
        estimator,
    ])


def encoded(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], codes: dict[str, str]) -> DataFrame:
    """The columns a feature pipeline reads: numbers without gaps, flags (``x_num`` of a flag ``x``) as 0 and 1, and labels.

    ``codes`` are labels made of a key column; other labels that are missing read UNKNOWN. An unknown number or flag is zero.
    """
    kinds = dict(df.dtypes)

    def number(name: str) -> Column:
        source = name if name in kinds else name.removesuffix("_num")
        value = F.col(source).cast("double") if kinds[source] == "boolean" else F.col(source)
        if kinds[source] in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        return F.coalesce(value, F.lit(0).cast("double" if kinds[source] == "boolean" else kinds[source]))

    def label(name: str) -> Column:
        return F.col(codes[name]).cast("string") if name in codes else F.coalesce(F.col(name), F.lit("UNKNOWN"))

    return df.withColumns({n: number(n) for n in numeric} | {n: label(n) for n in categorical})


def between(df: DataFrame, column: str, after: str | None, until: str, closed: bool = False) -> DataFrame:
    """Rows in the half-open time span (after, until]; ``closed`` includes the start."""
    at, end = F.col(column), F.lit(until).cast("timestamp_ntz")
    span = at <= end
    if after is not None:
        start = F.lit(after).cast("timestamp_ntz")
        span = span & (at >= start if closed else at > start)
    return df.filter(span)


def split_label(column: str, cuts: Sequence[str]) -> Column:
    """Name of the time split a row falls into; null outside all of them."""
    at = F.col(column)
    names = ("train", "validation", "test")
    return F.coalesce(*[F.when(at <= F.lit(c).cast("timestamp_ntz"), n) for c, n in zip(cuts, names)])


# --- regression --------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str = "trip_count", prediction: str = "prediction") -> DataFrame:
    """One row: mae, rmse, wape. No usable row gives zeros."""
    miss = F.col(prediction) - F.col(label)
    zero = F.lit(0.0)
    return df.agg(
        F.coalesce(F.avg(F.abs(miss)), zero).alias("mae"),
        F.coalesce(F.sqrt(F.avg(miss * miss)), zero).alias("rmse"),
        F.coalesce(F.sum(F.abs(miss)) / F.greatest(F.sum(F.abs(F.col(label))), F.lit(1.0)), zero).alias("wape"),
    )


def baseline_metrics(df: DataFrame, lag: str, label: str = "trip_count") -> DataFrame:
    """Error of predicting the lagged value, on rows that have one; infinite without such rows."""
    known = df.filter(F.col(lag).isNotNull())
    miss = F.col(lag) - F.col(label)
    worst = F.lit(float("inf"))
    return known.agg(
        F.coalesce(F.avg(F.abs(miss)), worst).alias("mae"),
        F.coalesce(F.sqrt(F.avg(miss * miss)), worst).alias("rmse"),
        F.coalesce(F.sum(F.abs(miss)) / F.greatest(F.sum(F.abs(F.col(label))), F.lit(1.0)), worst).alias("wape"),
    )


def numbers(one_row: DataFrame) -> dict[str, float]:
    return {k: float(v) for k, v in one_row.first().asDict().items()}


# --- classification ----------------------------------------------------------

def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class so that all classes count the same: total / (classes * class rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("class_weight", total / (F.lit(2.0) * F.col("rows")))


def weighted(df: DataFrame, label: str) -> DataFrame:
    """Attach class weights; a missing class is an error. Two classes give a two-row broadcast."""
    weights = class_weights(df, label).select(label, "class_weight")
    found = {float(r[0]): float(r[1]) for r in weights.collect()}
    if set(found) != {0.0, 1.0}:
        raise ValueError(f"training needs both classes, found {sorted(found)}")
    return df.withColumn("class_weight", F.when(F.col(label) == 1.0, found[1.0]).otherwise(found[0.0]))


def threshold_curve(scored: DataFrame) -> DataFrame:
    """Per distinct score of (score, label, prediction) rows with labels 0 and 1, from the highest down: positives and negatives at
    it, true and false positives from it upwards, and those of each class that are predicted rightly.

    Rows are counted by score in one pass; running sums go over score ranges, each starting from the totals of those before it.
    """
    one, right = F.col("label") == 1, F.col("label") == F.col("prediction")
    counts = scored.groupBy((-F.col("score")).alias("falling")).agg(
        F.count_if(one).alias("pos"), F.count_if(~one).alias("neg"),
        F.count_if(one & right).alias("pos_right"), F.count_if(~one & right).alias("neg_right"))
    ranged = in_ranges(staged(counts, "score-counts"), ["falling"], "score-ranges")
    totals = ranged.groupBy(PART).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg")).withColumns({
        "pos_before": sum_before("all_pos"), "neg_before": sum_before("all_neg")})
    within = Window.partitionBy(PART).orderBy("falling")
    return ranged.join(totals, PART).select(
        (-F.col("falling")).alias("score"), "pos", "neg", "pos_right", "neg_right",
        (F.col("pos_before") + F.sum("pos").over(within)).alias("tp"), (F.col("neg_before") + F.sum("neg").over(within)).alias("fp"))


def curve_metrics(scored: DataFrame) -> DataFrame:
    """One row: areas under the precision-recall and the ROC curve by trapezoids, and f1, precision and recall weighted by
    class, and accuracy. A class without rows weighs nothing; without any row all are zero."""
    curve = threshold_curve(scored)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in ("pos", "neg", "pos_right", "neg_right")]
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    earlier = F.coalesce(F.try_divide(before_tp, before_tp + before_fp), precision)  # the curve begins level
    whole = curve.agg(*sums, F.sum(F.col("pos") * (earlier + precision) / 2).alias("under_pr"),
                      F.sum(F.col("neg") * (before_tp + F.col("tp")) / 2).alias("under_roc"))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    pos, neg, tp, tn = (F.col(c) for c in ("pos", "neg", "pos_right", "neg_right"))
    rows = pos + neg
    by_class = [(neg, ratio(tn, tn + pos - tp), ratio(tn, neg)), (pos, ratio(tp, tp + neg - tn), ratio(tp, pos))]

    def weighted_by_class(measure) -> Column:
        return ratio(sum((n * measure(p, r) for n, p, r in by_class), F.lit(0.0)), rows)

    return whole.select(
        ratio(F.col("under_pr"), pos).alias("auc_pr"), ratio(F.col("under_roc"), pos * neg).alias("auc_roc"),
        weighted_by_class(lambda p, r: ratio(2 * p * r, p + r)).alias("f1"), weighted_by_class(lambda p, r: p).alias("precision"),
        weighted_by_class(lambda p, r: r).alias("recall"), ratio(tp + tn, rows).alias("accuracy"))


def classification_metrics(df: DataFrame, label: str) -> dict[str, float]:
    """All metrics from one pass over a model's output."""
    score = F.element_at(vector_to_array("rawPrediction"), 2)
    return numbers(curve_metrics(df.select(score.alias("score"), F.col(label).alias("label"), "prediction")))


def release(cached: Iterable[DataFrame]) -> None:
    """Drop cached frames; call it once the outputs that depend on them are written."""
    for df in cached:
        df.unpersist()


# --- choice ------------------------------------------------------------------

@dataclass
class Candidate:
    algorithm: str
    model: PipelineModel
    metrics: dict[str, float]


def fit_candidates(
    algorithms: Iterable[str], pipeline_for: Callable[[str], Pipeline], train: DataFrame,
    evaluate: Callable[[DataFrame], dict[str, float]], validation: DataFrame,
) -> list[Candidate]:
    """Fit each algorithm; one that fails is logged and left out as long as another succeeds."""
    fitted = []
    for algorithm in algorithms:
        pipeline = pipeline_for(algorithm)
        try:
            model = pipeline.fit(train)
            fitted.append(Candidate(algorithm, model, evaluate(model.transform(validation))))
        except Exception:  # noqa: BLE001 - any failure rules the candidate out
            log.exception("%s could not be fitted", algorithm)
    if not fitted:
        raise RuntimeError("no candidate algorithm could be fitted")
    return fitted


def metrics_frame(spark, model: str, algorithm: str, metrics: dict[str, float]) -> DataFrame:
    """Long table of metrics, one row per name."""
    rows = [(model, algorithm, name, float(metrics[name])) for name in sorted(metrics)]
    return spark.createDataFrame(rows, METRICS_DDL)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Slot names from the vector's metadata."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = {a["idx"]: a["name"] for attrs in groups.values() for a in attrs}
    return [slots[i] for i in sorted(slots)]


def feature_importance(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Importance per feature slot: tree importances, or coefficient sizes of a linear model."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = abs(last.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(feature_names(df), values)]
    return df.sparkSession.createDataFrame(rows, "feature_name string, importance double").orderBy(
        F.desc("importance"), "feature_name"
    )
