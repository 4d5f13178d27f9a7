"""Name -> Spark callable and, where SQL can say it, the DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.plans.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six digits, arrays as text.

    Engines add in different orders, and averages of cents often end halfway
    between two digits; the small shift moves them off that point on both sides.
    """
    def plain(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(col + F.lit(1e-9), 6).alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(col.cast("array<string>"), "|").alias(f.name)
        return col
    return df.select(*[plain(f) for f in df.schema.fields])


def register(name: str, build: Callable[[Workspace], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: tidy(build(Workspace(spark, sf_dir)))
    if sql is not None:
        ORACLES[name] = sql


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[Workspace], DataFrame]):
        register(name, build, sql)
        return build
    return wrap
