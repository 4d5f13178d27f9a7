"""Row-quality rules: each rule is a SQL predicate; all codes come out of one projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARNING = "ERROR", "WARNING"


@dataclass(frozen=True)
class Rule:
    code: str
    severity: str
    predicate: str  # SQL; null means not triggered


def codes_sql(rules: Iterable[Rule], severity: str) -> str:
    """SQL for the codes of the rules that fire, in rule order.

    One SQL text per array: building it column by column costs a driver round
    trip per rule, which adds up over some 30 rules and four services.
    """
    hits = [f"CASE WHEN {r.predicate} THEN '{r.code}' END" for r in rules if r.severity == severity]
    return f"array_compact(array({', '.join(hits)}))" if hits else "CAST(array() AS ARRAY<STRING>)"


_STATUS = (
    "size(quality_error_codes) AS quality_error_count",
    "size(quality_warning_codes) AS quality_warning_count",
    "CASE WHEN size(quality_error_codes) > 0 THEN 'REJECTED' WHEN size(quality_warning_codes) > 0 THEN 'WARNING' "
    "ELSE 'VALID' END AS quality_status",
)


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Attach error and warning codes, in rule order, with counts and status."""
    return df.selectExpr(
        "*",
        f"{codes_sql(rules, ERROR)} AS quality_error_codes",
        f"{codes_sql(rules, WARNING)} AS quality_warning_codes",
    ).selectExpr("*", *_STATUS)


def flag_more(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Append codes found later (say after a join) and refresh counts and status."""
    kept = [c for c in df.columns if not c.startswith("quality_")]
    merged = [
        f"array_distinct(concat({column}, {codes_sql(rules, severity)})) AS {column}"
        for column, severity in (("quality_error_codes", ERROR), ("quality_warning_codes", WARNING))
    ]
    return df.selectExpr(*kept, *merged).selectExpr("*", *_STATUS)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter("quality_error_count = 0")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter("quality_error_count > 0")


def rule_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per code and severity. Both arrays are exploded in one pass over the input."""
    def tagged(column: str, severity: str) -> Column:
        return F.transform(column, lambda c: F.struct(c.alias("rule_code"), F.lit(severity).alias("severity")))

    found = F.concat(tagged("quality_error_codes", ERROR), tagged("quality_warning_codes", WARNING))
    return (
        df.select(*by, F.explode(found).alias("hit"))
        .groupBy(*by, "hit.rule_code", "hit.severity")
        .agg(F.count(F.lit(1)).alias("affected_rows"))
    )


def quality_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("quality_error_count") == 0).alias("rows_valid"),
        F.count_if(F.col("quality_error_count") > 0).alias("rows_rejected"),
        F.count_if(F.col("quality_warning_count") > 0).alias("warning_rows"),
    )
