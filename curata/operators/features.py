"""Feature derivation (F1-F6): one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.spec import AGE_BRACKETS


def _need(df: DataFrame, cols: Sequence[str], feature: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{feature}: missing input column(s) {missing}")


def ordinal_expr(column: str, categories: Sequence[str] = AGE_BRACKETS) -> Column:
    """category -> 1..n as double from a literal map; unknown or NULL -> NULL."""
    pairs = []
    for i, cat in enumerate(categories):
        pairs += [F.lit(cat), F.lit(float(i + 1))]
    return F.create_map(*pairs)[F.col(column)].cast("double")


def sum_expr(columns: Sequence[str]) -> Column:
    """Row-wise sum as double; NULL if any input is NULL."""
    out = None
    for c in columns:
        x = F.col(c).cast("double")
        out = x if out is None else out + x
    return out


def flag_expr(column: str, value: str) -> Column:
    """1.0 where column == value, else 0.0 (NULL -> 0.0)."""
    return F.when(F.col(column) == F.lit(value), F.lit(1.0)).otherwise(F.lit(0.0))


def add_age_ordinal(df: DataFrame, column: str = "age", out: str = "age_ordinal") -> DataFrame:
    """F1 (the source column is dropped)."""
    _need(df, [column], out)
    return df.withColumn(out, ordinal_expr(column)).drop(column)


def add_total_visits(df: DataFrame, columns=("number_outpatient", "number_emergency", "number_inpatient"),
                     out: str = "total_visits") -> DataFrame:
    """F2."""
    _need(df, columns, out)
    return df.withColumn(out, sum_expr(columns))


def add_procedure_burden(df: DataFrame, columns=("num_procedures", "num_lab_procedures"),
                         out: str = "procedure_burden") -> DataFrame:
    """F3."""
    _need(df, columns, out)
    return df.withColumn(out, sum_expr(columns))


def add_flags(df: DataFrame) -> DataFrame:
    """F4 + F5."""
    _need(df, ["change", "diabetesMed"], "flags")
    return df.withColumns({"any_med_change": flag_expr("change", "Ch"),
                           "on_diabetes_med": flag_expr("diabetesMed", "Yes")})


def engineer_features(df: DataFrame) -> DataFrame:
    """all five features in one projection; ``age`` is replaced by its ordinal."""
    _need(df, ["age", "number_outpatient", "number_emergency", "number_inpatient",
               "num_procedures", "num_lab_procedures", "change", "diabetesMed"], "engineer_features")
    return df.withColumns({
        "age_ordinal": ordinal_expr("age"),
        "total_visits": sum_expr(("number_outpatient", "number_emergency", "number_inpatient")),
        "procedure_burden": sum_expr(("num_procedures", "num_lab_procedures")),
        "any_med_change": flag_expr("change", "Ch"),
        "on_diabetes_med": flag_expr("diabetesMed", "Yes"),
    }).drop("age")
