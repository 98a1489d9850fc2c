"""Types of text columns that survive sentinels (S1): a type lattice as one aggregate, and the fields that do not fit.

A reader's own inference sees ``?`` in a numeric column and falls back to text.  Here a column's type is
the narrowest that all its values have, sentinels and empty fields aside:

    boolean < text,  bigint < double < text,  date < timestamp < text

What has a type is told by patterns, so the rule does not depend on a cast's leniency; dates and times must exist
in the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.spec import SENTINELS

#: Narrowest first; a column takes the first type that all its values have.
PATTERNS = {
    "boolean": "^([Tt]rue|[Ff]alse|TRUE|FALSE)$",
    "bigint": "^[+-]?[0-9]{1,18}$",
    "double": "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$",
    "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": "^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$",
}
_CALENDAR = {"date": "date", "timestamp": "timestamp"}


def _has_type(value: Column, kind: str) -> Column:
    fits = value.rlike(PATTERNS[kind])
    return fits & value.try_cast(_CALENDAR[kind]).isNotNull() if kind in _CALENDAR else fits


def _fields(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str]) -> DataFrame:
    """(i, field, missing): every field of the columns as text."""
    name = lambda c: "`" + c.replace("`", "``") + "`"
    entries = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(name(c)).cast("string").alias("field")) for i, c in enumerate(columns)])))
    missing = F.col("field").isNull() | F.col("field").isin("", *sentinels)
    return entries.withColumn("missing", missing)


def type_table(df: DataFrame, columns: Sequence[str] | None = None, sentinels: Sequence[str] = SENTINELS, max_bad_share: float = 0.0) -> DataFrame:
    """(column_name, n_values, n_missing, n_boolean, n_bigint, n_double, n_date, n_timestamp, type, n_bad), one row a column.

    ``n_<type>`` counts the values that have the type.  With ``max_bad_share`` a type is also taken
    if at most that share of the values lacks it; ``n_bad`` counts those.  A column without values
    is text.  One grouped aggregate with partial counts; the groups are the columns.
    """
    columns = list(columns) if columns is not None else df.columns
    schema = "column_name string, n_values bigint, n_missing bigint, " + ", ".join(f"n_{k} bigint" for k in PATTERNS) + ", type string, n_bad bigint"
    if not columns:
        return df.sparkSession.createDataFrame([], schema)
    present = ~F.col("missing")
    counted = _fields(df, columns, sentinels).groupBy("i").agg(
        F.count_if(present).alias("n_values"), F.count_if("missing").alias("n_missing"),
        *[F.count_if(present & _has_type(F.col("field"), k)).alias(f"n_{k}") for k in PATTERNS])
    kind, bad = F.lit("string"), F.lit(0).cast("bigint")
    for k in reversed(PATTERNS):
        lacking = F.col("n_values") - F.col(f"n_{k}")
        taken = (F.col("n_values") > 0) & (lacking <= F.col("n_values") * F.lit(float(max_bad_share)))
        kind, bad = F.when(taken, F.lit(k)).otherwise(kind), F.when(taken, lacking).otherwise(bad)
    every = df.sparkSession.createDataFrame(list(enumerate(columns)), "i int, column_name string")
    numbers = ["n_values", "n_missing", *[f"n_{k}" for k in PATTERNS]]
    return every.join(counted, "i", "left").select(
        "column_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers], F.coalesce(kind, F.lit("string")).alias("type"), F.coalesce(bad, F.lit(0)).alias("n_bad"))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None, sentinels: Sequence[str] = SENTINELS, max_bad_share: float = 0.0) -> dict[str, str]:
    """Column name -> type; one row a column reaches the driver."""
    return {r["column_name"]: r["type"] for r in type_table(df, columns, sentinels, max_bad_share).select("column_name", "type").collect()}


def apply_types(df: DataFrame, types: Mapping[str, str], sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Cast text columns to their types; sentinels, empty fields and fields that lack the type become NULL."""
    name = lambda c: "`" + c.replace("`", "``") + "`"

    def typed(c: str) -> Column:
        kind, field = types.get(c, "string"), F.col(name(c)).cast("string")
        present = F.when(field.isNotNull() & ~field.isin("", *sentinels), field)
        return (present if kind == "string" else F.when(_has_type(present, kind), present.try_cast(kind))).alias(c)

    return df.select(*[typed(c) for c in df.columns])


def bad_fields(df: DataFrame, types: Mapping[str, str], sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """(column_name, field, n): the values that lack their column's type, with their number."""
    columns = [c for c in df.columns if types.get(c, "string") != "string"]
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, field string, n bigint")
    lacks = F.lit(False)
    for i, c in enumerate(columns):
        lacks = F.when(F.col("i") == i, ~_has_type(F.col("field"), types[c])).otherwise(lacks)
    found = _fields(df, columns, sentinels).where(~F.col("missing") & lacks).groupBy("i", "field").agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.get(F.array(*[F.lit(c) for c in columns]), F.col("i")).alias("column_name"), "field", "n")
