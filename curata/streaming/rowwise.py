"""Row-local cleaning and scoring of a stream of encounter records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.operators import cleaning as cl
from curata.operators.classifiers import score
from curata.operators.features import engineer_features
from curata.spec import DEFAULT_SPEC, EncounterSpec


def clean_stream(stream: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, drop_columns: Sequence[str] = (),
                 caps: Mapping[str, float] | None = None) -> DataFrame:
    """C1, C3, C4, C5, C7 and F1-F5 on a stream.

    ``drop_columns`` (from ``cleaning.sparse_columns`` on a batch table) and
    ``caps`` (from ``cleaning.quantiles``) carry the whole-table decisions.
    """
    df = cl.sentinels_to_null(stream, spec.sentinels)
    df = df.drop(*drop_columns)
    df = cl.drop_identifiers(df, spec.id_columns, key=spec.key, key_alias=spec.row_key)
    df = cl.drop_null_critical(df, spec.critical_columns)
    df = cl.drop_invalid_category(df, spec.category_column, spec.invalid_category)
    df = cl.encode_target(df, spec.target, spec.positive_target, spec.label)
    for c, p in (caps or {}).items():
        x = F.col(c).cast("double")
        df = df.withColumn(c, F.when(x > F.lit(p), F.lit(p)).otherwise(x))
    return engineer_features(df)


def score_stream(stream: DataFrame, model, keep: Sequence[str] = ("row_key", "label")) -> DataFrame:
    """Apply a fitted preprocessing + classifier ``PipelineModel`` to a stream."""
    return score(model, stream, keep)
