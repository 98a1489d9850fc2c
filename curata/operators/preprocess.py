"""MLlib preprocessing.

Stage order: string indexing, one-hot encoding, median imputation, vector
assembly, scaling.  The pipeline is fitted once on the training rows; the
fitted model is reused for every classifier.  Each fit is a bounded
aggregate: label counts per categorical column (one pass for all columns),
one counted table of the numeric columns' values for their medians, and a
moment summary of the assembled vector.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, ImputerModel, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from curata.functions.exprs import existing
from curata.operators.cleaning import exact_quantiles
from curata.spec import DEFAULT_SPEC, EncounterSpec


def feature_columns(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC) -> tuple[list[str], list[str]]:
    """The categorical and numeric inputs that exist."""
    return existing(df, spec.categorical_columns), existing(df, spec.numeric_columns)


MEDIAN_RANK_ERROR = 0.001


def indexer(categorical: list[str]) -> StringIndexer:
    """Index by falling frequency (ties alphabetical); NULL/unseen -> extra index n.

    The fitted labels live on the driver: use it for columns with few distinct
    values; ``value_counts.value_ranks`` and ``index_by_ranks`` give the same indices for free text or ids."""
    return StringIndexer(inputCols=categorical, outputCols=[f"{c}_idx" for c in categorical], handleInvalid="keep")


def encoder(categorical: list[str]) -> OneHotEncoder:
    """One-hot with the last slot dropped; as the indexer's extra bucket
    is last, NULL/unseen values encode to the all-zero vector."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical])


def imputer(numeric: list[str]) -> Imputer:
    """X2 by a quantile sketch: NULL and NaN -> a value whose rank is within
    ``MEDIAN_RANK_ERROR`` of one half.  ``exact_imputer`` has the median itself."""
    return Imputer(inputCols=numeric, outputCols=[f"{c}_imp" for c in numeric], strategy="median",
                   relativeError=MEDIAN_RANK_ERROR)


def exact_imputer(train: DataFrame, numeric: list[str]) -> ImputerModel:
    """NULL and NaN -> exact lower median of the column, selected from its counted values.

    The model is fitted on one row that holds the medians, which are then its surrogates.  A column
    without any value raises, as the estimator does."""
    medians = exact_quantiles(train, numeric, 0.5)
    empty = [c for c in numeric if medians[c] is None]
    if empty:
        raise ValueError(f"no median: every value of {', '.join(empty)} is NULL or NaN")
    row = train.sparkSession.createDataFrame([tuple(medians[c] for c in numeric)], T.StructType([T.StructField(c, T.DoubleType()) for c in numeric]))
    return imputer(numeric).fit(row)


def assembler(categorical: list[str], numeric: list[str], output: str = "features_raw") -> VectorAssembler:
    """Numeric slots first, then the one-hot blocks."""
    return VectorAssembler(inputCols=[f"{c}_imp" for c in numeric] + [f"{c}_ohe" for c in categorical],
                           outputCol=output, handleInvalid="keep")


def scaler(input_col: str = "features_raw", output: str = "features") -> StandardScaler:
    """Divide by the sample standard deviation, no centring (constant slot -> 0)."""
    return StandardScaler(inputCol=input_col, outputCol=output, withStd=True, withMean=False)


def preprocessing_stages(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, exact: bool = False) -> list:
    """The stages in order; with ``exact`` the medians are selected from ``df`` at once."""
    categorical, numeric = feature_columns(df, spec)
    stages = []
    if categorical:
        stages += [indexer(categorical), encoder(categorical)]
    return stages + [exact_imputer(df, numeric) if exact else imputer(numeric), assembler(categorical, numeric), scaler()]


def fit_preprocessing(train: DataFrame, spec: EncounterSpec = DEFAULT_SPEC) -> PipelineModel:
    """Fit the stages on the training rows only, with exact medians."""
    return Pipeline(stages=preprocessing_stages(train, spec, exact=True)).fit(train)
