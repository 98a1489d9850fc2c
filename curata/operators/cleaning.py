"""Cleaning (C1-C10).

Row-preserving steps are projections; the filter steps are plain filters
(pushed into the scan where the predicate allows); the sparse-column drop
and the cap read a few numbers per column from ONE aggregate each.  Dedup
is a hash aggregate with map-side combine, so a hot duplicate group shrinks
to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.exprs import existing
from curata.operators.value_counts import counted_quantiles, value_counts
from curata.sources.sinks import persist, written_table
from curata.spec import DEFAULT_SPEC, EncounterSpec

#: Number of input rows of a row of ``CountedRows``.
COUNT = "n_rows_"


def _require(df: DataFrame, column: str, step: str) -> None:
    if column not in df.columns:
        raise ValueError(f"{step}: column '{column}' is not in the table (was it dropped as sparse?)")


def sentinels_to_null(df: DataFrame, sentinels: Sequence[str] = ("?",), columns: Sequence[str] | None = None) -> DataFrame:
    """Sentinel strings -> NULL in every string column (one projection)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    sentinels = list(sentinels)
    return df.withColumns({c: F.when(F.col(c).isin(sentinels), F.lit(None).cast("string")).otherwise(F.col(c)) for c in columns})


def column_nulls(df: DataFrame, threshold: float = 0.40) -> DataFrame:
    """C2 by column: (column_name, null_share, dropped) from ONE aggregate."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_share").withColumn("dropped", F.coalesce(F.col("null_share") > threshold, F.lit(False)))


def null_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float | None]:
    """Share of NULL per column from ONE aggregate (NaN is not NULL here)."""
    cols = list(columns) if columns is not None else df.columns
    if not cols:
        return {}
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"f{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"f{i}"] for i, c in enumerate(cols)}


def sparse_columns(df: DataFrame, threshold: float = 0.40, protect: Sequence[str] = ()) -> list[str]:
    """Columns whose NULL share is strictly above ``threshold``.  Empty input drops nothing."""
    fractions = null_fractions(df, [c for c in df.columns if c not in set(protect)])
    return [c for c, f in fractions.items() if f is not None and f > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.40, protect: Sequence[str] = ()) -> DataFrame:
    """C2."""
    return df.drop(*sparse_columns(df, threshold, protect))


def drop_identifiers(df: DataFrame, ids: Sequence[str] = ("encounter_id", "patient_nbr"),
                     key: str | None = None, key_alias: str = "row_key") -> DataFrame:
    """Drop id columns.  ``key`` (one of them) is kept as ``key_alias`` so
    that keyed splits and samples still work after the drop."""
    present = existing(df, ids)
    if key is not None and key in df.columns:
        df = df.withColumnRenamed(key, key_alias)
        present = [c for c in present if c != key]
    return df.drop(*present)


def drop_null_critical(df: DataFrame, critical: Sequence[str] = ("gender", "age", "readmitted")) -> DataFrame:
    """C4: drop rows with NULL in any critical column that exists."""
    subset = existing(df, critical)
    return df.dropna(subset=subset) if subset else df


def drop_invalid_category(df: DataFrame, column: str = "gender", value: str = "Unknown/Invalid") -> DataFrame:
    """Keep rows whose value differs from ``value`` (NULL goes too, as in SQL)."""
    _require(df, column, "drop_invalid_category")
    return df.where(F.col(column) != F.lit(value))


def dedup_rows(df: DataFrame, key: str | None = "row_key") -> DataFrame:
    """One row per distinct combination of the non-key columns.

    NULLs compare equal.  With a key column the survivor is the row with the
    smallest key (deterministic), as GROUP BY all other columns + min(key).
    """
    if key is None or key not in df.columns:
        return df.dropDuplicates()
    others = [c for c in df.columns if c != key]
    return df.groupBy(*others).agg(F.min(key).alias(key)).select(*df.columns)


def encode_target(df: DataFrame, target: str = "readmitted", positive: str = "<30", label: str = "label") -> DataFrame:
    """label = 1 where target == positive, else 0 (NULL -> 0); target dropped."""
    _require(df, target, "encode_target")
    return df.withColumn(label, F.when(F.col(target) == F.lit(positive), 1).otherwise(0).cast("int")).drop(target)


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float) -> dict[str, float | None]:
    """Exact ``percentile_disc`` of each column: the smallest value whose
    cumulative share of the non-null rows reaches q.  NaN is ignored.

    From one counted table of all columns (``value_counts``), kept while its small jobs run: a value
    holding a third of the rows is one row per task.
    """
    if not columns:
        return {}
    counted = persist(value_counts(df, columns))
    try:
        return counted_quantiles(counted, columns, q)
    finally:
        counted.unpersist()


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    return exact_quantiles(df, [column], q)[column]


def quantiles(df: DataFrame, columns: Sequence[str], q: float, relative_error: float | None = None) -> dict[str, float | None]:
    """q-quantile per column.

    ``relative_error=None``: exact (``exact_quantiles``).  A number:
    ``percentile_approx`` (bounded Greenwald-Khanna sketch) for all columns in
    ONE aggregate.
    """
    if not columns:
        return {}
    if relative_error is None:
        return exact_quantiles(df, columns, q)
    acc = max(1, int(round(1.0 / relative_error)))
    row = df.agg(*[F.percentile_approx(F.col(c), q, acc).cast("double").alias(f"q{i}")
                   for i, c in enumerate(columns)]).first()
    return {c: row[f"q{i}"] for i, c in enumerate(columns)}


def cap_outliers(df: DataFrame, columns: Sequence[str] = ("time_in_hospital",), q: float = 0.99,
                 relative_error: float | None = None, valid_max: float | None = None) -> DataFrame:
    """Cap each column at its q-quantile; values become double, NULL stays NULL.

    ``valid_max`` (optional) first turns values above a known valid range
    into NULL, so that injected outliers that are more frequent than 1-q do
    not move the quantile itself.  With no rows there is no cap.
    """
    cols = existing(df, columns)
    if valid_max is not None:
        df = df.withColumns({c: F.when(F.col(c) <= F.lit(valid_max), F.col(c)) for c in cols})
    caps = quantiles(df, cols, q, relative_error)
    exprs = {}
    for c in cols:
        p = caps[c]
        x = F.col(c).cast("double")
        exprs[c] = x if p is None else F.when(x > F.lit(p), F.lit(p)).otherwise(x)
    return df.withColumns(exprs)


@dataclass
class CountedRows:
    """Rows with equal values in all columns but the ids as one row, with their number and smallest key.

    Null shares, filters, duplicates and the cap all follow from this table, so the input is read and
    shuffled once.  The table is written to the checkpoint folder: it survives lost executors, and
    nothing stays in the executors' memory.  The cleaning and its audit can share it.
    """

    table: DataFrame
    columns: list[str]
    spec: EncounterSpec = DEFAULT_SPEC
    keyed: bool = True
    _kept: tuple[list[str], dict[str, int]] | None = None
    _distinct: DataFrame | None = None

    @classmethod
    def build(cls, df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, keep_key: bool = True) -> CountedRows:
        staged = sentinels_to_null(df, spec.sentinels)
        columns = [c for c in staged.columns if c not in spec.id_columns]
        keyed = keep_key and spec.key in staged.columns
        key = [F.min(spec.key).alias(spec.row_key)] if keyed else []
        table = staged.groupBy(*columns).agg(F.count(F.lit(1)).alias(COUNT), *key)
        return cls(written_table(table, "counted-rows"), columns, spec, keyed)

    def _valid(self, columns: Sequence[str]) -> tuple[Column, Column]:
        """The conditions of the two filters."""
        not_null = F.lit(True)
        for c in self.spec.critical_columns:
            if c in columns:
                not_null = not_null & F.col(c).isNotNull()
        return not_null, not_null & F.coalesce(F.col(self.spec.category_column) != F.lit(self.spec.invalid_category), F.lit(False))

    def kept(self) -> tuple[list[str], dict[str, int]]:
        """The columns that are not sparse, and the rows left after each filter, from one aggregate.

        A critical column that turns out to be sparse is dropped and filters nothing; then the filters are counted again.
        """
        if self._kept is None:
            spec = self.spec
            n = F.col(COUNT)
            size = lambda cond, name: F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).alias(name)
            nulls = [size(F.col(c).isNull(), f"null{i}") for i, c in enumerate(self.columns)]
            _require_column(self.columns, spec.category_column)

            def sizes(columns):
                filled, valid = self._valid(columns)
                return [size(F.lit(True), "input"), size(filled, "filled"), size(valid, "valid")]

            row = self.table.agg(*nulls, *sizes(self.columns)).first()
            kept = [c for i, c in enumerate(self.columns) if not row["input"] or row[f"null{i}"] / row["input"] <= spec.sparse_threshold]
            _require_column(kept, spec.category_column)
            if any(c in self.columns and c not in kept for c in spec.critical_columns):
                row = self.table.agg(*sizes(kept)).first()
            self._kept = kept, {c: row[c] for c in ("input", "filled", "valid")}
        return self._kept

    def distinct(self) -> DataFrame:
        """The valid rows without duplicates, in the kept columns; grouped again only if a column was dropped."""
        if self._distinct is None:
            kept = self.kept()[0]
            valid = self.table.where(self._valid(kept)[1])
            key = [self.spec.row_key] if self.keyed else []
            if len(kept) == len(self.columns):
                self._distinct = valid.select(*key, *kept)
            else:
                least = [F.min(self.spec.row_key).alias(self.spec.row_key)] if self.keyed else [F.count(F.lit(1)).alias(COUNT)]
                self._distinct = written_table(valid.groupBy(*kept).agg(*least).select(*key, *kept), "distinct-rows")
        return self._distinct

    def clean(self, order: Sequence[str], relative_error: float | None = None, valid_max: float | None = None) -> DataFrame:
        """C10 from the table; ``order`` gives the columns' order."""
        spec = self.spec
        rows = self.distinct()
        rows = rows.select(*[c for c in order if c in rows.columns])
        rows = encode_target(rows, spec.target, spec.positive_target, spec.label)
        return cap_outliers(rows, spec.cap_columns, spec.cap_quantile, relative_error, valid_max)

    def audit(self) -> DataFrame:
        """C9 from the table."""
        sizes = self.kept()[1]
        counts = [sizes["input"], sizes["filled"], sizes["valid"], self.distinct().count()]
        steps = ("input", "drop_null_critical", "drop_invalid_category", "dedup_rows")
        rows = [(i, step, counts[max(0, i - 1)], counts[i]) for i, step in enumerate(steps)]
        return self.table.sparkSession.createDataFrame(rows, "step_no int, step string, rows_in bigint, rows_out bigint")


def _require_column(columns: Sequence[str], column: str) -> None:
    if column not in columns:
        raise ValueError(f"cleaning: column '{column}' is not in the table (was it dropped as sparse?)")


def clean(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, keep_key: bool = True, relative_error: float | None = None,
          valid_max: float | None = None, held: list[DataFrame] | None = None, counted: CountedRows | None = None) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C5 -> C6 -> C7 -> C8, all from one table of counted rows.

    ``counted`` is that table, if it has been made already.  Nothing is persisted, so nothing is added
    to ``held``, the list of tables that the caller has to release.
    """
    counted = counted or CountedRows.build(df, spec, keep_key)
    order = [spec.row_key if c == spec.key else c for c in df.columns]
    return counted.clean(order, relative_error, valid_max)


def cleaning_audit(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, counted: CountedRows | None = None) -> DataFrame:
    """Rows in/out of each row-removing step of ``clean``, as four rows, from the table that ``clean`` uses."""
    return (counted or CountedRows.build(df, spec)).audit()


def range_audit(df: DataFrame, limits: Sequence[tuple[str, float]]) -> DataFrame:
    """Rows above the known valid range of each column: (column_name, valid_max, n_rows, n_over), one aggregate."""
    present = [(c, m) for c, m in limits if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c) > m).alias(f"o{i}") for i, (c, m) in enumerate(present)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(float(m)).alias("valid_max"), F.col("n_rows"), F.col(f"o{i}").alias("n_over")) for i, (c, m) in enumerate(present)]
    if not entries:
        return df.sparkSession.createDataFrame([], "column_name string, valid_max double, n_rows bigint, n_over bigint")
    return wide.select(F.inline(F.array(*entries)))
