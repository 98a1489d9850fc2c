"""Seeded fault injection (N1-N4) and its exact audit.

Rows are chosen by the keyed draw ``hash_uniform(seed, key)``, so the same
rows are corrupted on any partition layout.  All faults are projections:
no shuffle, and filters above them still push down to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.exprs import safe_div
from curata.functions.keyed import hash_uniform
from curata.spec import (
    DEFAULT_SPEC, FLIP_RATE, NULL_RATE, OUTLIER_RATE, OUTLIER_VALUE, SENTINEL_RATE, EncounterSpec,
)


def null_expr(df: DataFrame, column: str, rate: float, seed: int, key: str) -> Column:
    dtype = df.schema[column].dataType
    return F.when(hash_uniform(seed, key) < rate, F.lit(None).cast(dtype)).otherwise(F.col(column))


def sentinel_expr(column: str, rate: float, seed: int, key: str, sentinel: str = "?") -> Column:
    return F.when(hash_uniform(seed, key) < rate, F.lit(sentinel)).otherwise(F.col(column))


def flip_expr(column: str, flips: Sequence[tuple[str, str, float, int]], key: str) -> Column:
    """Each (from, to, rate, seed) flips a share of one class with its own draw.
    The rules are tried in order; a value is flipped at most once."""
    out = None
    for src, dst, rate, seed in flips:
        cond = (F.col(column) == src) & (hash_uniform(seed, key) < rate)
        out = F.when(cond, F.lit(dst)) if out is None else out.when(cond, F.lit(dst))
    return F.col(column) if out is None else out.otherwise(F.col(column))


def outlier_expr(df: DataFrame, column: str, rate: float, seed: int, key: str, value=OUTLIER_VALUE) -> Column:
    dtype = df.schema[column].dataType
    return F.when(hash_uniform(seed, key) < rate, F.lit(value).cast(dtype)).otherwise(F.col(column))


def inject_nulls(df: DataFrame, column: str, rate: float = NULL_RATE, seed: int = 2026, key: str = "encounter_id") -> DataFrame:
    return df.withColumn(column, null_expr(df, column, rate, seed, key))


def inject_sentinel(df: DataFrame, column: str, rate: float = SENTINEL_RATE, seed: int = 2027,
                    key: str = "encounter_id", sentinel: str = "?") -> DataFrame:
    return df.withColumn(column, sentinel_expr(column, rate, seed, key, sentinel))


def flip_labels(df: DataFrame, column: str, flips: Sequence[tuple[str, str, float, int]], key: str = "encounter_id") -> DataFrame:
    return df.withColumn(column, flip_expr(column, flips, key))


def inject_outliers(df: DataFrame, column: str, rate: float = OUTLIER_RATE, seed: int = 2030,
                    key: str = "encounter_id", value=OUTLIER_VALUE) -> DataFrame:
    return df.withColumn(column, outlier_expr(df, column, rate, seed, key, value))


@dataclass(frozen=True)
class Fault:
    name: str
    column: str
    marked: str        # "null" | "value" | "changed": how a corrupted value looks
    value: object = None


def default_flips(spec: EncounterSpec = DEFAULT_SPEC) -> list[tuple[str, str, float, int]]:
    s = spec.noise_seed
    return [(spec.positive_target, ">30", FLIP_RATE, s + 2), ("NO", spec.positive_target, FLIP_RATE, s + 3)]


def fault_plan(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC) -> list[tuple[Fault, Column]]:
    """The four faults of the encounter table with their new column values."""
    s, k = spec.noise_seed, spec.key
    return [
        (Fault("null_injection", "age", "null"), null_expr(df, "age", NULL_RATE, s, k)),
        (Fault("sentinel_injection", "race", "value", spec.sentinels[0]),
         sentinel_expr("race", SENTINEL_RATE, s + 1, k, spec.sentinels[0])),
        (Fault("label_flip", spec.target, "changed"), flip_expr(spec.target, default_flips(spec), k)),
        (Fault("outlier_injection", "time_in_hospital", "value", OUTLIER_VALUE),
         outlier_expr(df, "time_in_hospital", OUTLIER_RATE, s + 4, k, OUTLIER_VALUE)),
    ]


def inject_faults(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, clean_target: str | None = None) -> DataFrame:
    """All four faults in one projection; with ``clean_target`` the target before the faults is kept under that name."""
    columns = {f.column: expr for f, expr in fault_plan(df, spec)}
    return df.withColumns(columns | ({clean_target: F.col(spec.target)} if clean_target else {}))


def _looks_corrupt(f: Fault, c: Column) -> Column:
    if f.marked == "null":
        return c.isNull()
    if f.marked == "value":
        return F.coalesce(c == F.lit(f.value), F.lit(False))
    return F.lit(False)


def noise_audit(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC) -> DataFrame:
    """Exact audit of ``inject_faults`` on ``df``, from ONE aggregate.

    Before and after values sit side by side in one projection, so per fault:
    n_changed  rows whose value was changed (null-safe compare),
    n_marked   rows that look corrupted afterwards (what a count after the fact sees),
    n_preexisting rows that looked corrupted before injection.
    A last row ``any_fault`` counts rows hit by at least one fault, so a row
    hit twice counts once.
    """
    plan = fault_plan(df, spec)
    after = {f.column: F.col(f"__after_{i}") for i, (f, _) in enumerate(plan)}
    side = df.select(*[F.col(f.column) for f, _ in plan], *[e.alias(f"__after_{i}") for i, (f, e) in enumerate(plan)])
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    changed_any, marked_any, pre_any = [], [], []
    for i, (f, _) in enumerate(plan):
        before, new = F.col(f.column), after[f.column]
        changed = ~new.eqNullSafe(before)
        marked = changed if f.marked == "changed" else _looks_corrupt(f, new)
        pre = _looks_corrupt(f, before)
        aggs += [F.count_if(changed).alias(f"c{i}"), F.count_if(marked).alias(f"m{i}"), F.count_if(pre).alias(f"p{i}")]
        changed_any.append(changed)
        marked_any.append(marked)
        pre_any.append(pre)

    def any_of(conds):
        out = conds[0]
        for c in conds[1:]:
            out = out | c
        return out

    aggs += [F.count_if(any_of(changed_any)).alias("c_any"), F.count_if(any_of(marked_any)).alias("m_any"),
             F.count_if(any_of(pre_any)).alias("p_any")]
    wide = side.agg(*aggs)
    entries = []
    for i, (f, _) in enumerate(plan):
        entries += [F.lit(f.name), F.lit(f.column), F.col(f"c{i}"), F.col(f"m{i}"), F.col(f"p{i}")]
    entries += [F.lit("any_fault"), F.lit("*"), F.col("c_any"), F.col("m_any"), F.col("p_any")]
    long = wide.select(
        "n_rows",
        F.stack(F.lit(len(entries) // 5), *entries).alias("fault", "column_name", "n_changed", "n_marked", "n_preexisting"),
    )
    return long.withColumn(
        "changed_pct", F.round(safe_div(F.col("n_changed") * 100.0, F.col("n_rows").cast("double")), 2)
    ).select("fault", "column_name", "n_rows", "n_changed", "n_marked", "n_preexisting", "changed_pct")
