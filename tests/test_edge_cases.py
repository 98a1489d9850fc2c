"""Literal edge cases (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from curata.operators import cleaning as cl
from curata.operators import evaluation as ev
from curata.operators import features as ft
from curata.operators import profiling as pf
from curata.operators import sampling as sm
from curata.operators.preprocess import encoder, indexer

SCHEMA = "row_key bigint, gender string, age string, x int, y double, readmitted string"


def test_empty_input_defines_results(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cl.sparse_columns(df) == []                       # no division by zero
    assert cl.cap_outliers(df, ["x"]).count() == 0           # no quantile, no cap
    assert pf.missing_rates(df).count() == 0
    assert pf.histogram(df, ["x"]).count() == 0
    assert sm.add_class_weights(df.withColumn("label", F.lit(0)))[1] == 1.0


def test_sparse_threshold_is_strict(spark):
    rows = [(i, "Male", "[0-10)", None if i < 4 else 1, None if i < 5 else 1.0, "NO") for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    # x: exactly 40% NULL stays; y: 50% goes
    assert cl.sparse_columns(df, 0.40) == ["y"]


def test_all_null_and_constant_columns(spark):
    rows = [(i, "Male", "[0-10)", 7, None, "NO") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("z", F.col("row_key").cast("double"))
    corr = {(r.col_a, r.col_b): r.corr for r in pf.correlations(df, ["x", "y", "z"]).collect()}
    assert corr[("x", "z")] is None            # constant column: NULL, no ANSI error
    assert corr[("y", "z")] is None            # all NULL
    assert corr[("z", "z")] == pytest.approx(1.0)
    hist = pf.histogram(df, ["x", "y"]).collect()
    assert [(h.column_name, h.bin, h.n) for h in hist] == [("x", 15, 6)]   # numpy widens a constant range


def test_histogram_last_bin_closed_and_nulls_ignored(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10]] + [(None,)], "v double")
    got = {(r.bin, r.n) for r in pf.histogram(df, ["v"], bins=5).collect()}
    assert got == {(0, 2), (1, 2), (4, 1)}


def test_unknown_age_bracket_and_null(spark):
    df = spark.createDataFrame([("[0-10)",), ("[90-100)",), ("weird",), (None,)], "age string")
    got = [r.age_ordinal for r in ft.add_age_ordinal(df).collect()]
    assert got == [1.0, 10.0, None, None]


def test_null_and_unseen_category_encode_to_zero_vector(spark):
    from pyspark.ml.functions import vector_to_array
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",)], "g string")
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "g string")
    idx = indexer(["g"]).fit(train)
    out = encoder(["g"]).fit(idx.transform(train)).transform(idx.transform(test))
    got = [(r.g_idx, list(r.v)) for r in out.select("g_idx", vector_to_array("g_ohe").alias("v")).collect()]
    # frequency desc, ties alphabetical: a=0, c=1, b=2; NULL/unseen -> 3 -> all-zero
    assert got == [(0.0, [1.0, 0.0, 0.0]), (2.0, [0.0, 0.0, 1.0]), (3.0, [0.0, 0.0, 0.0]), (3.0, [0.0, 0.0, 0.0])]


def test_no_minority_rows_gives_unit_weights(spark):
    df = spark.createDataFrame([(0,), (0,)], "label int")
    out, ratio = sm.add_class_weights(df)
    assert ratio == 1.0
    assert {r.class_weight for r in out.collect()} == {1.0}


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert ev.auc_roc(df).first().auc_roc is None


def test_auc_averages_ties(spark):
    # scores: pos {0.5, 0.9}, neg {0.5, 0.1}: pairs (0.5>0.5 tie=0.5, 0.5>0.1=1, 0.9>all=2) / 4
    df = spark.createDataFrame([(1, 0.5), (1, 0.9), (0, 0.5), (0, 0.1)], "label int, score double")
    assert ev.auc_roc(df, blocks=2).first().auc_roc == pytest.approx(3.5 / 4)


def test_best_model_first_wins_a_tie(spark):
    board = spark.createDataFrame(
        [(1, "A", 0.7, 0.8, 0.8, 0.8, 0.8), (2, "B", 0.9, 0.8, 0.8, 0.8, 0.8)],
        "position int, model string, auc_roc double, accuracy double, f1 double, "
        "weighted_precision double, weighted_recall double")
    assert ev.best_model(board).first().model == "A"


def test_dedup_keeps_smallest_key(spark):
    df = spark.createDataFrame([(5, "Male", None), (2, "Male", None), (3, "Female", "x")],
                               "row_key bigint, gender string, age string")
    got = sorted((r.row_key, r.gender) for r in cl.dedup_rows(df).collect())
    assert got == [(2, "Male"), (3, "Female")]          # NULLs compare equal


def test_invalid_category_drops_null_too(spark):
    df = spark.createDataFrame([("Male",), ("Unknown/Invalid",), (None,)], "gender string")
    assert [r.gender for r in cl.drop_invalid_category(df).collect()] == ["Male"]


def test_missing_critical_column_is_a_clear_error(spark):
    df = spark.createDataFrame([("x",)], "age string")
    with pytest.raises(ValueError, match="gender"):
        cl.drop_invalid_category(df)
    with pytest.raises(ValueError, match="readmitted"):
        cl.encode_target(df)


def test_cap_outliers_valid_range(spark):
    df = spark.createDataFrame([(float(v),) for v in list(range(1, 100)) + [999.0] * 5], "t double")
    capped = cl.cap_outliers(df, ["t"], 0.99)
    assert capped.agg(F.max("t")).first()[0] == 999.0    # 999 is the 99th percentile itself
    ranged = cl.cap_outliers(df, ["t"], 0.99, valid_max=14 * 10)
    assert ranged.agg(F.max("t")).first()[0] == 99.0    # ceil(0.99 * 99) = 99th of the 99 valid values


def test_metrics_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0), (0, 1.0)], "label int, prediction double")
    m = ev.classification_metrics(df).first()
    assert m.accuracy == pytest.approx(2 / 3)
    assert m.weighted_recall == pytest.approx(m.accuracy)


def test_exact_quantile_matches_percentile_disc_with_many_blocks(spark, monkeypatch):
    import curata.functions.blocks as blocks
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 7)
    # one value holds a third of the rows (skew) plus a long tail of distinct values
    rows = [(5.0,)] * 150 + [(float(v),) for v in range(300)] + [(None,)] * 4
    df = spark.createDataFrame(rows, "v double")
    for q in (0.01, 0.2, 0.5, 0.77, 0.99, 1.0):
        want = df.agg(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY v)")).first()[0]
        assert cl.exact_quantile(df, "v", q) == want
    assert cl.exact_quantile(df.where("v IS NULL"), "v", 0.5) is None
