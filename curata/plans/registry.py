"""Query registry: one callable (spark, sf_dir) -> DataFrame per operator.

Unless noted, queries read the ``encounters`` table built from the test
tables (orders, customer, lineitem), so their work grows with the data.
Floating results are rounded (6 places) so that they compare exactly with
the SQL oracles; counts are bigint, flags int/double as in the operators.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.operators import classifiers as clf
from curata.operators import cleaning as cl
from curata.operators import evaluation as ev
from curata.operators import faults as fx
from curata.operators import features as ft
from curata.operators import model_tables as mt
from curata.operators import profiling as pf
from curata.operators import value_counts as vc
from curata.operators.curve import curve_rows, learning_curve
from curata.operators.sampling import split_by_key, tag_split
from curata.operators.strata import curve_statistics
from curata.plans.artifacts import artifacts, prepared_table, resilience
from curata.session import checkpoint_dir
from curata.sources.encounters import encounters
from curata.sources.files import read_csv, source_profile, try_cast_columns
from curata.sources.inference import bad_fields, infer_types, type_table
from curata.sources.sinks import written_table
from curata.sources.tables import load_table
from curata.spec import DEFAULT_SPEC as SPEC, DT_PARAMS, LR_PARAMS, RF_PARAMS, VALID_MAX

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
#: The largest derivative that counts as vanished, and the trees of the forest that is recounted.
GRADIENT_BOUND = 1e-4
PLAIN_TREES = 10
QUARTILES = (0.25, 0.5, 0.75)
BAD_SHARE = 0.02


def _round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def _faulted(spark, d):
    return fx.inject_faults(encounters(spark, d), SPEC)


def scored_fixture(spark: SparkSession, d: str) -> DataFrame:
    """Fixed scored table for the evaluators: a rule score, not a model."""
    enc = encounters(spark, d)
    score = F.coalesce(F.col("number_outpatient"), F.lit(0)).cast("double") / 10.0
    return enc.select(
        "encounter_id",
        F.when(F.col("readmitted") == "<30", 1).otherwise(0).cast("int").alias("label"),
        score.alias("score"),
    ).withColumn("prediction", F.when(F.col("score") >= 0.3, 1.0).otherwise(0.0))


# --- S: sources -------------------------------------------------------------
def q_scan_encounters(spark, d):
    return encounters(spark, d)


def q_source_profile(spark, d):
    return source_profile(encounters(spark, d))


def q_scan_csv(spark, d):
    """The faulted rows written as CSV text and read back: everything as text, sentinels to NULL, then cast."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    rows = _faulted(spark, d)
    rows.write.option("header", True).option("nullValue", "").csv(path)
    text = read_csv(spark, path, ", ".join(f"`{c}` STRING" for c in rows.columns), bad_record=None)
    return try_cast_columns(cl.sentinels_to_null(text, SPEC.sentinels), {c: t for c, t in rows.dtypes if t != "string"})


def q_csv_bad_fields(spark, d):
    """Lines of the CSV form of orders whose fields do not fit a numeric priority column, counted beside the good ones."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    orders = load_table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.lit("?")).otherwise(F.col("o_custkey").cast("string")).alias("value"))
    orders.write.option("header", True).csv(path)
    return read_csv(spark, path, "o_orderkey BIGINT, value BIGINT").agg(F.count(F.lit(1)).alias("n_rows"), F.count("bad_record").alias("n_bad"), F.sum("value").alias("total"))


def _as_text(spark, d) -> DataFrame:
    """The faulted rows written as CSV and read as text, with sentinels in a numeric column."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    rows = _faulted(spark, d).withColumn("num_medications", F.when(F.col("encounter_id") % 7 == 0, F.lit("?")).otherwise(F.col("num_medications").cast("string")))
    rows = rows.withColumn("number_diagnoses", F.when(F.col("encounter_id") % 100 == 0, F.concat(F.lit("n"), F.col("encounter_id") % 3)).otherwise(F.col("number_diagnoses").cast("string")))
    rows.write.option("header", True).option("nullValue", "").csv(path)
    return read_csv(spark, path, ", ".join(f"`{c}` STRING" for c in rows.columns), bad_record=None)


def q_inferred_types(spark, d):
    """Types past sentinels; a column may have one bad field in fifty."""
    return type_table(_as_text(spark, d), sentinels=SPEC.sentinels, max_bad_share=BAD_SHARE).select("column_name", "n_values", "n_missing", "n_bigint", "n_double", "type", "n_bad")


def q_bad_fields(spark, d):
    """The fields that lack their column's inferred type."""
    text = _as_text(spark, d)
    return bad_fields(text, infer_types(text, sentinels=SPEC.sentinels, max_bad_share=BAD_SHARE), SPEC.sentinels)


# --- P: profiling -----------------------------------------------------------
def q_class_distribution(spark, d):
    return pf.class_distribution(encounters(spark, d), SPEC.target)


def q_age_distribution(spark, d):
    return pf.frequency_table(encounters(spark, d), "age")


def q_missing_rate(spark, d):
    return _round_doubles(pf.missing_rates(encounters(spark, d), SPEC.sentinels, SPEC.sparse_threshold))


def q_numeric_histogram(spark, d):
    counted = written_table(vc.value_counts(encounters(spark, d), SPEC.histogram_columns), "value-counts")
    return _round_doubles(vc.counted_histogram(counted, SPEC.histogram_columns, SPEC.histogram_bins))


def q_histogram_by_rows(spark, d):
    """The same histogram without a counted table, for columns whose values do not repeat."""
    return _round_doubles(pf.histogram(encounters(spark, d), SPEC.histogram_columns, SPEC.histogram_bins))


def q_column_quantiles(spark, d):
    """Exact quartiles of the histogram's columns from one counted table."""
    counted = written_table(vc.value_counts(encounters(spark, d), SPEC.histogram_columns), "value-counts")
    rows = [(c, *(vc.counted_quantiles(counted, [*SPEC.histogram_columns], q)[c] for q in QUARTILES)) for c in SPEC.histogram_columns]
    return spark.createDataFrame(rows, "column_name string, " + ", ".join(f"q{round(100 * q)} double" for q in QUARTILES))


def q_value_ranks(spark, d):
    """Every customer's number of orders as a dictionary: ranks by falling count, ties in text order."""
    return vc.value_ranks(encounters(spark, d).select(F.col("patient_nbr").cast("string").alias("patient")), "patient")


def q_index_by_ranks(spark, d):
    """The dictionary joined back: the index of each encounter's patient, odd patients taken as NULL."""
    rows = encounters(spark, d).select("encounter_id", F.when(F.col("patient_nbr") % 2 == 0, F.col("patient_nbr").cast("string")).alias("patient"))
    return vc.index_by_ranks(rows, "patient", vc.value_ranks(rows, "patient"), "patient_idx")


def q_correlation_matrix(spark, d):
    return _round_doubles(pf.correlations(encounters(spark, d), SPEC.correlation_columns))


def q_correlation_heatmap(spark, d):
    return pf.correlation_heatmap(encounters(spark, d), SPEC.correlation_columns, 2)


# --- N: faults --------------------------------------------------------------
def q_inject_nulls(spark, d):
    return fx.inject_nulls(encounters(spark, d), "age", fx.NULL_RATE, SPEC.noise_seed, SPEC.key)


def q_inject_sentinel(spark, d):
    return fx.inject_sentinel(encounters(spark, d), "race", fx.SENTINEL_RATE, SPEC.noise_seed + 1, SPEC.key)


def q_flip_labels(spark, d):
    return fx.flip_labels(encounters(spark, d), SPEC.target, fx.default_flips(SPEC), SPEC.key)


def q_inject_outliers(spark, d):
    return fx.inject_outliers(encounters(spark, d), "time_in_hospital", fx.OUTLIER_RATE, SPEC.noise_seed + 4, SPEC.key)


def q_noise_audit(spark, d):
    return fx.noise_audit(encounters(spark, d), SPEC)


# --- C: cleaning ------------------------------------------------------------
def q_clean_sentinels(spark, d):
    return cl.sentinels_to_null(_faulted(spark, d), SPEC.sentinels)


def q_drop_sparse_columns(spark, d):
    return cl.drop_sparse_columns(cl.sentinels_to_null(_faulted(spark, d), SPEC.sentinels), SPEC.sparse_threshold)


def q_column_nulls(spark, d):
    nulls = cl.column_nulls(cl.sentinels_to_null(_faulted(spark, d), SPEC.sentinels), SPEC.sparse_threshold)
    return _round_doubles(nulls)


def q_range_audit(spark, d):
    return cl.range_audit(_faulted(spark, d), VALID_MAX)


def q_drop_identifiers(spark, d):
    return cl.drop_identifiers(encounters(spark, d), SPEC.id_columns, key=SPEC.key, key_alias=SPEC.row_key)


def q_drop_null_critical(spark, d):
    df = fx.inject_nulls(encounters(spark, d), "age", fx.NULL_RATE, SPEC.noise_seed, SPEC.key)
    return cl.drop_null_critical(df, SPEC.critical_columns)


def q_drop_invalid_category(spark, d):
    return cl.drop_invalid_category(encounters(spark, d), SPEC.category_column, SPEC.invalid_category)


def q_dedup_rows(spark, d):
    df = encounters(spark, d).select(F.col(SPEC.key).alias(SPEC.row_key), "gender", "age", "race",
                                     "time_in_hospital", "readmitted")
    return cl.dedup_rows(df, SPEC.row_key)


def q_encode_target(spark, d):
    return cl.encode_target(encounters(spark, d), SPEC.target, SPEC.positive_target, SPEC.label)


def q_cap_outliers(spark, d):
    return cl.cap_outliers(_faulted(spark, d), ("time_in_hospital", "num_lab_procedures"), SPEC.cap_quantile)


def q_cleaning_audit(spark, d):
    return cl.cleaning_audit(_faulted(spark, d), SPEC, artifacts(spark, d, SPEC).counted)


def q_clean_pipeline(spark, d):
    return cl.clean(_faulted(spark, d), SPEC, counted=artifacts(spark, d, SPEC).counted)


# --- F: features ------------------------------------------------------------
def q_feature_age_ordinal(spark, d):
    return ft.add_age_ordinal(encounters(spark, d))


def q_feature_total_visits(spark, d):
    return ft.add_total_visits(encounters(spark, d))


def q_feature_procedure_burden(spark, d):
    return ft.add_procedure_burden(encounters(spark, d))


def q_feature_flags(spark, d):
    return ft.add_flags(encounters(spark, d))


def q_feature_table(spark, d):
    return prepared_table(spark, d, SPEC, counted=artifacts(spark, d, SPEC).counted)


# --- W: split and weights -----------------------------------------------------
def q_train_test_split(spark, d):
    return artifacts(spark, d, SPEC).tagged


def q_class_weights(spark, d):
    train, ratio = artifacts(spark, d, SPEC).weighted_train
    return _round_doubles(train.select(SPEC.row_key, SPEC.label, SPEC.weight_col,
                                       F.lit(float(ratio)).alias("balance_ratio")))


def q_patient_split(spark, d):
    """Split by patient: all encounters of a patient are on one side."""
    rows = encounters(spark, d).select("encounter_id", "patient_nbr")
    return tag_split(rows, "patient_nbr", SPEC.train_fraction, SPEC.split_seed)


def q_flipped_labels(spark, d):
    """Label before and after the faults, counted: what an evaluation on corrupted labels misses."""
    rows = fx.inject_faults(encounters(spark, d), SPEC, clean_target="clean_target")
    label = lambda c: (F.col(c) == SPEC.positive_target).cast("int")
    return rows.groupBy(label("clean_target").alias("clean_label"), label(SPEC.target).alias("label")).agg(F.count(F.lit(1)).alias("n"))


# --- X: preprocessing -----------------------------------------------------------
def q_impute_median(spark, d):
    a = artifacts(spark, d, SPEC)
    imp = [c for c in a.transformed.columns if c.endswith("_imp")]
    return a.transformed.select(SPEC.row_key, "split", *imp)


def q_string_index(spark, d):
    a = artifacts(spark, d, SPEC)
    idx = [c for c in a.transformed.columns if c.endswith("_idx")]
    return a.transformed.select(SPEC.row_key, *idx)


def q_one_hot(spark, d):
    a = artifacts(spark, d, SPEC)
    cats = [c[:-4] for c in a.transformed.columns if c.endswith("_ohe")]
    entries = []
    for c in cats:
        arr = vector_to_array(F.col(f"{c}_ohe"))
        pos = F.array_position(arr, 1.0)
        entries += [F.lit(c), F.size(arr).cast("int"), F.when(pos > 0, pos - 1).cast("int")]
    return a.transformed.select(SPEC.row_key, F.stack(F.lit(len(cats)), *entries).alias("column_name", "vec_size", "hot_slot"))


def _slots(a, vec: str, prefix: str) -> DataFrame:
    n_num = len([c for c in a.transformed.columns if c.endswith("_imp")])
    arr = vector_to_array(F.col(vec))
    return a.transformed.select(SPEC.row_key, F.size(arr).cast("int").alias("n_features"),
                                *[arr[i].alias(f"{prefix}{i:02d}") for i in range(n_num)])


def q_assemble_features(spark, d):
    return _round_doubles(_slots(artifacts(spark, d, SPEC), "features_raw", "f"))


def q_scale_features(spark, d):
    return _round_doubles(_slots(artifacts(spark, d, SPEC), "features", "s"))


def q_preprocess_pipeline(spark, d):
    a = artifacts(spark, d, SPEC)
    return a.transformed.select(SPEC.row_key, "split", SPEC.label,
                                F.size(vector_to_array("features")).alias("n_features"))


# --- M: classifiers -----------------------------------------------------------
def _terms_frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def q_train_logistic_regression(spark, d):
    m = artifacts(spark, d, SPEC).model("Logistic Regression")
    return _terms_frame(spark, clf.linear_terms(m), "term string, feature_index int, value double")


def q_train_decision_tree(spark, d):
    m = artifacts(spark, d, SPEC).model("Decision Tree")
    return _terms_frame(spark, clf.importances(m), "feature_index int, importance double")


def q_train_random_forest(spark, d):
    m = artifacts(spark, d, SPEC).model("Random Forest")
    return _terms_frame(spark, clf.importances(m), "feature_index int, importance double")


def q_score_test_set(spark, d):
    return artifacts(spark, d, SPEC).all_predictions()


def q_scored_test_keys(spark, d):
    """What is exact of the scored rows: which rows, labels and array sizes each model returns."""
    rows = artifacts(spark, d, SPEC).all_predictions()
    total = F.round(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x), DIGITS)
    return rows.select("model", SPEC.row_key, SPEC.label, F.size("raw_prediction").alias("n_raw"), total.alias("total_probability"))


def q_importance_totals(spark, d):
    """Slots and sum of importances of the tree models."""
    a = artifacts(spark, d, SPEC)
    rows = [(name, len(v), round(sum(x for _, x in v), DIGITS)) for name, v in ((n, clf.importances(a.model(n))) for n in clf.MODEL_ORDER[1:])]
    return spark.createDataFrame(rows, "model string, n_features int, total_importance double")


def q_logistic_gradient(spark, d):
    """Whether the training objective's derivative by each term vanishes at the fitted terms."""
    a = artifacts(spark, d, SPEC)
    terms = mt.linear_table(spark, a.model("Logistic Regression"))
    slopes = mt.logistic_gradient(a.train_vectors, terms, LR_PARAMS["regParam"], SPEC.weight_col, SPEC.label)
    return slopes.select("slot", (F.abs("gradient") < GRADIENT_BOUND).alias("at_optimum"))


def _tree_shape(name: str) -> tuple[int, int]:
    return (1, DT_PARAMS["maxDepth"]) if name == "Decision Tree" else (RF_PARAMS["numTrees"], RF_PARAMS["maxDepth"])


def q_tree_recount(spark, d):
    """Rows, weights and impurity of every node recounted from the training rows: the tree, and a forest without resampling."""
    a = artifacts(spark, d, SPEC)
    plain = clf.random_forest(SPEC.weight_col, bootstrap=False, numTrees=PLAIN_TREES).fit(a.train_vectors)
    saved = mt.tree_table(spark, plain, f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}")
    out = None
    for name, nodes, shape in (("Decision Tree", a.nodes("Decision Tree"), _tree_shape("Decision Tree")), ("plain forest", saved, (PLAIN_TREES, RF_PARAMS["maxDepth"]))):
        found = mt.recount_faults(mt.recount(a.train_vectors, nodes, *shape, weight=SPEC.weight_col, label=SPEC.label))
        rows = found.select(F.lit(name).alias("model"), "tree", "leaf_rows", F.round("leaf_weight", DIGITS).alias("leaf_weight"), "wrong_rows", "wrong_weights", "wrong_impurity")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_node_faults(spark, d):
    """Nodes of the fitted tree models whose children do not split what they hold, tree by tree."""
    a = artifacts(spark, d, SPEC)
    out = None
    for name in clf.MODEL_ORDER[1:]:
        rows = mt.node_faults(a.nodes(name)).select(F.lit(name).alias("model"), "tree", "wrong_split", "wrong_impurity", "wrong_gain")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_table_scores(spark, d):
    """Test rows scored from the models' tables by joins, held against the models' own scores."""
    a = artifacts(spark, d, SPEC)
    a.fit_all()
    out = None
    for name in clf.MODEL_ORDER:
        if name == "Logistic Regression":
            mine = mt.score_linear(a.test_vectors, mt.linear_table(spark, a.model(name)), keep=(SPEC.row_key, SPEC.label))
        else:
            mine = mt.score_trees(a.test_vectors, a.nodes(name), *_tree_shape(name), keep=(SPEC.row_key, SPEC.label))
        both = a.predictions(name).alias("m").join(mine.alias("t"), [SPEC.row_key, SPEC.label], "left")
        equal = F.forall(F.zip_with("m.probability", "t.probability", lambda x, y: F.round(x, DIGITS) == F.round(y, DIGITS)), lambda x: x)
        rows = both.select(F.lit(name).alias("model"), SPEC.row_key, SPEC.label, F.col("m.prediction").eqNullSafe(F.col("t.prediction")).alias("same_class"),
                           F.coalesce(equal, F.lit(False)).alias("same_probability"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_model_confusion(spark, d):
    return ev.confusion_by(artifacts(spark, d, SPEC).all_predictions(), "model", SPEC.label, "prediction")


def q_model_test_rows(spark, d):
    """Cells of each model's confusion matrix add up to its test rows, class by class."""
    cells = ev.confusion_by(artifacts(spark, d, SPEC).all_predictions(), "model", SPEC.label, "prediction")
    return cells.groupBy("model", F.col("label").cast("int").alias("label")).agg(F.sum("n").alias("n"))


def q_resilience(spark, d):
    return _round_doubles(resilience(spark, d, SPEC))


def q_model_leaderboard(spark, d):
    return ev.leaderboard(artifacts(spark, d, SPEC).leaderboard_rows())


def q_best_model(spark, d):
    return ev.best_model(ev.leaderboard(artifacts(spark, d, SPEC).leaderboard_rows()))


def q_metric_comparison(spark, d):
    return ev.metric_comparison(ev.leaderboard(artifacts(spark, d, SPEC).leaderboard_rows()))


# --- V: evaluators on the fixed scored table ----------------------------------
def q_auc_roc(spark, d):
    return _round_doubles(ev.auc_roc(scored_fixture(spark, d), "label", "score"))


def q_classification_metrics(spark, d):
    return _round_doubles(ev.classification_metrics(scored_fixture(spark, d), "label", "prediction"))


def q_confusion_matrix(spark, d):
    return ev.confusion_counts(scored_fixture(spark, d), "label", "prediction")


RULES = ((1, "low rule", 0.2), (2, "middle rule", 0.3), (3, "same as middle", 0.3))


def _rule_board(spark, d):
    """Three thresholds of the fixed score as models; two are equal, so the best is a tie."""
    scored = scored_fixture(spark, d)
    out = None
    for position, name, least in RULES:
        rows = scored.withColumn("prediction", (F.col("score") >= least).cast("double"))
        row = ev.evaluate(rows).select(F.lit(position).alias("position"), F.lit(name).alias("model"), *ev.METRICS)
        out = row if out is None else out.unionByName(row)
    return ev.leaderboard(out)


def q_rule_leaderboard(spark, d):
    return _rule_board(spark, d)


def q_rule_best_model(spark, d):
    return ev.best_model(_rule_board(spark, d))


def q_rule_metric_comparison(spark, d):
    return ev.metric_comparison(_rule_board(spark, d))


# --- L: learning curve --------------------------------------------------------
def q_learning_curve_rows(spark, d):
    return curve_rows(artifacts(spark, d, SPEC).prepared, key=SPEC.row_key)


def q_curve_statistics(spark, d):
    """What the preprocessing learns on each nested training sample, from one counted table."""
    a = artifacts(spark, d, SPEC)
    train = split_by_key(a.prepared, SPEC.row_key, SPEC.train_fraction, SPEC.split_seed)[0]
    return _round_doubles(curve_statistics(train, SPEC))


def q_learning_curve(spark, d):
    a = artifacts(spark, d, SPEC)
    rows = learning_curve(a.prepared, SPEC)
    metrics = spark.createDataFrame([(r["fraction"], r["auc_roc"], r["f1"], r["accuracy"]) for r in rows],
                                    "fraction double, auc_roc double, f1 double, accuracy double")
    return curve_rows(a.prepared, key=SPEC.row_key).join(metrics, "fraction")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
