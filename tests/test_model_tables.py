"""Fitted models as tables: scoring by joins, gradients, recounted nodes."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from curata.operators import classifiers as clf
from curata.operators import model_tables as mt
from curata.plans.artifacts import artifacts
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    a = artifacts(spark, SF_SMALL)
    a.fit_all()
    return a


@pytest.fixture(scope="module")
def small(spark):
    """Six rows with ties, a constant slot, a zero weight and features as plain arrays."""
    rows = [(1, 0, 1.0, [0.0, 1.0, 5.0]), (2, 0, 2.0, [1.0, 1.0, 4.0]), (3, 1, 1.0, [1.0, 0.0, 5.0]),
            (4, 1, 3.0, [2.0, 0.0, 5.0]), (5, 0, 0.0, [3.0, 0.0, 1.0]), (6, 1, 0.5, [3.0, 1.0, 5.0])]
    return spark.createDataFrame(rows, "row_key long, label int, class_weight double, features array<double>")


@pytest.fixture(scope="module")
def stump(spark):
    """Tree 0 splits slot 0 at 1, its right child slot 1 at 0.5; tree 1 is a lone leaf."""
    rows = [(0, 0, 0, 1.0, 1, 2, 0.5, 0.1, 6, [3.0, 4.5]), (0, 1, None, None, None, None, 0.375, None, 3, [3.0, 1.0]),
            (0, 2, 1, 0.5, 3, 4, 0.0, 0.0, 3, [0.0, 3.5]), (0, 3, None, None, None, None, 0.0, None, 2, [0.0, 3.0]),
            (0, 4, None, None, None, None, 0.0, None, 1, [0.0, 0.5]), (1, 0, None, None, None, None, 0.48, None, 6, [3.0, 4.5])]
    return spark.createDataFrame(rows, mt.NODE_SCHEMA)


def plain_leaf(nodes, tree, x):
    at, way = 0, [0]
    while nodes[tree, at].slot is not None:
        n = nodes[tree, at]
        at = n.left_node if x[n.slot] <= n.threshold else n.right_node
        way.append(at)
    return at, way


def test_route_and_scores_of_a_small_forest(small, stump):
    nodes = {(r.tree, r.node): r for r in stump.collect()}
    got = {(r.row_key, r.tree): (r.node, list(r.visited)) for r in mt.route(small, stump, 2, 2).collect()}
    rows = small.collect()
    assert got == {(r.row_key, t): plain_leaf(nodes, t, r.features) for r in rows for t in (0, 1)}
    scored = {r.row_key: r for r in mt.score_trees(small, stump, 2, 2).collect()}
    for r in rows:
        shares = [nodes[t, plain_leaf(nodes, t, r.features)[0]].class_weights for t in (0, 1)]
        want = [sum(w[c] / sum(w) for w in shares) / 2 for c in (0, 1)]
        assert scored[r.row_key].probability == pytest.approx(want)
        assert scored[r.row_key].prediction == float(want[1] > want[0])


def test_recount_finds_wrong_nodes(small, stump):
    counted = mt.recount(small, stump.filter("tree = 0"), 1, 2)
    seen = {r.node: (r.seen_rows, list(r.seen_weights)) for r in counted.collect()}
    assert seen == {0: (6, [3.0, 4.5]), 1: (3, [3.0, 1.0]), 2: (3, [0.0, 3.5]), 3: (2, [0.0, 3.0]), 4: (1, [0.0, 0.5])}
    (faults,) = mt.recount_faults(counted).collect()
    assert (faults.n_nodes, faults.n_leaves, faults.leaf_rows, faults.leaf_weight) == (5, 3, 6, 7.5)
    assert (faults.wrong_rows, faults.wrong_weights) == (0, 0)
    assert faults.wrong_impurity == 1          # the root's 0.5 is not the impurity of 3.0 and 4.5
    broken = stump.withColumn("n_rows", F.col("n_rows") + (F.col("node") == 3).cast("int"))
    assert mt.recount_faults(mt.recount(small, broken.filter("tree = 0"), 1, 2)).first().wrong_rows == 1
    unreached = mt.recount(small.filter("row_key < 3"), stump.filter("tree = 0"), 1, 2)
    assert mt.recount_faults(unreached).first().wrong_rows == 5


def test_node_faults(stump):
    found = {r.tree: r for r in mt.node_faults(stump).collect()}
    assert (found[0].n_inner, found[0].wrong_split, found[0].wrong_impurity) == (2, 0, 1)
    assert (found[1].n_inner, found[1].wrong_split, found[1].wrong_gain, found[1].wrong_impurity) == (0, 0, 0, 0)
    broken = stump.withColumn("class_weights", F.when(F.col("node") == 4, F.array(F.lit(1.0), F.lit(0.5))).otherwise(F.col("class_weights")))
    assert {r.tree: r.wrong_split for r in mt.node_faults(broken).collect()} == {0: 1, 1: 0}


def test_linear_scores_and_gradient_of_a_small_table(spark, small):
    terms = spark.createDataFrame([(mt.INTERCEPT, 0.25), (0, -0.5), (1, 1.0), (2, 0.125)], "slot int, weight double")
    b, w = 0.25, [-0.5, 1.0, 0.125]
    rows = small.collect()
    p = {r.row_key: 1 / (1 + math.exp(-(b + sum(x * y for x, y in zip(r.features, w))))) for r in rows}
    scored = {r.row_key: r for r in mt.score_linear(small, terms).collect()}
    assert {k: r.score for k, r in scored.items()} == pytest.approx(p)
    assert all(r.prediction == float(p[k] > 0.5) for k, r in scored.items())
    total, squares = sum(r.class_weight for r in rows), sum(r.class_weight ** 2 for r in rows)
    want = {mt.INTERCEPT: sum(r.class_weight * (p[r.row_key] - r.label) for r in rows) / total}
    for i in range(3):
        mean = sum(r.class_weight * r.features[i] for r in rows) / total
        variance = sum(r.class_weight * (r.features[i] - mean) ** 2 for r in rows) / (total - squares / total)
        want[i] = sum(r.class_weight * (p[r.row_key] - r.label) * r.features[i] for r in rows) / total + 0.1 * variance * w[i]
    got = {r.slot: r.gradient for r in mt.logistic_gradient(small, terms, 0.1).collect()}
    assert got == pytest.approx(want)


def test_gradient_vanishes_where_the_estimator_converged(spark, small):
    data = spark.createDataFrame([(i, int((i * 7) % 5 < 2), 1.0 + i % 3, float(i % 4), float((i * 3) % 7)) for i in range(200)],
                                 "row_key long, label int, class_weight double, a double, b double")
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(data)
    model = clf.logistic_regression(maxIter=200, tol=1e-12, regParam=0.05).fit(data)
    rows = mt.logistic_gradient(data, mt.linear_table(spark, model), 0.05).collect()
    assert len(rows) == 3 and all(abs(r.gradient) < 1e-8 for r in rows)
    moved = mt.linear_table(spark, model).withColumn("weight", F.col("weight") + 0.1)
    assert any(abs(r.gradient) > 1e-3 for r in mt.logistic_gradient(data, moved, 0.05).collect())


@pytest.mark.parametrize("name", clf.MODEL_ORDER[1:])
def test_saved_trees_hold_what_they_split(spark, run, tmp_path, name):
    model = run.model(name)
    nodes = mt.tree_table(spark, model, f"{tmp_path}/model")
    assert nodes.schema.simpleString() == spark.createDataFrame([], mt.NODE_SCHEMA).schema.simpleString()
    assert nodes.select("tree", "node").distinct().count() == nodes.count()
    faults = mt.node_faults(nodes).agg(*[F.sum(c).alias(c) for c in ("wrong_split", "wrong_impurity", "wrong_gain")]).first()
    assert tuple(faults) == (0, 0, 0)


def test_nodes_recounted_from_the_training_rows(spark, run, tmp_path):
    forest = clf.random_forest(bootstrap=False, numTrees=4, maxDepth=5).fit(run.train_vectors)
    for model, trees, depth in ((run.model("Decision Tree"), 1, 6), (forest, 4, 5)):
        nodes = mt.tree_table(spark, model, f"{tmp_path}/{trees}")
        for r in mt.recount_faults(mt.recount(run.train_vectors, nodes, trees, depth)).collect():
            assert (r.wrong_rows, r.wrong_weights, r.wrong_impurity) == (0, 0, 0)
            assert r.leaf_rows == run.train_vectors.count()


def test_empty_rows(small, stump):
    assert mt.score_trees(small.limit(0), stump, 2, 2).count() == 0
