"""Fitted models as tables (M1-M4): terms and tree nodes, scoring by joins, and exact checks of a fit.

A fitted model is small whatever the data: a linear model has one term per slot, a tree at most
``2 ** (depth + 1) - 1`` nodes.  As tables they can be stored, compared and joined with rows, and what
must hold of a fit becomes an aggregate over the training rows:

* the weighted, regularised gradient of logistic regression vanishes at its terms (``logistic_gradient``);
* each node of a tree holds the class weights of the training rows that reach it, and their impurity
  (``recount``), and its children split what it holds (``node_faults``).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Node tables up to this many nodes (trees * 2 ** (depth + 1)) are broadcast to the rows; larger ones are joined by key.
BROADCAST_NODES = 1_000_000
INTERCEPT = -1
NODE_SCHEMA = "tree int, node int, slot int, threshold double, left_node int, right_node int, impurity double, gain double, n_rows long, class_weights array<double>"


def linear_table(spark: SparkSession, model) -> DataFrame:
    """(slot, weight) of a fitted linear model; the intercept has slot -1."""
    weights = model.coefficients.toArray().tolist()
    return spark.createDataFrame([(INTERCEPT, float(model.intercept)), *enumerate(map(float, weights))], "slot int, weight double")


def tree_table(spark: SparkSession, model, path: str) -> DataFrame:
    """The nodes of a fitted tree or forest, one row each, read from the model saved at ``path``.

    Node 0 of a tree is its root.  ``slot``, ``threshold`` and the children are NULL in a leaf; a row
    goes left if the slot's value is at most the threshold.  ``class_weights`` are the training
    weights by class that reached the node.  The impurity is NULL where the learner kept none (leaves
    it did not try to split).
    """
    model.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    nodes = saved.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in saved.columns else saved.select(F.lit(0).alias("tree"), "*")
    inner = F.col("leftChild") >= 0
    if not nodes.filter(inner & (F.col("split.numCategories") >= 0)).isEmpty():
        raise ValueError("splits of category slots have no threshold")
    inside = lambda c: F.when(inner, c)
    return nodes.select("tree", F.col("id").alias("node"), inside(F.col("split.featureIndex")).alias("slot"),
                        inside(F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
                        inside(F.col("leftChild")).alias("left_node"), inside(F.col("rightChild")).alias("right_node"),
                        F.when(F.col("impurity") >= 0, F.col("impurity")).alias("impurity"), inside(F.col("gain")).alias("gain"), F.col("rawCount").alias("n_rows"), F.col("impurityStats").alias("class_weights"))


def _values(rows: DataFrame, features: str) -> Column:
    kind = dict(rows.dtypes)[features]
    return F.col(features) if kind.startswith("array") else vector_to_array(features)


def _sized(nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    return F.broadcast(nodes) if trees * 2 ** (depth + 1) <= BROADCAST_NODES else nodes


def route(rows: DataFrame, nodes: DataFrame, trees: int, depth: int, features: str = "features", keep: tuple[str, ...] = ("row_key",)) -> DataFrame:
    """(keep, tree, node, visited): the leaf that each row reaches in each tree, and all nodes on its way.

    One join with the node table for each level; no row is compared with more than one node a level.
    """
    inner = _sized(nodes.filter("slot IS NOT NULL").select("tree", "node", "slot", "threshold", "left_node", "right_node"), trees, depth)
    at = rows.select(*keep, _values(rows, features).alias("x_"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    at = at.select("*", F.lit(0).alias("node"), F.array(F.lit(0)).alias("visited"))
    for _ in range(depth):
        at = at.join(inner, ["tree", "node"], "left")
        to = F.when(F.get("x_", F.col("slot")) <= F.col("threshold"), F.col("left_node")).otherwise(F.col("right_node"))
        at = at.select(*keep, "x_", "tree", F.when(F.col("slot").isNull(), F.col("node")).otherwise(to).alias("node"),
                       F.when(F.col("slot").isNull(), F.col("visited")).otherwise(F.concat("visited", F.array(to))).alias("visited"))
    return at.select(*keep, "tree", "node", "visited")


def _class_columns(classes: int) -> list[str]:
    return [f"p{c}_" for c in range(classes)]


def _scored(sums: DataFrame, keep: tuple[str, ...], classes: int) -> DataFrame:
    """Class shares of the sums, the first of the largest as prediction, and the share of class 1 as score."""
    names = _class_columns(classes)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    shares = sums.select(*keep, F.array(*[F.col(n) / total for n in names]).alias("probability"))
    best = F.array_position("probability", F.array_max("probability")) - 1
    return shares.select(*keep, best.cast("double").alias("prediction"), "probability", F.get("probability", F.lit(1)).alias("score"))


def score_trees(rows: DataFrame, nodes: DataFrame, trees: int, depth: int, classes: int = 2, features: str = "features",
                keep: tuple[str, ...] = ("row_key", "label")) -> DataFrame:
    """(keep, prediction, probability, score) from the node table alone: leaves' class shares, averaged over the trees.

    ``keep`` must identify a row.
    """
    total = F.aggregate("class_weights", F.lit(0.0), lambda a, w: a + w)
    leaves = _sized(nodes.filter("slot IS NULL").select(
        "tree", "node", *[(F.col("class_weights")[c] / total).alias(n) for c, n in enumerate(_class_columns(classes))]), trees, depth)
    reached = route(rows, nodes, trees, depth, features, keep).drop("visited").join(leaves, ["tree", "node"])
    sums = reached.groupBy(*keep).agg(*[F.sum(n).alias(n) for n in _class_columns(classes)])
    return _scored(sums, keep, classes)


def _margin(terms: DataFrame, features: Column) -> Column:
    """Intercept plus the weighted sum of the slots; the terms, one for each slot, come as one array."""
    ordered = F.array(*[F.lit(r["weight"]) for r in terms.orderBy("slot").collect()])
    products = F.zip_with(F.concat(F.array(F.lit(1.0)), features), ordered, lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


def score_linear(rows: DataFrame, terms: DataFrame, features: str = "features", keep: tuple[str, ...] = ("row_key", "label")) -> DataFrame:
    """(keep, prediction, probability, score) of a binary logistic model from its terms."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin_")))
    margins = rows.select(*keep, _margin(terms, _values(rows, features)).alias("margin_"))
    scored = margins.select(*keep, p.alias("score"))
    return scored.select(*keep, (F.col("score") > 0.5).cast("double").alias("prediction"), F.array(1 - F.col("score"), F.col("score")).alias("probability"), "score")


def logistic_gradient(rows: DataFrame, terms: DataFrame, reg: float, weight: str = "class_weight", label: str = "label", features: str = "features") -> DataFrame:
    """(slot, weight, gradient): the derivative of the training objective by each term, at the terms.

    The objective is the weighted mean of the log loss plus ``reg / 2`` times the sum of squares of
    the terms in units of their slots' weighted standard deviations (the estimator's default); the
    intercept is free.  One aggregate over (slot, value) entries with partial sums; zero entries are
    not made.  At the optimum every derivative is zero.
    """
    w = F.col(weight).cast("double")
    residual = w * (F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(terms, F.col("x_")))) - F.col(label))
    prepared = rows.select(_values(rows, features).alias("x_"), F.col(weight), F.col(label)).select(
        "x_", w.alias("w_"), residual.alias("r_"))
    entries = prepared.select("w_", "r_", F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("x_"))).alias("place", "v_")).filter("v_ <> 0")
    sums = entries.groupBy((F.col("place") - 1).alias("slot")).agg(
        F.sum(F.col("r_") * F.col("v_")).alias("g"), F.sum(F.col("w_") * F.col("v_")).alias("s1"),
        F.sum(F.col("w_") * F.col("v_") * F.col("v_")).alias("s2"), F.sum(F.col("w_") * F.col("w_")).alias("ww"))
    whole = sums.filter(F.col("slot") == INTERCEPT).select(F.struct(F.col("s1").alias("w"), "ww").alias("t")).scalar()
    total, squares = whole.getField("w"), whole.getField("ww")
    variance = (F.col("s2") - F.col("s1") * F.col("s1") / total) / (total - squares / total)
    penalty = F.when(F.col("slot") == INTERCEPT, F.lit(0.0)).otherwise(reg * variance * F.col("weight"))
    held = terms.join(sums, "slot", "left")
    return held.select("slot", "weight", (F.coalesce(F.col("g"), F.lit(0.0)) / total + F.coalesce(penalty, F.lit(0.0))).alias("gradient"))


def gini(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    squares = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w * w)
    return F.when(total > 0, 1 - squares / (total * total)).otherwise(0.0)


def recount(rows: DataFrame, nodes: DataFrame, trees: int, depth: int, classes: int = 2, weight: str = "class_weight", label: str = "label",
            features: str = "features") -> DataFrame:
    """``nodes`` with ``seen_rows``, ``seen_weights`` and ``seen_impurity`` of the rows that reach each node."""
    reached = route(rows, nodes, trees, depth, features, (label, weight))
    visits = reached.select("tree", F.explode("visited").alias("node"), label, weight)
    by_class = [F.sum(F.when(F.col(label) == c, F.col(weight)).otherwise(0.0)).alias(n) for c, n in enumerate(_class_columns(classes))]
    seen = visits.groupBy("tree", "node").agg(F.count("*").alias("seen_rows"), *by_class)
    seen = seen.select("tree", "node", "seen_rows", F.array(*_class_columns(classes)).alias("seen_weights"))
    return nodes.join(seen, ["tree", "node"], "left").withColumn("seen_impurity", gini(F.col("seen_weights")))


def _differ(a: Column, b: Column, tolerance: float) -> Column:
    return F.coalesce(F.abs(a - b) > tolerance * F.greatest(F.lit(1.0), F.abs(a), F.abs(b)), F.lit(True))


def _weights_differ(a: str, b: str, tolerance: float) -> Column:
    return (F.size(a) != F.size(b)) | F.exists(F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b")), lambda z: _differ(z["a"], z["b"], tolerance))


def recount_faults(counted: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(tree, n_nodes, n_leaves, leaf_rows, leaf_weights, wrong_rows, wrong_weights, wrong_impurity) of a recounted tree table."""
    leaf = F.col("slot").isNull()
    known = F.col("seen_weights").isNotNull()
    return counted.groupBy("tree").agg(
        F.count("*").alias("n_nodes"), F.count_if(leaf).alias("n_leaves"), F.sum(F.when(leaf, F.col("seen_rows"))).alias("leaf_rows"),
        F.sum(F.when(leaf, F.aggregate("class_weights", F.lit(0.0), lambda a, w: a + w))).alias("leaf_weight"),
        F.count_if(~known | (F.col("seen_rows") != F.col("n_rows"))).alias("wrong_rows"),
        F.count_if(~known | _weights_differ("seen_weights", "class_weights", tolerance)).alias("wrong_weights"),
        F.count_if(F.col("impurity").isNotNull() & _differ(F.col("seen_impurity"), F.col("impurity"), tolerance)).alias("wrong_impurity"))


def node_faults(nodes: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(tree, n_inner, wrong_split, wrong_impurity, wrong_gain): nodes whose children do not split what they hold.

    Holds for every tree, also where the training rows were drawn with replacement.
    """
    child = nodes.select("tree", F.col("node").alias("child"), F.col("class_weights").alias("w"), F.coalesce("impurity", gini(F.col("class_weights"))).alias("i"))
    left, right = (child.select("tree", F.col("child").alias(f"{side}_node"), F.col("w").alias(f"{side}_w"), F.col("i").alias(f"{side}_i")) for side in ("left", "right"))
    both = nodes.filter("slot IS NOT NULL").join(left, ["tree", "left_node"], "left").join(right, ["tree", "right_node"], "left")
    added = F.zip_with("left_w", "right_w", lambda a, b: a + b)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, w: a + w)
    gain = F.col("impurity") - (total("left_w") * F.col("left_i") + total("right_w") * F.col("right_i")) / total("class_weights")
    faults = both.withColumn("added", added).groupBy("tree").agg(
        F.count("*").alias("n_inner"), F.count_if(F.col("added").isNull() | _weights_differ("added", "class_weights", tolerance)).alias("wrong_split"),
        F.count_if(_differ(gain, F.col("gain"), tolerance)).alias("wrong_gain"))
    impure = nodes.groupBy("tree").agg(F.count_if(F.col("impurity").isNotNull() & _differ(gini(F.col("class_weights")), F.col("impurity"), tolerance)).alias("wrong_impurity"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_inner", "wrong_split", "wrong_gain")]
    return impure.join(faults, "tree", "left").select("tree", *zero, "wrong_impurity")
