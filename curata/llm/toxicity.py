"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression (operator 7).

Features of a whole text: densities and counts of lexicon hits (whole words and word beginnings, in
tiers of strength), hits close to second-person words, capitals, exclamation and repeated
punctuation, obfuscated words, and lexicon hits that appear only after obfuscation is undone.

The lexicon is learned: word and beginning counts in toxic and other labelled texts, kept by their
log odds.  Lexicon, trees and calibration are fitted on disjoint parts of a bounded sample of
labelled rows: at most about ``SAMPLE`` rows of each class, drawn by a hash of the key, and at most
``LEXICON`` entries.  These bounds do not depend on the input size.

Defined results
* NULL and empty texts are scored from their (zero) features like any other text.
* Without labelled rows, or with labels of one class only, every score is that class (0.0 without any).
* Several labels of one key: the largest counts.  NULL labels and keys are not learned from.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import materialise

SAMPLE = 6_000
LEXICON = 4_000
SUPPORT = 3                     # toxic texts that an entry must occur in
BEGINNINGS = (4, 5, 6)
TIERS = (0.5, 1.5, 2.7, 4.0)    # least log odds, less 1.5 standard errors
NEAR = 5                        # words on either side
TREES, DEPTH = 30, 4
#: Parts of the sample by a hash of the key, in hundredths: lexicon, trees, calibration.
PARTS = (50, 80, 100)

#: Second-person words of the common languages.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch vous votre vos toi ton tu te tes usted ustedes vosotros ti".split())
_UNDO = str.maketrans("013457@$!", "oieastasi")
_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"[^\W\d_]+[\d@$!*.\-][\w@$!*.\-]*[^\W\d_]")
_RUN = re.compile(r"[!?]{2,}")


def entries(word: str) -> list[str]:
    """What a word counts for: itself (marked by a blank) and its beginnings."""
    return [f"{word} ", *[word[:n] for n in BEGINNINGS if len(word) > n]]


def featurise(text: str | None, lexicon: dict[str, int]) -> list[float]:
    """Dense features of a whole text; ``lexicon`` gives an entry's tier."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    hits, places = [0] * (2 * len(TIERS)), []
    for at, w in enumerate(words):
        tier = lexicon.get(w + " ")
        if tier is not None:
            hits[tier] += 1
        best = max((lexicon.get(w[:k], -1) for k in BEGINNINGS if len(w) > k), default=-1)
        if best >= 0:
            hits[len(TIERS) + best] += 1
        if best > 0 or (tier or 0) > 0:
            places.append(at)
    near = 0
    if places:
        second = [at for at, w in enumerate(words) if w in SECOND_PERSON]
        marks = {at + d for at in second for d in range(-NEAR, NEAR + 1)}
        near = sum(at in marks for at in places)
    mixed = _MIXED.findall(text)
    undone = 0
    for w in mixed:
        plain = re.sub(r"[^\w]", "", w.lower().translate(_UNDO))
        undone += (plain + " ") in lexicon
    letters = sum(map(str.isalpha, text)) if len(text) < 200 else sum(map(len, words))
    upper = sum(1 for c in text if "A" <= c <= "Z") if len(text) < 200 else len(re.findall(r"[A-Z]", text))
    size = max(1, len(text))
    return [math.log1p(len(words)), *[h / n for h in hits], *[math.log1p(h) for h in hits], math.log1p(near), near / n,
            upper / max(1, letters), (text.count("!") + text.count("?")) / size, len(_RUN.findall(text)) / n,
            len(mixed) / n, math.log1p(undone)]


def features(lexicon: dict[str, int], text: str = "text"):
    @F.pandas_udf("array<double>")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([featurise(t, lexicon) for t in texts])

    return make(F.col(text).cast("string"))


def _sample(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str) -> DataFrame:
    """(part, text, label) of the drawn labelled rows; the drawn keys are few and go to all executors."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg((F.max(label) > 0).cast("int").alias("label"))
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "k"), F.lit(1_000_003))
    limit = F.when(F.col("label") == 1, math.ceil(1_000_003 * min(1.0, SAMPLE / n.get(1, 1)))).otherwise(math.ceil(1_000_003 * min(1.0, SAMPLE / n.get(0, 1))))
    # what the draw thins out is made up for by weight, so that scores keep the labels' base rate
    weight = F.when(F.col("label") == 1, max(1.0, n.get(1, 1) / SAMPLE)).otherwise(max(1.0, n.get(0, 1) / SAMPLE))
    drawn = known.filter(draw < limit).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "k"), F.lit(100))).withColumn("weight", weight)
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text"))
    return rows.join(F.broadcast(drawn), "k").select("part", "text", "label", "weight")


def _counts(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """Texts and occurrences of each entry; with ``wanted`` only these entries are counted."""

    def as_rows(texts: Counter, uses: Counter) -> pa.RecordBatch:
        names = list(uses)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([texts[e] for e in names], pa.int64()), pa.array([uses[e] for e in names], pa.int64())],
                                          ["entry", "texts", "uses"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, uses = Counter(), Counter()
        for batch in batches:
            for t in batch.column("text"):
                own = Counter(e for w in _WORD.findall((t.as_py() or "").lower()) for e in entries(w) if wanted is None or e in wanted)
                texts.update(own.keys())
                uses.update(own)
                if len(uses) > 500_000:
                    yield as_rows(texts, uses)
                    texts, uses = Counter(), Counter()
        yield as_rows(texts, uses)

    return rows.select("text").mapInArrow(count, "entry string, texts long, uses long").groupBy("entry").agg(F.sum("texts").alias("texts"), F.sum("uses").alias("uses"))


def learn_lexicon(rows: DataFrame) -> dict[str, int]:
    """Entry -> tier from labelled texts (text, label): at most ``LEXICON`` entries leave the executors."""
    sizes = {r["label"]: (r["n"], r["w"]) for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("w")).collect()}
    toxic_size, other_size = (max(1, sizes.get(k, (0, 0))[1] or 0) for k in (1, 0))
    common = _counts(rows.filter("label = 1"), None).filter(F.col("texts") >= SUPPORT)
    top = common.orderBy(F.desc("texts"), "entry").limit(5 * LEXICON).collect()
    found = {r["entry"]: (r["texts"], r["uses"]) for r in top}
    if not found:
        return {}
    other = {r["entry"]: r["uses"] for r in _counts(rows.filter("label = 0"), frozenset(found)).collect()}
    strength = {}
    for e, (texts, uses) in found.items():
        a, b = uses + 0.5, other.get(e, 0) + 0.5
        odds = math.log(a / toxic_size) - math.log(b / other_size) - 1.5 * math.sqrt(1 / a + 1 / b)
        if odds >= TIERS[0]:
            strength[e] = (odds, texts)
    kept = sorted(strength, key=lambda e: (-strength[e][0] * math.log1p(strength[e][1]), e))[:LEXICON]
    return {e: max(i for i, least in enumerate(TIERS) if strength[e][0] >= least) for e in kept}


@dataclass
class ToxicityModel:
    lexicon: dict[str, int]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float = 0.0

    def score(self, docs: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
        """Add the calibrated score of every text as ``out``."""
        if out in docs.columns:
            raise ValueError(f"the input has a column {out}")
        if self.trees is None:
            return docs.withColumn(out, F.lit(self.constant))
        held = docs.select(F.struct("*").alias("row_"), array_to_vector(features(self.lexicon, text)).alias("features"))
        scored = self.trees.transform(held).select("row_", vector_to_array("probability")[1].alias("raw_"))
        if self.calibration is not None:
            # a little of the raw score keeps the order inside the steps of the calibration
            scored = self.calibration.setFeaturesCol("raw_").setPredictionCol("step_").transform(scored)
            scored = scored.withColumn("raw_", 0.98 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("step_"))) + 0.02 * F.col("raw_"))
        return scored.select("row_.*", F.col("raw_").alias(out))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> ToxicityModel:
    rows = materialise(_sample(docs, labels, text, key, label), "toxicity-sample")
    classes = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(classes) < 2:
        return ToxicityModel({}, None, None, float(max(classes, default=0)))
    lexicon = learn_lexicon(rows.filter(F.col("part") < PARTS[0]))
    table = materialise(rows.select("part", F.col("label").cast("double").alias("label"), "weight", features(lexicon).alias("x")), "toxicity-features")
    table = table.select("part", "label", "weight", array_to_vector("x").alias("features")).coalesce(4)
    train, held = table.filter((F.col("part") >= PARTS[0]) & (F.col("part") < PARTS[1])), table.filter(F.col("part") >= PARTS[1])
    if train.select("label").distinct().count() < 2:
        train = table
    trees = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, subsamplingRate=0.8,
                          minInstancesPerNode=3).fit(train)
    held = trees.transform(held).select("label", "weight", vector_to_array("probability")[1].alias("raw"))
    calibration = None
    if held.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(labelCol="label", featuresCol="raw", weightCol="weight").fit(held)
    return ToxicityModel(lexicon, trees, calibration)
