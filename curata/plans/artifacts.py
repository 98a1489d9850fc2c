"""The encounter pipeline as the original runs it, built once per session
and data folder: corrupt -> clean -> derive -> split -> weight -> fit the
preprocessing once -> fit three classifiers on the persisted vectors.

The prepared table and the vectors are persisted (memory and disk).  All
steps are deterministic (keyed draws, min-key dedup, exact quantiles), so a
block lost with an executor is recomputed to the same rows.
"""

from __future__ import annotations

import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators import classifiers as clf
from curata.operators.cleaning import CountedRows, clean
from curata.operators.evaluation import evaluate
from curata.operators.faults import inject_faults
from curata.operators.features import engineer_features
from curata.operators.model_tables import tree_table
from curata.operators.preprocess import fit_preprocessing
from curata.operators.sampling import add_class_weights, tag_split
from curata.session import checkpoint_dir
from curata.sources.encounters import encounters
from curata.sources.sinks import in_parts, persist, written_table
from curata.spec import DEFAULT_SPEC, VALID_MAX, EncounterSpec


#: Rows of a partition of the prepared table; as vectors and as a forest's training points a row takes about 0.2 and 0.4 KB,
#: and a task that reads a persisted partition from disk holds it whole beside what Spark's memory manager counts.
ROWS_PER_PART = 200_000
#: Up to so many rows the classifiers are fitted concurrently, as series of small jobs; beyond, one fit fills the cores.
CONCURRENT_ROWS = 1_000_000


def prepared_table(spark: SparkSession, sf_dir: str, spec: EncounterSpec = DEFAULT_SPEC, faults: bool = True,
                   valid_max: float | None = None, counted: CountedRows | None = None) -> DataFrame:
    """encounters -> (faults) -> clean -> features."""
    return engineer_features(clean(source_table(spark, sf_dir, spec, faults), spec, valid_max=valid_max, counted=counted))


def source_table(spark: SparkSession, sf_dir: str, spec: EncounterSpec = DEFAULT_SPEC, faults: bool = True) -> DataFrame:
    df = encounters(spark, sf_dir)
    return inject_faults(df, spec) if faults else df


class Artifacts:
    """Tables and models of one run.  Persisted tables are released by ``release``.

    With ``models_only`` the prepared rows are released as soon as the vectors are there: nothing else of such a run reads them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, spec: EncounterSpec = DEFAULT_SPEC, faults: bool = True, valid_max: float | None = None,
                 counted: CountedRows | None = None, models_only: bool = False):
        self.spark, self.sf_dir, self.spec, self.faults, self.valid_max = spark, sf_dir, spec, faults, valid_max
        self.models_only = models_only
        self.fit_seconds: dict[str, float] = {}
        self.score_seconds: dict[str, float] = {}
        self._held: list[DataFrame] = []
        self._models: dict = {}
        self._preds: dict[str, DataFrame] = {}
        self._nodes: dict[str, DataFrame] = {}
        if counted is not None:
            self.counted = counted      # another run's, of the same source
        self._locks = {name: threading.Lock() for name in clf.MODEL_ORDER}

    def _keep(self, df: DataFrame) -> DataFrame:
        self._held.append(persist(df))
        return df

    def release(self) -> None:
        """Unpersist every table of this run; it is made again if asked for."""
        for df in self._held:
            df.unpersist()
        self._held.clear()
        self._preds.clear()
        for name in ("counted", "prepared", "tagged", "weighted_train", "transformed", "vectors"):
            self.__dict__.pop(name, None)

    @cached_property
    def counted(self) -> CountedRows:
        """The counted rows that cleaning and its audit share; written, not persisted."""
        return CountedRows.build(source_table(self.spark, self.sf_dir, self.spec, self.faults), self.spec)

    @cached_property
    def prepared(self) -> DataFrame:
        return self.tagged.drop("split")

    @cached_property
    def tagged(self) -> DataFrame:
        """The prepared rows and their side of the split, persisted as one table: the draw is made once, not in every pass."""
        s = self.spec
        rows = prepared_table(self.spark, self.sf_dir, s, self.faults, self.valid_max, self.counted)
        return self._keep(tag_split(in_parts(rows, ROWS_PER_PART), s.row_key, s.train_fraction, s.split_seed))

    @cached_property
    def weighted_train(self) -> tuple[DataFrame, float]:
        train = self.tagged.where(F.col("split") == "train")
        return add_class_weights(train, self.spec.label, self.spec.weight_col)

    @cached_property
    def prep_model(self):
        return fit_preprocessing(self.weighted_train[0], self.spec)

    @cached_property
    def transformed(self) -> DataFrame:
        """All rows (train and test) through the fitted preprocessing; a projection of the persisted rows."""
        return self.prep_model.transform(self.tagged)

    @cached_property
    def vectors(self) -> DataFrame:
        """The one cached table of vectors: key, split, label, weight, features."""
        s = self.spec
        ratio = self.weighted_train[1]
        weight = F.when(F.col(s.label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0))
        return self._keep(self.transformed.select(s.row_key, "split", s.label, weight.alias(s.weight_col), "features"))

    @property
    def train_vectors(self) -> DataFrame:
        return self.vectors.where(F.col("split") == "train")

    @property
    def test_vectors(self) -> DataFrame:
        return self.vectors.where(F.col("split") == "test")

    def model(self, name: str):
        with self._locks[name]:
            if name not in self._models:
                est = clf.classifiers(self.spec.weight_col)[name]
                self._models[name], self.fit_seconds[name] = clf.fit_timed(est, self.train_vectors)
        return self._models[name]

    def fit_all(self, parallelism: int | None = None) -> None:
        """Fit the classifiers on the shared persisted vectors, ``parallelism`` at
        a time (as CrossValidator does).  Without it, all three up to
        ``CONCURRENT_ROWS`` rows, where a fit is a series of small jobs, and one
        beyond, so that the learners' own tables are not held beside each other."""
        rows = self.vectors.count()
        if self.models_only:
            self.tagged.unpersist()
        if parallelism is None:
            parallelism = 3 if rows <= CONCURRENT_ROWS else 1
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(self.model, clf.MODEL_ORDER))

    def nodes(self, name: str) -> DataFrame:
        """The node table of a tree model, saved in the checkpoint folder."""
        if name not in self._nodes:
            self._nodes[name] = tree_table(self.spark, self.model(name), f"{checkpoint_dir(self.spark).rstrip('/')}/model-{uuid.uuid4().hex}")
        return self._nodes[name]

    def predictions(self, name: str) -> DataFrame:
        """Scored test rows of one model; scored once, timed apart from the fit."""
        if name not in self._preds:
            model = self.model(name)
            start = time.perf_counter()
            self._preds[name] = self._keep(clf.score(model, self.test_vectors))
            self._preds[name].count()
            self.score_seconds[name] = time.perf_counter() - start
        return self._preds[name]

    def all_predictions(self) -> DataFrame:
        """Scored test rows of all models with the model's name."""
        self.fit_all()
        out = None
        for name in clf.MODEL_ORDER:
            rows = self.predictions(name).select(F.lit(name).alias("model"), "*")
            out = rows if out is None else out.unionByName(rows)
        return out

    def metrics_row(self, name: str) -> DataFrame:
        pos = clf.MODEL_ORDER.index(name) + 1
        return evaluate(self.predictions(name), self.spec.label, "prediction", "score").select(
            F.lit(pos).alias("position"), F.lit(name).alias("model"),
            "auc_roc", "accuracy", "f1", "weighted_precision", "weighted_recall")

    def leaderboard_rows(self) -> DataFrame:
        out = None
        self.fit_all()
        for name in clf.MODEL_ORDER:
            row = self.metrics_row(name)
            out = row if out is None else out.unionByName(row)
        return out


#: The variants of the resilience table: (name, faults injected, valid range applied).
VARIANTS = (("clean", False, False), ("corrupted_then_cleaned", True, False), ("corrupted_then_cleaned_valid_range", True, True))


def resilience(spark: SparkSession, sf_dir: str, spec: EncounterSpec = DEFAULT_SPEC) -> DataFrame:
    """Metrics of every classifier on clean input, on corrupted-then-cleaned
    input, and with values beyond the known valid range set to NULL first."""
    limit = dict(VALID_MAX)[spec.cap_columns[0]]
    out = None
    source = written_table(encounters(spark, sf_dir), "encounters")
    counted = {}
    for variant, faults, ranged in VARIANTS:
        if faults not in counted:       # the valid range is applied after the rows are counted
            counted[faults] = CountedRows.build(inject_faults(source, spec) if faults else source, spec)
        run = Artifacts(spark, sf_dir, spec, faults, limit if ranged else None, counted[faults], models_only=True)
        rows = [(variant, *r) for r in run.leaderboard_rows().collect()]
        run.release()
        out = rows if out is None else out + rows
    return spark.createDataFrame(out, "variant string, position int, model string, auc_roc double, accuracy double, f1 double, "
                                      "weighted_precision double, weighted_recall double")


_lock = threading.Lock()
_memo: dict[tuple, tuple[tuple, Artifacts]] = {}


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """Paths, sizes and times of the source files."""
    out = []
    for name in ("orders", "customer", "lineitem"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def artifacts(spark: SparkSession, sf_dir: str, spec: EncounterSpec = DEFAULT_SPEC) -> Artifacts:
    """The run over a folder in this session; a new one, with the old one released, once its files have changed."""
    key, files = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), spec), _files(spark, sf_dir)
    with _lock:
        for old in [k for k in _memo if k[0] != key[0]]:
            del _memo[old]
        held = _memo.get(key)
        if held is None or held[0] != files:
            if held:
                held[1].release()
            _memo[key] = (files, Artifacts(spark, sf_dir, spec))
        return _memo[key][1]
