"""Column roles and constants of the encounter table.

The operators take column names as parameters; this dataclass bundles the
defaults so that a caller can pass one object instead of a dozen lists.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the values of the original job for equal
# results (column names, sentinels, thresholds, seeds, model parameters).
# ---------------------------------------------------------------------------
SENTINELS = ("?",)
ID_COLUMNS = ("encounter_id", "patient_nbr")
CRITICAL_COLUMNS = ("gender", "age", "readmitted")
INVALID_GENDER = "Unknown/Invalid"
TARGET_COLUMN = "readmitted"
POSITIVE_TARGET = "<30"
SPARSE_THRESHOLD = 0.40
CAP_QUANTILE = 0.99
AGE_BRACKETS = (
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
    "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
)  # ordinal = position + 1
HISTOGRAM_COLUMNS = ("time_in_hospital", "num_lab_procedures", "num_medications", "number_inpatient")
HISTOGRAM_BINS = 30
CORRELATION_COLUMNS = (
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
)
CATEGORICAL_COLUMNS = ("gender", "race", "max_glu_serum", "A1Cresult")
NUMERIC_COLUMNS = (
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
    "age_ordinal", "total_visits", "procedure_burden", "any_med_change", "on_diabetes_med",
)
NOISE_SEED = 2026          # age -> NULL uses 2026, race 2027, flips 2028/2029, stay 2030
NULL_RATE = 0.10
SENTINEL_RATE = 0.08
FLIP_RATE = 0.05
OUTLIER_RATE = 0.03
OUTLIER_VALUE = 999
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8
LR_PARAMS = {"maxIter": 20, "regParam": 0.01}
DT_PARAMS = {"maxDepth": 6, "seed": 42}
RF_PARAMS = {"numTrees": 50, "maxDepth": 8, "seed": 42}
CURVE_FRACTIONS = (0.25, 0.50, 0.75, 1.00)
CURVE_RF_PARAMS = {"numTrees": 20, "maxDepth": 6, "seed": 42}
# ---------------------------------------------------------------------------

# Our own choices (not from the original job).
ROW_KEY = "row_key"        # carried past the id drop for keyed split/sampling
CURVE_SAMPLE_SEED = 44     # must differ from SPLIT_SEED, see curve.py
VALID_MAX = (("time_in_hospital", 14),)   # known valid range; used only where a caller asks for it


@dataclass(frozen=True)
class EncounterSpec:
    key: str = "encounter_id"
    row_key: str = ROW_KEY
    sentinels: tuple = SENTINELS
    id_columns: tuple = ID_COLUMNS
    critical_columns: tuple = CRITICAL_COLUMNS
    category_column: str = "gender"
    invalid_category: str = INVALID_GENDER
    target: str = TARGET_COLUMN
    positive_target: str = POSITIVE_TARGET
    label: str = "label"
    sparse_threshold: float = SPARSE_THRESHOLD
    cap_columns: tuple = ("time_in_hospital",)
    cap_quantile: float = CAP_QUANTILE
    histogram_columns: tuple = HISTOGRAM_COLUMNS
    histogram_bins: int = HISTOGRAM_BINS
    correlation_columns: tuple = CORRELATION_COLUMNS
    categorical_columns: tuple = CATEGORICAL_COLUMNS
    numeric_columns: tuple = NUMERIC_COLUMNS
    noise_seed: int = NOISE_SEED
    split_seed: int = SPLIT_SEED
    train_fraction: float = TRAIN_FRACTION
    weight_col: str = "class_weight"


DEFAULT_SPEC = EncounterSpec()
