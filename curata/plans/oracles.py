"""DuckDB SQL oracles, one per exactly checkable query in the registry.

They are written from the operator definitions (not from the Spark plans)
over the same parquet tables; ``encounters`` is the shared CTE of
``curata.sources.encounters``.  Queries with model output (trees, fitted
coefficients, timings) have no oracle and are checked by rows and by the
property tests.
"""

from __future__ import annotations

from curata.functions.keyed import hash_uniform_sql as U
from curata.operators.classifiers import MODEL_ORDER
from curata.sources.encounters import with_encounters
from curata.spec import AGE_BRACKETS, CATEGORICAL_COLUMNS, CORRELATION_COLUMNS, CURVE_FRACTIONS, CURVE_SAMPLE_SEED, HISTOGRAM_COLUMNS, NUMERIC_COLUMNS, RF_PARAMS

D = "::DOUBLE"

# Columns of ``encounters`` and their kind (s = string, n = number).
ENC_COLUMNS = [
    ("encounter_id", "n"), ("patient_nbr", "n"), ("race", "s"), ("gender", "s"), ("age", "s"), ("weight", "s"),
    ("time_in_hospital", "n"), ("num_lab_procedures", "n"), ("num_procedures", "n"), ("num_medications", "n"),
    ("number_outpatient", "n"), ("number_emergency", "n"), ("number_inpatient", "n"), ("number_diagnoses", "n"),
    ("max_glu_serum", "s"), ("A1Cresult", "s"), ("change", "s"), ("diabetesMed", "s"), ("readmitted", "s"),
]
STRING_COLUMNS = [c for c, k in ENC_COLUMNS if k == "s"]


def _lt(seed: int, rate: float, key: str = "encounter_id") -> str:
    return f"{U(seed, key)} < {rate}{D}"


AGE_NULL = f"CASE WHEN {_lt(2026, 0.10)} THEN NULL ELSE age END"
RACE_Q = f"CASE WHEN {_lt(2027, 0.08)} THEN '?' ELSE race END"
FLIP = (f"CASE WHEN readmitted = '<30' AND {_lt(2028, 0.05)} THEN '>30' "
        f"WHEN readmitted = 'NO' AND {_lt(2029, 0.05)} THEN '<30' ELSE readmitted END")
STAY_999 = f"CAST(CASE WHEN {_lt(2030, 0.03)} THEN 999 ELSE time_in_hospital END AS INT)"

FAULTED = (f"faulted AS (SELECT * REPLACE ({AGE_NULL} AS age, {RACE_Q} AS race, {FLIP} AS readmitted, "
           f"{STAY_999} AS time_in_hospital) FROM encounters)")
C1 = "c1 AS (SELECT * REPLACE (" + ", ".join(f"NULLIF({c}, '?') AS {c}" for c in STRING_COLUMNS) + ") FROM faulted)"
# C2 on this table drops exactly `weight` (97% missing); C3 keeps encounter_id as row_key.
C3 = "c3 AS (SELECT * EXCLUDE (weight, encounter_id, patient_nbr), encounter_id AS row_key FROM c1)"
C4 = "c4 AS (SELECT * FROM c3 WHERE gender IS NOT NULL AND age IS NOT NULL AND readmitted IS NOT NULL)"
C5 = "c5 AS (SELECT * FROM c4 WHERE gender <> 'Unknown/Invalid')"
C6 = "c6 AS (SELECT * EXCLUDE (row_key), MIN(row_key) AS row_key FROM c5 GROUP BY ALL)"
C7 = ("c7 AS (SELECT * EXCLUDE (readmitted), CAST(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS INT) AS label "
      "FROM c6)")
C8 = ("c8 AS (SELECT c7.* REPLACE (CAST(CASE WHEN time_in_hospital > q.p THEN q.p ELSE time_in_hospital END AS DOUBLE) "
      "AS time_in_hospital) FROM c7, (SELECT quantile_disc(time_in_hospital, 0.99) AS p FROM c7) q)")
AGE_ORD = "CAST(CASE age " + " ".join(f"WHEN '{b}' THEN {i + 1}" for i, b in enumerate(AGE_BRACKETS)) + " END AS DOUBLE)"
TOTAL_VISITS = f"(number_outpatient{D} + number_emergency{D} + number_inpatient{D})"
BURDEN = f"(num_procedures{D} + num_lab_procedures{D})"
MED_CHANGE = f"CASE WHEN change = 'Ch' THEN 1.0{D} ELSE 0.0{D} END"
ON_MED = f"CASE WHEN diabetesMed = 'Yes' THEN 1.0{D} ELSE 0.0{D} END"
PREPARED = (f"prepared AS (SELECT * EXCLUDE (age), {AGE_ORD} AS age_ordinal, {TOTAL_VISITS} AS total_visits, "
            f"{BURDEN} AS procedure_burden, {MED_CHANGE} AS any_med_change, {ON_MED} AS on_diabetes_med FROM c8)")
TAGGED = (f"tagged AS (SELECT *, CASE WHEN {_lt(42, 0.8, 'row_key')} THEN 'train' ELSE 'test' END AS split "
          f"FROM prepared)")
TRAIN = "train AS (SELECT * FROM tagged WHERE split = 'train')"
CHAIN = [FAULTED, C1, C3, C4, C5, C6, C7, C8]
PREP_CHAIN = CHAIN + [PREPARED, TAGGED, TRAIN]
SCORED = (f"scored AS (SELECT encounter_id, CAST(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS INT) AS label, "
          f"COALESCE(number_outpatient, 0){D} / 10.0{D} AS score FROM encounters), "
          f"scored2 AS (SELECT *, CASE WHEN score >= 0.3{D} THEN 1.0{D} ELSE 0.0{D} END AS prediction FROM scored)")


def W(*ctes: str) -> str:
    return with_encounters(*ctes)


def _r(x: str, d: int = 6) -> str:
    return f"ROUND({x}, {d})"


# --- P ----------------------------------------------------------------------
def _missing_sql() -> str:
    parts = []
    for c, k in ENC_COLUMNS:
        cond = f"{c} IS NULL" + (f" OR {c} = '?'" if k == "s" else "")
        parts.append(f"SELECT '{c}' AS column_name, AVG(CASE WHEN {cond} THEN 1 ELSE 0 END{D}) AS r FROM encounters")
    return (W() + "SELECT column_name, ROUND(r, 6) AS missing_rate, r > 0.4" + D + " AS above_threshold FROM ("
            + " UNION ALL ".join(parts) + ") t WHERE r > 0")


def _hist_sql() -> str:
    """Bins by division, then corrected against the edges i * width + lo, as NumPy does."""
    parts = []
    for c in HISTOGRAM_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS column_name, {c}{D} AS x, CASE WHEN s.hi > s.lo THEN s.lo ELSE s.lo - 0.5{D} END AS lo, "
            f"CASE WHEN s.hi > s.lo THEN s.hi ELSE s.lo + 0.5{D} END AS hi "
            f"FROM encounters, (SELECT MIN({c}){D} AS lo, MAX({c}){D} AS hi FROM encounters) s WHERE {c} IS NOT NULL")
    return (W() + f"""
SELECT column_name, bin, ROUND(bin * w + lo, 6) AS bin_lo, ROUND(CASE WHEN bin = 29 THEN hi ELSE (bin + 1) * w + lo END, 6) AS bin_hi, COUNT(*) AS n FROM (
  SELECT column_name, lo, hi, w, CAST(CASE WHEN x < g * w + lo THEN g - 1 WHEN g < 29 AND x >= (g + 1) * w + lo THEN g + 1 ELSE g END AS INT) AS bin FROM (
    SELECT *, (hi - lo) / 30{D} AS w, LEAST(CAST(FLOOR((x - lo) / (hi - lo) * 30{D}) AS INT), 29) AS g FROM ({" UNION ALL ".join(parts)}) t) u) v
GROUP BY column_name, bin, lo, hi, w""")


def _corr_expr(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    xa, xb = f"CASE WHEN {both} THEN {a}{D} END", f"CASE WHEN {both} THEN {b}{D} END"
    return f"covar_pop({xa}, {xb}) / NULLIF(stddev_pop({xa}) * stddev_pop({xb}), 0)"


def _corr_cte() -> tuple[str, dict]:
    cols = list(CORRELATION_COLUMNS)
    names, exprs = {}, []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            k = f"r{len(exprs)}"
            names[(a, b)] = names[(b, a)] = k
            exprs.append(f"{_corr_expr(a, b)} AS {k}")
    return "corr AS (SELECT " + ", ".join(exprs) + " FROM encounters)", names


def _corr_long_sql() -> str:
    cte, names = _corr_cte()
    cols = list(CORRELATION_COLUMNS)
    # "+ 0.0" turns DuckDB's -0.0 after rounding into 0.0, as Spark returns
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND({names[(a, b)]}, 6) + 0.0{D} AS corr FROM corr"
             for a in cols for b in cols]
    return W(cte) + " UNION ALL ".join(parts)


def _corr_wide_sql() -> str:
    cte, names = _corr_cte()
    cols = list(CORRELATION_COLUMNS)
    parts = ["SELECT '" + a + "' AS feature, " + ", ".join(f"ROUND({names[(a, b)]}, 2) + 0.0{D} AS {b}" for b in cols) + " FROM corr"
             for a in cols]
    return W(cte) + " UNION ALL ".join(parts)


# --- N ----------------------------------------------------------------------
def _audit_sql() -> str:
    side = (f"side AS (SELECT age, race, readmitted, time_in_hospital, {AGE_NULL} AS age2, {RACE_Q} AS race2, "
            f"{FLIP} AS readmitted2, {STAY_999} AS time2 FROM encounters)")
    ch = ["age2 IS DISTINCT FROM age", "race2 IS DISTINCT FROM race", "readmitted2 IS DISTINCT FROM readmitted",
          "time2 IS DISTINCT FROM time_in_hospital"]
    mk = ["age2 IS NULL", "COALESCE(race2 = '?', false)", ch[2], "COALESCE(time2 = 999, false)"]
    pre = ["age IS NULL", "COALESCE(race = '?', false)", "false", "COALESCE(time_in_hospital = 999, false)"]
    names = [("null_injection", "age"), ("sentinel_injection", "race"), ("label_flip", "readmitted"),
             ("outlier_injection", "time_in_hospital")]
    rows = [(n, c, ch[i], mk[i], pre[i]) for i, (n, c) in enumerate(names)]
    rows.append(("any_fault", "*", " OR ".join(f"({x})" for x in ch), " OR ".join(f"({x})" for x in mk),
                 " OR ".join(f"({x})" for x in pre)))
    parts = [f"SELECT '{n}' AS fault, '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {a}) AS n_changed, "
             f"COUNT(*) FILTER (WHERE {m}) AS n_marked, COUNT(*) FILTER (WHERE {p}) AS n_preexisting FROM side"
             for n, c, a, m, p in rows]
    return (W(side) + "SELECT *, ROUND(n_changed * 100.0" + D + " / n_rows" + D + ", 2) AS changed_pct FROM ("
            + " UNION ALL ".join(parts) + ") t")


# --- C ----------------------------------------------------------------------
def _cleaning_audit_sql() -> str:
    # One scan path: group c3 by every non-key column once.  The filter flags
    # depend on grouping columns only, so the step counts are sums of group
    # sizes, and the dedup count is the number of valid groups.
    ok1 = "gender IS NOT NULL AND age IS NOT NULL AND readmitted IS NOT NULL"
    ok2 = ok1 + " AND gender <> 'Unknown/Invalid'"
    g = "g AS (SELECT * EXCLUDE (row_key), COUNT(*) AS cnt FROM c3 GROUP BY ALL)"
    agg = (f"agg AS (SELECT CAST(SUM(cnt) AS BIGINT) AS n0, CAST(SUM(cnt) FILTER (WHERE {ok1}) AS BIGINT) AS n1, "
           f"CAST(SUM(cnt) FILTER (WHERE {ok2}) AS BIGINT) AS n2, COUNT(*) FILTER (WHERE {ok2}) AS n3 FROM g)")
    return (W(FAULTED, C1, C3, g, agg) +
            "SELECT UNNEST([0, 1, 2, 3]) AS step_no, "
            "UNNEST(['input', 'drop_null_critical', 'drop_invalid_category', 'dedup_rows']) AS step, "
            "UNNEST([n0, n0, n1, n2]) AS rows_in, UNNEST([n0, n1, n2, n3]) AS rows_out FROM agg")


CAP = ("SELECT faulted.* REPLACE ("
       "CAST(CASE WHEN time_in_hospital > q.t THEN q.t ELSE time_in_hospital END AS DOUBLE) AS time_in_hospital, "
       "CAST(CASE WHEN num_lab_procedures > q.l THEN q.l ELSE num_lab_procedures END AS DOUBLE) AS num_lab_procedures) "
       "FROM faulted, (SELECT quantile_disc(time_in_hospital, 0.99) AS t, quantile_disc(num_lab_procedures, 0.99) AS l "
       "FROM faulted) q")


# --- X ----------------------------------------------------------------------
def _medians_cte() -> str:
    return "med AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in NUMERIC_COLUMNS) + " FROM train)"


def _imputed_cte() -> str:
    return ("imputed AS (SELECT t.row_key, t.split, " +
            ", ".join(f"COALESCE(t.{c}, med.{c}) AS {c}_imp" for c in NUMERIC_COLUMNS) + " FROM tagged t, med)")


def _label_ctes() -> list[str]:
    out = []
    for c in CATEGORICAL_COLUMNS:
        out.append(f"lab_{c} AS (SELECT {c} AS v, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS idx "
                   f"FROM train WHERE {c} IS NOT NULL GROUP BY {c})")
    out.append("nlab AS (SELECT " + ", ".join(f"(SELECT COUNT(*) FROM lab_{c}) AS {c}" for c in CATEGORICAL_COLUMNS) + ")")
    return out


def _indexed_sql() -> str:
    joins = " ".join(f"LEFT JOIN lab_{c} ON t.{c} = lab_{c}.v" for c in CATEGORICAL_COLUMNS)
    cols = ", ".join(f"CAST(COALESCE(lab_{c}.idx, nlab.{c}) AS DOUBLE) AS {c}_idx" for c in CATEGORICAL_COLUMNS)
    return W(*PREP_CHAIN, *_label_ctes()) + f"SELECT t.row_key, {cols} FROM tagged t CROSS JOIN nlab {joins}"


def _one_hot_sql() -> str:
    parts = [f"SELECT t.row_key, '{c}' AS column_name, CAST(nlab.{c} AS INT) AS vec_size, "
             f"CAST(lab_{c}.idx AS INT) AS hot_slot FROM tagged t CROSS JOIN nlab LEFT JOIN lab_{c} ON t.{c} = lab_{c}.v"
             for c in CATEGORICAL_COLUMNS]
    return W(*PREP_CHAIN, *_label_ctes()) + " UNION ALL ".join(parts)


def _assembled_sql() -> str:
    n_feat = f"CAST({len(NUMERIC_COLUMNS)} + " + " + ".join(f"nlab.{c}" for c in CATEGORICAL_COLUMNS) + " AS INT)"
    slots = ", ".join(f"ROUND(i.{c}_imp{D}, 6) AS f{k:02d}" for k, c in enumerate(NUMERIC_COLUMNS))
    return (W(*PREP_CHAIN, _medians_cte(), _imputed_cte(), *_label_ctes()) +
            f"SELECT i.row_key, {n_feat} AS n_features, {slots} FROM imputed i CROSS JOIN nlab")


def _scaled_sql() -> str:
    n_feat = f"CAST({len(NUMERIC_COLUMNS)} + " + " + ".join(f"nlab.{c}" for c in CATEGORICAL_COLUMNS) + " AS INT)"
    sd = ("sd AS (SELECT " + ", ".join(f"stddev_samp({c}_imp{D}) AS {c}" for c in NUMERIC_COLUMNS) +
          " FROM imputed WHERE split = 'train')")
    slots = ", ".join(
        f"ROUND(CASE WHEN sd.{c} IS NULL OR sd.{c} = 0 THEN 0.0{D} ELSE i.{c}_imp{D} * (1.0{D} / sd.{c}) END, 6) AS s{k:02d}"
        for k, c in enumerate(NUMERIC_COLUMNS))
    return (W(*PREP_CHAIN, _medians_cte(), _imputed_cte(), sd, *_label_ctes()) +
            f"SELECT i.row_key, {n_feat} AS n_features, {slots} FROM imputed i CROSS JOIN nlab CROSS JOIN sd")


# --- V ----------------------------------------------------------------------
CONF = ("conf AS (SELECT COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
        "COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
        "COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, "
        "COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, "
        "COUNT(*) FILTER (WHERE NOT COALESCE(label IN (0, 1) AND prediction IN (0, 1), false)) AS n_other FROM scored2)")


def _metrics_sql() -> str:
    c = (f"cd AS (SELECT tn{D} AS tn, fp{D} AS fp, fn{D} AS fn, tp{D} AS tp, (tn + fp + fn + tp) AS n_rows FROM conf), "
         f"pr AS (SELECT *, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS p1, COALESCE(tn / NULLIF(tn + fn, 0), 0) AS p0, "
         f"COALESCE(tp / NULLIF(tp + fn, 0), 0) AS r1, COALESCE(tn / NULLIF(tn + fp, 0), 0) AS r0, "
         f"(tp + fn) / NULLIF(n_rows{D}, 0) AS w1, (tn + fp) / NULLIF(n_rows{D}, 0) AS w0 FROM cd), "
         f"f AS (SELECT *, COALESCE(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0) AS f1_1, "
         f"COALESCE(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0) AS f1_0 FROM pr)")
    return (W(SCORED, CONF, c) +
            "SELECT n_rows, (SELECT n_other FROM conf) AS n_unclassified, ROUND((tp + tn) / NULLIF(n_rows" + D + ", 0), 6) AS accuracy, "
            "ROUND(w0 * f1_0 + w1 * f1_1, 6) AS f1, ROUND(w0 * p0 + w1 * p1, 6) AS weighted_precision, "
            "ROUND(w0 * r0 + w1 * r1, 6) AS weighted_recall FROM f")


def _auc_sql() -> str:
    g = ("g AS (SELECT score AS s, COUNT(*) FILTER (WHERE label = 1)" + D + " AS pos, "
         "COUNT(*) FILTER (WHERE label <> 1)" + D + " AS neg FROM scored2 WHERE score IS NOT NULL GROUP BY score), "
         "c AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
         "FROM g)")
    return (W(SCORED, g) + "SELECT ROUND(SUM(pos * (below + neg / 2.0" + D + ")) / NULLIF(SUM(pos) * SUM(neg), 0), 6) "
            "AS auc_roc, CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg, "
            "(SELECT COUNT(*) FROM scored2 WHERE score IS NULL OR label IS NULL) AS n_unscored FROM c")


def _curve_rows_sql() -> str:
    parts = [f"SELECT {f}{D} AS fraction, COUNT(*) FILTER (WHERE {_lt(44, f, 'row_key')}) AS n_rows, "
             f"COUNT(*) FILTER (WHERE {_lt(44, f, 'row_key')} AND {_lt(42, 0.8, 'row_key')}) AS n_train FROM prepared"
             for f in (0.25, 0.5, 0.75, 1.0)]
    return W(*CHAIN, PREPARED) + " UNION ALL ".join(parts)


def _column_nulls_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, AVG(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END{D}) AS r FROM c1" for c, _ in ENC_COLUMNS]
    return W(FAULTED, C1) + "SELECT column_name, ROUND(r, 6) AS null_share, r > 0.4" + D + " AS dropped FROM (" + " UNION ALL ".join(parts) + ") t"


def _models_sql(names) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS model" for n in names)


def _rule_board_sql() -> str:
    """Three thresholds of the fixed score as models, metrics by model from the definitions."""
    rules = " UNION ALL ".join(f"SELECT {i} AS position, '{n}' AS model, {t}{D} AS least" for i, n, t in ((1, "low rule", 0.2), (2, "middle rule", 0.3), (3, "same as middle", 0.3)))
    auc = ("g AS (SELECT score AS s, COUNT(*) FILTER (WHERE label = 1)" + D + " AS pos, COUNT(*) FILTER (WHERE label <> 1)" + D +
           " AS neg FROM scored2 GROUP BY score), "
           "below AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM g), "
           "auc AS (SELECT SUM(pos * (b + neg / 2.0" + D + ")) / NULLIF(SUM(pos) * SUM(neg), 0) AS auc_roc FROM below)")
    cells = (f"rules AS ({rules}), cells AS (SELECT position, model, label AS y, CASE WHEN score >= least THEN 1 ELSE 0 END AS p, COUNT(*){D} AS n "
             "FROM scored2 CROSS JOIN rules GROUP BY ALL), "
             "classes AS (SELECT position, model, c, SUM(CASE WHEN y = c THEN n ELSE 0 END) AS t, SUM(CASE WHEN y = c AND p = c THEN n ELSE 0 END) AS h, "
             "SUM(CASE WHEN p = c THEN n ELSE 0 END) AS q FROM cells CROSS JOIN (SELECT 0 AS c UNION ALL SELECT 1) k GROUP BY ALL), "
             "rates AS (SELECT *, COALESCE(h / NULLIF(q, 0), 0) AS pr, COALESCE(h / NULLIF(t, 0), 0) AS re FROM classes), "
             "scores AS (SELECT *, COALESCE(2 * pr * re / NULLIF(pr + re, 0), 0) AS fm FROM rates)")
    board = ("board AS (SELECT position, model, ROUND((SELECT auc_roc FROM auc), 4) AS auc_roc, ROUND(SUM(h) / SUM(t), 4) AS accuracy, "
             "ROUND(SUM(t * fm) / SUM(t), 4) AS f1, ROUND(SUM(t * pr) / SUM(t), 4) AS weighted_precision, ROUND(SUM(t * re) / SUM(t), 4) AS weighted_recall "
             "FROM scores GROUP BY position, model)")
    return W(SCORED, auc, cells, board)


# DuckDB 2.0.0 raises an internal "dict-surviving cache" error on this filter
# over the string columns of the view; an identity CASE on each string column
# (encounter_id is never NULL) avoids it without changing any value.
_FLAT = ", ".join(f"CASE WHEN encounter_id IS NULL THEN NULL ELSE {c} END AS {c}"
                  for c in STRING_COLUMNS if c != "age")

def _types_sql() -> str:
    """Counts of fields by the patterns of numbers; the other columns of this table are text."""
    numbers = {"num_medications": "CASE WHEN encounter_id % 7 = 0 THEN '?' ELSE CAST(num_medications AS VARCHAR) END",
               "number_diagnoses": "CASE WHEN encounter_id % 100 = 0 THEN 'n' || (encounter_id % 3) ELSE CAST(number_diagnoses AS VARCHAR) END"}
    fields = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {numbers.get(c, f'CAST({c} AS VARCHAR)')} AS field FROM faulted" for c, _ in ENC_COLUMNS)
    return W(FAULTED, f"fields AS (SELECT *, (field IS NULL OR field IN ('', '?')) AS missing FROM ({fields}))",
             "counts AS (SELECT column_name, COUNT(*) FILTER (WHERE NOT missing) AS n_values, COUNT(*) FILTER (WHERE missing) AS n_missing, "
             "COUNT(*) FILTER (WHERE NOT missing AND regexp_matches(field, '^[+-]?[0-9]{1,18}$')) AS n_bigint, "
             "COUNT(*) FILTER (WHERE NOT missing AND regexp_matches(field, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$')) AS n_double "
             "FROM fields GROUP BY column_name)",
             "typed AS (SELECT *, CASE WHEN n_values = 0 THEN 'string' WHEN n_values - n_bigint <= n_values * 0.02" + D + " THEN 'bigint' "
             "WHEN n_values - n_double <= n_values * 0.02" + D + " THEN 'double' ELSE 'string' END AS type FROM counts)")


def _curve_statistics_sql() -> str:
    samples = " UNION ALL ".join(f"SELECT {f}{D} AS fraction, * FROM train WHERE {_lt(CURVE_SAMPLE_SEED, f, 'row_key')}" for f in CURVE_FRACTIONS)
    labels = [f"SELECT fraction, '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS INT) AS n_labels, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS deviation "
              "FROM samples GROUP BY fraction" for c in CATEGORICAL_COLUMNS]
    numbers = [f"SELECT fraction, '{c}', CAST(NULL AS INT), ROUND(ANY_VALUE(m), 6), ROUND(STDDEV_SAMP(COALESCE({c}{D}, m)), 6) FROM "
               f"(SELECT fraction, {c}, quantile_disc({c}{D}, 0.5) OVER (PARTITION BY fraction) AS m FROM samples) GROUP BY fraction" for c in NUMERIC_COLUMNS]
    return W(*CHAIN, PREPARED, TAGGED, TRAIN, f"samples AS ({samples})") + " UNION ALL ".join(labels + numbers)


ORACLES: dict[str, str] = {
    "curve_statistics": _curve_statistics_sql(),
    "inferred_types": _types_sql() + (
        "SELECT *, CASE type WHEN 'bigint' THEN n_values - n_bigint WHEN 'double' THEN n_values - n_double ELSE 0 END AS n_bad FROM typed"),
    "bad_fields": _types_sql() + (
        "SELECT f.column_name, f.field, COUNT(*) AS n FROM fields f JOIN typed t ON t.column_name = f.column_name AND t.type = 'bigint' "
        "WHERE NOT f.missing AND NOT regexp_matches(f.field, '^[+-]?[0-9]{1,18}$') GROUP BY ALL"),
    "scan_encounters": W() + "SELECT * FROM encounters",
    "source_profile": W() + ("SELECT (SELECT COUNT(*) FROM encounters) AS n_rows, CAST(COUNT(DISTINCT name) AS INT) AS n_cols FROM "
                             "(SELECT COLUMNS(*)::VARCHAR FROM encounters LIMIT 1) UNPIVOT INCLUDE NULLS (v FOR name IN (COLUMNS(*)))"),
    "scan_csv": W(FAULTED, C1) + "SELECT * FROM c1",
    "csv_bad_fields": ("SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE o_orderkey % 7 = 0) AS n_bad, "
                       "CAST(SUM(o_custkey) FILTER (WHERE o_orderkey % 7 <> 0) AS BIGINT) AS total FROM orders"),
    "column_nulls": _column_nulls_sql(),
    "range_audit": W(FAULTED) + ("SELECT 'time_in_hospital' AS column_name, 14.0" + D + " AS valid_max, COUNT(*) AS n_rows, "
                                 "COUNT(*) FILTER (WHERE time_in_hospital > 14) AS n_over FROM faulted"),
    "patient_split": W() + f"SELECT encounter_id, patient_nbr, CASE WHEN {_lt(42, 0.8, 'patient_nbr')} THEN 'train' ELSE 'test' END AS split FROM encounters",
    "flipped_labels": W() + (f"SELECT CAST(readmitted = '<30' AS INT) AS clean_label, CAST(({FLIP}) = '<30' AS INT) AS label, COUNT(*) AS n "
                             "FROM encounters GROUP BY ALL"),
    "preprocess_pipeline": W(*PREP_CHAIN, *_label_ctes()) + (
        f"SELECT row_key, split, label, CAST({len(NUMERIC_COLUMNS)} + " + " + ".join(f"nlab.{c}" for c in CATEGORICAL_COLUMNS) +
        " AS INT) AS n_features FROM tagged CROSS JOIN nlab"),
    "scored_test_keys": W(*CHAIN, PREPARED, TAGGED) + (
        f"SELECT m.model, row_key, label, CAST(2 AS INT) AS n_raw, 1.0{D} AS total_probability FROM tagged CROSS JOIN ({_models_sql(MODEL_ORDER)}) m WHERE split = 'test'"),
    "importance_totals": W(*PREP_CHAIN, *_label_ctes()) + (
        f"SELECT m.model, CAST({len(NUMERIC_COLUMNS)} + " + " + ".join(f"nlab.{c}" for c in CATEGORICAL_COLUMNS) +
        f" AS INT) AS n_features, 1.0{D} AS total_importance FROM nlab CROSS JOIN ({_models_sql(MODEL_ORDER[1:])}) m"),
    "model_test_rows": W(*CHAIN, PREPARED, TAGGED) + (
        f"SELECT m.model, label, COUNT(*) AS n FROM tagged CROSS JOIN ({_models_sql(MODEL_ORDER)}) m WHERE split = 'test' GROUP BY ALL"),
    "logistic_gradient": W(*PREP_CHAIN, *_label_ctes()) + (
        f"SELECT CAST(unnest(range(-1, {len(NUMERIC_COLUMNS)} + " + " + ".join(f"nlab.{c}" for c in CATEGORICAL_COLUMNS) + ")) AS INT) AS slot, TRUE AS at_optimum FROM nlab"),
    "tree_recount": W(*PREP_CHAIN) + (
        "SELECT m.model, CAST(m.tree AS INT) AS tree, COUNT(*) AS leaf_rows, ROUND(2.0" + D + " * COUNT(*) FILTER (WHERE label = 0), 6) AS leaf_weight, "
        "CAST(0 AS BIGINT) AS wrong_rows, CAST(0 AS BIGINT) AS wrong_weights, CAST(0 AS BIGINT) AS wrong_impurity FROM train "
        "CROSS JOIN (SELECT 'Decision Tree' AS model, 0 AS tree UNION ALL SELECT 'plain forest', unnest(range(10))) m GROUP BY m.model, m.tree"),
    "node_faults": (
        "SELECT model, CAST(tree AS INT) AS tree, CAST(0 AS BIGINT) AS wrong_split, CAST(0 AS BIGINT) AS wrong_impurity, CAST(0 AS BIGINT) AS wrong_gain "
        f"FROM (SELECT 'Decision Tree' AS model, 0 AS tree UNION ALL SELECT 'Random Forest', unnest(range({RF_PARAMS['numTrees']})))"),
    "table_scores": W(*CHAIN, PREPARED, TAGGED) + (
        f"SELECT m.model, row_key, label, TRUE AS same_class, TRUE AS same_probability FROM tagged CROSS JOIN ({_models_sql(MODEL_ORDER)}) m WHERE split = 'test'"),
    "rule_leaderboard": _rule_board_sql() + "SELECT * FROM board",
    "rule_best_model": _rule_board_sql() + "SELECT * FROM board ORDER BY f1 DESC, position LIMIT 1",
    "rule_metric_comparison": _rule_board_sql() + "SELECT position, model, metric, value FROM (UNPIVOT board ON auc_roc, accuracy, f1, weighted_precision, weighted_recall INTO NAME metric VALUE value)",
    "class_distribution": W() + ("SELECT readmitted, COUNT(*) AS n, ROUND(COUNT(*) * 100.0" + D +
                                 " / SUM(COUNT(*)) OVER ()" + D + ", 1) AS pct FROM encounters GROUP BY readmitted"),
    "age_distribution": W() + "SELECT age, COUNT(*) AS n FROM encounters GROUP BY age",
    "missing_rate": _missing_sql(),
    "numeric_histogram": _hist_sql(),
    "histogram_by_rows": _hist_sql(),
    "column_quantiles": W() + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, " + ", ".join(f"quantile_disc({c}, {q}){D} AS q{round(100 * q)}" for q in (0.25, 0.5, 0.75)) + " FROM encounters" for c in HISTOGRAM_COLUMNS),
    "value_ranks": W() + (
        "SELECT value, n, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, value) - 1 AS BIGINT) AS rank FROM "
        "(SELECT CAST(patient_nbr AS VARCHAR) AS value, COUNT(*) AS n FROM encounters GROUP BY ALL)"),
    "index_by_ranks": W("kept AS (SELECT encounter_id, CASE WHEN patient_nbr % 2 = 0 THEN CAST(patient_nbr AS VARCHAR) END AS patient FROM encounters)",
                        "ranks AS (SELECT patient, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, patient) - 1 AS rank FROM kept WHERE patient IS NOT NULL GROUP BY patient)") + (
        "SELECT encounter_id, kept.patient, CAST(COALESCE(rank, (SELECT COUNT(*) FROM ranks)) AS DOUBLE) AS patient_idx FROM kept LEFT JOIN ranks ON kept.patient = ranks.patient"),
    "correlation_matrix": _corr_long_sql(),
    "correlation_heatmap": _corr_wide_sql(),
    "inject_nulls": W() + f"SELECT * REPLACE ({AGE_NULL} AS age) FROM encounters",
    "inject_sentinel": W() + f"SELECT * REPLACE ({RACE_Q} AS race) FROM encounters",
    "flip_labels": W() + f"SELECT * REPLACE ({FLIP} AS readmitted) FROM encounters",
    "inject_outliers": W() + f"SELECT * REPLACE ({STAY_999} AS time_in_hospital) FROM encounters",
    "noise_audit": _audit_sql(),
    "clean_sentinels": W(FAULTED, C1) + "SELECT * FROM c1",
    "drop_sparse_columns": W(FAULTED, C1) + "SELECT * EXCLUDE (weight) FROM c1",
    "drop_identifiers": W() + "SELECT * EXCLUDE (encounter_id, patient_nbr), encounter_id AS row_key FROM encounters",
    "drop_null_critical": W() + (f"SELECT * FROM (SELECT * REPLACE ({AGE_NULL} AS age, {_FLAT}) FROM encounters) t "
                                 "WHERE gender IS NOT NULL AND age IS NOT NULL AND readmitted IS NOT NULL"),
    "drop_invalid_category": W() + "SELECT * FROM encounters WHERE gender <> 'Unknown/Invalid'",
    "dedup_rows": W() + ("SELECT gender, age, race, time_in_hospital, readmitted, MIN(encounter_id) AS row_key "
                         "FROM encounters GROUP BY ALL"),
    "encode_target": W() + ("SELECT * EXCLUDE (readmitted), CAST(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS INT) "
                            "AS label FROM encounters"),
    "cap_outliers": W(FAULTED) + CAP,
    "cleaning_audit": _cleaning_audit_sql(),
    "clean_pipeline": W(*CHAIN) + "SELECT * FROM c8",
    "feature_age_ordinal": W() + f"SELECT * EXCLUDE (age), {AGE_ORD} AS age_ordinal FROM encounters",
    "feature_total_visits": W() + f"SELECT *, {TOTAL_VISITS} AS total_visits FROM encounters",
    "feature_procedure_burden": W() + f"SELECT *, {BURDEN} AS procedure_burden FROM encounters",
    "feature_flags": W() + f"SELECT *, {MED_CHANGE} AS any_med_change, {ON_MED} AS on_diabetes_med FROM encounters",
    "feature_table": W(*CHAIN, PREPARED) + "SELECT * FROM prepared",
    "train_test_split": W(*CHAIN, PREPARED, TAGGED) + "SELECT * FROM tagged",
    "class_weights": W(*PREP_CHAIN) + (
        "SELECT row_key, label, ROUND(CASE WHEN label = 1 THEN r.ratio ELSE 1.0" + D + " END, 6) AS class_weight, "
        "ROUND(r.ratio, 6) AS balance_ratio FROM train, (SELECT CASE WHEN COUNT(*) FILTER (WHERE label = 1) = 0 THEN 1.0"
        + D + " ELSE COUNT(*) FILTER (WHERE label = 0)" + D + " / COUNT(*) FILTER (WHERE label = 1) END AS ratio FROM train) r"),
    "impute_median": W(*PREP_CHAIN, _medians_cte(), _imputed_cte()) + "SELECT * FROM imputed",
    "string_index": _indexed_sql(),
    "one_hot": _one_hot_sql(),
    "assemble_features": _assembled_sql(),
    "scale_features": _scaled_sql(),
    "auc_roc": _auc_sql(),
    "classification_metrics": _metrics_sql(),
    "confusion_matrix": W(SCORED, CONF) + "SELECT tn, fp, fn, tp, n_other FROM conf",
    "learning_curve_rows": _curve_rows_sql(),
}
