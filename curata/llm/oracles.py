"""DuckDB SQL for the training-data queries that SQL can express, written from the plain patterns."""

from __future__ import annotations

from curata.llm import blob_ledger, personal_data


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(kind: str, place: int, pattern: str, keep: str, extra: str = "") -> str:
    """Rows (doc_id, kind, place, s, e, m, before_m, after_m) of one kind; ``keep`` filters by m."""
    rx = _quoted(pattern)
    return f"""
SELECT doc_id, '{kind}' AS kind, {place} AS place, e - length(m) AS s, e, m, before_m, after_m FROM (
  SELECT doc_id, m, before_m, after_m,
         CAST(sum(length(before_m) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS e
  FROM (SELECT doc_id, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(pieces[:len(ms)]) AS before_m, unnest(pieces[2:]) AS after_m FROM (
    SELECT doc_id, regexp_extract_all(t, {rx}) AS ms, string_split_regex(t, {rx}) AS pieces
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))))
WHERE {keep}"""


def _digits(m: str = "m") -> str:
    return f"regexp_replace({m}, '[^0-9]', '', 'g')"


_LUHN = f"""(length({_digits()}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_digits()}) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN CAST(reverse({_digits()})[i] AS INT)
       ELSE CAST(reverse({_digits()})[i] AS INT) * 2 - CASE WHEN CAST(reverse({_digits()})[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0)"""

_MOVED = "(substr(m, 5) || substr(m, 1, 4))"
#: An account number of 34 characters may have 68 digits: the check value is carried over digit by digit.
_MOD97 = f"""(length(m) BETWEEN 15 AND 34 AND list_reduce(list_transform(string_split(array_to_string(list_transform(string_split({_MOVED}, ''), lambda c:
  CASE WHEN regexp_matches(c, '[0-9]') THEN c ELSE CAST(ord(c) - 55 AS VARCHAR) END), ''), ''), lambda d: CAST(d AS INT)), lambda a, d: (a * 10 + d) % 97) = 1)"""

_KEEP = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(nullif(ltrim(p, '0'), '') AS INT), 0) > 255)) = 0",
    "card": _LUHN,
    "phone": f"length({_digits()}) BETWEEN 9 AND 15",
    "iban": _MOD97,
}


def _joined(order: str, where: str = "true") -> str:
    return f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY {order}) FILTER (WHERE {where}), '')"


def _report(spans: list[str], base: tuple[str, ...], order: str, more: str = "") -> str:
    counts = ",\n       ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in base)
    is_base = "kind IN (" + ", ".join(f"'{k}'" for k in base) + ")"
    return f"""
WITH spans AS ({' UNION ALL '.join(spans)})
SELECT d.doc_id, {counts},
       sha256({_joined(order, is_base)}) AS base_sha256, {_joined(order, "kind IS NOT NULL")} AS spans{more}
FROM documents d LEFT JOIN spans x ON x.doc_id = d.doc_id GROUP BY d.doc_id"""


_NEAR = "lower(concat_ws(' ', right(before_m, 40), left(after_m, 40)))"
_SCORE = "CASE kind " + " ".join(
    f"WHEN '{k}' THEN {personal_data.SCORE[k]} + CASE WHEN regexp_matches({_NEAR}, '{personal_data.NEAR[k]}') THEN {personal_data.STEP} ELSE 0 END"
    for k in personal_data.KINDS) + f" END - CASE WHEN regexp_matches({_NEAR}, '{personal_data.AGAINST}') THEN {personal_data.STEP} ELSE 0 END"

PERSONAL_DATA = _report(
    [_spans(k, i, p, _KEEP[k]) for i, (k, p) in enumerate(personal_data.PLAIN.items())], personal_data.BASE, "place, s",
    f",\n       coalesce(string_agg(CAST({_SCORE} AS VARCHAR), ',' ORDER BY place, s) FILTER (WHERE kind IS NOT NULL), '') AS scores")


def _secret(i: int, rule: blob_ledger.Rule) -> str:
    kept = f"length(regexp_extract(m, {_quoted(rule.plain)}, {rule.secret_group})) >= {rule.least}"
    return _spans(rule.name, i, rule.plain, kept)


SECRETS = _report([_secret(i, r) for i, r in enumerate(blob_ledger.RULES)], blob_ledger.BASE, "s, place")

#: Lower case of A-Z alone; the words are what is between ASCII white space.
_WORDS = r"""string_split_regex(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ')"""

#: All pairs that share a shingle, counted; components by repeated minimum over links.
NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter({_WORDS}, lambda x: x <> '') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) m ON m.x = d.doc_id
"""


def _parts(rows: str) -> str:
    return f"SELECT item_id, part, unnest(list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM ({rows}) WHERE len(w) > 0"


def _by_part(count: str) -> str:
    return ", ".join(f"{count} FILTER (WHERE part = '{p}') AS {p}" for p in "qaw")


#: Every item against every text by shared shingles, those of question (q) and answer (a) and those of the whole item (w);
#: parts of fewer than five words are looked for in the word sequence.
LEAKS = f"""
WITH doc_words AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
item_words AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark WHERE text IS NOT NULL),
cut AS (SELECT item_id, w, CASE WHEN len(w) < 10 THEN len(w) ELSE len(w) - greatest(5, len(w) // 4) END AS n FROM item_words),
parts AS MATERIALIZED ({_parts("SELECT item_id, 'q' AS part, w[:n] AS w FROM cut UNION ALL SELECT item_id, 'a', CASE WHEN len(w) < 10 THEN w ELSE w[n + 1:] END FROM cut UNION ALL SELECT item_id, 'w', w FROM cut")}),
sizes AS (SELECT item_id, {_by_part("count(*)")} FROM parts GROUP BY item_id),
texts AS MATERIALIZED (SELECT DISTINCT r, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM doc_words WHERE len(w) > 4),
hits AS (
  SELECT r, item_id, {_by_part("count(*)")} FROM (
    SELECT DISTINCT t.r, p.item_id, p.part, p.s FROM parts p JOIN texts t USING (s)
    UNION SELECT d.r, p.item_id, p.part, p.s FROM parts p JOIN doc_words d ON len(string_split(p.s, ' ')) < 5 AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || p.s || ' '))
  GROUP BY r, item_id)
SELECT d.doc_id, h.item_id, z.q AS n_question, h.q AS question_found, z.a AS n_answer, h.a AS answer_found
FROM hits h JOIN sizes z USING (item_id) JOIN doc_words d USING (r)
WHERE (100 * h.q >= 75 * z.q AND 100 * h.a >= 75 * z.a) OR 100 * h.w >= 75 * z.w
"""


def _recorded(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_recorded(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, base: str) -> str:
    """Recursive levels (tree, level, pos, digest, n) over ``base`` (tree, pos, digest, n): runs of three until one node is left."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, pos, digest, n FROM {base}
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3, n),
{name}_sides AS (
  SELECT tree, level, pos, coalesce(lag(digest, 2) OVER run, '') || coalesce(lag(digest) OVER run, '') AS l, coalesce(lead(digest) OVER run, '') || coalesce(lead(digest, 2) OVER run, '') AS r
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, pos // 3 ORDER BY pos))"""


#: crc32 by its table of 256 remainders, made from the polynomial.
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda x:
  list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS tree, {_leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS altered
  FROM documents, crc_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
base AS (SELECT tree, pos, leaf AS digest, n FROM leaves),
{_levels("nodes", "base")},
subroots AS (SELECT tree AS source_key, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
top_base AS (SELECT 0 AS tree, pos, digest, n FROM subroots),
{_levels("tops", "top_base")},
steps AS (
  SELECT d.doc_id, d.leaf, d.tree, d.pos, 0 AS part, x.level, x.l, x.r FROM leaves d JOIN nodes_sides x ON x.tree = d.tree AND x.pos = d.pos // CAST(pow(3, x.level) AS BIGINT)
  UNION ALL
  SELECT d.doc_id, d.leaf, d.tree, d.pos, 1, x.level, x.l, x.r FROM leaves d JOIN subroots s ON s.source_key = d.tree
  JOIN tops_sides x ON x.pos = s.pos // CAST(pow(3, x.level) AS BIGINT)),
paths AS (SELECT tree, pos, list({{'l': l, 'r': r}} ORDER BY part, level) AS path, string_agg(l || r, '' ORDER BY part, level) AS proof FROM steps GROUP BY tree, pos),
folded AS (
  SELECT d.doc_id, d.leaf, s.digest AS subroot, t.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': coalesce(d.altered, d.leaf), 'r': ''}}, coalesce(p.path, [])), lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l AS folded_root
  FROM leaves d JOIN subroots s ON s.source_key = d.tree CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t LEFT JOIN paths p ON p.tree = d.tree AND p.pos = d.pos)
SELECT *, folded_root = root AS verified FROM folded"""
