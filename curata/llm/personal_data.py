"""Personal data with built-in functions only (operator 4).

Regular expressions propose spans, validators confirm them (Luhn for cards, mod 97 for IBANs, parts
up to 255 for addresses, digit counts for cards and phones), and words near a span raise or lower
its score.  Spans that a validator refuses are dropped; the score drops none.

The patterns below match what the plain ones in ``PLAIN`` match, but run in linear time: a run of
characters is taken at its start and never given back (possessive quantifiers, look-behind), where
the plain form would try every suffix of a long run.

Defined results: NULL text counts as empty, an empty text has no spans, repeated rows are treated
alike, columns other than the text stay as they are (``add_spans`` refuses to replace one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.spans import let, located

#: The plain patterns, in listing order.  iban is added by this operator.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z][A-Z][0-9][0-9][A-Z0-9]+",
}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PLAIN)

_LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": PLAIN["phone"],
    "iban": r"[A-Z][A-Z][0-9][0-9][A-Z0-9]{11,}+",
}
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}

#: Score in percent before context, and what a context word adds or takes.
SCORE = {"email": 80, "ip": 60, "card": 70, "phone": 50, "iban": 80}
STEP = 20
NEAR = {
    "email": "mail|contact|write|reply",
    "ip": "address|host|server|login|ip",
    "card": "card|visa|credit|payment|debit",
    "phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|bank|account|transfer",
}
AGAINST = "example|sample|version|test|dummy"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """The account number's check value: 1 if it is valid."""
    moved = F.concat(F.substring(iban, 5, 1000), F.substring(iban, 1, 4))
    values = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return let(_digits(match), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return F.when(F.length(match).between(15, 34), mod97(match) == 1).otherwise(False)
    return F.lit(True)


def find(text: Column) -> Column:
    """array<struct<kind, start, end, match, score>> of a text, by kind as listed, then start."""
    parts = []
    for kind in KINDS:
        possible = text.contains(_NEEDS[kind]) if kind in _NEEDS else None
        parts.append(_confirmed(kind, located(text, _LINEAR[kind], possible)))
    return F.concat(*parts)


def _confirmed(kind: str, spans: Column) -> Column:
    """The valid spans with their scores."""

    def scored(s: Column) -> Column:
        near = F.lower(F.concat_ws(" ", s["before"], s["after"]))
        score = F.lit(SCORE[kind]) + F.when(near.rlike(NEAR[kind]), STEP).otherwise(0) - F.when(near.rlike(AGAINST), STEP).otherwise(0)
        return F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["match"], score.alias("score"))

    return F.transform(F.filter(spans, lambda s: _valid(kind, s["match"])), scored)


def add_spans(docs: DataFrame, text: str = "text", out: str = "personal_data") -> DataFrame:
    """Add the spans of every text as ``out``."""
    if out in docs.columns:
        raise ValueError(f"the input has a column {out}")
    return docs.withColumn(out, find(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def masked(text: Column, spans: Column, least_score: int = 0) -> Column:
    """The text with each found string of at least ``least_score`` replaced by its kind in brackets."""
    chosen = F.filter(spans, lambda s: s["score"] >= least_score)
    return F.aggregate(chosen, text, lambda t, s: F.replace(t, s["match"], F.concat(F.lit("["), s["kind"], F.lit("]"))))
