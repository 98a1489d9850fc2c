"""Secret scan over content-addressed blobs with a ledger, built-in functions only (operator 9).

Every version of every text is named by its SHA-256.  The ledger is a Parquet table with one row
for each blob and scan: (blob, rules, spans), where ``rules`` names the rule versions that the scan
tried and ``spans`` what they found.  A scan looks only at pairs of blob and rule version that the
ledger lacks, so a copy, an old version or an unchanged file costs one hash, and a changed rule
scans again for that rule alone.  Findings are joined back to every row that holds the blob.  Rows
are appended in one commit: a run that dies leaves the ledger as it was.  Runs that append the same
pair at the same time leave it twice; its spans count once.

Defined results: NULL text counts as the empty blob; repeated rows share a blob and each get its
findings; an empty table scans nothing.  Columns other than key and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm.spans import let, located


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs in linear time and matches what ``plain`` matches, less what fails."""

    name: str
    plain: str
    pattern: str
    version: int = 1
    secret_group: int = 0      # the group that holds the secret
    least: int = 0             # characters that the group must have
    opening: str = ""          # the span starts where this first stands in the match


_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

#: Fixed patterns, in listing order; those from private_key on are added by this operator.
RULES = (
    Rule("assign", _ASSIGN, _ASSIGN, secret_group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16,}+", least=20),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{24,}+", least=24),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", r"gh[pousr]_[A-Za-z0-9]{36,}+", least=40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", # one try for each run of characters, from its start: a run has thousands of places where the text could begin
         r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", opening="eyJ"),
)
BASE = ("assign", "access", "hex")

SPANS = "array<struct<kind:string,version:int,start:int,end:int>>"
SCANS = f"blob string, rules array<string>, spans {SPANS}"


def _name(rule: Rule) -> str:
    return f"{rule.name}:{rule.version}"


def find(rule: Rule, text: Column) -> Column:
    """Spans of one rule in a text, in order."""
    spans = located(text, rule.pattern)
    if rule.least:
        spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["match"], rule.pattern, rule.secret_group)) >= rule.least)
    start = lambda s: s["start"] + F.instr(s["match"], rule.opening) - 1 if rule.opening else s["start"]
    return F.transform(spans, lambda s: F.struct(F.lit(rule.name).alias("kind"), F.lit(rule.version).alias("version"), start(s).alias("start"), s["end"]))


def _scans(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger, or None if nothing was scanned yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.read.schema(SCANS).parquet(ledger)
    return None


def _versions(docs: DataFrame, text: str, key: str) -> DataFrame:
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> None:
    """Scan the pairs of blob and rule version that the ledger lacks and append them to it."""
    blobs = _versions(docs, text, key).select("blob", "text").dropDuplicates(["blob"])
    known = _scans(docs.sparkSession, ledger)
    if known is None:
        todo = blobs.withColumn("done", F.array().cast("array<string>"))
    else:
        done = known.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))   # a blob has one row for each change of rules
        todo = blobs.join(done, "blob", "left").withColumn("done", F.coalesce("done", F.array().cast("array<string>")))
        todo = todo.filter(F.size(F.array_except(F.array(*[F.lit(_name(r)) for r in rules]), "done")) > 0)
    spans = F.concat(*[F.when(F.array_contains("done", _name(r)), F.array().cast(SPANS)).otherwise(find(r, F.col("text"))) for r in rules])
    tried = F.array_except(F.array(*[F.lit(_name(r)) for r in rules]), F.col("done"))
    todo.select("blob", tried.alias("rules"), spans.alias("spans")).write.mode("append").parquet(ledger)


def _found(spark: SparkSession, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of the blobs in which the rules' versions found something."""
    names = F.array(*[F.lit(_name(r)) for r in rules])
    known = _scans(spark, ledger).filter(F.size("spans") > 0).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    current = F.filter("spans", lambda s: F.array_contains(names, F.concat_ws(":", s["kind"], s["version"].cast("string"))))
    ordered = F.array_sort(F.transform(current, lambda s: F.struct(s["start"], place[s["kind"]].alias("place"), s["kind"], s["end"])))
    once = let(ordered, lambda o: F.filter(o, lambda s, i: (i == 0) | ~s.eqNullSafe(F.get(o, i - 1))))
    return known.select("blob", once.alias("spans"))


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, blob, spans) for every row of ``docs``; spans by start, then rule as listed."""
    found = _found(docs.sparkSession, ledger, rules)
    rows = _versions(docs, text, key).select(F.col("key").alias(key), "blob")
    return rows.join(found, "blob", "left").select(key, "blob", F.coalesce("spans", F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")).alias("spans"))


def scan_secrets(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return the findings of its rows."""
    scan(docs, ledger, rules, text, key)
    return findings(docs, ledger, rules, text, key)


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover replaced by ``mark``; ``spans`` are ordered by start."""

    def merge(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (s["start"] < last["end"]), joined).otherwise(F.concat(done, F.array(F.struct(s["start"], s["end"]))))

    covered = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), merge)

    def cut(c: Column) -> Column:
        def piece(i: Column) -> Column:
            begin = F.when(i == 0, 0).otherwise(F.get(c, i - 1)["end"])
            end = F.when(i == F.size(c), F.length(text)).otherwise(F.get(c, i)["start"])
            return F.substring(text, begin + 1, end - begin)

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(c)), piece), mark)

    return F.when(F.size(spans) > 0, let(covered, cut)).otherwise(text)


def mask_secrets(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with their own columns, whose texts have their secrets masked."""
    rows = docs.select(F.struct("*").alias("row_"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    rows = rows.withColumn("blob", F.sha2(F.col("text_").cast("binary"), 256))
    scan(rows, ledger, rules, "text_", "blob")
    found = rows.join(_found(docs.sparkSession, ledger, rules), "blob", "left")
    clean = F.when(F.size("spans") > 0, masked(F.col("text_"), F.col("spans"))).otherwise(F.col(f"row_.{text}"))
    return found.select(*[clean.alias(c) if c == text else F.col(f"row_.{c}") for c in docs.columns])
