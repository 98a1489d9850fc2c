"""Pieces, language, personal data, secrets and leaks against brute force, with odd tables."""

import hashlib
import random
import re
import time

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from curata.llm import blob_ledger, decontamination, language_id, personal_data, piece_bpe
from curata.llm.common import keyed_bucket, shared_path
from curata.llm.oracles import LEAKS
from tests.conftest import SF_MID

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [None, "", " ", "\n", "\t\x0b", "word", "a" * 3000, "x" * 40 + " " + "y" * 40, "é日本𝔘▁ <s> <0x41>\x00", "same text", "same text"]


def odd_docs(spark, more=()):
    """Every odd text, a NULL id, equal rows, and columns named like the operators' own."""
    rows = [(i, t, "en") for i, t in enumerate([*ODD_TEXTS, *more])] + [(None, "no id", None), (3, "\n", "en")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").select(
        "doc_id", "text", "lang", *[F.lit("x").alias(c) for c in ("key", "ids", "decoded", "blob", "spans", "rule", "k", "t", "l", "row", "draw")])


def test_pieces_equal_the_library():
    coder = piece_bpe.PrefixTableEncoder(PIECES)
    rng = random.Random(1)
    texts = [t or "" for t in ODD_TEXTS]
    texts += ["".join(rng.choice("ab cdeth  \n\t.,▁éß中0123'\"-_\0") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice(["the", "ing", " ", "\n", "ation", "  ", "un", "▁", "int", "er", "=="]) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for t in texts:
        assert coder.encode(t) == coder.processor.encode(t), repr(t)


def test_pieces_on_odd_tables(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = odd_docs(spark)
    got = sorted((r.doc_id is not None, r.doc_id or 0, list(r.ids), r.decoded) for r in piece_bpe.encode_documents(docs, PIECES).collect())
    want = [(r.doc_id is not None, r.doc_id or 0, library.encode(r.text or ""), library.decode(library.encode(r.text or ""))) for r in docs.collect()]
    assert got == sorted(want)
    assert piece_bpe.encode_documents(docs.limit(0), PIECES).count() == 0
    again = piece_bpe.decode_documents(piece_bpe.encode_documents(docs, PIECES).withColumnRenamed("decoded", "first"), PIECES)
    assert again.where("first <> decoded").count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    held = keyed_bucket("doc_id", 4) == 2
    model = language_id.fit_dictionaries(docs.filter(~held))
    assert set(model) == {"en", "de", "fr", "es"} and all(len(x) <= language_id.DICTIONARY_BYTES for x in model.values())
    found = docs.filter(held).select("lang", language_id.identify(model).alias("x")).select("lang", "x.*").toPandas()
    assert (found.lang == found.lang_pred).mean() >= 0.97
    assert found.score.between(0, 1).all()


def test_language_on_odd_tables(spark):
    docs = odd_docs(spark, ["123 -- 456", "½ ²", "Ⅷ 12", "the only one with words " * 9])
    found = docs.select("text", language_id.identify(language_id.fit_dictionaries(docs)).alias("x")).collect()
    for r in found:
        letters = bool(r.text and any(c.isalpha() for c in r.text))
        assert r.x.lang_pred == ("en" if letters else "und") and r.x.rejected == (not letters)
    nothing = docs.select(language_id.identify(language_id.fit_dictionaries(docs.limit(0))).alias("x")).select("x.lang_pred", "x.score").distinct().collect()
    assert [tuple(r) for r in nothing] == [("und", 0.0)]
    kept = language_id.keep_identified(docs, docs)
    assert kept.columns == docs.columns and kept.count() == sum(bool(r.text and any(c.isalpha() for c in r.text)) for r in found)


def test_language_ties_go_to_the_more_frequent():
    model = language_id.CompressionClassifier({"aa": b"one two three " * 9, "bb": b"one two three " * 9})
    assert model.predict("one two", 0.01)[:3] == ("aa", 0.0, 0.0)
    assert model.predict("one two three " * 20, 0.01)[3]          # long enough to have had a margin
    assert not model.predict("one two", 0.01)[3]


def _plain(patterns, text, keep):
    return [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, text, re.A) if keep(k, m)]


def _luhn(digits):
    return sum(int(d) if i % 2 == 0 else (int(d) * 2 - 9 if int(d) > 4 else int(d) * 2) for i, d in enumerate(reversed(digits))) % 10 == 0


def _personal(kind, m):
    s = m[0]
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "iban":
        return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    return True


def _noise(seed, parts, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_personal_data_equals_plain_patterns(spark):
    parts = ["a@b.c", "x.y@", "@", ".", "..", "foo_", "-", " ", "é", "中", "1.2.3.4", "256.1.1.1", "999", "4111 1111 1111 1111", "4111-1111", "1", "+1 (098) 555-0174", "+", "(", "5555555555554444",
             "DE89370400440532013000", "GB82WEST12345698765432", "mail ", "card ", "7" * 50, "1.2.3.4.5.6.7.8", "12 34", "\n"]
    docs = odd_docs(spark, _noise(2, parts) + ["a@b.cd_e@f.gh", "1 " * 500 + "4111111111111111", "x" * 5000 + "@y.z " + "1.1.1.1 " * 700])
    for r in personal_data.add_spans(docs).collect():
        got = [(s.kind, s.start, s.end) for s in r.personal_data]
        assert got == _plain(personal_data.PLAIN, r.text or "", _personal), r.text
        assert all((r.text or "")[s.start:s.end] == s.match and 0 <= s.score <= 120 for s in r.personal_data)
    assert personal_data.add_spans(docs.limit(0)).count() == 0
    near = personal_data.add_spans(spark.createDataFrame([("card 4111111111111111",), ("xxxx 4111111111111111",), ("card example 4111111111111111",)], "text string"))
    assert [r.personal_data[0].score for r in near.collect()] == [90, 70, 70]
    hidden = personal_data.add_spans(spark.createDataFrame([("mail a@b.c now",)], "text string")).select(personal_data.masked(F.col("text"), F.col("personal_data")))
    assert hidden.first()[0] == "mail [email] now"


SECRET_PARTS = ["password", "API_KEY", "apikey", "token", "=", ": ", "\"", "'", "abc", "abcdef", "hunter2secret", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef" * 4, " ", "é", "\n",
                "ghp_" + "a1B2" * 10, "eyJhbGci.eyJzdWIi.c2ln", "-----BEGIN RSA PRIVATE KEY-----", "zz"]


def _secret_spans(text):
    rules = {r.name: r for r in blob_ledger.RULES}

    def keep(kind, m):
        return len(m[rules[kind].secret_group]) >= rules[kind].least

    order = {r.name: i for i, r in enumerate(blob_ledger.RULES)}
    return sorted(_plain({r.name: r.plain for r in blob_ledger.RULES}, text, keep), key=lambda x: (x[1], order[x[0]]))


def test_secrets_equal_plain_patterns_and_are_scanned_once(spark):
    docs = odd_docs(spark, _noise(4, SECRET_PARTS) + ["token=abcdef " * 300])
    ledger = shared_path(spark, "test-ledger")
    found = blob_ledger.scan_secrets(docs, ledger).collect()
    by_id = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(found) == docs.count()
    for r in found:
        assert [(s.kind, s.start, s.end) for s in r.spans] == _secret_spans(by_id[r.doc_id])
        assert r.blob == hashlib.sha256(by_id[r.doc_id].encode()).hexdigest()
    blobs = len({r.blob for r in found})
    assert spark.read.parquet(ledger).count() == blobs                   # copies share a scan
    blob_ledger.scan(docs, ledger)
    assert spark.read.parquet(ledger).count() == blobs                   # nothing is scanned twice
    changed = tuple(blob_ledger.Rule(r.name, r.plain, r.pattern, 2, r.secret_group, 30) if r.name == "hex" else r for r in blob_ledger.RULES)
    again = blob_ledger.scan_secrets(docs, ledger, changed)
    new = spark.read.parquet(ledger).where(F.array_contains("rules", "hex:2"))
    assert new.count() == blobs and new.where(F.size("rules") > 1).count() == 0      # only the changed rule
    for r in again.collect():
        want = [x for x in _secret_spans(by_id[r.doc_id]) if x[0] != "hex" or x[2] - x[1] >= 30]
        assert [(s.kind, s.start, s.end) for s in r.spans] == want
    assert blob_ledger.scan_secrets(docs.limit(0), shared_path(spark, "test-ledger")).count() == 0


def test_secrets_are_masked(spark):
    docs = odd_docs(spark, _noise(5, SECRET_PARTS, 200))
    clean = blob_ledger.mask_secrets(docs, shared_path(spark, "test-ledger"))
    assert clean.columns == docs.columns

    def masked(text):
        out, at = [], 0
        for _, s, e in _secret_spans(text or ""):
            if s >= at:
                out.append((text[at:s], True))
            at = max(at, e)
        return "".join(t + "[SECRET]" for t, _ in out) + (text or "")[at:] if out else text

    def rows(df):
        return sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "", r.text is None) for r in df.collect()))

    want = sorted((r.doc_id is not None, r.doc_id or 0, masked(r.text) or "", r.text is None) for r in docs.collect())
    assert rows(clean) == want


def _brute_leaks(docs, items, whole=False):
    """Every item against every text."""
    out = set()
    index = decontamination.TestIndex([(i, q, None) for i, q in items], 0.0, whole)
    for d, text in docs:
        words = decontamination.words_of(text)
        joined = f" {' '.join(words)} "
        for (item, question, answer), together in zip(index.parts, index.wholes, strict=True):
            found = [sum(f" {' '.join(s)} " in joined for s in part) for part in (question, answer, together)]
            both = 100 * found[0] >= 75 * len(question) and 100 * found[1] >= 75 * len(answer)
            if both or whole and 100 * found[2] >= 75 * len(together):
                out.add((d, item, len(question), found[0], len(answer), found[1]))
    return out


def test_leaks_equal_brute_force(spark, monkeypatch):
    con = duckdb.connect()
    items = con.sql(f"SELECT item_id, text FROM '{SF_MID}/benchmark.parquet'").fetchall() + [(900, "only four words here"), (901, "tiny"), (902, None), (903, "..."), (904, "long " * 200 + "end of it all")]
    docs = con.sql(f"SELECT doc_id, text FROM '{SF_MID}/documents.parquet' ORDER BY doc_id LIMIT 250").fetchall()
    rng = random.Random(6)
    for k, (i, t) in enumerate(items[:30]):
        words = t.split()
        at = rng.randrange(len(words))
        edited = words[:at] + ["changed"] + words[at + 1:]
        docs.append((10_000 + k, " ".join(["before"] * rng.randrange(200) + edited + ["after"] * 50)))
        docs.append((20_000 + k, t.upper().replace(" ", ",  ")))
        docs.append((30_000 + k, " ".join(words[:len(words) // 2])))
    docs += [(40_000, "x only four words here y"), (40_001, "a tiny thing"), (40_002, None), (40_003, ""), (40_004, "long " * 5000 + "end of it all"), (40_001, "a tiny thing")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit(1)), spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in decontamination.find_leaks(d, b).drop("score").collect()]
    want = _brute_leaks(docs, items)
    assert set(got) == want and len(got) == len(want) + sum(x[0] == 40_001 for x in want)
    kept = decontamination.drop_leaking(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {x for x, _ in docs} - {x[0] for x in want}
    either = [tuple(r) for r in decontamination.find_leaks(d, b, whole=True).drop("score").collect()]
    assert set(either) == _brute_leaks(docs, items, whole=True) > want
    held, tests = d.toPandas(), b.toPandas()
    con.register("documents", held)
    con.register("benchmark", tests)
    assert sorted(con.sql(LEAKS).fetchall()) == sorted(either)
    monkeypatch.setattr(decontamination, "SHARD_CHARS", 8_000)
    sharded = [tuple(r) for r in decontamination.find_leaks(d, b, whole=True).drop("score").collect()]
    assert sorted(sharded) == sorted(either)
    kept = decontamination.drop_leaking(d, b, whole=True)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {x for x, _ in docs} - {x[0] for x in either}
    for empty in (decontamination.find_leaks(d.limit(0), b), decontamination.find_leaks(d, b.limit(0))):
        assert empty.count() == 0


def test_wand_finds_every_unit_above_the_threshold():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(60)], k=rng.randint(3, 30))), None) for i in range(400)]
    for least in (0.2, 0.5, 0.8):
        index = decontamination.TestIndex(items, least)
        for _ in range(60):
            query = {index.word_id[w] for w in rng.sample(vocabulary, 25) if w in index.word_id}
            scores = {}
            for w in query:
                for u, x in zip(index.postings[w].units, index.postings[w].impacts, strict=True):
                    scores[u] = scores.get(u, 0) + x
            want = {u for u, s in scores.items() if s >= least}
            assert {u for u, _ in index.search(query, 0, 10 ** 9)} == want
            assert {u for u, _ in index.search(query, 100, 200)} == {u for u in want if 100 <= u < 200}


@pytest.mark.parametrize("question, answer, text, found", [
    ("what is the capital city of france", "the city is paris of course", "q: what is the capital city of france a: the city is paris of course", True),
    ("what is the capital city of france", "the city is paris of course", "what is the capital city of france", False),
    ("what is the capital city of france", "the city is paris of course", "the city is paris of course", False),
])
def test_question_and_answer_are_both_needed(spark, question, answer, text, found):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    items = spark.createDataFrame([(5, question, answer)], "item_id bigint, q string, a string")
    assert decontamination.find_leaks(docs, items, question="q", answer="a", least_score=0.4).count() == int(found)


def test_long_runs_are_scanned_in_linear_time(spark):
    texts = ["eyJ" * 200_000, "eyJ" * 100_000 + ".a" * 1, "eyJa." * 60_000, "token " * 50_000 + " " * 100_000, "gh" * 100_000, "-eyJa.b.c", "xeyJa.eyJb.c.eyJd.e.f", "eyJ.eyJ.a.eyJk.b.c", "aeyJ eyJx..eyJy.z.w"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    began = time.time()
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "jwt"] for r in blob_ledger.scan_secrets(docs, shared_path(spark, "long-runs")).collect()}
    assert time.time() - began < 20
    plain = next(r.plain for r in blob_ledger.RULES if r.name == "jwt")
    assert all(got[i] == [m.span() for m in re.finditer(plain, texts[i])] for i in (2, 5, 6, 7, 8)) and got[0] == got[1] == got[3] == got[4] == []


def test_a_pair_that_two_runs_append_counts_once(spark):
    docs = spark.createDataFrame([(1, "token = abcdefgh")], "doc_id bigint, text string")
    ledger, other = shared_path(spark, "twice"), shared_path(spark, "other")
    blob_ledger.scan(docs, ledger)
    blob_ledger.scan(docs, other)
    spark.read.parquet(other).write.mode("append").parquet(ledger)
    assert [len(r.spans) for r in blob_ledger.findings(docs, ledger).collect()] == [1]
