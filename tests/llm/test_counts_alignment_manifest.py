"""Token counts, alignment and the Merkle manifest against brute force, with odd tables."""

import hashlib
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from curata.llm import merkle_manifest, queries, token_alignment, token_counts
from tests.conftest import SF_MID

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD_TEXTS = [None, "", " ", "\n", "\t\x0b", "word", "a" * 3000, "x" * 40 + " " + "y" * 40, "é日本𝔘▁ <s> </s> <unk> <0x41>\x00 <|endoftext|>", "same text", "same text",
             "  two  blanks  ", "\r\n　x​", "1234 5,678.90", "line\nbreak\n\n", " " * 500, "▁"]


def random_texts(n):
    rng = random.Random(5)
    letters = ["".join(rng.choice("ab cdeth  \n\t.,▁éß中0123'\"-_\0") for _ in range(rng.randint(1, 60))) for _ in range(n)]
    parts = ["".join(rng.choice(["the", "ing", " ", "\n", "ation", "  ", "un", "▁", "int", " of", "=="]) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    return letters + parts


def odd_docs(spark, more=()):
    """Every odd text, a NULL id, equal rows, and columns named like the operators' own."""
    rows = [(i, t) for i, t in enumerate([*ODD_TEXTS, *more])] + [(None, "no id"), (3, "\n"), (3, "\n")]
    names = ("key", "row", "tokens", "n", "pre_token", "times", "others", "codes", "code", "known", "n_a", "best", "tree", "rank", "digest", "place", "path", "block")
    return spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", "text", *[F.lit("x").alias(c) for c in names])


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# --- token counts ---------------------------------------------------------------
def counted(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return order((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in rows)


def test_pre_tokens_add_up_to_the_library():
    counter = token_counts.PieceCounter(PIECES)
    for text in [t or "" for t in ODD_TEXTS] + random_texts(1500):
        assert sum(counter.count(counter.split(text))) == len(counter.processor.encode(text)), repr(text)


@pytest.mark.parametrize("share", [2.0, 0.01, 0.0])
def test_token_counts_on_odd_tables(spark, share):
    """No pre-token is broadcast, some are, all are: the counts are the same."""
    docs = odd_docs(spark, random_texts(100)).repartition(5)
    assert order(token_counts.count_tokens(docs, PIECES, share=share).collect()) == counted(docs.collect())


def test_token_counts_of_empty_tables(spark):
    docs = odd_docs(spark)
    assert token_counts.count_tokens(docs.limit(0), PIECES).count() == 0
    assert order(token_counts.count_tokens(docs.filter("text = '' OR text IS NULL"), PIECES).collect()) == [(0, 0, 0), (1, 0, 0)]


def test_token_counts_of_the_documents(spark):
    got = queries.op11_token_counts(spark, SF_MID)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert order(r[:3] for r in rows) == counted(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect())
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)


# --- alignment --------------------------------------------------------------------
class Plain:
    """Both tokenisations by their libraries and the groups from sets of ends, without windows."""

    def __init__(self):
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        self.byte_of = token_alignment._byte_of_character()

    def sides(self, text):
        ids_a, ids_b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        bytes_a = [bytes(self.byte_of[c] for c in self.a.id_to_token(i)) for i in ids_a]
        pieces = [self.b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        return (ids_a, bytes_a), (ids_b, bytes_b)

    def links(self, text):
        """(n_a, n_b, groups, links), or None for a text without tokens."""
        if not text:
            return None
        (a, bytes_a), (b, bytes_b) = self.sides(text)
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return None
        end_a, end_b = ({len(b"".join(x[:i + 1])): i for i in range(len(x))} for x in (bytes_a, bytes_b))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(end_a.keys() & end_b.keys()):
            groups.append(",".join(map(str, a[i:end_a[end] + 1])) + "|" + ",".join(map(str, b[j:end_b[end] + 1])))
            links.append((a[end_a[end]], b[end_b[end]]))
            i, j = end_a[end] + 1, end_b[end] + 1
        return len(a), len(b), groups, links

    def table(self, rows):
        found = [(r.doc_id, self.links(r.text)) for r in rows]
        count = Counter(x for _, f in found if f for x in f[3])
        most = {}
        for (_, b), n in count.items():
            most[b] = max(most.get(b, 0), n)
        return order((d, f[0], f[1], len(f[2]), len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]),
                      hashlib.sha256(";".join(f[2]).encode()).hexdigest()) if f else (d, 0, 0, 0, 0, 0, 0, "") for d, f in found)


@pytest.mark.parametrize("share", [2.0, 0.02, 0.0])
def test_alignment_on_odd_tables(spark, share):
    docs = odd_docs(spark, random_texts(100)).repartition(5)
    got = token_alignment.alignment(docs, BYTES, PIECES, share=share)
    assert order(got.collect()) == Plain().table(docs.collect())


def test_windows_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(token_alignment, "WINDOWS_KEPT", 8)
    aligner, plain = token_alignment.Aligner(BYTES, PIECES), Plain()
    for text in random_texts(150):
        want, tokens = plain.links(text), aligner.tokens(text, aligner.processor.encode(text))
        assert (tokens is None) == (want is None)
        if tokens:
            groups, links = aligner.align(*tokens)
            assert groups == ";".join(want[2])
            assert links.tolist() == [x << aligner.bits | y for x, y in want[3]]
    assert len(aligner.old.texts) < 8 + 60


def test_alignment_of_empty_tables(spark):
    docs = odd_docs(spark)
    assert token_alignment.alignment(docs.limit(0), BYTES, PIECES).count() == 0
    empty = token_alignment.alignment(docs.filter("text = '' OR text IS NULL OR text = '▁'"), BYTES, PIECES)
    assert order(empty.collect()) == order((i, 0, 0, 0, 0, 0, 0, "") for i in (0, 1, ODD_TEXTS.index("▁")))


def test_alignment_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").limit(200)
    assert order(token_alignment.alignment(docs, BYTES, PIECES).collect()) == Plain().table(docs.collect())


# --- Merkle manifest --------------------------------------------------------------
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    return levels


def siblings(levels, i):
    out = []
    for below in levels[:-1]:
        first = i // 3 * 3
        out.append((below[first:i], below[i + 1:first + 3]))
        i //= 3
    return out


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted(groups[s], key=lambda x: x[:3]) for s in names}
    trees = {s: levels_of([x[2] for x in groups[s]]) for s in names}
    top, out = levels_of([trees[s][-1][0] for s in names]), []
    for k, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            text = r.text
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf_of(r, text)
            for left, right in path:
                folded = sha("".join(left) + folded + "".join(right))
            out.append((r.doc_id, leaf, trees[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in path)), folded, folded == top[-1][0]))
    return order(out)


def manifest_docs(spark, n, sources):
    rng = random.Random(n)
    rows = [(i, rng.choice(["one", "two\nlines", "\n", "", None, "ünï"]), rng.choice(["en", None]), rng.choice(sources), rng.choice([None, 3])) for i in range(n)]
    rows += [(None, "no id\n", "en", None, 1), (1, "again\n", None, sources[0], None), (1, "again\n", None, sources[0], None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").select(
        "*", *[F.lit("x").alias(c) for c in ("tree", "rank", "digest", "key", "part", "place", "altered", "group", "n")])


@pytest.mark.parametrize("n, sources", [(700, ["a"] * 9 + ["b", None, "ä", "Z"]), (5, ["a"]), (40, [f"s{i}" for i in range(300)])])
def test_manifest_equals_the_plain_trees(spark, n, sources):
    docs = manifest_docs(spark, n, sources).repartition(7)
    assert order(queries.merkle_rows(docs).collect()) == plain_manifest(docs.collect())


def test_manifest_with_narrow_buckets(spark, monkeypatch):
    """Three levels a bucket give four buckets above 700 leaves and the same digests."""
    monkeypatch.setattr(merkle_manifest, "BAND", 2)
    monkeypatch.setattr(merkle_manifest, "WIDTH", 9)
    docs = manifest_docs(spark, 700, ["a", "a", "a", "b"]).repartition(3)
    assert order(queries.merkle_rows(docs).collect()) == plain_manifest(docs.collect())


def test_manifest_nodes_cover_their_leaves(spark):
    docs = manifest_docs(spark, 400, ["a", "a", "b"])
    manifest = merkle_manifest.build_manifest(docs, "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"])
    leaves = {}
    for r in manifest.leaves.collect():
        leaves.setdefault(r.tree, {})[r["rank"]] = r.digest
    got = {(r.tree, r.level, r.lo, r.hi): r.digest for r in manifest.nodes().collect()}
    want = {}
    for tree, digests in leaves.items():
        n = len(digests)
        for level, nodes in enumerate(levels_of([digests[i] for i in range(n)])):
            want |= {(tree, level, i * 3 ** level, min((i + 1) * 3 ** level, n)): d for i, d in enumerate(nodes)}
    assert got == want


def test_manifest_of_an_empty_table(spark):
    assert queries.merkle_rows(manifest_docs(spark, 3, ["a"]).limit(0)).count() == 0


def test_manifest_of_one_row(spark):
    docs = manifest_docs(spark, 3, ["a"]).filter("doc_id = 0")
    (row,) = queries.merkle_rows(docs).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")
