"""Near-duplicates, token files, pages, vectors and toxicity against brute force, with odd tables."""

import glob
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from curata.llm import near_duplicates, projected_search, site_style, token_files, toxicity
from curata.llm.common import keyed_bucket, shared_path
from curata.llm.components import connected_components
from tests.conftest import SF_MID

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 400)] + [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(150)] + [(5, 5)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _near(rows):
    """Brute force: (doc_id, n_shingles, component_id, kept) of (doc_id, text)."""
    sets = [_shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and min(len(a), len(b)) * 100 >= 75 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    up[root(i)] = root(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[root(i)] = min(d, smallest.get(root(i), d))
    return [(d, len(s), smallest.get(root(i)) if d is not None else None, d is None or smallest[root(i)] == d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def _key(row):
    return tuple((x is not None, x or 0) for x in row)


@pytest.fixture(scope="module")
def copies():
    """Exact copies, families of near copies around the threshold, a shared passage, odd texts."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: rng.choices(words, k=n)
    rows, passage = [], text(60)
    for family in range(6):
        base = text(rng.randint(40, 160))
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own))
    rows += [" ".join(passage + text(rng.randint(5, 60))) for _ in range(60)] + [" ".join(text(80)) for _ in range(40)]
    rows += [rows[0]] * 40 + [rows[3].upper(), "one two", "One\ttwo ", "one two three", "", " \n", None, None, "x", "y" * 2000]
    rng.shuffle(rows)
    out = [(i * 3 + 1, t) for i, t in enumerate(rows)]
    return out + [out[5], (None, rows[0]), (out[7][0], "another text under a used id")]


@pytest.mark.parametrize("block", [512, 7])
def test_near_duplicates_equal_brute_force(spark, copies, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    docs = spark.createDataFrame(copies, "doc_id bigint, text string").withColumn("component", F.lit(0)).withColumn("node", F.lit("x")).repartition(5)
    got = sorted((tuple(r) for r in near_duplicates.near_duplicates(docs).collect()), key=_key)
    assert got == sorted(_near(copies), key=_key)
    if block == 512:
        kept = near_duplicates.keep_one_of_each(docs)
        assert kept.columns == docs.columns
        want = {(d, t) for (d, t), (_, _, _, k) in zip(copies, _near(copies), strict=True) if k}
        rows = [(r.doc_id, r.text) for r in kept.collect()]
        assert set(rows) == want and len(rows) == len(want)
        assert near_duplicates.near_duplicates(docs.limit(0)).count() == 0


def test_large_families_whose_members_are_apart_from_their_leader(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 7)
    rng = random.Random(17)
    words = [f"w{rng.randrange(10**6)}" for _ in range(900)]
    texts = [" ".join(words[4 * k:4 * k + 90]) for k in range(80)]                                   # a chain: links between neighbours only
    texts += [" ".join(words[400:500] + [f"x{k}"]) for k in range(60)] + texts[:5]                    # all linked with any leader
    texts += [" ".join(words[600:660] + [f"y{k % 9}{i}" for i in range(16 + k % 9)]) for k in range(45)]      # some near, some not
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)] + [(1000, "another text under the chain's first id"), (993, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert sorted(tuple(r) for r in near_duplicates.near_duplicates(docs).collect()) == sorted(_near(rows))


def test_token_files_read_back(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    texts = [None, "", " ", "a  b\n\n", "é\t中 <|endoftext|>", "w " * 4000, "same", "same"] + [f"text number {i} " * (i % 17) for i in range(300)]
    rows = [(i * 7 % 311, t) for i, t in enumerate(texts)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("part", F.lit("x")).withColumn("tokens", F.lit(1)).repartition(6)
    path = shared_path(spark, "test-tokens")
    token_files.write_token_files(docs, path, BYTES, end_id=2, row_group_bytes=64 << 10, page_bytes=8 << 10)
    want, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    files = token_files.read_token_files(spark, path)
    got = token_files.with_start(token_files.id_checksums(files), files)
    assert [tuple(r) for r in got.orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()] == want
    names = sorted(glob.glob(path.replace("file:", "") + "/*.parquet"))
    assert [d for n in names for d in pq.read_table(n, columns=["doc_id"]).column(0).to_pylist()] == [w[0] for w in want]     # name order is key order
    for n in names:
        group = pq.ParquetFile(n).metadata.row_group(0)
        by_name = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert any("DICTIONARY" in e for e in by_name["tokens.list.element"].encodings)
        assert by_name["part_start"].encodings[0].startswith("DELTA") or "DELTA_BINARY_PACKED" in by_name["part_start"].encodings
        assert all(c.has_offset_index and c.has_column_index for c in by_name.values())
    only = token_files.read_token_files(spark, path, ["doc_id", "n_tokens"])
    assert "tokens" not in only._jdf.queryExecution().toString().split("ReadSchema")[1].replace("n_tokens", "")
    empty = shared_path(spark, "test-tokens")
    token_files.write_token_files(docs.limit(0), empty, BYTES, end_id=2)
    assert token_files.read_token_files(spark, empty).count() == 0


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a b"), ("<div>x<span>y</span>z<br>w</div>", "xyz w"),
    ("<nav>menu</nav><article><header><h1>T</h1></header><p>a &lt; b</p><section class='comments'><p>no</p></section><form>no</form></article><footer>no</footer>", "T a < b"),
    ("<header>no</header><div class='content'><h1>T</h1><p>a<b>b</b>c</p></div><div id='cookie-notice'>no</div>", "T abc"),
    ("<p>abc <scr", "abc"), ("<p>x<!-- c --></p><script>var t='</p>'</script><style>p{}</style>y", "x y"), ("<table><tr><td>a<td>b</table>", "a b"),
    ("<b><p>one</b><p>two", "one two"), ('<a href="x>y">t</a> u', "t u"), ("<aside>no</aside><p hidden>no</p><p>yes", "yes"),
    ("<main><p>one</p><div class='ad'>buy</div><p>two</p></main><p>outside</p>", "one two"), ("</p>a</div>b", "a b"),
])
def test_page_text(html, text):
    assert site_style.main_text(site_style.Reader().read(html), {}) == text


def test_style_tree_cuts_what_repeats(spark):
    rng = random.Random(10)
    body = lambda: "".join(f"<p>{' '.join(rng.choices('alpha beta gamma delta epsilon zeta eta theta'.split(), k=12))} {rng.random()}</p>" for _ in range(rng.randint(2, 9)))
    bodies = [body() for _ in range(40)]
    pages = [(i, f"http://a.example/{i}", f"<div class=x7>Buy now at our shop</div><div class=q{i % 2}>{b}</div><div class=zz>All rights somewhere</div>") for i, b in enumerate(bodies)]
    pages += [(100, "http://a.example/0", pages[0][2]), (None, None, None), (101, "no url", ""), (102, "http://b.example/", "<p>single page</p>")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("body", F.lit(1)).withColumn("host", F.lit("x"))
    got = site_style.extract(df).collect()
    assert len(got) == len(pages)
    for r in got:
        if r.page_id is not None and r.page_id < 40:
            assert r.text == " ".join(bodies[r.page_id].replace("<p>", "").split("</p>")).strip()
    by_id = {r.page_id: r.text for r in got}
    assert by_id[100] == by_id[0] and by_id[None] == "" and by_id[101] == "" and by_id[102] == "single page"
    assert site_style.extract(df.limit(0)).count() == 0


def test_pages_of_the_fixture(spark):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    found = site_style.extract(pages).toPandas().merge(pages.toPandas()[["page_id", "html"]], on="page_id")
    for r in found.itertuples():
        assert r.text and "<p>" not in r.text and "track(" not in r.text and "&copy;" not in r.text
        first = r.html.split("<article><h1>")[1].split("</h1>")[0].replace("&amp;", "&")
        assert r.text.startswith(" ".join(first.split()))


def _neighbours(rows, asks, k):
    ids = [i for i, _ in rows]
    vectors = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i in sorted({i for i in ids if asks(i)}):
        q = vectors[ids.index(i)]
        scores = sorted(((-float((v * q).sum()), j) for j, v in dict(zip(ids, map(tuple, vectors), strict=True)).items() if j != i))
        out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def test_vector_search_recall_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(projected_search, "CELL", 300)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 32))
    good = [(i, (centres[i % 12] + rng.normal(size=32) * 0.7).astype(np.float32).tolist()) for i in range(1500)]
    good += [(2000 + i, good[0][1]) for i in range(300)]                  # one vector with many ids
    bad = [(3000, None), (3020, []), (3040, [0.0] * 32), (3060, [None] + [1.0] * 31), (3080, [float("nan")] * 32), (3100, [float("inf")] * 32), (3120, [1.0] * 5), (None, good[1][1])]
    df = spark.createDataFrame(good + bad + good[:3], "vec_id bigint, embedding array<float>").withColumn("id", F.lit(0)).withColumn("h", F.lit("x"))
    got = projected_search.nearest(df, F.col("vec_id") % 20 == 0, 20).collect()
    want = _neighbours(good, lambda i: i % 20 == 0, 20)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == set(want)
    vectors = dict(good)
    hits = 0
    for q, found in by.items():
        assert [x[0] for x in found] == list(range(1, 21))
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        assert all(s == pytest.approx(float(np.dot(np.float64(vectors[q]), np.float64(vectors[j]))), abs=1e-9) for _, j, s in found)
        hits += len({j for _, j, _ in found} & {j for j, _ in want[q]})
    assert hits / sum(map(len, want.values())) >= 0.9
    assert [j for _, j, _ in by[2000]] == [0, *range(2001, 2020)]         # ties by id, itself left out
    few = projected_search.nearest(df.where("vec_id IN (0, 1, 20)"), F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(0, 1), (0, 2), (20, 1), (20, 2)]
    assert projected_search.nearest(df.limit(0), F.lit(True)).count() == 0
    assert projected_search.nearest(df.where("vec_id >= 3000"), F.lit(True)).count() <= 1


def test_chi_square_quantile():
    draws = np.random.default_rng(12).chisquare(10, 400_000)
    assert projected_search.chi_square_quantile(0.95, 10) == pytest.approx(np.quantile(draws, 0.95), rel=0.01)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(keyed_bucket("doc_id", 3) != 1))
    scored = model.score(docs.select("doc_id", "text")).join(labels, "doc_id").filter(keyed_bucket("doc_id", 3) == 1).toPandas()
    order, positive = scored.score.rank(), scored.toxic == 1
    auc = (order[positive].sum() - positive.sum() * (positive.sum() + 1) / 2) / (positive.sum() * (~positive).sum())
    assert auc > 0.75 and scored.score.between(0, 1).all()
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x" * 5000), (3, "YOU idiot!!! 1d10t")], "doc_id bigint, text string").withColumn("features", F.lit("x"))
    rows = model.score(odd).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert model.score(odd.limit(0)).count() == 0


def test_toxicity_without_labels_or_with_one_class(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    for labels, score in (([], 0.0), ([(1, 0)], 0.0), ([(1, 1), (2, None), (None, 0)], 1.0)):
        table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        assert {r.score for r in toxicity.fit(docs, table).score(docs).collect()} == {score}


def test_toxic_words_are_learned_from_duplicated_labels(spark):
    rows = duckdb.sql("SELECT i, CASE WHEN i % 4 = 0 THEN 'you are a blarg ' || i ELSE 'a calm word ' || i END FROM range(400) t(i)").fetchall()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(0, 0), (4, None)], "doc_id bigint, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.fit(docs, labels).score(docs).collect()}
    assert min(s for i, s in scores.items() if i % 4 == 0) > max(s for i, s in scores.items() if i % 4)
