"""Lightly edited test items of one text column."""

import duckdb

from curata.llm import decontamination
from tests.conftest import SF_MID


def test_edited_items_are_accepted_by_the_whole_item(spark):
    """One word changed anywhere: accepted wherever 0.75 of the item's shingles are left, also if the answer part has fewer."""
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_MID}/benchmark.parquet' ORDER BY item_id LIMIT 20").fetchall()
    docs, want = [], set()
    for i, t in items:
        words = decontamination.words_of(t)
        own = decontamination.shingles_of(words)
        for at in range(len(words)):
            edited = words[:at] + ["changedword"] + words[at + 1:]
            doc_id = i * 1000 + at
            docs.append((doc_id, " ".join(["before"] * 30 + edited + ["after"] * 30)))
            if 100 * len(own & decontamination.shingles_of(edited)) >= 75 * len(own):
                want.add((doc_id, i))
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    parts = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(d, b).collect()}
    found = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(d, b, whole=True).collect()}
    assert want - parts and want | parts == found
    kept = {r.doc_id for r in decontamination.drop_leaking(d, b, whole=True).collect()}
    assert kept == {x for x, _ in docs} - {x for x, _ in found}
