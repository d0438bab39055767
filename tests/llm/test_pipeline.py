"""The pipeline against its stages done by hand, and all queries on small tables."""

import zlib

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from seasonlens.llm import quality
from seasonlens.llm.queries import QUERIES, table



def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def by_hand(spark, sf_dir):
    """Ids that are left before packing."""
    docs = table(spark, sf_dir, "documents")
    scores = quality.quality_scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    good = {r.doc_id for r in scores.filter("predicted = 1").collect()}
    left = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id in good}
    newest = {}
    for i in sorted(left):
        newest[left[i]] = i
    left = {i: left[i] for i in newest.values()}
    sets = {i: shingles(t) for i, t in left.items()}
    parent = {i: i for i in left}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sorted(left):
        for b in left:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    left = {i: t for i, t in left.items() if find(i) == i}
    items = [" ".join(r.text.lower().split()) for r in table(spark, sf_dir, "benchmark").collect()]
    return {i for i, t in left.items() if not any(x in " ".join(t.lower().split()) for x in items)}


def test_pipeline(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == by_hand(spark, sf_dir)
    assert all(0 <= r.ids_crc32 < 1 << 32 for r in found)
    ends = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_stages_keep_the_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, step in corpus_pipeline.STAGES[1:-1]:
        assert step(spark, docs.limit(40), sf_dir).columns == docs.columns


def test_registered(spark):
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name, key, source", [("op2_secrets", "doc_id", "documents"), ("op4_token_counts", "doc_id", "documents"), ("op6_quality", "doc_id", "documents"), ("op10_html_text", "page_id", "pages")])
def test_one_row_per_row(spark, sf_dir, name, key, source):
    found = QUERIES[name](spark, sf_dir)
    rows = table(spark, sf_dir, source)
    assert found.select(key).exceptAll(rows.select(key)).count() == 0 and found.count() == rows.count()


def test_held_out_rows(spark, sf_dir):
    found = QUERIES["op6_quality"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
