"""Each stage against a brute-force version of its decision."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from test_decontaminate import brute as windows_in
from test_jaccard_join import brute as joined
from test_secrets import brute as secrets_in
from llm_fixtures import edge_docs, folder, no_docs  # noqa: F401
from ledgerloom.llm.common import table


@pytest.fixture(scope="module")
def documents(spark, folder):
    return table(spark, folder, "documents")


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_language_stage_keeps_text(spark, folder, edge_docs, documents):
    assert bag(cp.identify_language(spark, documents, folder)) == bag(documents)
    out = cp.identify_language(spark, edge_docs, folder)
    assert out.columns == edge_docs.columns
    texts = edge_docs.filter("text rlike '[A-Za-z]'")
    assert bag(out) == bag(texts)


def test_one_of_each_group_stays(spark, folder, documents):
    rows = documents.select("doc_id", "text").collect()
    components = {d: c for d, _, c, _ in joined(list(map(tuple, rows)), 5, 80)}
    out = cp.drop_near_copies(spark, documents, folder)
    assert out.columns == documents.columns
    kept = [components[r.doc_id] for r in out.collect()]
    assert sorted(kept) == sorted(set(components.values()))


def test_contaminated_rows_go(spark, folder, documents):
    items = list(map(tuple, table(spark, folder, "benchmark").select("item_id", "text").collect()))
    rows = documents.select("doc_id", "text").collect()
    found = windows_in([r.text for r in rows], items)
    clean = {r.doc_id for r, (n, hit, _) in zip(rows, found) if not (hit and 20 * hit >= n)}
    out = cp.drop_contaminated(spark, documents, folder)
    assert out.columns == documents.columns
    assert {r.doc_id for r in out.collect()} == clean


def test_secrets_are_masked(spark, folder, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    out = cp.mask_secrets(spark, documents, folder)
    assert out.columns == documents.columns and out.count() == len(texts)
    for r in out.collect():
        want, at = "", 0
        for start, _, end, _ in secrets_in(texts[r.doc_id]):
            if start >= at:
                want += texts[r.doc_id][at:start] + "[secret]"
            at = max(at, end)
        want += texts[r.doc_id][at:]
        assert r.text == want and r.n_chars == len(want)


def test_whole_pipeline(spark, folder, documents):
    out = cp.run(spark, folder)
    assert 0 < out.select("doc_id").distinct().count() < documents.count()


def test_odd_and_no_rows(spark, folder, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        docs = docs.withColumn("n_chars", docs.shard.cast("long"))
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        cp.STAGES[-1][1](spark, docs, folder).collect()


def test_rows_dropped_do_not_depend_on_how_files_are_read(spark, scratch, monkeypatch):
    """Executors may come and go between the two reads of the stage's input."""
    texts = [f"{w} " + " ".join(f"word{i % 7}{j}" for j in range(40)) for i in range(60) for w in "ab"]
    df = spark.createDataFrame(
        [(None if i % 5 == 0 else i % 9, t, "s") for i, t in enumerate(texts)],
        "doc_id long, text string, file string",
    )
    path = scratch.path("docs")
    df.repartition(5).write.option("parquet.block.size", 1024).parquet(path)
    docs = spark.read.parquet(path)
    real = cp.jaccard_join.jaccard_join

    def changed(*args):
        out = scratch.keep(real(*args), "joined")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
        return out

    monkeypatch.setattr(cp.jaccard_join, "jaccard_join", changed)
    try:
        kept = cp.drop_near_copies(spark, docs, "").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # One of each group of texts that are alike stays, with all its columns.
    def group(t):
        return t.split(" ", 1)[1]

    assert sorted(group(r.text) for r in kept) == sorted({group(t) for t in texts})
    assert docs.columns == ["doc_id", "text", "file"] and len(kept[0]) == 3


def test_rows_of_other_frames_are_numbered_once(spark, scratch):
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text"))
    rows = cp.with_places(docs.union(docs), scratch)
    assert rows.select("place").distinct().count() == 40
    kept = cp.drop_near_copies(spark, docs.union(docs), "")
    assert kept.count() == 1
