"""The subpackage's queries against their SQL, and the pipeline against a plain version."""

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import brute
from tickloom.llm import bloom, queries, quality_classifier
from tools.compare import rows_of

QUERIES, ORACLE = queries.load()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, sql, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    cursor = sql.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, cursor.fetchall())


def test_pipeline_keeps_what_a_plain_version_keeps(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    scores = {r.doc_id: r.score for r in quality_classifier.score_documents(documents, labels).collect()}
    rows = [(r.doc_id, r.text) for r in documents.collect() if scores[r.doc_id] >= 0.7]
    rows = list(zip([i for i, _ in rows], brute.without_common_lines([t for _, t in rows], 10)))
    first = {i for i, _, least in brute.components(rows, 5, 80) if i == least}
    rows = [(i, t) for i, t in rows if i in first and not brute.contained(t, items, 5, 80)]
    result = corpus_pipeline.run(spark, sf_dir)
    got = result.collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got) == sorted((i, t, len(t)) for i, t in rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line dedup", "near duplicates", "decontamination", "pieces"]
    assert set(documents.columns) <= set(result.columns)


def test_stages_handle_nulls_repeats_and_empty_tables(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = [(None, None, None, None, None), (900001, None, "en", "s", 0), (900001, "", "en", "s", 0), (None, "some text", None, None, 9)]
    odd += [(900002, "a text of several words here", "en", "s", 1)] * 2
    mixed = documents.limit(30).unionByName(spark.createDataFrame(odd, documents.schema))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), sf_dir).count() == 0
        out = stage(spark, mixed, sf_dir)
        assert out.columns[:5] == documents.columns
        assert out.count() <= mixed.count()
        if name == "near duplicates":
            assert out.where("doc_id = 900002").count() == 1
            assert out.where("doc_id IS NULL").count() == 2


def test_near_duplicates_are_rows_not_ids(spark):
    """Copies under a repeated or null id go; columns may have any name."""
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, 5, 0), (1, long + " tail", 6, 0), (None, long, 7, 0), (1, "other words than those above", 8, 0), (2, long, 9, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, copies long, key long")
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "").collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {1}
    assert sum(r.text.startswith(long) for r in kept) == 1


def test_texts_of_rows_that_stay_are_not_shuffled(spark, tmp_path):
    """Rows that no other is near come in the order of their file; only the doubtful ones meet the verdict in a join."""
    rows = [(i, " ".join(f"word{i}x{k}" for k in range(30))) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)] + [rows[i] for i in range(20, 30)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/documents"), "")
        got = kept.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.doc_id, r.text) for r in got) == rows[:400]
    first = [r.doc_id for r in got[:340]]
    assert first == sorted(first) and not set(first) & set(range(20, 30))


@pytest.mark.parametrize("count", [1, 5_000, 28_766, 300_000])
def test_filters_let_few_others_pass(count):
    random = np.random.default_rng(count)
    held, others = random.integers(0, 1 << 64, (2, count), dtype=np.uint64)
    found = bloom.Gathered(bloom.bits_for(count))
    found.add(held)
    packed = np.packbits(found.cells > 0)
    assert bloom.passes(packed, held).all()
    assert bloom.passes(packed, others).mean() <= 0.04
    assert bloom.bits_for(1 << 40) == bloom.DEFAULT_BITS
