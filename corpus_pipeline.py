"""A corpus pipeline: documents that a language model may be trained on, and their tokens.

Quality filter, line dedup, near-duplicate removal, benchmark decontamination and encoding. Every
stage takes all that its predecessor kept and returns the columns of ``documents``, the last one
with the piece ids added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bloom, decontaminate, line_dedup, quality_classifier, sentencepiece_nbest
from tickloom.llm.jaccard_join import JaccardJoin
from tickloom.llm.queries import tokenizer_path
from tickloom.session import scratch_path, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.7 go; it learns from the labels at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_classifier.score_documents(docs.withColumn("row", F.struct(*docs.columns)).select("doc_id", "text", "row"), labels)
    return scored.where(F.col("score") >= 0.7).select("row.*")


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents have go, and n_chars follows; every document stays."""
    kept = line_dedup.drop_common_lines(docs, min_documents=10, least_chars=1)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", length)
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 stays: that with the smallest id.

    Rows are told apart by id and content, so a repeated or null id keeps no copy; null ids come last.
    Of rows with the same id and text one stays. Null and empty texts are linked with nothing and stay.
    """
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"))
    groups = JaccardJoin(rows.select("key", "row.text"), "key", "text", size=5, threshold=80).components()
    groups = groups.groupBy(F.col("id").alias("key")).agg(F.first("component_id").alias("group"), F.count("*").alias("copies"))
    ids = rows.groupBy("key").agg(F.first("row.doc_id").alias("id"))
    place = F.struct(F.isnull("id"), "id", "key", "copies").alias("place")
    chosen = ids.join(groups, "key").groupBy("group").agg(F.min(place).alias("place")).select("place.key", "place.copies")
    chosen = store(chosen, "pipeline-chosen")
    doubtful = store(groups.select("key").join(chosen.where("copies = 1"), "key", "left_anti"), "pipeline-doubtful")
    rows = bloom.with_held(rows, doubtful, "key", bloom.bits_for(doubtful.count()))
    staying, rows = rows.where("NOT held").select("row.*"), rows.where("held").drop("held")
    single = staying.unionByName(rows.join(chosen.where("copies = 1"), "key").select("row.*"))
    repeated = chosen.where("copies > 1")
    if repeated.isEmpty():
        return single
    several = rows.join(repeated, "key").dropDuplicates(["key"]).select("row.*")
    return single.unionByName(several)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and its best segmentations."""
    model = tokenizer_path(spark, "piece_bpe_32k.model")
    return sentencepiece_nbest.encode(docs, model, n_best=4).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_low_quality),
    ("line dedup", drop_common_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

# A trained classifier decides first, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
