"""Nearest neighbours by cross-polytope hashing with multiprobe tables.

A table turns the directions of vectors by a random pseudo-rotation, three rounds of random signs and
a fast Hadamard transform, and hashes each to the nearest signed axis. A query probes the buckets of
the axes nearest to it in every table; what it meets there is scored exactly.

Longer vectors can be near at wider angles: those up to twice as long as usual are a tier of their own
with twice the probes, those up to four times as long one with four times, and so on. A tier that
holds no more vectors than it takes probes, or whose probes reach every bucket, is compared whole.
A query that met fewer vectors than it wants is compared with all of them.

Equal vectors form a class that is hashed and scored once. Buckets are split by their sizes, on the
side of the vectors and on that of the queries, so no task gets an unbounded bucket; a part of
a bucket returns only the best of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.batches import bound_batches
from tickloom.session import store

TABLES = 8
PROBES = 20
# Vectors or queries that one part of a bucket holds.
PART_ROWS = 4096
# Rows beyond the wanted ones that a part scores exactly, against rounding in the product.
MARGIN = 8


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of the rows, whose length is a power of two."""
    count, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(count, -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, width)
        step *= 2
    return x / np.sqrt(width)


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    random = np.random.default_rng(table)
    width = 1 << max(0, (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x
    for _ in range(3):
        out = hadamard(out * (random.integers(0, 2, width) * 2 - 1))
    return out


def axes(x: np.ndarray, table: int, count: int) -> np.ndarray:
    """The ``count`` signed axes nearest to each row, nearest first; axis i with sign minus is i + width."""
    turned = rotate(x, table)
    both = np.concatenate([turned, -turned], axis=1)
    count = min(count, both.shape[1])
    if count == 1:
        return both.argmax(axis=1)[:, None]
    near = np.argpartition(-both, count - 1, axis=1)[:, :count]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(both, near, 1), axis=1, kind="stable"), 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, as squares of very large or small components leave the range of a double.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hash(tables: int, probes: dict[int, int], query: bool):
    """One row for each table and bucket: of its own tier for a vector, of all tiers for a query.

    ``probes`` has the number of probes of each tier. A tier without one is whole: bucket 0 of table -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, 2048) for whole in batches for start in range(0, whole.num_rows, 2048)):
            x, tiers = _unit(_matrix(batch.column(1))), np.array(batch.column(2).to_pylist())

            def placed(tier: int, table: int, found: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
                who = pa.array(np.repeat(rows, found.shape[1]))
                places = [pa.array(np.full(len(who), n, np.int32)) for n in (tier, table)]
                columns = [*places, pa.array(found.reshape(-1).astype(np.int32)), *(batch.column(c).take(who) for c in (0, 1))]
                return pa.RecordBatch.from_arrays(columns, names=["tier", "table", "bucket", "class_id", "vector"])

            def members(tier: int) -> np.ndarray:
                return np.arange(len(x)) if query else np.flatnonzero(tiers == tier)

            for tier in probes:
                if not probes[tier]:
                    rows = members(tier)
                    yield placed(tier, -1, np.zeros((len(rows), 1)), rows)
            for table in range(tables if any(probes.values()) else 0):
                found = axes(x, table, max(probes.values()) if query else 1)
                for tier in probes:
                    if probes[tier]:
                        rows = members(tier)
                        yield placed(tier, table, found[rows, : probes[tier]] if query else found[rows], rows)

    return run


def _best(count: int):
    def run(_key, vectors, queries):
        kind = pa.list_(pa.struct([("class_id", pa.int64()), ("score", pa.float64())]))
        if vectors.num_rows == 0 or queries.num_rows == 0:
            return pa.table({"query_class": pa.array([], pa.int64()), "found": pa.array([], kind)})
        x, q = _matrix(vectors.column("vector")), _matrix(queries.column("vector"))
        ids = np.array(vectors.column("class_id").to_pylist(), np.int64)
        rows = []
        keep = min(count + MARGIN, len(x))
        for start in range(0, len(q), 512):
            part = q[start : start + 512]
            near = np.argpartition(-(part @ x.T), keep - 1, axis=1)[:, :keep]
            for query, at in zip(part, near):
                # The same sum for the same pair in every table.
                scores = (x[at] * query).sum(axis=1)
                order = np.lexsort((ids[at], -scores))[:count]
                rows.append([{"class_id": int(ids[at][i]), "score": float(scores[i])} for i in order])
        return pa.table({"query_class": queries.column("class_id"), "found": pa.array(rows, kind)})

    return run


def _met(index: DataFrame, queries: DataFrame, count: int) -> DataFrame:
    """query_class, class_id and score of the best ``count`` + 1 of each query in each part of a bucket."""

    def parts(frame: DataFrame) -> int:
        most = frame.groupBy("tier", "table", "bucket").count().agg(F.max("count")).first()[0] or 0
        return -(-most // PART_ROWS) or 1

    rows_in, rows_out = parts(index), parts(queries)

    def dealt(frame: DataFrame, own: str, count_own: int, other: str, count_other: int) -> DataFrame:
        spread = F.explode(F.sequence(F.lit(0), F.lit(count_other - 1)))
        return frame.withColumn(own, F.pmod(F.xxhash64("class_id"), F.lit(count_own)).cast("int")).withColumn(other, spread)

    keys = ["tier", "table", "bucket", "x", "y"]
    left = dealt(index, "x", rows_in, "y", rows_out).groupBy(*keys)
    right = dealt(queries, "y", rows_out, "x", rows_in).groupBy(*keys)
    found = left.cogroup(right).applyInArrow(
        _best(count + 1), "query_class long, found array<struct<class_id:bigint,score:double>>"
    )
    return found.select("query_class", F.explode("found").alias("hit")).select("query_class", "hit.*")


def usable_vectors(rows: DataFrame, ids: str, vector: str) -> DataFrame:
    """id and vector of rows that can take part: known id, finite components, not all zero, and as
    many components as most of them (the smaller number on a tie)."""
    values = rows.select(F.col(ids).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    values = values.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0))
    sizes = values.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    return values.where(F.size("vector") == (sizes[0].width if sizes else 0))


def nearest(
    rows: DataFrame,
    is_query: F.Column,
    count: int = 20,
    ids: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """For each row that ``is_query`` (over ``ids``) holds for: query_id, rank, ids, score.

    Its ``count`` nearest by inner product among all other rows found, of any length, nearest first,
    ties to smaller ids; fewer only if there are fewer other rows. Rows with the query's own id are no candidates; other rows with an equal vector are.
    Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
    of another length than most. Repeated rows count once. Other columns are not read. No usable
    rows, or no queries, give no rows.
    """
    bound_batches(rows.sparkSession)
    usable = store(usable_vectors(rows, ids, vector).distinct(), "ann-vectors")
    small = Window.partitionBy("vector").orderBy("id")
    # Of a class only the smallest ids can be among the nearest; Spark cuts them before the shuffle too.
    members = usable.withColumn("place", F.row_number().over(small)).where(F.col("place") <= count + 1)
    classes = members.groupBy("vector").agg(F.min("id").alias("class_id"), F.sort_array(F.collect_list("id")).alias("ids"))
    classes = store(classes, "ann-classes")
    # The logarithm of the length, in twos.
    greatest = F.aggregate("vector", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, v: a + (v / F.col("greatest")) ** 2)
    both = classes.select("class_id", "vector", greatest.alias("greatest"))
    both = both.withColumn("length", F.log2("greatest") + F.log2(squares) / 2)
    usual = both.agg(F.percentile_approx("length", 0.5), F.first(F.size("vector"))).first()
    # Up to a quarter longer is usual.
    tier = F.greatest(F.lit(0), F.ceil(F.col("length") - F.lit((usual[0] or 0.0) + 0.33))).cast("int")
    both = both.select("class_id", "vector", tier.alias("tier"))
    sizes = {r.tier: r["count"] for r in both.groupBy("tier").count().collect()}
    buckets = 2 << max(0, ((usual[1] or 1) - 1).bit_length())
    per_tier = {t: min(probes << t, buckets) for t in sorted(sizes)}
    per_tier = {t: n if n < buckets and sizes[t] > tables * n else 0 for t, n in per_tier.items()}
    asked = usable.where(is_query).join(classes.select("vector", "class_id"), "vector").select("id", "class_id")
    asked = store(asked, "ann-queries")

    schema = "tier int, table int, bucket int, class_id long, vector array<double>"
    query_classes = both.join(asked.select("class_id").distinct(), "class_id", "left_semi").select(*both.columns)

    def met(queries: DataFrame, per_tier: dict[int, int]) -> DataFrame:
        return _met(both.mapInArrow(_hash(tables, per_tier, False), schema), queries.mapInArrow(_hash(tables, per_tier, True), schema), count)

    pairs = store(met(query_classes, per_tier), "ann-pairs")
    wanted = min(count + 1, sum(sizes.values()))
    enough = pairs.groupBy("query_class").agg(F.count_distinct("class_id").alias("n")).where(F.col("n") >= wanted)
    poor = store(query_classes.join(enough, query_classes["class_id"] == enough["query_class"], "left_anti"), "ann-poor")
    if not poor.isEmpty():
        pairs = pairs.unionByName(met(poor, dict.fromkeys(per_tier, 0)))
    # The best classes of each query class, then the best rows of these classes.
    pairs = pairs.groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    pairs = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count + 1)
    hits = pairs.join(classes.select("class_id", "ids"), "class_id").select(
        "query_class", F.explode("ids").alias("id"), "score"
    )
    order = Window.partitionBy("query_class").orderBy(F.desc("score"), "id")
    hits = hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count + 1)
    answer = hits.groupBy("query_class").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("found"))
    # A query leaves itself out of its class's answer.
    others = F.filter("found", lambda h: h["id"] != F.col("query_id"))
    each = asked.select(F.col("id").alias("query_id"), F.col("class_id").alias("query_class")).distinct().join(answer, "query_class")
    top = each.select("query_id", F.posexplode(F.slice(others, 1, count)).alias("at", "hit"))
    return top.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias(ids), F.col("hit.score").alias("score"))
