"""Benchmark decontamination: short test items found inside long documents.

An item is in a document if the document has at least ``threshold`` percent of the item's
word shingles. Plain MinHash bands over whole documents cannot find this: a long document's
minima say next to nothing about a short item. The search therefore turns around: items are
partitioned by their number of shingles, and each size has its own number of MinHash values, the
k smallest hashes of the item's shingles, k = n - ceil(threshold * n) + 1. A document that
contains the item lacks at most n - ceil(threshold * n) of its shingles, so it has at least
one of the k: no containing document is missed. Documents are read once per block of
items; their shingles are looked up among the MinHash values, and every item that is hit is
verified at once on the document's whole shingle set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import bound_batches
from tickloom.llm.shingles import shingle_sets, shingles, slices
from tickloom.session import store

# Shingles of the items that are sent to the tasks at once; more items take more passes.
ITEM_BLOCK_SHINGLES = 1 << 20
# Leading bits of a hash that are looked up before the hash itself.
LOOKUP_BITS = 20


class Sketches:
    """The items of a block: whole shingle sets, and for each size its MinHash values."""

    def __init__(self, items: list[tuple[int, np.ndarray]], threshold: int) -> None:
        self.ids = [i for i, _ in items]
        self.sets = [s for _, s in items]
        by_size: dict[int, list[int]] = {}
        for number, members in enumerate(self.sets):
            by_size.setdefault(len(members), []).append(number)
        values, owners = [], []
        for n, numbers in sorted(by_size.items()):
            least = n - -(-threshold * n // 100) + 1
            for number in numbers:
                values.append(self.sets[number][:least])
                owners.append(np.full(least, number))
        values, owners = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]
        self.lookup = np.zeros(1 << LOOKUP_BITS, dtype=bool)
        self.lookup[self.values >> np.uint64(64 - LOOKUP_BITS)] = True
        self.threshold = threshold

    def found(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text number, item number and common shingles, for all texts of a block."""
        near = np.flatnonzero(self.lookup[hashes >> np.uint64(64 - LOOKUP_BITS)])
        at = np.searchsorted(self.values, hashes[near])
        at[at == len(self.values)] = 0
        near = near[self.values[at] == hashes[near]]
        if len(near) == 0:
            return
        texts = np.searchsorted(bounds, near, "right") - 1
        first = np.searchsorted(self.values, hashes[near], "left")
        last = np.searchsorted(self.values, hashes[near], "right")
        for text in np.unique(texts):
            mine = texts == text
            numbers = {int(x) for a, b in set(zip(first[mine], last[mine])) for x in self.owners[a:b]}
            whole = np.unique(hashes[bounds[text] : bounds[text + 1]])
            for number in sorted(numbers):
                members = self.sets[number]
                place = np.minimum(np.searchsorted(whole, members), len(whole) - 1)
                common = int(np.count_nonzero(whole[place] == members))
                if 100 * common >= self.threshold * len(members):
                    yield int(text), number, common


def _item_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                ],
                names=["item_id", "n", "members"],
            )

    return run


def _search(size: int, items, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Sketches(items.value, threshold)
        for batch in batches:
            hits: list[list[tuple[int, int, int]]] = []
            for start, stop in slices(batch.column(0)):
                own: list[list[tuple[int, int, int]]] = [[] for _ in range(stop - start)]
                hashes, bounds = shingles(batch.column(0).slice(start, stop - start), size)
                for text, number, common in block.found(hashes, bounds):
                    own[text].append((block.ids[number], common, len(block.sets[number])))
                hits += own
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("common", pa.int64()), ("item_shingles", pa.int64())]))
            values = [[dict(zip(("item_id", "common", "item_shingles"), h)) for h in row] for row in hits]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values, kind)], names=[*batch.schema.names[1:], "items"])

    return run


def item_blocks(items: DataFrame, ids: str, text: str, size: int) -> tuple[DataFrame, int]:
    """Items with shingles, numbered into blocks of bounded size by a hash of their id."""
    sets = items.select(F.col(ids).cast("long").alias("item_id"), F.col(text).alias("text"))
    sets = store(sets.mapInArrow(_item_sets(size), "item_id long, n long, members binary").where("n > 0"), "benchmark-sets")
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = -(-2 * total // ITEM_BLOCK_SHINGLES) if total > ITEM_BLOCK_SHINGLES else 1
    return sets.withColumn("block", F.pmod(F.xxhash64("members"), F.lit(blocks))), blocks


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 5,
    threshold: int = 80,
) -> DataFrame:
    """Documents with the items they contain: all input columns and ``items``.

    ``items`` is an array of (item_id, common, item_shingles), by item_id; empty if none. An input
    column of that name is replaced. An item with fewer than ``size`` words has one shingle of all
    its words, which only a document of just these words has. Items and documents that are null,
    empty or without words match nothing. Repeated rows are answered alike; repeated items all
    count. With an empty table on either side nothing is contained.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    documents = documents.drop(*[c for c in ("items",) if c != text])
    kind = "array<struct<item_id:bigint,common:bigint,item_shingles:bigint>>"
    numbered, blocks = item_blocks(items, item_id, item_text, size)
    out = documents.withColumn("items", F.array().cast(kind))
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).select("item_id", "members").toPandas()
        if rows.empty:
            continue
        sets = [(None if i != i else int(i), np.frombuffer(m, np.uint64)) for i, m in zip(rows["item_id"], rows["members"])]
        block_items = spark.sparkContext.broadcast(sets)
        before = out.withColumnRenamed("items", "__before")
        schema = before.withColumn("items", F.array().cast(kind)).schema
        found = before.select(F.col(text).alias("__text"), *before.columns).mapInArrow(_search(size, block_items, threshold), schema)
        out = found.withColumn("items", F.concat("__before", "items")).drop("__before")
    return out.withColumn("items", F.array_sort("items"))


def clean_documents(documents: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents that contain no item; the columns stay as they are."""
    found = contained_items(documents, items, text, **options)
    return found.where(F.size("items") == 0).select(*documents.columns)
