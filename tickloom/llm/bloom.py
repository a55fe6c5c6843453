"""Bloom filters of bounded size over 64-bit hashes, built by Spark and probed in tasks.

A filter has one bit per hash, at the hash's leading bits. Its size is a parameter and never
follows the data: beyond its capacity it lets more hashes pass, which costs time and no result.
``repeats`` is a second filter of the same shape for bits that were set more than once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DEFAULT_BITS = 25
LEAST_BITS = 18
# Filters are merged block by block, so that no task ever holds a whole column of filters.
BLOCK_BITS = 16

SCHEMA = "block int, seen binary, repeats binary"
ARROW_SCHEMA = pa.schema([("block", pa.int32()), ("seen", pa.binary()), ("repeats", pa.binary())])


class Gathered:
    """The two filters of one task, as a byte per cell: 1 if it was set, 3 if more than once."""

    def __init__(self, bits: int) -> None:
        self.shift = np.uint64(64 - bits)
        self.cells = np.zeros(1 << bits, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Add the distinct hashes of one document."""
        at = np.sort(hashes.astype(np.uint64) >> self.shift)
        again = self.cells[at] > 0
        again[1:] |= at[1:] == at[:-1]
        self.cells[at] |= np.uint8(1)
        self.cells[at[again]] = 3

    def blocks(self) -> Iterator[pa.RecordBatch]:
        size = 1 << BLOCK_BITS
        for block in range(len(self.cells) // size):
            part = self.cells[block * size : (block + 1) * size]
            if part.any():
                packed = [zlib.compress(np.packbits(part >= least).tobytes(), 1) for least in (1, 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array(packed[:1], pa.binary()), pa.array(packed[1:], pa.binary())],
                    schema=ARROW_SCHEMA,
                )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge rows that come sorted by block, holding one block at a time."""
    block, seen, repeats = None, None, None

    def done() -> pa.RecordBatch:
        packed = [zlib.compress(x.tobytes(), 1) for x in (seen, repeats)]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array(packed[:1], pa.binary()), pa.array(packed[1:], pa.binary())],
            schema=ARROW_SCHEMA,
        )

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
            one, two = (np.frombuffer(zlib.decompress(x), np.uint8) for x in row[1:])
            if row[0] != block:
                if block is not None:
                    yield done()
                block, seen, repeats = row[0], one.copy(), two.copy()
            else:
                repeats |= two | (seen & one)
                seen |= one
    if block is not None:
        yield done()


def build(gathered: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The filters of all tasks as packed bits: at most 2 * 2**bits / 8 bytes."""
    tasks = max(1, min(gathered.rdd.getNumPartitions(), (1 << bits) >> (BLOCK_BITS + 2)))
    merged = gathered.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(_merge, SCHEMA)
    size = 1 << (BLOCK_BITS - 3)
    filters = np.zeros((2, 1 << (bits - 3)), np.uint8)
    for row in merged.collect():
        for kind, packed in enumerate((row.seen, row.repeats)):
            filters[kind, row.block * size : (row.block + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return filters[0], filters[1]


def passes(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in a filter."""
    bits = int(len(packed) * 8).bit_length() - 1
    at = hashes.astype(np.uint64) >> np.uint64(64 - bits)
    return (packed[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1


def bits_for(count: int) -> int:
    """Size of a filter of so many hashes that lets at most one in 32 others pass, but for the largest size."""
    return max(LEAST_BITS, min(DEFAULT_BITS, (32 * count).bit_length()))


def of_rows(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int = DEFAULT_BITS) -> np.ndarray:
    """The filter of the hashes, as 64-bit numbers, that ``hashes`` makes of each batch of ``rows``.

    They are made in the step that gathers them. A Python step of their own before it would give each task a
    second Python worker, and an executor keeps all workers it ever had, with the memory they once took.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(bits)
        for batch in batches:
            found.add(hashes(batch))
        yield from found.blocks()

    return build(rows.mapInArrow(gather, SCHEMA), bits)[0]


def with_held(rows: DataFrame, hashes: DataFrame, column: str, bits: int = DEFAULT_BITS) -> DataFrame:
    """Rows with ``held``: whether the filter of the long column in ``hashes`` may hold theirs, which is never null.

    For rows too wide to go through Python: the filter is a table of 64 bits a row, at most 2**bits / 64 rows, which is
    broadcast, so the rows stay where they were read.
    """
    word, bit = f"shiftrightunsigned({column}, {64 - bits + 6})", f"cast(shiftrightunsigned({column}, {64 - bits}) & 63 AS int)"
    words = hashes.select(F.expr(word).alias("__word"), F.expr(f"shiftleft(1L, {bit})").alias("__bits"))
    words = words.groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    met = rows.withColumn("__word", F.expr(word)).join(F.broadcast(words), "__word", "left")
    return met.withColumn("held", F.coalesce(F.expr(f"getbit(__bits, {bit}) = 1"), F.lit(False))).drop("__word", "__bits")
