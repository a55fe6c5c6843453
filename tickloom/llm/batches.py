"""Size of the Arrow batches that go to Python tasks, and the memory that tasks leave to their worker."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
# Freed memory goes back to the system each time that batches of so many bytes have been read.
RETURNED_BYTES = 4 << 20

Batches = Iterator[pa.RecordBatch]


def bound_batches(spark: SparkSession) -> None:
    """Keep batches small: texts differ in length by orders of magnitude, and each batch is in
    memory on both sides. A session that asks for smaller batches keeps them."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name, None)
        digits = "".join(c for c in str(now) if c.isdigit()) if now else ""
        if not digits or int(digits) > most or int(digits) <= 0:
            spark.conf.set(name, str(most))


def give_back() -> None:
    """Return freed memory to the system, as far as the C library at hand can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, which does not leave what it freed to its worker.

    A worker serves one task after the other, and the holes that one leaves in its heap count for the executor
    until it ends. Results are those of ``run``.
    """

    def task(batches: Batches) -> Batches:
        def counted() -> Batches:
            read = 0
            for batch in batches:
                yield batch
                read += batch.nbytes
                if read >= RETURNED_BYTES:
                    give_back()
                    read = 0

        yield from run(counted())
        give_back()

    return task
