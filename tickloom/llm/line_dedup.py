"""Removal of lines that many documents share.

Two Bloom filters of fixed size hold the hashes of lines that some document has, and of those
that more than one document has. Only lines that pass the second filter are shuffled, as 128-bit
hashes: their documents are counted exactly, and if asked for their first occurrence is chosen.
What the filters let pass by mistake is counted like the rest and stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import bound_batches, lean
from tickloom.llm import bloom
from tickloom.llm.shingles import _IS_WORD, _power, mix, raw_bytes, slices
from tickloom.session import store

_RANDOM = np.random.default_rng(19991231)
_LINE_BYTES = _RANDOM.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LINE_BYTES[:, 65:91] = _LINE_BYTES[:, 97:123]
NEWLINE = 10
# Documents of one line's key that one part of the join takes.
PART_DOCUMENTS = 20000


class Lines:
    """The lines of a block of texts: bounds in the bytes, key hashes, key lengths, text numbers."""

    def __init__(self, texts: pa.Array, least_chars: int) -> None:
        data, offsets = raw_bytes(texts)
        self.data = data
        breaks = np.flatnonzero(data == NEWLINE)
        self.starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
        self.ends = ends
        counts = np.diff(np.searchsorted(breaks, offsets)) + 1
        self.texts = np.repeat(np.arange(len(texts)), counts)
        self.bounds = np.concatenate([[0], np.cumsum(counts)])
        solid = np.flatnonzero(_IS_WORD[data])
        first, last = np.searchsorted(solid, self.starts), np.searchsorted(solid, ends)
        filled = last > first
        begin, end = np.zeros_like(self.starts), np.zeros_like(self.starts)
        begin[filled], end[filled] = solid[first[filled]], solid[last[filled] - 1] + 1
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.counted = (chars[end] - chars[begin] >= least_chars) & filled
        self.hashes = []
        for table in _LINE_BYTES:
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(table[data] * _power("up", len(data)), out=sums[1:])
            down = np.concatenate([_power("down", max(len(data), 1)), [np.uint64(0)]])
            self.hashes.append(mix((sums[end] - sums[begin]) * down[begin]))


def _gather(least_chars: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = bloom.Gathered(bits)
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                lines = Lines(batch.column(0).slice(start, stop - start), least_chars)
                for i in range(stop - start):
                    part = slice(lines.bounds[i], lines.bounds[i + 1])
                    own = lines.hashes[0][part][lines.counted[part]]
                    if len(own):
                        found.add(np.unique(own))
        yield from found.blocks()

    return run


def _suspects(least_chars: int, filters):
    """Lines that other documents may have: document, number of the line, hash; the first of each in a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                lines = Lines(batch.column(0).slice(start, stop - start), least_chars)
                at = np.flatnonzero(lines.counted)
                at = at[bloom.passes(filters.value, lines.hashes[0][at])]
                order = np.lexsort((at, lines.hashes[1][at], lines.hashes[0][at], lines.texts[at]))
                at = at[order]
                keys = (lines.texts[at], lines.hashes[0][at], lines.hashes[1][at])
                new = np.ones(len(at), dtype=bool)
                new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0) if len(at) else []
                at = at[new]
                who = pa.array(start + lines.texts[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(who),
                        batch.column(2).take(who),
                        pa.array((at - lines.bounds[lines.texts[at]]).astype(np.int64)),
                        pa.array(lines.hashes[0][at].view(np.int64)),
                        pa.array(lines.hashes[1][at].view(np.int64)),
                    ],
                    names=["row_key", "row_id", "line", "h1", "h2"],
                )

    return run


def _cut(least_chars: int, keep_first: bool, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            width = batch.num_columns - 2
            for start, stop in slices(texts):
                part = texts.slice(start, stop - start)
                lines = Lines(part, least_chars)
                cuts = batch.column(width).slice(start, stop - start).to_pylist()
                firsts = batch.column(width + 1).slice(start, stop - start).to_pylist()
                kept, dropped = part.to_pylist(), []
                for i, cut in enumerate(cuts):
                    here = slice(lines.bounds[i], lines.bounds[i + 1])
                    gone = np.zeros(here.stop - here.start, dtype=bool)
                    if cut:
                        wanted = np.array(cut, np.int64).view(np.uint64)
                        gone = np.isin(lines.hashes[0][here], wanted) & lines.counted[here]
                        if keep_first and firsts[i]:
                            gone[np.array(firsts[i], np.int64)] = False
                    if gone.any():
                        stay = np.flatnonzero(~gone) + here.start
                        pieces = [lines.data[a:b].tobytes() for a, b in zip(lines.starts[stay], lines.ends[stay])]
                        kept[i] = b"\n".join(pieces).decode()
                    dropped.append(int(gone.sum()))
                columns = [batch.column(k).slice(start, stop - start) for k in range(width)]
                columns[text_at] = pa.array([x or "" for x in kept], pa.string())
                columns += [pa.array(np.diff(lines.bounds), pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[str(k) for k in range(len(columns))])

    return run


def drop_common_lines(
    documents: DataFrame,
    ids: str = "doc_id",
    text: str = "text",
    min_documents: int = 10,
    least_chars: int = 1,
    keep_first: bool = False,
    bits: int = bloom.DEFAULT_BITS,
) -> DataFrame:
    """Documents without the lines whose key at least ``min_documents`` of them have.

    Texts are split at newlines. A line's key is the line without white space (space and
    0x09-0x0D) at both ends, with A-Z as a-z; keys below ``least_chars`` characters are never
    dropped. All lines of a common key go; with ``keep_first`` its first occurrence stays, that
    in the document with the smallest (id, content hash), null ids first, and in its first such line.

    All input columns return, the text cut and never null, with ``n_lines`` (before) and
    ``n_dropped``; an input column of one of these names is replaced. A null or empty text is one
    empty line. Every row is a document: repeated rows count and are cut alike, but of fully equal
    rows each keeps the first occurrence. An empty table gives an empty table.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    documents = documents.drop(*[c for c in ("n_lines", "n_dropped") if c not in (ids, text)])
    key = F.xxhash64(F.col(ids), F.col(text))
    gathered = documents.select(text).mapInArrow(lean(_gather(least_chars, bits)), bloom.SCHEMA)
    filters = spark.sparkContext.broadcast(bloom.build(gathered, bits)[1])
    suspects = store(
        documents.select(F.col(text), key.alias("row_key"), F.col(ids).cast("string").alias("row_id")).mapInArrow(
            lean(_suspects(least_chars, filters)), "row_key long, row_id string, line long, h1 long, h2 long"
        ),
        "line-suspects",
    )
    place = F.struct(F.col("row_id").cast(documents.schema[ids].dataType).alias("id"), "row_key", "line")
    common = (
        suspects.groupBy("h1", "h2")
        .agg(F.count("*").alias("found_in"), F.min(place).alias("first"))
        .where(F.col("found_in") >= min_documents)
    )
    common = store(common, "line-common")
    # A key that very many documents have is split into as many parts as its own count asks for.
    parts = F.ceil(F.col("found_in") / PART_DOCUMENTS).cast("int")
    hot = common.where(parts > 1).select("h1", "h2", parts.alias("parts"))
    spread = common.select("h1", "h2", "first", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    part = F.pmod(F.hash("row_key"), F.coalesce("parts", F.lit(1))).alias("part")
    hits = suspects.join(hot, ["h1", "h2"], "left").select("h1", "h2", "row_key", part).join(spread, ["h1", "h2", "part"])
    verdict = hits.groupBy("row_key").agg(
        F.collect_set("h1").alias("cut"),
        F.collect_set(F.when((F.col("first.row_key") == F.col("row_key")), F.col("first.line"))).alias("first"),
    )
    verdict = verdict.select(F.col("row_key").alias("__key"), F.col("cut").alias("__cut"), F.col("first").alias("__first"))
    joined = documents.withColumn("__key", key).join(verdict, "__key", "left")
    names = documents.columns
    ready = joined.select(*names, "__cut", "__first")
    schema = ready.select(*names).schema.add("n_lines", "long").add("n_dropped", "long")
    text_at = names.index(text)
    return ready.mapInArrow(lean(_cut(least_chars, keep_first, text_at)), schema)
