"""Token ids of a corpus in binary shard files, with Elias-Fano document boundaries.

A shard file holds a run of documents in ascending id order: all their token ids in one array,
and two Elias-Fano sequences, the end offset of every document and the document ids. An Elias-Fano
sequence of n values up to u takes about n * (2 + log2(u / n)) bits: the low bits of each value
stand side by side, the high bits are a unary bit vector, and the place of every 256th of its ones
is noted, so that a value is found without reading those before it and without 64-bit tables.

File format, little-endian: the ids of all documents; the sequence of ends; that of document ids less the
smallest; and a footer of fixed size: as unsigned 64-bit integers the width of an id in bytes, the number of
documents, of ids, of documents with a null id (which stand first), the smallest document id as a signed
integer, the byte lengths of the two sequences, and the magic ``EFTOK002``. With all that is small at
the end, ids are written as they come and a task never holds a file's ids.
"""

from __future__ import annotations

import io
import os
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.batches import bound_batches
from tickloom.llm.shingles import slices, word_spans
from tickloom.session import partitions_for, scratch_path, store

MAGIC = b"EFTOK002"
FOOTER = "<QQQQqQQ8s"
SAMPLE = 256
# Words whose ids a task remembers before it starts anew.
REMEMBERED_WORDS = 1_000_000
# Texts are encoded in blocks of about so many bytes.
ENCODED_BYTES = 2 << 20
# Runs of words that go to the tokenizer at once, and the ids that are read at once.
RUNS_AT_ONCE = 32
READ_IDS = 1 << 20
RANGE_CHARS = 32


class EliasFano:
    """A sequence of whole numbers that never falls, in compressed form."""

    PART = "<QBQQ"

    def __init__(self, data: bytes | memoryview) -> None:
        self.count, self.low_bits, low, high = struct.unpack_from(self.PART, data)
        at = struct.calcsize(self.PART)
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.samples = np.frombuffer(data, np.uint32, -(-self.count // SAMPLE), at + low + high)

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        low = np.zeros((n, bits), np.uint8)
        for bit in range(bits):
            low[:, bit] = (values >> np.uint64(bit)) & np.uint64(1)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        packed = [np.packbits(x, bitorder="little").tobytes() for x in (low.reshape(-1), high)]
        samples = places[::SAMPLE].astype(np.uint32).tobytes()
        return struct.pack(cls.PART, n, bits, len(packed[0]), len(packed[1])) + packed[0] + packed[1] + samples

    def _low(self, start: int, stop: int) -> np.ndarray:
        out = np.zeros(stop - start, np.uint64)
        if self.low_bits:
            first = start * self.low_bits
            bits = np.unpackbits(self.low[first // 8 : -(-stop * self.low_bits // 8)], bitorder="little")
            bits = bits[first % 8 :][: (stop - start) * self.low_bits].reshape(-1, self.low_bits)
            for bit in range(self.low_bits):
                out |= bits[:, bit].astype(np.uint64) << np.uint64(bit)
        return out

    def select(self, index: int) -> int:
        """The value at an index."""
        place = int(self.samples[index // SAMPLE])
        wanted = index % SAMPLE
        byte = place // 8
        skip = place % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64], bitorder="little")[skip:])
            if wanted < len(ones):
                high = byte * 8 + skip + int(ones[wanted]) - index
                return (high << self.low_bits) | int(self._low(index, index + 1)[0])
            wanted -= len(ones)
            byte, skip = byte + 64, 0

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        return ((places - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.count)


def boundaries(ids: list[int | None], counts: np.ndarray, n_ids: int, width: int) -> bytes:
    """What stands behind the ids of a shard file of documents in ascending id order, nulls first."""
    known = np.array([i for i in ids if i is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    ends = EliasFano.encode(np.cumsum(counts))
    names = EliasFano.encode((known - least).astype(np.uint64))
    return ends + names + struct.pack(FOOTER, width, len(ids), n_ids, len(ids) - len(known), least, len(ends), len(names), MAGIC)


class Shard:
    """A shard file read back, of which only the boundaries are in memory.

    ``source`` is a seekable binary file, or its content; ids are read where they are asked for.
    """

    def __init__(self, source) -> None:
        self.source = source = io.BytesIO(source) if isinstance(source, bytes) else source
        size, footer = source.seek(0, 2), struct.calcsize(FOOTER)
        if size < footer:
            raise ValueError("not a token shard")
        self.width, self.documents, self.ids, self.nulls, self.least, ends, names, magic = struct.unpack(FOOTER, self._bytes(size - footer, footer))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        data = memoryview(self._bytes(size - footer - ends - names, ends + names))
        self.ends, self.names = EliasFano(data[:ends]), EliasFano(data[ends:])

    def _bytes(self, start: int, count: int) -> bytes:
        self.source.seek(start)
        return self.source.read(count)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids from one place to another."""
        return np.frombuffer(self._bytes(start * self.width, (stop - start) * self.width), f"<u{self.width}")

    def document(self, index: int) -> np.ndarray:
        """The ids of one document, found by two selections."""
        return self.tokens(self.ends.select(index - 1) if index else 0, self.ends.select(index))

    def document_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.values().astype(np.int64) + self.least).tolist()


class WordEncoder:
    """Encodes whole texts by their words.

    The tokenizer splits at white space and drops it, takes A-Z as a-z, and nothing it does looks
    across: the ids of a text are those of its words between ASCII white space, one after the other.
    Texts repeat words, so the ids of the words that were met are kept, by their hash. New words
    go to the tokenizer many at a time. A word of letters with marks behind it is two runs to the
    tokenizer, so these are encoded apart; the last id of a run of letters is known by its ``</w>``. A word counts
    as letters only if it still is so once normalised: a letter that comes apart into letter and mark
    would join the marks behind it.
    """

    MARKS = ".,;:!?"

    def __init__(self, path: str, width: int) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = f"<u{width}"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.kind)
        self.tails: dict[str, bytes] = {"": b""}

    def _batches(self, texts: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), RUNS_AT_ONCE):
            for x in self.tokenizer.encode_batch_fast(texts[i : i + RUNS_AT_ONCE], add_special_tokens=False):
                yield np.array(x.ids, self.kind)

    def _alone(self, words: list[str]) -> list[bytes]:
        return [x.tobytes() for x in self._batches(words)]

    def _runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of runs of letters."""
        out: dict[str, bytes] = {}
        groups = [runs[i : i + 512] for i in range(0, len(runs), 512)]
        for group, ids in zip(groups, self._batches([" ".join(g) for g in groups])):
            ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
            if len(ends) == len(group):
                data, ends = ids.tobytes(), ends.tolist()
                out.update(zip(group, [data[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                out.update(zip(group, self._alone(group)))
        return out

    def _is_letters(self, core: str) -> bool:
        if core.isascii():
            return core.isalpha()
        return core.isalpha() and self.tokenizer.normalizer.normalize_str(core).isalpha()

    def _encode(self, words: list[str]) -> list[bytes]:
        cores = [w.rstrip(self.MARKS) for w in words]
        plain = [self._is_letters(c) for c in cores]
        cores = [c.lower() if c.isascii() else c for c in cores]
        runs = self._runs(list({c for c, p in zip(cores, plain) if p}))
        other = [w for w, p in zip(words, plain) if not p]
        apart = iter(self._alone(other))
        tails = [w[len(c) :] if p else "" for w, c, p in zip(words, cores, plain)]
        for tail in set(tails).difference(self.tails):
            self.tails[tail] = self._alone([tail])[0]
        return [runs[c] + self.tails[t] if p else next(apart) for c, t, p in zip(cores, tails, plain)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and where each text's start; a null text has none."""
        hashes, begin, end, bounds, data = word_spans(texts)
        if len(self.hashes) > REMEMBERED_WORDS:
            self._forget()
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, unique)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == unique[known]
        new = np.flatnonzero(~known)
        if len(new):
            text = data.tobytes()
            found = self._encode([text[begin[i] : end[i]].decode() for i in first[new]])
            lengths = np.array([len(x) for x in found]) // self.ids.itemsize
            starts = len(self.ids) + np.concatenate([[0], np.cumsum(lengths)[:-1]])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), self.kind)])
            place = at[new]
            self.hashes = np.insert(self.hashes, place, unique[new])
            self.starts = np.insert(self.starts, place, starts)
            self.lengths = np.insert(self.lengths, place, lengths)
            at = np.searchsorted(self.hashes, unique)
        place = at[back]
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[place] - ends + lengths, lengths)
        out = self.ids[np.arange(len(shift)) + shift]
        return out, np.concatenate([[0], ends])[bounds]


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def _encoder(path: str, width: int) -> WordEncoder:
    """The encoder of this Python worker: Spark gives it task after task, and words come again."""
    state = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders"))
    key = f"{path} {width}"
    if not hasattr(state, key):
        setattr(state, key, WordEncoder(path, width))
    return getattr(state, key)


def _write(folder: str, tokenizer: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer, width)
        number = TaskContext.get().partitionId()
        files, root = _filesystem(folder)
        draft = f"{root}/.draft-{number:06d}-{uuid.uuid4().hex}"
        ids, counts, out = [], [], None
        for batch in batches:
            if out is None:
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(draft)
            ids += batch.column(0).to_pylist()
            for start, stop in slices(batch.column(1), ENCODED_BYTES):
                found, bounds = encode(batch.column(1).slice(start, stop - start))
                own = np.diff(bounds) + 1
                counts.append(own)
                data = np.empty(len(found) + len(own), found.dtype)
                last = np.cumsum(own) - 1
                body = np.ones(len(data), dtype=bool)
                body[last] = False
                data[last] = end_id
                data[body] = found
                out.write(data.tobytes())
        if out is not None:
            ends = np.concatenate(counts)
            total = int(ends.sum())
            out.write(boundaries(ids, ends, total, width))
            out.close()
            # A task that runs again replaces its file by the same content, whole at any moment.
            files.move(draft, f"{root}/shard-{number:06d}.eftok")
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([number], pa.int64()), "documents": pa.array([len(ids)], pa.int64()), "ids": pa.array([total], pa.int64())}
            )

    return run


def write_shards(
    documents: DataFrame, tokenizer: str, ids: str = "doc_id", text: str = "text", end_id: int = 2, width: int = 2
) -> tuple[str, DataFrame]:
    """Encode all texts and write shard files; the folder, and one row per shard.

    ``tokenizer`` is the path of a file of the tokenizers library that splits at white space, the
    same on all executors. Every document gets ``end_id`` behind its ids; a null or empty text has
    only that. ``width`` is the bytes of an id. Documents are in ascending id order over all shards,
    null ids first, and equal ids in the order of their texts; a much repeated id spans several shards.
    Only ids and texts are read. An empty table writes no file. Shards are sized by the bytes of the texts.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    rows = documents.select(F.col(ids).cast("long").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    folder = scratch_path(spark, "token-shards")
    # The driver samples the keys of the ranges, so the texts stand in them by their beginnings.
    ranged = rows.repartitionByRange(partitions_for(spark, size), "id", F.substring("text", 1, RANGE_CHARS))
    ordered = ranged.sortWithinPartitions("id", "text")
    shards = ordered.mapInArrow(_write(folder, tokenizer, end_id, width), "shard long, documents long, ids long")
    return folder, store(shards, "token-manifest")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(folder)
        for batch in batches:
            for number, before in zip(*(batch.column(i).to_pylist() for i in range(2))):
                with files.open_input_file(f"{root}/shard-{number:06d}.eftok") as source:
                    shard = Shard(source)
                    ends = np.concatenate([[0], shard.ends.values().astype(np.int64)])
                    ids, first = shard.document_ids(), 0
                    while first < shard.documents:
                        stop = int(np.searchsorted(ends, ends[first] + READ_IDS, "right")) - 1
                        stop = min(max(stop, first + 1), shard.documents)
                        tokens, edges = shard.tokens(int(ends[first]), int(ends[stop])), ends[first : stop + 1] - ends[first]
                        sums = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(edges[:-1], edges[1:])]
                        columns = [ids[first:stop], ends[first:stop] + before, np.diff(edges), sums]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in columns], names=["id", "start", "n_tokens", "ids_crc32"]
                        )
                        first = stop

    return run


def read_documents(folder: str, shards: DataFrame) -> DataFrame:
    """Each document as the shard files have it: id, start (ids of all documents before it), n_tokens, ids_crc32.

    One row per shard goes to a task, which reads that file's boundaries and then slices of its ids.
    """
    # One row per shard file, so the running sum is over few rows.
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = shards.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    spread = offsets.repartition(max(1, shards.count()), "shard")
    return spread.mapInArrow(_read(folder), "id long, start long, n_tokens long, ids_crc32 long")
