"""Alignment of two tokenizers over a corpus, with counts of linked id pairs.

A text is encoded by a byte-level BPE (A) and a sentencepiece model (B). Byte offsets where tokens of both
end cut it into groups; the A and the B token that end there are linked. The corpus-wide counts of
linked id pairs come from an inverted index: for every pair, compressed bitmaps of the documents that
link it, one for each bit of its multiplicity in a document (bit-sliced planes). Documents are numbered
within chunks of at most 2**16, and a chunk's bitmap is a container of 16-bit numbers or of 2**16 bits,
whichever is smaller. The OR of a pair's planes has one bit per document, and its population count is the pair's
document count; the plane of bit j adds its population count times 2**j to the link count. The same postings then
bring each pair's score back to its documents.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import bound_batches
from tickloom.session import store

CHUNK_DOCUMENTS = 1 << 16
# A chunk ends when it holds about so many (document, pair) entries, which bounds a task's memory.
CHUNK_ENTRIES = 3_000_000
BITMAP_BYTES = CHUNK_DOCUMENTS // 8
# From BITMAP_BYTES on, 2**16 bits are no larger than 16-bit numbers. A container's size tells which it
# holds, so numbers must stay below it: 4,096 of them would be read as bits.
ARRAY_MOST = BITMAP_BYTES // 2 - 1
# Units whose alignment a task remembers, and the longest of them.
REMEMBERED_UNITS = 400_000
REMEMBERED_CHARS = 64

SEPARATORS = " \t\n\x0b\x0c"
UNIT = re.compile(f"[{SEPARATORS}]*[^{SEPARATORS}]+|[{SEPARATORS}]+")
# White space that only one tokenizer cuts at, beside a separator: such texts are one unit.
JOINED_SPACE = re.compile(f"[^\\S{SEPARATORS}][{SEPARATORS}]|[{SEPARATORS}][^\\S{SEPARATORS}]")
WORD_MARK = "▁"


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 as itself, other bytes from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokenizer:
    """Tokenizer A: ids of texts, and the bytes of every id.

    A vocabulary whose merges make the ids in ascending order is the same as one of ranks, which tiktoken
    encodes several times faster; any other vocabulary goes to the tokenizers library.
    """

    # Fixed value: the split pattern of byte-level BPE.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        alphabet = _byte_alphabet()
        content = {i: bytes(alphabet[c] for c in token) for token, i in vocabulary.items() if all(c in alphabet for c in token)}
        self.bytes = [content.get(i, b"") for i in range(max(vocabulary.values()) + 1)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ranked = all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        split = spec.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if ranked and plain and spec.get("normalizer") is None and not spec["model"].get("ignore_merges"):
            import tiktoken

            ranks = {token: i for i, token in content.items() if i < 256 + len(merges)}
            self._one = tiktoken.Encoding("A", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.encode = lambda texts: [self._one(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self.encode = lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokenizer:
    """Tokenizer B: ids of texts that start with the space it adds, or with none, and the bytes of every id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(WORD_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # No piece may hold a separator behind another character, or texts cannot be encoded unit by unit.
        inner = re.compile(f"[^{SEPARATORS}][{SEPARATORS}]")
        self.by_unit = not any(inner.search(p.replace(WORD_MARK, " ")) for p in pieces)
        self.lead = len(self.model.encode("x"))

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids of units of space+text: the space that the model adds is taken off, or its own is cut away."""
        # An empty text would get no added space, so a lone space is led as well.
        led = [not u.startswith(" ") or u == " " for u in units]
        found = self.model.encode(["x" + u if x else u[1:] for u, x in zip(units, led)], num_threads=1)
        return [ids[self.lead :] if x else ids for ids, x in zip(found, led)]


class Aligner:
    """Groups and links of texts, unit by unit.

    A unit is a run of separators and the characters up to the next one. Both tokenizers end a token
    wherever a unit ends, so a text's groups are those of its units one after the other, and a
    task remembers the units it met.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.shown: list[bytes] = []
        self.counts = np.zeros((4, 0), np.int64)  # A tokens, B tokens, groups, and 1 if the bytes differ
        self.links = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def units(self, text: str | None) -> list[str]:
        if not text:
            return []
        whole = " " + text
        if not self.b.by_unit or JOINED_SPACE.search(whole):
            return [whole]
        return UNIT.findall(whole)

    def _align(self, unit: str, a: list[int], b: list[int]) -> tuple[bytes, tuple[int, int, int, int], list[int]]:
        data = unit.encode()
        bytes_a, bytes_b = [self.a.bytes[i] for i in a], [self.b.bytes[i] for i in b]
        if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            return b"", (0, 0, 0, 1), []
        shown, links, first_a, first_b = [], [], 0, 0
        ends_b = {end: j for j, end in enumerate(accumulate(map(len, bytes_b)), 1)}
        for i, end in enumerate(accumulate(map(len, bytes_a)), 1):
            j = ends_b.get(end)
            if j is not None:
                shown.append(",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
                links.append((a[i - 1] << 32) | b[j - 1])
                first_a, first_b = i, j
        return ";".join(shown).encode(), (len(a), len(b), len(shown), 0), links

    def _learn(self, new: list[str]) -> None:
        found = [self._align(*x) for x in zip(new, self.a.encode(new), self.b.encode(new))]
        self.shown += [x[0] for x in found]
        self.counts = np.concatenate([self.counts, np.array([x[1] for x in found], np.int64).reshape(-1, 4).T], axis=1)
        own = np.array([len(x[2]) for x in found], np.int64)
        self.links = np.concatenate([self.links, np.array([link for x in found for link in x[2]], np.int64)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(own)])

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, bytes, np.ndarray]]:
        """For each text: its numbers of A tokens, B tokens and groups; its groups as text; its links as a << 32 | b."""
        if len(self.number) > REMEMBERED_UNITS:
            self._forget()
        number, unnamed = self.number, len(self.shown)
        lists = []
        new: list[str] = []
        for text in texts:
            own = []
            for unit in self.units(text):
                at = number.get(unit)
                if at is None:
                    at = unnamed + len(new)
                    new.append(unit)
                    number[unit] = at
                own.append(at)
            lists.append(own)
        if new:
            self._learn(new)
        for own in lists:
            at = np.array(own, np.int64)
            sums = self.counts[:, at].sum(axis=1)
            if not own or sums[3]:
                yield np.zeros(3, np.int64), b"", np.zeros(0, np.int64)
                continue
            first, lengths = self.starts[at], self.starts[at + 1] - self.starts[at]
            ends = np.cumsum(lengths)
            place = np.arange(ends[-1]) + np.repeat(first - ends + lengths, lengths)
            yield sums[:3], b";".join([self.shown[i] for i in own]), self.links[place]
        if any(len(unit) > REMEMBERED_CHARS for unit in new):
            for unit in new:
                if len(unit) > REMEMBERED_CHARS:
                    # Long units rarely come again; their place stays, but not their text.
                    self.shown[number.pop(unit)] = b""


DOCUMENT = "chunk long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTING = "a int, b int, plane int, documents long, bits_set long, bits binary"
ARROW = pa.schema(
    [("chunk", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32())]
    + [("documents", pa.int64()), ("bits_set", pa.int64()), ("bits", pa.binary())]
)
POSTING_ROWS = 50_000


def container(places: np.ndarray) -> bytes:
    """A chunk's bitmap from ascending document numbers."""
    if len(places) <= ARRAY_MOST:
        return places.astype("<u2").tobytes()
    bits = np.zeros(CHUNK_DOCUMENTS, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def members(bits: bytes) -> np.ndarray:
    """The document numbers in a bitmap."""
    if len(bits) == BITMAP_BYTES:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    return np.frombuffer(bits, "<u2").astype(np.int64)


class Chunk:
    """The inverted index of a run of documents."""

    def __init__(self) -> None:
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.entries = 0

    def add(self, links: np.ndarray) -> int:
        """Add a document; its number."""
        pairs, times = np.unique(links, return_counts=True)
        self.pairs.append(pairs)
        self.times.append(times.astype(np.int32))
        self.entries += len(pairs)
        return len(self.pairs) - 1

    @property
    def full(self) -> bool:
        return len(self.pairs) == CHUNK_DOCUMENTS or self.entries >= CHUNK_ENTRIES

    def postings(self, chunk: int) -> Iterator[pa.RecordBatch]:
        """One row per pair and plane."""
        lengths = [len(p) for p in self.pairs]
        pairs = np.concatenate([np.zeros(0, np.int64), *self.pairs])
        times = np.concatenate([np.zeros(0, np.int32), *self.times])
        self.pairs, self.times = [], []
        places = np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)
        order = np.argsort(pairs, kind="stable")
        pairs, times, places = pairs[order], times[order], places[order]
        fresh = np.ones(len(pairs), dtype=bool)
        fresh[1:] = pairs[1:] != pairs[:-1]
        firsts = np.flatnonzero(fresh)
        named, found_in = pairs[firsts], np.diff(np.append(firsts, len(pairs)))
        counted = np.zeros(len(firsts), dtype=bool)  # pairs whose document count stands in a row already
        plane = 0
        while len(times) and plane <= int(times.max()).bit_length() - 1:
            inside = (times >> plane) & 1 == 1
            own, members_ = pairs[inside], places[inside]
            start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
            at = np.searchsorted(named, own[start])
            documents = np.where(counted[at], 0, found_in[at])
            counted[at] = True
            bounds = np.append(start, len(own))
            for i in range(0, len(start), POSTING_ROWS):
                part = slice(i, min(i + POSTING_ROWS, len(start)))
                edges = bounds[part.start : part.stop + 1]
                yield _posting_batch(chunk, plane, own[start[part]], documents[part], members_, edges)
            plane += 1


def _posting_batch(chunk: int, plane: int, pairs: np.ndarray, documents: np.ndarray, places: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
    counts = np.diff(edges)
    if counts.max() <= ARRAY_MOST:
        data = places[edges[0] : edges[-1]].astype("<u2").tobytes()
        offsets = ((edges - edges[0]) * 2).astype(np.int32)
        bits = pa.Array.from_buffers(pa.binary(), len(pairs), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    else:
        bits = pa.array([container(places[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.binary())
    n = len(pairs)
    given = {
        "chunk": pa.array(np.full(n, chunk)),
        "a": pa.array((pairs >> 32).astype(np.int32)),
        "b": pa.array((pairs & 0xFFFFFFFF).astype(np.int32)),
        "plane": pa.array(np.full(n, plane, np.int32)),
        "documents": pa.array(documents.astype(np.int64)),
        "bits_set": pa.array(counts.astype(np.int64)),
        "bits": bits,
    }
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in ARROW], schema=ARROW)


def _index(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(path_a, path_b)
        chunk, number = Chunk(), TaskContext.get().partitionId() << 24
        for batch in batches:
            rows: list[tuple] = []
            # The texts first: the aligner forgets long units once it is asked for more than there are.
            for (counts, shown, links), doc_id in zip(align(batch.column(1).to_pylist()), batch.column(0).to_pylist()):
                digest = hashlib.sha256(shown).hexdigest() if counts[0] else ""
                rows.append((number, chunk.add(links), doc_id, *counts.tolist(), len(links), digest))
                if chunk.full:
                    yield from chunk.postings(number)
                    chunk, number = Chunk(), number + 1
            columns = list(zip(*rows)) if rows else [()] * 8
            arrays = [pa.array(c, f.type) for c, f in zip(columns, ARROW)]
            yield pa.RecordBatch.from_arrays(arrays + [pa.nulls(len(rows), f.type) for f in list(ARROW)[8:]], schema=ARROW)
        yield from chunk.postings(number)

    return run


class Alignment:
    """The inverted index of a corpus, stored once, and what is read from it.

    ``documents`` has one row per document: its counts and the digest of its groups. ``postings`` has
    one row per pair, chunk and plane. A text that is null, empty, or whose tokens' bytes are not those
    of space+text has no tokens: zeros and an empty digest. Repeated rows and ids, also null ids, are
    documents of their own. Only ids and texts are read, so other columns may have any name. An
    empty table gives empty results. A long unit without separators is aligned in one piece.
    """

    def __init__(self, documents: DataFrame, path_a: str, path_b: str, ids: str = "doc_id", text: str = "text") -> None:
        bound_batches(documents.sparkSession)
        rows = documents.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).alias("text"))
        stored = store(rows.mapInArrow(_index(path_a, path_b), f"{DOCUMENT}, {POSTING}"), "token-alignment")
        self.documents = stored.where("a IS NULL").select("chunk", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        self.postings = stored.where("a IS NOT NULL").select("chunk", "a", "b", "plane", "documents", "bits_set", "bits")

    def pair_counts(self) -> DataFrame:
        """a, b, documents and links of every linked pair.

        Chunks hold different documents, so a pair's bitmaps over chunks OR to one whose population
        count is the sum of theirs.
        """
        return self.postings.groupBy("a", "b").agg(
            F.sum("documents").alias("documents"), F.sum(F.col("bits_set") * F.expr("shiftleft(1L, plane)")).alias("links")
        )

    def scored_documents(self) -> DataFrame:
        """``documents`` with count_sum, the counts of all their links, and n_best, how many of these are
        the highest of their B id."""
        counts = store(self.pair_counts().select("a", "b", "links"), "pair-counts")
        best = counts.groupBy("b").agg(F.max("links").alias("most"))
        scores = counts.join(best, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))
        found = self.postings.select("chunk", "a", "b", "plane", "bits").join(scores, ["a", "b"])
        ready = found.select("chunk", "plane", "links", "best", "bits").repartition("chunk").sortWithinPartitions("chunk")
        sums = ready.mapInArrow(_bring_back, "chunk long, place int, count_sum long, n_best long")
        filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
        return self.documents.join(sums, ["chunk", "place"], "left").select(*self.documents.columns[2:7], *filled, "groups_sha256")


def _bring_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of scores per document, chunk after chunk."""
    now, sums = None, np.zeros((2, CHUNK_DOCUMENTS), np.int64)

    def done() -> pa.RecordBatch:
        places = np.flatnonzero(sums[0])
        columns = [np.full(len(places), now), places.astype(np.int32), sums[0][places], sums[1][places]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "place", "count_sum", "n_best"])

    for batch in batches:
        chunks = batch.column(0).to_numpy()
        planes, links = batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_numpy()
        best = batch.column(3).to_numpy(zero_copy_only=False)
        bits = batch.column(4)
        edges = np.concatenate([[0], np.flatnonzero(chunks[1:] != chunks[:-1]) + 1, [len(chunks)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if a == b:
                continue
            if chunks[a] != now:
                if now is not None:
                    yield done()
                now, sums = int(chunks[a]), np.zeros((2, CHUNK_DOCUMENTS), np.int64)
            part = bits.slice(a, b - a)
            lists = [members(x) for x in part.to_pylist()]
            lengths = [len(x) for x in lists]
            places = np.concatenate(lists)
            weight = np.left_shift(np.ones(b - a, np.int64), planes[a:b])
            np.add.at(sums[0], places, np.repeat(links[a:b] * weight, lengths))
            np.add.at(sums[1], places, np.repeat(weight * best[a:b], lengths))
    if now is not None:
        yield done()
