"""Encoding with the pieces of a SentencePiece model, the N best segmentations, and decoding.

A text is a lattice of pieces. Forward Viterbi scores give the best segmentation; they are also
the exact rest cost of every partial segmentation that is built from the end, so that a
backward A* search finds the N best one after the other. The lattice falls apart wherever no piece holds
two neighbouring characters together: a text is a row of short units, each of which is solved once,
many of a length at a time. The N best of a text combine alternatives of the few units whose second
best costs least; no other unit can have a part in them.

As the model's scores are used, pieces of a model trained by merges are ranked by their scores' sum.
A character without a piece becomes the pieces of its bytes, at the lowest score of all pieces less 10.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.batches import bound_batches, lean
from tickloom.llm.shingles import _power, mix, slices

UNKNOWN_PENALTY = 10.0
# Units that are solved together, and units whose result a task keeps.
LATTICE_CELLS = 1 << 14
KEPT_UNITS = 500_000
KEPT_ALTERNATIVES = 20_000
ENCODED_BYTES = 1 << 19
SLOT_BITS = 20

_RANDOM = np.random.default_rng(5)


class Pieces:
    """The pieces of a model, by their characters and their ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.vocab_size()
        self.decoded: list[bytes] = []
        self.score: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.decoded.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.decoded.append(b"")
            else:
                text = piece.replace("▁", " ")
                self.decoded.append(text.encode())
                self.score[text] = (i, model.get_score(i))
        self.unknown = min(s for _, s in self.score.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.score))
        joined = sorted({c for p in self.score if len(p) > 1 for c in p})
        others = sorted({p for p in self.score if len(p) == 1}.difference(joined))
        self.codes = np.zeros(0x110000, np.int32)
        self.codes[[ord(c) for c in joined + others]] = np.arange(1, len(joined) + len(others) + 1)
        self.joined = len(joined)
        self.together = np.zeros((len(joined) + 1, len(joined) + 1), dtype=bool)
        for piece in self.score:
            own = self.codes[[ord(c) for c in piece]]
            if len(own) > 1:
                self.together[own[:-1], own[1:]] = True
        self.values = _RANDOM.integers(1, 1 << 63, len(joined) + len(others) + 1, dtype=np.uint64) | np.uint64(1)
        names = list(self.score)
        hashes = mix(np.array([self._hash(self.codes[[ord(c) for c in p]]) for p in names], np.uint64))
        self.ids = np.array([self.score[p][0] for p in names] + [-1], np.int64)
        self.scores = np.array([self.score[p][1] for p in names] + [-np.inf])
        # Two tables by different bits of a hash; what collides in the first is in the second.
        self.hashes = np.concatenate([hashes, np.zeros(1, np.uint64)])
        self.slots = np.full((2, 1 << SLOT_BITS), len(names), np.int32)
        for number, value in enumerate(hashes.tolist()):
            first, second = value >> (64 - SLOT_BITS), value & ((1 << SLOT_BITS) - 1)
            if self.slots[0, first] == len(names):
                self.slots[0, first] = number
            elif self.slots[1, second] == len(names):
                self.slots[1, second] = number
            else:
                raise ValueError("pieces collide in both tables")

    def _hash(self, codes: np.ndarray) -> np.uint64:
        out = np.zeros(1, np.uint64)
        for code in codes:
            out = out * np.uint64(0x9E3779B97F4A7C15) + self.values[code]
        return out[0]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of pieces by the hashes of their characters; the last number for none."""
        hashes = mix(hashes)
        found = self.slots[0][hashes >> np.uint64(64 - SLOT_BITS)]
        missed = self.hashes[found] != hashes
        found[missed] = self.slots[1][hashes[missed] & np.uint64((1 << SLOT_BITS) - 1)]
        found[missed & (self.hashes[found] != hashes)] = len(self.ids) - 1
        return found

    def best(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int]]]]:
        """For units of one length (rows of character codes): best score, what the second best
        costs more, and the best pieces as (start, id), -1 where a character has no piece."""
        count, length = codes.shape
        arcs, ids = [], []
        rolled = np.zeros((count, length), np.uint64)
        for size in range(1, min(self.longest, length) + 1):
            rolled = rolled[:, : length - size + 1] * np.uint64(0x9E3779B97F4A7C15) + self.values[codes[:, size - 1 :]]
            found = self.find(rolled)
            score = self.scores[found]
            if size == 1:
                score = np.where(np.isneginf(score), self.unknown, score)
            arcs.append(score)
            ids.append(self.ids[found])
        forward = np.full((count, length + 1), -np.inf)
        forward[:, 0] = 0
        taken = np.zeros((count, length + 1), np.int64)
        for end in range(1, length + 1):
            for size in range(1, min(len(arcs), end) + 1):
                score = forward[:, end - size] + arcs[size - 1][:, end - size]
                better = score > forward[:, end]
                forward[better, end] = score[better]
                taken[better, end] = size
        backward = np.full((count, length + 1), -np.inf)
        backward[:, length] = 0
        for start in range(length - 1, -1, -1):
            for size in range(1, min(len(arcs), length - start) + 1):
                np.maximum(backward[:, start], arcs[size - 1][:, start] + backward[:, start + size], out=backward[:, start])
        used = [np.zeros(a.shape, dtype=bool) for a in arcs]
        paths: list[list[tuple[int, int]]] = [[] for _ in range(count)]
        at = np.full(count, length)
        while True:
            rows = np.flatnonzero(at)
            if len(rows) == 0:
                break
            sizes = taken[rows, at[rows]]
            at[rows] -= sizes
            for size in np.unique(sizes).tolist():
                own = rows[sizes == size]
                used[size - 1][own, at[own]] = True
                for row, start, piece in zip(own.tolist(), at[own].tolist(), ids[size - 1][own, at[own]].tolist()):
                    paths[row].append((start, piece))
        second = np.full(count, -np.inf)
        for size, (score, mine) in enumerate(zip(arcs, used), 1):
            through = forward[:, : length - size + 1] + score + backward[:, size:]
            through[mine] = -np.inf
            np.maximum(second, through.max(axis=1), out=second)
        return forward[:, length], forward[:, length] - second, paths

    def n_best(self, unit: str, count: int) -> list[tuple[float, list[int]]]:
        """The N best segmentations of one unit, best first: score and ids."""
        length = len(unit)
        into: list[list[tuple[int, float, list[int]]]] = [[] for _ in range(length + 1)]
        rest = [0.0] + [-np.inf] * length
        for end in range(1, length + 1):
            for start in range(max(0, end - self.longest), end):
                found = self.score.get(unit[start:end])
                if found is None and end - start > 1:
                    continue
                ids = [found[0]] if found else [self.byte_ids[b] for b in unit[start:end].encode()]
                score = found[1] if found else self.unknown
                into[end].append((start, score, ids))
                rest[end] = max(rest[end], rest[start] + score)
        out: list[tuple[float, list[int]]] = []
        waiting = [(-rest[length], 0, length, 0.0, None)]
        pushed = 0
        while waiting and len(out) < count:
            _, _, at, score, path = heapq.heappop(waiting)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                out.append((score, ids))
                continue
            for start, own, ids in into[at]:
                pushed += 1
                heapq.heappush(waiting, (-(rest[start] + score + own), pushed, start, score + own, (ids, path)))
        return out


def combine(options: list[list[float]], count: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``count`` smallest sums of one cost from each list (each sorted, first 0), with the choices."""
    start = (0,) * len(options)
    waiting, seen, out = [(0.0, start)], {start}, []
    while waiting and len(out) < count:
        cost, choice = heapq.heappop(waiting)
        out.append((cost, choice))
        for i, options_i in enumerate(options):
            if choice[i] + 1 < len(options_i):
                other = choice[:i] + (choice[i] + 1,) + choice[i + 1 :]
                if other not in seen:
                    seen.add(other)
                    heapq.heappush(waiting, (sum(o[c] for o, c in zip(options, other)), other))
    return out


class Encoder:
    """Encodes blocks of texts, keeping the units it has solved."""

    def __init__(self, path: str, n_best: int) -> None:
        self.pieces = Pieces(path)
        self.n_best = n_best
        self.alternatives: dict[int, list[tuple[float, list[int]]]] = {}
        self.piece_lengths = np.array([len(b) for b in self.pieces.decoded])
        self.piece_starts = np.concatenate([[0], np.cumsum(self.piece_lengths)[:-1]])
        self.piece_bytes = np.frombuffer(b"".join(self.pieces.decoded), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.scores = np.zeros(0)
        self.gaps = np.zeros(0)
        self.ids = np.zeros(0, np.int32)

    def _solve(self, codes: np.ndarray, points: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """Scores, gaps and ids of new units."""
        scores, gaps = np.zeros(len(begin)), np.zeros(len(begin))
        ids: list[list[int]] = [[] for _ in begin]
        sizes = end - begin
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            step = max(1, LATTICE_CELLS // size)
            for start in range(0, len(rows), step):
                own = rows[start : start + step]
                places = begin[own][:, None] + np.arange(size)
                best, gap, paths = self.pieces.best(codes[places])
                scores[own], gaps[own] = best, gap
                for row, path in zip(own.tolist(), paths):
                    found = ids[row]
                    for place, piece in reversed(path):
                        if piece >= 0:
                            found.append(piece)
                        else:
                            found += [self.pieces.byte_ids[b] for b in chr(points[begin[row] + place]).encode()]
        return scores, gaps, ids

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, float, list]]:
        """For each text: ids, score, and the N best as (score, changes of the best ids)."""
        padded = [" " + t if t else "" for t in texts]
        sizes = np.array([len(t) for t in padded])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.pieces.codes[points]
        # The mark of the pieces' blanks is a character like any other in a text.
        near = np.where(codes > self.pieces.joined, 0, codes)
        begins = np.ones(len(points), dtype=bool)
        if len(points) > 1:
            begins[1:] = ~self.pieces.together[near[:-1], near[1:]]
        begins[bounds[:-1][sizes > 0]] = True
        begin = np.flatnonzero(begins)
        end = np.concatenate([begin[1:], [len(points)]]) if len(begin) else begin
        # Characters without a code differ by their code points.
        values = self.pieces.values[codes] ^ np.where(codes == 0, points.astype(np.uint64) << np.uint64(20), np.uint64(0))
        sums = np.add.reduceat(values * _power("up", len(points)), begin) if len(begin) else np.zeros(0, np.uint64)
        hashes = mix(sums * _power("down", len(points))[begin])
        if len(self.hashes) > KEPT_UNITS:
            self._forget()
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, unique)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == unique[known]
        new = np.flatnonzero(~known)
        if len(new):
            scores, gaps, ids = self._solve(codes, points, begin[first[new]], end[first[new]])
            lengths = np.array([len(x) for x in ids])
            starts = len(self.ids) + np.concatenate([[0], np.cumsum(lengths)[:-1]])
            self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.int32)])
            place = at[new]
            self.hashes = np.insert(self.hashes, place, unique[new])
            for name, values in (("starts", starts), ("lengths", lengths), ("scores", scores), ("gaps", gaps)):
                setattr(self, name, np.insert(getattr(self, name), place, values))
            at = np.searchsorted(self.hashes, unique)
        place = at[back]
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[place] - ends + lengths, lengths)]
        units = np.searchsorted(begin, bounds)
        out = []
        for i in range(len(texts)):
            a, b = units[i], units[i + 1]
            tokens = slice(ends[a] - lengths[a], ends[b - 1]) if b > a else slice(0, 0)
            own = place[a:b]
            score = float(self.scores[own].sum())
            gaps = self.gaps[own]
            few = np.argsort(gaps, kind="stable")[: self.n_best - 1] if b - a < 64 else self._smallest(gaps)
            few = few[np.isfinite(gaps[few])]
            options = []
            for unit in few.tolist():
                best = ids[ends[a + unit] - lengths[a + unit] : ends[a + unit]].tolist()
                options.append(self._alternatives(int(hashes[a + unit]), padded[i][begin[a + unit] - bounds[i] : end[a + unit] - bounds[i]], best))
            ranked = []
            for cost, choice in combine([[o[0][0] - s for s, _ in o] for o in options], self.n_best):
                changes = [
                    (int(ends[a + unit] - lengths[a + unit] - tokens.start), int(lengths[a + unit]), options[k][c][1])
                    for k, (unit, c) in enumerate(zip(few.tolist(), choice))
                    if c
                ]
                ranked.append((score - cost, sorted(changes)))
            out.append((ids[tokens], score, ranked))
        return out

    def _smallest(self, gaps: np.ndarray) -> np.ndarray:
        """Places of the smallest gaps, the first of equal ones."""
        count = min(self.n_best - 1, len(gaps))
        if count == 0:
            return np.zeros(0, np.int64)
        limit = np.partition(gaps, count - 1)[count - 1]
        near = np.flatnonzero(gaps <= limit)
        return near[np.argsort(gaps[near], kind="stable")][:count]

    def _alternatives(self, name: int, unit: str, best: list[int]) -> list[tuple[float, list[int]]]:
        if name not in self.alternatives:
            if len(self.alternatives) > KEPT_ALTERNATIVES:
                self.alternatives.clear()
            found = self.pieces.n_best(unit, self.n_best)
            others = [x for x in found if x[1] != best]
            self.alternatives[name] = [(found[0][0], best), *others[: self.n_best - 1]]
        return self.alternatives[name]

    def decode(self, ids: np.ndarray) -> str:
        lengths = self.piece_lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.piece_starts[ids] - ends + lengths, lengths)
        return self.piece_bytes[at].tobytes().decode("utf-8", "replace")[1:]


RESULT = (
    "ids array<int>, score double, "
    "n_best array<struct<score:double,changes:array<struct<at:int,removed:int,ids:array<int>>>>>, decoded string"
)
_CHANGE = pa.struct([("at", pa.int32()), ("removed", pa.int32()), ("ids", pa.list_(pa.int32()))])
_RANKED = pa.list_(pa.struct([("score", pa.float64()), ("changes", pa.list_(_CHANGE))]))


def _encode(path: str, n_best: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, n_best)
        for batch in batches:
            for start, stop in slices(batch.column(text_at), ENCODED_BYTES):
                found = encoder(batch.column(text_at).slice(start, stop - start).to_pylist())
                bounds = np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([x[0] for x in found]), pa.int32()))
                ranked = [
                    [{"score": s, "changes": [dict(zip(("at", "removed", "ids"), c)) for c in changes]} for s, changes in x[2]]
                    for x in found
                ]
                columns = [c.slice(start, stop - start) for c in batch.columns]
                columns += [ids, pa.array([x[1] for x in found], pa.float64()), pa.array(ranked, _RANKED)]
                columns.append(pa.array([encoder.decode(x[0]) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "ids", "score", "n_best", "decoded"])

    return run


def encode(documents: DataFrame, model: str, text: str = "text", n_best: int = 4) -> DataFrame:
    """Documents with ``ids`` of the best segmentation, its ``score``, the ``n_best`` and the text ``decoded``.

    ``model`` is the path of a SentencePiece model with byte pieces, the same on all executors. A
    blank is put before every text that is not empty, as the model's own normaliser does. Each of the
    ``n_best``, best first, has its score and what differs from ``ids``: from position ``at``,
    ``removed`` ids become ``ids``. ``decoded`` is made from ``ids`` and equals the text. A null or
    empty text has no ids, score 0 and one segmentation. All input columns return; those with the
    name of a result are replaced. Repeated rows are answered alike; texts are whole, whatever their length.
    """
    bound_batches(documents.sparkSession)
    documents = documents.drop(*[c for c in ("ids", "score", "n_best", "decoded") if c != text])
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(lean(_encode(model, n_best, documents.columns.index(text))), f"{own}, {RESULT}")
