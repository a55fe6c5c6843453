"""N-gram Jaccard join of documents with adaptive multi-match prefixes.

Two documents link when the sets of their word shingles have a Jaccard similarity of at least
``threshold`` percent. Documents with equal sets form a class, and all work is on classes.

Shingles have one global order: rare ones first, frequent ones last, as far as their frequency
is known. A class with n shingles that must share t of them with any partner shares at least l
shingles of its first n - t + l with those of the partner. A longer prefix costs more postings,
but every candidate then takes up l of them: the class takes the l with the lowest estimated
cost, and a pair becomes a candidate only with as many common prefix shingles as the smaller l
of the two. Candidates are verified on their whole sets.

A group of many near copies would meet in many long posting lists with all its pairs. Each
class therefore has a home, the longest list that it is in, and is compared there with all
members at once: blocks of whole sets are multiplied as 0/1 matrices, and a pair of blocks
only reports links that connect what was not connected yet. Other lists then leave out all
pairs that met at the home of one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import bound_batches, lean
from tickloom.llm import bloom
from tickloom.llm.components import connected_components
from tickloom.llm.shingles import mix, shingle_sets, slices
from tickloom.session import discard, scratch_path, store

# The longest prefix asks for so many common shingles.
MOST_MATCHES = 16
# What the verification of a candidate costs, in postings read.
VERIFY_COST = 300
# A known shingle of so many other classes stands behind all of unknown frequency.
HOT_CLASSES = 16
# Frequencies of at most so many shingles are sent to the tasks, those of the most frequent.
FREQUENT_SHINGLES = 1 << 19
# Lists with more members than this are long.
LONG_LIST = 64
# Blocks of a long list hold so many members or shingles, whichever is reached first.
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 1 << 20


def _least_common(n: int, threshold: int) -> int:
    return -(-threshold * n // 100)


def _identity(found: np.ndarray) -> bytes:
    """128 bits that name a set."""
    spread = mix(found + np.uint64(0x632BE59BD9B4E019))
    head = mix(np.array([spread.sum(dtype=np.uint64) + np.uint64(len(found))]))
    return head.tobytes() + np.bitwise_xor.reduce(mix(spread)).tobytes()


def _known_limit(threshold: int) -> int:
    """Shingles with a smaller hash have their frequency counted: twice what a prefix needs."""
    return min((1 << 64) - 1, int((1 << 64) * 2 * (100 - threshold) / 100))


def _profiles(size: int, threshold: int):
    limit = np.uint64(_known_limit(threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                ids, counts, first = [], [], []
                for found in shingle_sets(batch.column(1).slice(start, stop - start), size):
                    n = len(found)
                    common = _least_common(n, threshold)
                    wanted = n - common + min(common, MOST_MATCHES)
                    counts.append(n)
                    ids.append(_identity(found) if n else None)
                    # All known shingles may be hot, so as many unknown ones as a prefix takes go along.
                    first.append(found[: int(np.searchsorted(found, limit)) + wanted].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(first, pa.binary()),
                    ],
                    names=["id", "n", "set_id", "first"],
                )

    return run


def _known(batches: Iterator[pa.RecordBatch], limit: np.uint64) -> Iterator[np.ndarray]:
    for batch in batches:
        tokens = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
        yield tokens[tokens < limit]


def _counted(threshold: int):
    limit = np.uint64(_known_limit(threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _known(batches, limit):
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], names=["token"])

    return run


def _frequencies(classes: DataFrame, threshold: int, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of the known shingles, sorted, with the number of classes of each."""
    counts = classes.select("first").mapInArrow(_counted(threshold), "token long").groupBy("token").count()
    counts = store(counts.where("count > 1"), "shingle-counts", folder)
    sizes = counts.groupBy("count").agg(F.count("*").alias("tokens")).orderBy(F.desc("count"))
    # One row per distinct count: far fewer than shingles, and no more than FREQUENT_SHINGLES are read.
    least, total = 2, 0
    for row in sizes.limit(FREQUENT_SHINGLES).toLocalIterator():
        if total + row.tokens > FREQUENT_SHINGLES:
            least = row["count"] + 1
            break
        total += row.tokens
    # As Arrow columns: 16 bytes a shingle. As rows, each would be several objects in both of the driver's processes.
    found = counts.where(F.col("count") >= least).toArrow()
    tokens = found["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found["count"].to_numpy()[order]


def _prefix(first: np.ndarray, n: int, threshold: int, limit: np.uint64, tokens: np.ndarray, counts: np.ndarray):
    """Places of the prefix shingles in the global order, the level of each, the matches asked for."""
    others = np.zeros(len(first), np.int64)
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, first), len(tokens) - 1)
        hit = tokens[at] == first
        others[hit] = counts[at[hit]] - 1
    unknown = first >= limit
    rank = np.ceil(np.log2(others + 1)).astype(np.int64)
    rank = np.where(unknown, 64, np.where(others >= HOT_CLASSES, 64 + rank, rank))
    order = np.lexsort((first, rank))
    common = _least_common(n, threshold)
    spare = n - common
    most = min(common, MOST_MATCHES)
    order = order[: spare + most]
    estimate = others.astype(np.float64)
    if unknown.any():
        known = others[~unknown & (others < HOT_CLASSES)]
        estimate[unknown] = known.mean() if len(known) else float(HOT_CLASSES)
    postings = np.cumsum(estimate[order])[spare : spare + most]
    matches = np.arange(1, most + 1)
    # Shingles that nobody is known to share may still be shared.
    postings = postings + 0.1 * (spare + matches)
    best = int(np.argmin(postings * (1 + VERIFY_COST / matches) + matches)) + 1
    order = order[: spare + best]
    levels = np.maximum(np.arange(len(order)) - spare + 1, 1)
    return order, levels, best


def _postings(threshold: int, frequent):
    limit = np.uint64(_known_limit(threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = frequent.value
        for batch in batches:
            ns, firsts = (batch.column(i).to_pylist() for i in (1, 2))
            for start in range(0, len(ns), 500):
                parts = []
                for packed, n in zip(firsts[start : start + 500], ns[start : start + 500]):
                    first = np.frombuffer(packed, np.uint64)
                    order, levels, best = _prefix(first, n, threshold, limit, tokens, counts)
                    parts.append((first[order], (n << 2 * MATCH_BITS) + (levels << MATCH_BITS) + best))
                who = np.repeat(np.arange(start, start + len(parts)), [len(p[0]) for p in parts])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)),
                        batch.column(0).take(pa.array(who)),
                        pa.array(np.concatenate([p[1] for p in parts]).astype(np.int64)),
                    ],
                    names=["token", "number", "packed"],
                )

    return run


# A posting travels as three numbers; the last holds n, the level and the matches asked for.
MATCH_BITS = 5
POSTINGS = "token long, number long, packed long"
_LOW = (1 << MATCH_BITS) - 1


def _unpacked(postings: DataFrame) -> DataFrame:
    return postings.withColumns(
        {
            "n": F.shiftright("packed", 2 * MATCH_BITS),
            "level": F.shiftright("packed", MATCH_BITS).bitwiseAND(F.lit(_LOW)),
            "matches": F.col("packed").bitwiseAND(F.lit(_LOW)),
        }
    ).drop("packed")


def _place(name: bytes, row: int | None) -> bytes:
    """A hash of a class and one of its documents."""
    return mix(np.frombuffer(name[:8], np.uint64) + np.array([row or 0]).astype(np.uint64)).tobytes()


def _places(batch: pa.RecordBatch) -> np.ndarray:
    found = [_place(name, row) for name, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
    return np.frombuffer(b"".join(found), np.uint64)


def _whole_sets(size: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets = [], []
            for row, found in zip(batch.column(1).to_pylist(), shingle_sets(batch.column(0), size)):
                if len(found):
                    name = _identity(found)
                    if bloom.passes(wanted.value, np.frombuffer(_place(name, row), np.uint64))[0]:
                        ids.append(name)
                        sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(sets, pa.binary())], names=["set_id", "members"]
            )

    return run


def _verify(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3)):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two))
                at = np.minimum(np.searchsorted(left, right), len(left) - 1)
                common = int(np.count_nonzero(left[at] == right))
                keep.append(100 * common >= threshold * (len(left) + len(right) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _compare_blocks(threshold: int):
    """Links between the sets of two blocks, as a forest with the same connections."""

    def run(_key, table):
        given = dict(zip(table.column("number").to_pylist(), table.column("members")))
        names = list(given)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in given.values()]
        sizes = np.array([len(x) for x in sets])
        values, at = np.unique(np.concatenate(sets), return_inverse=True)
        rows = np.repeat(np.arange(len(sets)), sizes)
        shared = np.bincount(at, minlength=len(values)) > 1
        columns = np.cumsum(shared) - 1
        keep = shared[at]
        rows, at = rows[keep], columns[at[keep]]
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(at, kind="stable")
        rows, at = rows[order], at[order]
        for start in range(0, int(shared.sum()), 4096):
            part = slice(*np.searchsorted(at, [start, start + 4096]))
            matrix = np.zeros((len(sets), 4096), np.float32)
            matrix[rows[part], at[part] - start] = 1
            common += matrix @ matrix.T
        union = sizes[:, None] + sizes[None, :] - common
        linked = (100 * common.astype(np.float64) >= threshold * union.astype(np.float64)) & (common > 0)
        one, two = [], []
        waiting = np.ones(len(sets), dtype=bool)
        for start in range(len(sets)):
            if not waiting[start]:
                continue
            waiting[start] = False
            front = [start]
            while front:
                member = front.pop()
                for other in np.flatnonzero(linked[member] & waiting):
                    waiting[other] = False
                    front.append(int(other))
                    pair = sorted((names[member], names[other]))
                    one.append(pair[0])
                    two.append(pair[1])
        return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})

    return run


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("number")).union(pairs.select("b"))


class JaccardJoin:
    """The join over one table of documents; intermediate tables are in one folder of the shared folder.

    ``ids`` is the long column that results carry and ``text`` the column compared. Other
    columns are not read. A null or empty text, or one without words, has no shingles and
    links with nothing. Repeated rows and repeated ids are members like any other. Rows with a null
    id count as members, but never as the smallest id of a component.

    Classes have numbers, given once when their table is written. ``discard`` deletes all
    intermediate tables; results that are still to be read must be stored elsewhere before.
    """

    def __init__(self, documents: DataFrame, ids: str, text: str, size: int = 5, threshold: int = 80) -> None:
        self.threshold, self.size = threshold, size
        self.spark = documents.sparkSession
        bound_batches(self.spark)
        self.folder = scratch_path(self.spark, "jaccard")
        self.texts = documents.select(F.col(ids).cast("long").alias("id"), F.col(text).alias("text"))
        profiles = self.texts.mapInArrow(lean(_profiles(size, threshold)), "id long, n long, set_id binary, first binary")
        # Two passes over the texts cost less space than keeping the shingles of every copy.
        self.profiles = self._store(profiles.select("id", "n", "set_id"), "profiles")
        classes = (
            profiles.where("n > 0")
            .groupBy("set_id")
            .agg(F.first("n").alias("n"), F.first("first").alias("first"), F.min("id").alias("least"))
        )
        self.classes = self._store(classes.withColumn("number", F.monotonically_increasing_id()), "classes")
        self.postings = self._shared_postings()

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        return store(df, name, self.folder)

    def discard(self) -> None:
        """Delete the intermediate tables."""
        discard(self.spark, self.folder)

    def _shared_postings(self) -> DataFrame:
        """Prefix shingles that more than one class has: token, number, n, level, matches, length of the list."""
        frequent = self.spark.sparkContext.broadcast(_frequencies(self.classes, self.threshold, self.folder))
        made = self.classes.select("number", "n", "first").mapInArrow(lean(_postings(self.threshold, frequent)), POSTINGS)
        made = self._store(made, "made")
        lists = made.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
        return _unpacked(self._store(made.join(lists, "token"), "postings"))

    def _sets(self, numbers: DataFrame) -> DataFrame:
        """The whole shingle sets of the classes named: number, members."""
        # One document of each class gives its set; the filter keeps the others out of the shuffle.
        names = self.classes.select("number", "set_id", F.col("least").alias("id"))
        names = self._store(names.join(numbers.select("number").distinct(), "number"), "names")
        filters = bloom.of_rows(names.select("set_id", "id"), _places, bloom.bits_for(names.count()))
        wanted = self.spark.sparkContext.broadcast(filters)
        sets = self.texts.select("text", "id").mapInArrow(lean(_whole_sets(self.size, wanted)), "set_id binary, members binary")
        sets = sets.groupBy("set_id").agg(F.first("members").alias("members"))
        return self._store(sets.join(names.select("set_id", "number"), "set_id").select("number", "members"), "sets")

    def _candidates(self, met: DataFrame) -> DataFrame:
        """Pairs of rows (a, b, asked), one row for each common prefix shingle, that have enough."""
        pairs = met.groupBy("a", "b").agg(F.count("*").alias("met"), F.first("asked").alias("asked"))
        return self._store(pairs.where("met >= asked").select("a", "b"), "pairs")

    def _verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The linked ones among pairs (a, b)."""
        one = sets.select(F.col("number").alias("a"), F.col("members").alias("left"))
        two = sets.select(F.col("number").alias("b"), F.col("members").alias("right"))
        joined = pairs.join(two, "b").join(one, "a").select("a", "b", "left", "right")
        return joined.mapInArrow(lean(_verify(self.threshold)), "a long, b long")

    def _pairs(self, postings: DataFrame, homes: DataFrame | None = None) -> DataFrame:
        """All members of a list that may link, block by block, but for those that met at a home."""
        blocks = F.ceil(F.col("length") / BLOCK_MEMBERS).cast("int")
        if homes is None:
            postings = postings.withColumn("home", F.lit(None).cast("long")).withColumn("visits", F.array().cast("array<long>"))
        else:
            postings = postings.join(homes, "number", "left")
        left = postings.withColumn("block", F.pmod(F.hash("number"), blocks))
        right = postings.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        met = F.array_contains("q.visits", F.col("p.home")) | F.array_contains("p.visits", F.col("q.home"))
        pair = left.alias("p").join(
            right.alias("q"),
            (F.col("p.token") == F.col("q.token"))
            & (F.col("p.block") == F.col("q.block"))
            & (F.col("p.number") < F.col("q.number"))
            & (F.greatest("p.level", "q.level") <= F.least("p.matches", "q.matches"))
            & (F.col("p.n") * 100 >= F.col("q.n") * self.threshold)
            & (F.col("q.n") * 100 >= F.col("p.n") * self.threshold)
            & ~F.coalesce(met, F.lit(False)),
        )
        return pair.select(
            F.col("p.number").alias("a"), F.col("q.number").alias("b"), F.least("p.matches", "q.matches").alias("asked")
        )

    def links(self) -> DataFrame:
        """All linked pairs of classes: a, b, the numbers of ``members``."""
        pairs = self._candidates(self._pairs(self.postings))
        return self._verified(pairs, self._sets(_ends(pairs)))

    def members(self) -> DataFrame:
        """Each document with the number of its class: id, n_shingles, number (null without shingles)."""
        found = self.profiles.join(self.classes.select("set_id", "number"), "set_id", "left")
        return found.select("id", F.col("n").alias("n_shingles"), "number")

    def _apart(self, visits: DataFrame) -> DataFrame:
        """The postings of short lists, and those of long lists whose members have not all met at one home.

        All members of a long list have a home. Those at home there have met every member, and
        members with the same home have met each other.
        """
        guests = visits.where("token <> home")
        mixed = guests.groupBy("token").agg(
            F.count("*").alias("guests"), F.min("home").alias("one"), F.max("home").alias("other")
        )
        mixed = mixed.where("one <> other").select("token", "guests")
        kept = guests.join(mixed, "token").withColumn("length", F.col("guests"))
        columns = ["token", "number", "n", "level", "matches", "length"]
        return self.postings.where(F.col("length") <= LONG_LIST).select(columns).unionByName(kept.select(columns))

    def _connections(self) -> DataFrame:
        """Links that connect the same classes as all links do."""
        long_lists = self.postings.where(F.col("length") > LONG_LIST)
        homes = long_lists.groupBy("number").agg(F.max(F.struct("length", "token"))["token"].alias("home"))
        visits = self._store(long_lists.join(homes, "number"), "visits")
        at_home = F.col("token") == F.col("home")
        totals = visits.groupBy("token").agg(
            F.count(F.when(at_home, 1)).alias("homes"),
            F.sum(F.when(at_home, F.col("n"))).alias("home_total"),
            F.count(F.when(~at_home, 1)).alias("others"),
            F.coalesce(F.sum(F.when(~at_home, F.col("n"))), F.lit(0)).alias("other_total"),
        )
        inside = visits.select("token", "number", "home").join(totals.where("homes > 0"), "token")
        inside = self._store(inside, "inside")

        def parts(count: str, total: str):
            return F.greatest(F.ceil(F.col(count) / BLOCK_MEMBERS), F.ceil(F.col(total) / BLOCK_SHINGLES)).cast("int")

        # Members at home lie in the first blocks, the others in blocks behind them. Every block at
        # home meets each block once: itself, those at home in unordered pairs, and those behind.
        host_blocks, guest_blocks = parts("homes", "home_total"), parts("others", "other_total")
        own_host, own_guest = F.pmod(F.hash("number"), host_blocks), F.pmod(F.hash("number"), guest_blocks)
        own = F.when(at_home, own_host).otherwise(host_blocks + own_guest)
        last = F.when(at_home, host_blocks + guest_blocks).otherwise(host_blocks) - 1
        cells = inside.select("token", "number", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
        cells = cells.select("token", "number", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
        met = inside.groupBy("number").agg(F.first("home").alias("home"), F.collect_list("token").alias("visits"))
        pairs = self._candidates(self._pairs(self._apart(visits), met))
        sets = self._sets(_ends(pairs).union(inside.select("number")))
        forest = (
            cells.join(sets, "number")
            .groupBy("token", "x", "y")
            .applyInArrow(_compare_blocks(self.threshold), "a long, b long")
        )
        return forest.union(self._verified(pairs, sets))

    def components(self) -> DataFrame:
        """One row per document: id, n_shingles, component_id (smallest id reachable by links).

        The result is stored and the intermediate tables are deleted, so it is the last call.
        """
        links = self._store(self._connections(), "links")
        smallest = self.classes.select("number", "set_id", "least")
        labels = connected_components(links, "components", self.folder).withColumnRenamed("id", "number")
        smallest = smallest.join(labels, "number", "left").withColumn("component", F.coalesce("component", "number"))
        groups = smallest.groupBy("component").agg(F.min("least").alias("component_id"))
        smallest = smallest.join(groups, "component").select("set_id", "component_id")
        full = self.profiles.where("set_id IS NOT NULL").join(smallest, "set_id")
        empty = self.profiles.where("set_id IS NULL").withColumn("component_id", F.col("id"))
        columns = ["id", F.col("n").alias("n_shingles"), "component_id"]
        found = store(full.select(columns).unionByName(empty.select(columns)), "jaccard-members")
        self.discard()
        return found
