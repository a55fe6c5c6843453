"""Versioned tables: every change is a new version, put in place by one atomic rename.

A change writes its rows to a folder of its own, ``data/commit=<id>``, partitioned as the table is. What one
commit wrote into one partition is a unit. A version is a manifest, a small Parquet table of the units
that make up the table, and a version file that names it. Files once written never change: a reader keeps
the version it opened, and a driver lost at any moment leaves the last version whole.

Writers are optimistic: the version file of the version after the one that was read must not exist
yet. Of two writers one gets it, and the other gets a ``VersionConflict`` and can start anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructType

from tickloom.operators.cleanse import deduplicate
from tickloom.session import SHUFFLE_PARTITION_BYTES, store
from tickloom.sinks.curated import PARTITION_COLUMNS
from tickloom.sinks.warehouse import LoadError, require_unique

COMMIT = "commit"
UNIT_COLUMNS = "unit string, files long, row_count long, bytes long, low string, high string"

Result = TypeVar("Result")


class VersionConflict(LoadError):
    """Raised when another writer has committed first."""


class _Files:
    """The few file-system calls a commit needs, by Hadoop's own interface."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        configuration = spark._jsc.hadoopConfiguration()
        self.root = self.path(root)
        self.system = self.root.getFileSystem(configuration)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), configuration)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(x.getPath().getName() for x in self.system.listStatus(where)) if self.system.exists(where) else []

    def text(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, content: str) -> bool:
        """Whether a file came into being whole under a name that was free."""
        folder, _, base = name.rpartition("/")
        draft = self.path(f"{folder}/.{base}-{uuid.uuid4().hex}")
        stream = self.system.create(draft, True)
        stream.write(bytearray(content.encode()))
        stream.close()
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            self.context.rename(draft, self.path(name), self.gateway.new_array(kind, 0))
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            self.system.delete(draft, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equal in all columns, where null equals null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def retrying(change: Callable[[], Result], attempts: int = 5) -> Result:
    """Run a change anew as long as other writers come first."""
    for left in reversed(range(attempts)):
        try:
            return change()
        except VersionConflict:
            if not left:
                raise


class VersionedTable:
    """A table at ``path``. ``sort_by`` is the column whose range each unit notes.

    A version's units are listed on the driver, one row per commit and partition, as Spark's own file index
    lists files; compaction bounds their number by that of the partitions. ``version`` fixes a version to read.
    """

    def __init__(
        self, spark: SparkSession, path: str, partition_by: Sequence[str] = PARTITION_COLUMNS, sort_by: str = "trade_date"
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.partition_by, self.sort_by = tuple(partition_by), sort_by
        self.files = _Files(spark, path)
        self._refresh()

    def _refresh(self) -> None:
        names = [n for n in self.files.names(f"{self.path}/_versions") if n.isdigit()]
        self.version = int(names[-1]) if names else 0
        self.state = self._state(self.version) if names else {"schema": None, "manifest": None}

    def _state(self, version: int) -> dict:
        return json.loads(self.files.text(f"{self.path}/_versions/{version:020d}"))

    @property
    def exists(self) -> bool:
        return self.version > 0

    def at(self, version: int) -> VersionedTable:
        """The table as of an earlier version."""
        earlier = VersionedTable(self.spark, self.path, self.partition_by, self.sort_by)
        earlier.version, earlier.state = version, self._state(version)
        return earlier

    @property
    def schema(self) -> StructType | None:
        return StructType.fromJson(self.state["schema"]) if self.state["schema"] else None

    def units(self) -> DataFrame:
        """The manifest: path below ``data``, files, rows, bytes and range of ``sort_by`` of every unit."""
        if self.state["manifest"] is None:
            return self.spark.createDataFrame([], UNIT_COLUMNS)
        return self.spark.read.schema(UNIT_COLUMNS).parquet(f"{self.path}/{self.state['manifest']}")

    def read(self, units: Sequence[str] | None = None, like: StructType | None = None, with_commit: bool = False) -> DataFrame:
        """The rows of the version, or of some of its units."""
        schema = like or self.schema
        if schema is None:
            raise LoadError(f"there is no table at {self.path}")
        if units is None:
            units = [r.unit for r in self.units().select("unit").collect()]
        full = StructType(list(schema.fields)).add(COMMIT, StringType())
        if not units:
            rows = self.spark.createDataFrame([], full)
        else:
            base = f"{self.path}/data"
            rows = self.spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/{u}" for u in units])
        return rows.select(*schema.names, COMMIT) if with_commit else rows.select(*schema.names)

    def _write(self, rows: DataFrame, commit: str, spread: DataFrame | None = None) -> DataFrame:
        """Write a commit's rows; its units. An empty commit has none."""
        rows = rows.hint("rebalance", *self.partition_by) if spread is None else spread
        target = f"{self.path}/data/{COMMIT}={commit}"
        writer = rows.write
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(target)
        file = F.col("_metadata.file_path")
        where = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
        unit = F.regexp_extract(where, f"/data/({COMMIT}={commit}.*)/[^/]*$", 1)
        # Days are compared as days: least and greatest texts would need all rows sorted by file.
        noted = F.lit(None).cast("string")
        if self.sort_by in rows.columns:
            noted = F.col(self.sort_by) if isinstance(rows.schema[self.sort_by].dataType, DateType) else F.col(self.sort_by).cast("string")
        written = self.spark.read.schema(rows.schema).parquet(target)
        by_file = written.groupBy(file.alias("file"), F.col("_metadata.file_size").alias("bytes"))
        by_file = by_file.agg(F.count("*").alias("n"), F.min(noted).cast("string").alias("low"), F.max(noted).cast("string").alias("high"))
        return by_file.groupBy(unit.alias("unit")).agg(
            F.count("*").alias("files"), F.sum("n").alias("row_count"), F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")
        )

    def _commit(self, rows: DataFrame | None, gone: Sequence[str], operation: str, spread: DataFrame | None = None) -> VersionedTable:
        """Put a version in place that has ``rows`` and lacks the units ``gone``."""
        number = self.version + 1
        commit = f"{number:020d}-{uuid.uuid4().hex}"
        manifest = f"_manifests/{commit}"
        kept = self.units()
        if gone:
            kept = kept.filter(~F.col("unit").isin(list(gone)))
        units = kept if rows is None else kept.unionByName(self._write(rows, commit, spread))
        # One row per unit.
        units.coalesce(1).write.parquet(f"{self.path}/{manifest}")
        schema = json.loads(rows.schema.json()) if rows is not None else self.state["schema"]
        state = {"version": number, "manifest": manifest, "operation": operation, "schema": schema}
        if not self.files.create(f"{self.path}/_versions/{number:020d}", json.dumps(state)):
            raise VersionConflict(f"version {number} of {self.path} was committed by another writer")
        self.version, self.state = number, state
        return self

    def _require_columns(self, rows: DataFrame) -> None:
        lacking = [c for c in (self.schema.names if self.exists else []) if c not in rows.columns]
        if lacking:
            raise LoadError(f"the table at {self.path} has columns the incoming rows lack: {lacking}")

    def _places(self) -> DataFrame:
        """Commit and partition values of every unit, typed as in the table, from the units' paths alone."""
        units = [r.unit for r in self.units().select("unit").collect()]
        kinds = {f.name: f.dataType for f in self.schema}
        parts = [[u, *[p.partition("=")[2] for p in u.split("/")]] for u in units]
        columns = [COMMIT, *self.partition_by]
        frame = self.spark.createDataFrame(parts, ", ".join(f"`{c}` string" for c in ["unit", *columns]))
        typed = [
            F.when(F.col(c) != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).cast(kinds[c]).alias(c)
            for c in self.partition_by
        ]
        return frame.select("unit", COMMIT, *typed)

    def _units_of_partitions(self, rows: DataFrame) -> list[str]:
        """Units in the partitions that rows fall in; no row of the table is read."""
        places = self._places()
        if self.partition_by:
            wanted = rows.select(*self.partition_by).distinct()
            places = places.alias("t").join(wanted.alias("s"), _same("t", "s", self.partition_by), "left_semi")
        return [r.unit for r in places.select("unit").collect()]

    def _paths(self, named: DataFrame) -> list[str]:
        """Paths of the units of (commit, partition) rows, distinct ones of which are as many as units at most."""
        columns = [COMMIT, *self.partition_by]
        found = {tuple(r) for r in named.select(*columns).distinct().collect()}
        return [r.unit for r in self._places().collect() if tuple(r)[1:] in found] if found else []

    def append(self, rows: DataFrame) -> VersionedTable:
        """Add rows as they are."""
        self._require_columns(rows)
        return self._commit(rows, [], "append")

    def upsert(
        self, staging: DataFrame, keys: Sequence[str] = ("price_id",), fixed_partition: bool = False,
        newer: str | None = None, check_unique: bool = True,
    ) -> VersionedTable:
        """Replace rows by key and add new ones, each key stored once; null equals null.

        Only units that hold a staged key are rewritten. They are found by a scan of the key columns: of the
        whole table, as a key's row may lie in another partition than it comes with, or with ``fixed_partition``,
        where the key determines the partition, of the partitions that staged rows fall in. With
        ``newer`` a staged row changes nothing where the stored row of its key has a greater value there.
        ``staging`` is read several times, so pass a stored table.
        """
        self._require_columns(staging)
        if check_unique:
            require_unique(staging, keys)
        if not self.exists:
            return self._commit(staging, [], "upsert")
        units = self._units_of_partitions(staging) if fixed_partition else None
        kept_columns = list(dict.fromkeys([COMMIT, *self.partition_by, *keys, *([newer] if newer else [])]))
        stored_keys = self.read(units, staging.schema, True).select(*kept_columns)
        older = F.col(f"t.{newer}") > F.col(f"s.{newer}") if newer else F.lit(False)
        staged_keys = staging.select(*dict.fromkeys([*keys, *([newer] if newer else [])]))
        hits = stored_keys.alias("t").join(staged_keys.alias("s"), _same("t", "s", keys)).select("t.*", F.coalesce(older, F.lit(False)).alias("_stays"))
        if newer:
            hits = store(hits, "matched")
            staying = hits.filter("_stays").select(*keys)
            staging = store(staging.alias("s").join(staying.alias("t"), _same("s", "t", keys), "left_anti"), "staging")
            if staging.isEmpty():
                return self
        changed = self._paths(hits.filter("NOT _stays"))
        rest = self.read(changed, staging.schema).alias("t").join(staging.select(*keys).alias("s"), _same("t", "s", keys), "left_anti")
        return self._commit(rest.select(*staging.columns).unionByName(staging) if changed else staging, changed, "upsert")

    def insert_if_absent(self, staging: DataFrame, keys: Sequence[str] = ("price_id",), fixed_partition: bool = False) -> VersionedTable:
        """Add one row for each key that the table lacks. Two writers at once cannot both add it."""
        self._require_columns(staging)
        if self.exists:
            units = self._units_of_partitions(staging) if fixed_partition else None
            known = self.read(units, staging.schema).select(*keys)
            staging = staging.alias("s").join(known.alias("t"), _same("s", "t", keys), "left_anti")
        fresh = store(deduplicate(staging, tuple(keys)), "inserts")
        return self if self.exists and fresh.isEmpty() else self._commit(fresh, [], "insert")

    def replace_partitions(self, rows: DataFrame) -> VersionedTable:
        """Replace all rows of the partitions that rows fall in; without partitions, the whole table."""
        self._require_columns(rows)
        return self._commit(rows, self._units_of_partitions(rows) if self.exists else [], "replace partitions")

    def replace_all(self, rows: DataFrame, operation: str = "replace") -> VersionedTable:
        """Replace the whole table; its earlier rows stay in earlier versions."""
        return self._commit(rows, [r.unit for r in self.units().select("unit").collect()], operation)

    def replace_date(self, rows: DataFrame, trade_date: str, column: str = "trade_date") -> VersionedTable:
        """Replace one trade date. All rows must be of that date, and there must be some.

        The manifest's ranges name the units that may hold the date; others are neither read nor rewritten.
        """
        self._require_columns(rows)
        day = F.to_date(F.lit(trade_date))
        scope = rows.agg(F.count("*").alias("n"), F.count_if(F.col(column) != day).alias("other")).first()
        if scope["n"] == 0 or scope["other"]:
            raise LoadError(f"{scope['n']} rows given for {trade_date}, of which {scope['other']} have another date")
        if not self.exists:
            return self._commit(rows, [], "replace date")
        within = F.col("low").isNull() | ((F.col("low") <= trade_date) & (F.col("high") >= trade_date)) if column == self.sort_by else F.lit(True)
        units = [r.unit for r in self.units().filter(within).select("unit").collect()]
        holding = self.read(units, rows.schema, True).filter(F.col(column) == day).select(COMMIT, *self.partition_by)
        changed = self._paths(holding)
        kept = self.read(changed, rows.schema).filter(F.col(column).isNull() | (F.col(column) != day))
        return self._commit(kept.unionByName(rows), changed, "replace date")

    def compact(self, cluster_by: Sequence[str] = ("trade_date", "symbol"), target_bytes: int = SHUFFLE_PARTITION_BYTES) -> int:
        """Merge the small units of each partition, sorted; how many units were merged.

        A unit is small if its files are below half of ``target_bytes`` on average. A small unit that is its
        partition's only one and has one file stays, as do all larger units, byte for byte.
        """
        folder = F.regexp_extract("unit", "^[^/]*(/.*)?$", 1)
        small = self.units().filter(F.col("bytes") < F.col("files") * (target_bytes / 2)).withColumn("partition", folder)
        several = small.groupBy("partition").agg(F.count("*").alias("units"), F.sum("files").alias("all_files"), F.sum("bytes").alias("size"))
        chosen = small.join(several.filter("units > 1 OR all_files > 1"), "partition").filter(
            (F.col("units") > 1) | (F.col("files") > F.ceil(F.col("size") / target_bytes))
        )
        picked = chosen.select("unit", "bytes").collect()
        if not picked:
            return 0
        units = [r.unit for r in picked]
        rows = self.read(units)
        order = [c for c in dict.fromkeys([*self.partition_by, *cluster_by]) if c in rows.columns]
        parts = max(1, -(-sum(r.bytes for r in picked) // target_bytes), len({u.partition("/")[2] for u in units}))
        spread = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        self._commit(rows, units, "compact", spread)
        return len(units)

    def analyze(self, columns: Sequence[str]) -> int:
        """Note statistics of columns for the units that have none yet; how many units these were.

        A unit never changes, so what is known of it stays right: after a change only new units are read.
        """
        known = self._statistics()
        lacking = self.units().select("unit")
        if known is not None:
            whole = known.filter(F.col("column_name").isin(list(columns))).groupBy("unit").agg(F.count("*").alias("n")).filter(F.col("n") >= len(columns))
            lacking = lacking.join(whole, "unit", "left_anti")
        units = [r.unit for r in lacking.collect()]
        if not units:
            return 0
        kinds = self.schema
        base = f"{self.path}/data"
        full = StructType(list(kinds.fields)).add(COMMIT, StringType())
        files = self.spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/{u}" for u in units])
        rows = files.select(F.col("_metadata.file_path").alias("file"), *columns)
        unit = F.regexp_extract(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), f"/data/({COMMIT}=.*)/[^/]*$", 1)
        # Lows and highs are kept by value, so that numbers compare as numbers.
        ranges = [x for c in columns for x in (F.min(c).cast("string").alias(f"low_{c}"), F.max(c).cast("string").alias(f"high_{c}"))]
        counts = [x for c in columns for x in (F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"), F.hll_sketch_agg(F.col(c).cast("string")).alias(f"sketch_{c}"))]
        by_unit = rows.withColumn("unit", unit).groupBy("unit").agg(F.count("*").alias("row_count"), *ranges, *counts)
        lines = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c].dataType.simpleString()).alias("kind"), *[F.col(f"{n}_{c}").alias(n) for n in ("low", "high", "nulls", "sketch")])
            for c in columns
        ])
        fresh = by_unit.select("unit", "row_count", F.inline(lines))
        if known is not None:
            fresh = known.join(fresh.select("unit", "column_name"), ["unit", "column_name"], "left_anti").select(fresh.columns).unionByName(fresh)
        fresh.coalesce(1).write.parquet(f"{self.path}/_statistics/{self.version:020d}-{uuid.uuid4().hex}")
        return len(units)

    def _statistics(self) -> DataFrame | None:
        """What is known of the version's units by the newest finished analysis."""
        folder = f"{self.path}/_statistics"
        done = [n for n in self.files.names(folder) if "_SUCCESS" in self.files.names(f"{folder}/{n}")]
        if not done:
            return None
        return self.spark.read.parquet(f"{folder}/{done[-1]}").join(self.units().select("unit"), "unit", "left_semi")

    def statistics(self) -> DataFrame:
        """Per analyzed column: rows, nulls, least and greatest value, distinct values by merged sketches, and
        ``stats_off``, the percentage of the table's rows that lie in units not analyzed."""
        known = self._statistics()
        if known is None:
            raise LoadError(f"the table at {self.path} was never analyzed")
        total = self.units().agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total"))
        number = F.col("kind").rlike("int|decimal|double|float")

        def least(column: str, pick) -> Column:
            by_number = pick(F.when(number, F.struct(F.col(column).cast("double").alias("n"), F.col(column).alias("s"))))
            return F.coalesce(by_number["s"], pick(F.when(~number, F.col(column)))).alias(column)

        merged = known.groupBy("column_name").agg(
            F.sum("row_count").alias("row_count"), F.sum("nulls").alias("nulls"), least("low", F.min), least("high", F.max),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
        )
        off = F.when(F.col("total") > 0, F.round((1 - F.col("row_count") / F.col("total")) * 100, 2)).otherwise(0.0)
        return merged.withColumn("total", total.scalar()).withColumn("stats_off", off).drop("total")

    def history(self) -> list[dict]:
        """Number and operation of every version that is kept, oldest first."""
        names = [n for n in self.files.names(f"{self.path}/_versions") if n.isdigit()]
        return [{k: self._state(int(n))[k] for k in ("version", "operation")} for n in names]

    def expire(self, keep: int = 10) -> list[str]:
        """Delete all but the newest versions, and the commits that no kept version has; the commits' names.

        A commit that is being written has a number above the newest version and is left alone.
        """
        versions = [int(n) for n in self.files.names(f"{self.path}/_versions") if n.isdigit()]
        old, kept = versions[:-keep], versions[-keep:]
        manifests = [self._state(v)["manifest"] for v in kept]
        used = {r.unit.split("/")[0] for v in kept for r in self.at(v).units().select("unit").distinct().collect()}
        for version in old:
            self.files.delete(f"{self.path}/_versions/{version:020d}")
        newest = versions[-1] if versions else 0
        for name in self.files.names(f"{self.path}/_manifests"):
            if f"_manifests/{name}" not in manifests and int(name.split("-")[0]) <= newest:
                self.files.delete(f"{self.path}/_manifests/{name}")
        gone = []
        for name in self.files.names(f"{self.path}/data"):
            if name.startswith(f"{COMMIT}=") and name not in used and int(name.partition("=")[2].split("-")[0]) <= newest:
                self.files.delete(f"{self.path}/data/{name}")
                gone.append(name)
        return gone


def open_table(spark: SparkSession, path: str, partition_by: Sequence[str] = PARTITION_COLUMNS) -> VersionedTable:
    return VersionedTable(spark, path, partition_by)
