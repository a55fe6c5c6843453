"""The quality gate over every listed file, also over files that yield no rows.

Three tables meet per file: the listing of the folder, which is the left side and knows empty and broken
files; the inventory of the columns that the file's own records name; and the counters of its rows, all
from one aggregation. Nothing here depends on the number of rows of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.operators import quality as q

READABLE = "expect_file_to_be_readable"
RECORD = "map<string,string>"


def listed_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """source_file and bytes of every file below a folder; no content is read.

    Spark's scans pass over files of no bytes, so their names are taken from its file index, which the
    driver holds for any read of the folder.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    # The index spells local files with an empty host, the scans without.
    found = [(name.replace("file:///", "file:/", 1) if name.startswith("file:///") else name,) for name in files.inputFiles()]
    names = spark.createDataFrame(found, "source_file string")
    sizes = files.select(F.col("_metadata.file_path").alias("source_file"), F.col("length").alias("bytes"))
    return names.join(sizes, "source_file", "left").select("source_file", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def file_columns(spark: SparkSession, path: str, pattern: str = "*.json", multi_line: bool = True) -> DataFrame:
    """Per file: the keys of its records in order of first appearance, its documents, and how many are no JSON.

    With ``multi_line`` a file is one document, else every line that is not blank.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    documents = reader.text(path, wholetext=multi_line)
    value = F.col("value")
    own = F.from_json(value, RECORD)
    is_bar = F.map_contains_key(own, F.lit("symbol")) | F.map_contains_key(own, F.lit("timestamp"))
    records = F.when(value.rlike(r"^\s*\["), F.from_json(value, f"array<{RECORD}>")).otherwise(
        F.coalesce(F.from_json(value, f"struct<data:array<{RECORD}>>")["data"], F.when(is_bar, F.array(own)))
    )
    keys = F.array_distinct(F.flatten(F.transform(records, lambda r: F.coalesce(F.map_keys(r), F.array().cast("array<string>")))))
    rows = documents.filter(F.lit(multi_line) | ~value.rlike(r"^\s*$")).select(
        F.col("_metadata.file_path").alias("source_file"), F.try_parse_json(value).isNull().alias("broken"), keys.alias("keys")
    )
    totals = rows.groupBy("source_file").agg(F.count("*").alias("documents"), F.count_if("broken").alias("broken_documents"))
    places = rows.select("source_file", F.posexplode("keys").alias("place", "key")).groupBy("source_file", "key").agg(F.min("place").alias("place"))
    ordered = places.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("found"))
    named = ordered.select("source_file", F.transform("found", lambda x: x["key"]).alias("columns"))
    return totals.join(named, "source_file", "left")


def evaluate_files(
    spark: SparkSession, path: str, suite: q.Suite, rows: DataFrame, pattern: str = "*.json", multi_line: bool = True
) -> DataFrame:
    """One row per listed file and rule, shaped as ``quality.evaluate`` by ``source_file`` gives them.

    ``rows`` are the bars read from the files. A rule on a column that the file's records do not name fails,
    as does every such rule for a file without records. A file with a document that is no JSON has one
    more outcome, rule 0, which fails.
    """
    counters = [F.count("*").alias("_rows")]
    for i, rule in enumerate(suite.rules):
        if rule.kind not in q.TABLE_RULES and not q._missing(rule, rows.columns):
            considered, violated = q._counted(rule)
            counters.append(F.count_if(considered).alias(f"_considered_{i}"))
            counters.append(F.count_if(considered & violated).alias(f"_violations_{i}"))
    counted = rows.groupBy("source_file").agg(*counters)
    joined = (
        listed_files(spark, path, pattern)
        .join(file_columns(spark, path, pattern, multi_line), "source_file", "left")
        .join(counted, "source_file", "left")
    )
    known = F.coalesce("columns", F.array().cast("array<string>"))
    broken = F.coalesce("broken_documents", F.lit(0)) + F.when(F.col("documents").isNull(), 1).otherwise(0)
    ready = joined.withColumns({"columns": known, "_rows": F.coalesce("_rows", F.lit(0)), "broken_documents": broken})
    outcomes = [_outcome(i, rule, rows.columns) for i, rule in enumerate(suite.rules)]
    unreadable = F.when(F.col("broken_documents") > 0, _readable())
    return ready.select("source_file", F.inline(F.array_compact(F.array(unreadable, *outcomes))))


def _struct(number: int, kind: str, column: str | None, success: Column, considered: Column, violations: Column, details: dict) -> Column:
    return F.struct(
        F.lit(number).alias("rule_no"),
        F.lit(kind).alias("expectation_type"),
        F.lit(column).cast("string").alias("column_name"),
        success.alias("success"),
        considered.alias("considered"),
        violations.alias("violations"),
        F.when(violations.isNotNull(), F.round(q._share(considered, violations), 4)).alias("success_rate"),
        F.to_json(F.struct(*[c.alias(n) for n, c in details.items()])).alias("details"),
    )


def _readable() -> Column:
    documents = F.greatest(F.coalesce("documents", F.lit(0)), F.lit(1)).cast("long")
    broken = F.col("broken_documents").cast("long")
    return _struct(0, READABLE, None, F.lit(False), documents, broken, {"documents": documents, "broken_documents": broken})


def _outcome(i: int, rule: q.Rule, row_columns: list[str]) -> Column:
    none = F.lit(None).cast("long")
    if rule.kind in (q.ORDERED_COLUMNS, q.COLUMNS_EXIST):
        wanted = F.array(*[F.lit(c) for c in rule.args["column_list"]])
        absent = F.array_except(wanted, F.col("columns"))
        held = F.col("columns") == wanted if rule.kind == q.ORDERED_COLUMNS else F.size(absent) == 0
        return _struct(i + 1, rule.kind, None, held, none, none, {"required_columns": wanted, "missing_columns": absent})
    if rule.kind == q.ROW_COUNT:
        low, high = rule.args.get("min_value"), rule.args.get("max_value")
        n = F.col("_rows")
        held = (n >= low if low is not None else F.lit(True)) & (n <= high if high is not None else F.lit(True))
        details = {"row_count": n, "min_expected": F.lit(low).cast("long"), "max_expected": F.lit(high).cast("long")}
        return _struct(i + 1, rule.kind, None, held, n, none, details)
    needed = rule.columns()
    name = rule.column or ",".join(needed)
    absent = F.array_except(F.array(*[F.lit(c) for c in needed]), F.col("columns"))
    if q._missing(rule, row_columns):
        lacking, considered, violations = F.lit(True), none, none
    else:
        lacking = F.size(absent) > 0
        considered, violations = (
            F.when(~lacking, F.coalesce(f"_{kind}_{i}", F.lit(0)).cast("long")) for kind in ("considered", "violations")
        )
    success = F.when(lacking, False).otherwise(q._share(considered, violations) >= rule.mostly)
    error = F.when(lacking, F.concat(F.lit("Column not found: "), F.array_join(absent, ", ")))
    details = {"error": error, "violations": violations, "considered": considered, "required_success_rate": F.lit(float(rule.mostly))}
    return _struct(i + 1, rule.kind, name, success, considered, violations, details)
