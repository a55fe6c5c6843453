"""Windows that continue from stored rows, so that daily increments equal one run over everything.

A window looks back on the rows before it. An increment therefore starts from the last rows of each symbol,
which are kept as a small table of their own, the tail: as many rows per symbol as the deepest indicator
looks back. The last rows of two runs are the last of both together, so the tail is merged run by run.
Bars that arrive late, at or before a symbol's stored end, need more: the rows around them, and a new
calculation of those after them whose windows now hold other rows. Only for such symbols is the table read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.operators.enrich import INDICATOR_DEPTH
from tickloom.schema import PRICE_COLUMNS, RAW_COLUMNS

ROLE = "_role"
LEAD, INCOMING, FOLLOW = "lead", "incoming", "follow"
# Columns of a fact row from which its indicators are computed again.
BASE_COLUMNS = ["symbol", "trade_date", "trade_timestamp", *PRICE_COLUMNS, "volume", "dividend_amount", "split_coefficient"]


def last_rows(rows: DataFrame, depth: int = INDICATOR_DEPTH) -> DataFrame:
    """The last ``depth`` rows of every symbol. Spark applies the rank limit before the shuffle too."""
    newest = Window.partitionBy("symbol").orderBy(F.desc("trade_date"), F.desc("trade_timestamp"))
    return rows.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= depth).drop("_place")


def merge_tails(tail: DataFrame | None, rows: DataFrame, depth: int = INDICATOR_DEPTH) -> DataFrame:
    """The tail after rows are added; a row of the same symbol and date replaces the tail's."""
    rows = rows.select(BASE_COLUMNS)
    if tail is not None:
        kept = tail.select(BASE_COLUMNS).join(rows.select("symbol", "trade_date"), ["symbol", "trade_date"], "left_anti")
        rows = kept.unionByName(rows)
    return last_rows(rows, depth)


def context(incoming: DataFrame, stored: DataFrame, tail: DataFrame | None, depth: int = INDICATOR_DEPTH) -> DataFrame:
    """Stored rows that the windows of ``incoming`` (dated bars) need or change, with their role.

    Leading rows are only looked back on; following rows get new indicators. ``tail`` must be
    that of ``stored``; without one all symbols are looked up in ``stored``.
    """
    spans = incoming.groupBy("symbol").agg(F.min("trade_date").alias("low"), F.max("trade_date").alias("high"))
    leading = None
    if tail is not None:
        ends = tail.groupBy("symbol").agg(F.max("trade_date").alias("end"))
        compared = spans.join(ends, "symbol")
        in_time = compared.filter("low > end").select("symbol")
        leading = tail.select(BASE_COLUMNS).join(in_time, "symbol", "left_semi").withColumn(ROLE, F.lit(LEAD))
        spans = compared.filter("low <= end").select("symbol", "low", "high")
        if spans.isEmpty():
            return leading
    near = stored.select(BASE_COLUMNS).join(spans, "symbol")
    # Rows that come again are replaced, so they are no context.
    near = near.join(incoming.select("symbol", "trade_date"), ["symbol", "trade_date"], "left_anti")
    before = last_rows(near.filter("trade_date < low"), depth).withColumn(ROLE, F.lit(LEAD))
    oldest = Window.partitionBy("symbol").orderBy("trade_date", "trade_timestamp")
    after = near.filter("trade_date > high").withColumn("_place", F.row_number().over(oldest)).filter(F.col("_place") <= depth).drop("_place")
    between = near.filter("trade_date BETWEEN low AND high")
    late = before.unionByName(after.unionByName(between).withColumn(ROLE, F.lit(FOLLOW))).select(*BASE_COLUMNS, ROLE)
    return late if leading is None else leading.unionByName(late)


def together(incoming: DataFrame, around: DataFrame) -> DataFrame:
    """Incoming dated bars and their context as one table, ready for the indicators."""
    spelled = around.withColumn("timestamp", F.date_format("trade_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    columns = [*RAW_COLUMNS, "trade_date", "trade_timestamp", ROLE]
    return incoming.withColumn(ROLE, F.lit(INCOMING)).select(columns).unionByName(spelled.select(columns))
