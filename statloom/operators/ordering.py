"""Promised orders as a column that later steps and other engines can check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.operators.schema import quoted
from statloom.storage import materialize

#: The lower bits of a generated id number the rows of a task.
ROW_BITS = 33


def with_places(df: DataFrame, order: list[Column], place: str = "place") -> DataFrame:
    """``df`` with the place of each row, 1, 2, ... without gaps, in the given order.

    Rows equal in ``order`` are told apart by their other columns, so that a hot value spreads over
    tasks and equal input gives equal places (but for rows equal throughout). One shuffle into
    ranges, sorted and written; the sizes of the ranges, one row per task, then shift the numbers
    within the tasks. A column named ``place`` is replaced; an empty table stays empty.
    """
    df = df.drop(place)
    marked = _sorted_ranges(df, order)
    task = F.shiftright("__at", ROW_BITS)
    sizes = marked.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__task")) - F.col("__rows")  # a row per task
    starts = sizes.select("__task", before.alias("__before"))
    joined = marked.join(F.broadcast(starts), task == F.col("__task"))
    within = F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return joined.select(*[quoted(c) for c in df.columns], (F.col("__before") + within + 1).alias(place))


def _sorted_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows as a table, sorted in ranges, with the number of range and row as ``__at``."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rest = [quoted(c) for c, kind in kinds.items() if not ("map<" in kind or "variant" in kind)]
    tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(tasks, *order, *rest).sortWithinPartitions(*order, *rest)
    return materialize(dealt.withColumn("__at", F.monotonically_increasing_id()), "places")
