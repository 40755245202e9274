"""Dense numbers over tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.sources import writers


def dense_places(df: DataFrame, order: Sequence[Column] = (), by: str | None = None, name: str = "place") -> DataFrame:
    """``df`` with a number of each row from 0, without gaps, in ``order``, or in its own order; of each value of ``by`` apart.

    The rows are written once to the shared folder, in ranges of the order, and read again
    with their file and row in it; the files' counts, one row a file and value, give what
    comes before each.  So both readings see the same places, whatever made ``df`` and however it is
    split, and no task holds more than a range.
    """
    spark = df.sparkSession
    keys = [F.col(by)] if by else []
    if order:
        df = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    path = writers.scratch(spark)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    group = F.col(by) if by else F.lit(0)
    files = rows.groupBy("__file", group.alias("__by")).agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__by").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select(F.col("__file").alias("__of"), "__by", (before - F.col("__first")).alias("__shift"))
    same = (F.col("__file") == F.col("__of")) & (group.eqNullSafe(F.col("__by")))
    out = rows.join(files, same)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__row") + F.col("__shift")).alias(name))


def dealt(df: DataFrame, at: str) -> DataFrame:
    """``df`` evenly over tasks, however few files or row groups it comes from; ``at`` keeps the rows' own order for ``dense_places_of``.

    The number of tasks is given: Spark would put rows of few bytes together in one, whatever the work on each.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.withColumn(at, F.monotonically_increasing_id()).repartition(parts, F.col(at))


def dense_places_of(df: DataFrame, at: str, name: str = "place") -> DataFrame:
    """``df`` with a number of each row from 0, without gaps, in the order that its rows had when ``dealt`` gave them ``at``.

    The rows, all of them that were dealt, are written once to the shared folder.  An id is the number of
    the task that read the row, above 33 bits, and the row's place in it, so the tasks' counts, one
    row each, give what comes before.
    """
    spark = df.sparkSession
    path = writers.scratch(spark)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    task = F.shiftright(at, 33)
    tasks = rows.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"), F.min(at).alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = tasks.select("__task", (before - F.col("__first")).alias("__shift"))
    out = rows.join(tasks, task == F.col("__task"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != at], (F.col(at) + F.col("__shift")).alias(name))
