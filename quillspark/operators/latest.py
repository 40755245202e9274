"""One row per key, the first rows of an order, rows of a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    ``order`` should end in tie-breaks.  Row number and filter are the form that
    lets Spark cut each group before the shuffle.
    """
    return df.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__at = 1").drop("__at")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the largest ``by`` of each key, nulls last, ties by ``ties`` rising."""
    return first_per_key(df, keys, [F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]])


def deduplicate(df: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """One row of each key: the first by ``ties``, any without them."""
    return first_per_key(df, keys, [F.col(t).asc_nulls_last() for t in ties]) if ties else df.dropDuplicates(list(keys))


def newest_rows(df: DataFrame, limit: int, by: str = "created_ts", ties: Sequence[str] = ()) -> DataFrame:
    """The newest rows, between 1 and 500 of them."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t) for t in ties]).limit(max(1, min(limit, 500)))


def retained(df: DataFrame, max_age_seconds: int, by: str = "created_ts", now: Column | None = None) -> DataFrame:
    """Rows no older than ``max_age_seconds``."""
    now = F.current_timestamp() if now is None else now
    return df.where(F.col(by) >= now - F.make_dt_interval(secs=F.lit(float(max_age_seconds))))


def purge_report(df: DataFrame, kind: str, max_age_seconds: int, by: str = "created_ts", now: Column | None = None) -> DataFrame:
    """(kind, kept, purged) of what retention would do."""
    now = F.current_timestamp() if now is None else now
    keep = F.coalesce(F.col(by) >= now - F.make_dt_interval(secs=F.lit(float(max_age_seconds))), F.lit(False))
    return df.groupBy(kind).agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("purged"))
