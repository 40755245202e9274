"""Sinks: layers, manifests, control tables.

A layer is written by dynamic partition overwrite, so a retry replaces its own
partitions and nothing else, whether or not a crash came before the manifest.
"""

from __future__ import annotations

import datetime as dt
import json
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark import schemas
from quillspark.sources import readers


class Counts:
    """Rows by the values of some columns, as the job that passes them by sees them.

    The counts are observed metrics of that job: nothing is read again.  Keys are text, null as None.  A
    sketch of ``most`` keys counts them, exactly as long as there are no more, and the
    total beside it proves that.  Observe last before a write: further down, tasks that
    are repeated for lost shuffle files may count twice.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], most: int = 100_000) -> None:
        self.seen, self.keys = Observation(), list(keys)
        key = F.to_json(F.array(*[F.col(f"`{k}`").cast("string") for k in keys])) if keys else F.lit("[]")
        name = "__key"
        self.df = df.withColumn(name, key).observe(self.seen, F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k({name}, {most // 2}, {most})").alias("by")).drop(name)

    def _told(self) -> dict:
        try:
            return self.seen.get
        except Py4JJavaError as error:
            # a plan that is known to be empty loses its metrics: a row without fields comes back
            if "toPyRow" not in str(error):
                raise
            return {"rows": 0, "by": []}

    def total(self) -> int:
        """Rows of the action that ended."""
        return self._told()["rows"]

    def get(self) -> dict[tuple, int]:
        """Rows by key of the action that ended."""
        by = {tuple(json.loads(r["item"])): r["count"] for r in self._told()["by"] or ()}
        if sum(by.values()) != self.total():
            raise ValueError(f"more values of {', '.join(self.keys)} than one job can count")
        return by


def write_jsonl(df: DataFrame, path: str) -> int:
    """Rows as lines of JSON, replacing any; how many."""
    counts = Counts(df, [])
    counts.df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return counts.total()


def put_text(spark: SparkSession, path: str, text: str) -> str:
    """A small object in whatever store the path's scheme names, replacing any."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


def get_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_layer(df: DataFrame, root: str, name: str, by: Sequence[str] = ("ingest_date", "run_id")) -> dict[tuple, int]:
    """Replaces the partitions of ``df`` in a table, in one evaluation of it; an empty one writes no rows.

    Gives the rows written by (run_id, ingest_date), or by the one of them that there is.
    """
    by = [c for c in by if c in df.columns]
    # files follow partitions; a large partition is split by adaptive execution
    counts = Counts(df.hint("rebalance", *by) if by else df, [c for c in ("run_id", "ingest_date") if c in df.columns])
    counts.df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{root.rstrip('/')}/{name}")
    return counts.get()


def scratch(spark: SparkSession) -> str:
    """A folder for intermediate files that all nodes share: the session's checkpoint folder, a temporary one only on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        named = tempfile.mkdtemp(prefix="quillspark-")
    return f"{named.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def manifest_path(root: str, stage: str, day: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{stage}/dt={day}/run_id={run_id}/manifest.json"


def write_manifest(spark: SparkSession, root: str, stage: str, day: str, run_id: str, **facts) -> str:
    return put_text(spark, manifest_path(root, stage, day, run_id), json.dumps({"run_id": run_id, "stage": stage, "ingest_date": str(day), **facts}, default=str, sort_keys=True))


def append_ops(spark: SparkSession, root: str, name: str, rows: Sequence[dict] | DataFrame) -> int:
    """Appends rows to a control table, by day and clustered; how many.  An empty list is no write."""
    ddl, cluster = schemas.OPS_TABLES[name]
    target = schemas.parse(ddl)
    if isinstance(rows, DataFrame):
        df = rows
    elif not rows:
        return 0
    else:
        df = spark.createDataFrame([tuple(r.get(f.name) for f in target.fields) for r in rows], target)
    counts = Counts(_shaped(df, target).withColumn("created_date", F.to_date("created_ts")).sortWithinPartitions(*cluster), [])
    counts.df.write.mode("append").partitionBy("created_date").parquet(f"{root.rstrip('/')}/{name}")
    return counts.total()


def replace_ops(spark: SparkSession, root: str, name: str, rows: DataFrame, keys: Sequence[str] = ("run_id", "stage")) -> None:
    """Rows of a control table in place of those of the same keys, so that a stage can be repeated.

    They take the day of those before them; only the days that are touched are written.
    """
    path = f"{root.rstrip('/')}/{name}"
    target = schemas.parse(schemas.OPS_TABLES[name][0])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    if readers.has_rows(spark, path):
        have = spark.read.parquet(path)
        own = rows.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
        old = have.join(own, same, "left_semi")
        first = old.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min("created_ts").alias("__first"))
        rows = rows.join(first, same, "left").withColumn("created_ts", F.coalesce("__first", F.current_timestamp())).drop(*[f"__{k}" for k in keys], "__first")
        kept = have.join(old.select("created_date").distinct(), "created_date", "left_semi").join(own, same, "left_anti")
        # what is read is replaced only when the job commits
        out = _shaped(rows, target).unionByName(kept.drop("created_date"))
    else:
        out = _shaped(rows, target)
    out.withColumn("created_date", F.to_date("created_ts")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("created_date").parquet(path)


def purge_ops(spark: SparkSession, root: str, name: str, cutoff: dt.datetime, by: str = "created_ts") -> tuple[int, int]:
    """Takes the rows whose ``by`` is before ``cutoff``, or null, out of a control table; rows before and after.

    Only days up to the cutoff's are looked at, as nothing is changed before it is made.  Of these, days
    that keep nothing lose their folder and days that keep some rows are written anew,
    in that order of safety: the rewritten ones replace theirs when the job commits, and what a
    crash leaves is found by the next run.  A repeat removes nothing.
    """
    path = f"{root.rstrip('/')}/{name}"
    if not readers.has_rows(spark, path):
        return 0, 0
    have = spark.read.parquet(path)
    limit = F.lit(cutoff)
    old = have.where((F.col("created_date") <= F.to_date(limit)) | F.col("created_date").isNull())
    stays = F.coalesce(F.col(by) >= limit, F.lit(False))
    # a row a day
    days = [(r["created_date"], r["rows"], r["kept"]) for r in old.groupBy("created_date").agg(F.count(F.lit(1)).alias("rows"), F.count_if(stays).alias("kept")).collect()]
    before = have.count()
    if some := [day for day, rows, kept in days if 0 < kept < rows]:
        target = schemas.parse(schemas.OPS_TABLES[name][0])
        left = old.where(F.col("created_date").isin(some)).where(stays).select(*target.names, "created_date")
        left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("created_date").parquet(path)
    for day, _, kept in days:
        if not kept:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/created_date={day if day is not None else '__HIVE_DEFAULT_PARTITION__'}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark.catalog.refreshByPath(path)
    return before, before - sum(rows - kept for _, rows, kept in days)


#: Audit tables and the time by which their rows age.
AUDIT = {"agent_sessions": "created_ts", "agent_tool_calls": "created_ts", "agent_responses": "created_ts", "agent_proposals": "updated_ts"}


def purge_audit(spark: SparkSession, root: str, max_age_seconds: int, now: dt.datetime | None = None) -> dict[str, int]:
    """Purges the stored audit tables of what is older; rows removed by table."""
    cutoff = (now or dt.datetime.now(dt.UTC)) - dt.timedelta(seconds=max_age_seconds)
    counts = {name: purge_ops(spark, root, name, cutoff, by) for name, by in AUDIT.items()}
    return {name: before - after for name, (before, after) in counts.items()}


def _shaped(df: DataFrame, target: T.StructType) -> DataFrame:
    stamps = {c: F.coalesce(F.col(c), F.current_timestamp()) if c in df.columns else F.current_timestamp() for c in ("created_ts", "updated_ts") if c in target.names}
    df = df.withColumns(stamps)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields])


def publish(tables: dict[str, DataFrame], format: str, options: dict[str, str], prefix: str = "gold_") -> list[str]:
    """Appends each non-empty table through a Spark data source; the names that went out.

    ``{table}`` in an option's value stands for the table's name.
    """
    if not options:
        raise ValueError("publishing needs a target")
    out = []
    for name, df in tables.items():
        if not df.isEmpty():
            df.write.format(format).mode("append").options(**{k: v.format(table=f"{prefix}{name}") for k, v in options.items()}).save()
            out.append(name)
    return out
