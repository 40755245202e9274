"""Sources: files, tables, REST and the layers of the lake."""

from __future__ import annotations

import json
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillspark import schemas
from quillspark.functions import columns as C


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of a JSON file whose top level is a list; anything else is an error.

    The first line that has anything tells, so no file becomes one string here.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), F.ltrim(F.regexp_replace("value", r"\A[\s\x{FEFF}]+", "")).substr(1, 1).alias("c"))
    heads = lines.where("c <> ''").groupBy("file").agg(F.min_by("c", "at").alias("c"))
    if heads.isEmpty() or not heads.where("c <> '['").isEmpty():
        raise ValueError(f"{path}: the top level must be a list")
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All values as strings; header, BOM, quoted line ends and doubled quotes are understood."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False, encoding="UTF-8")


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"json": read_json_array, "csv": read_csv}


def read_source(spark: SparkSession, source_type: str, path: str) -> DataFrame:
    if source_type not in READERS:
        raise ValueError(f"unsupported source_type {source_type!r}; one of {sorted(READERS)}")
    return READERS[source_type](spark, path)


def fetch_json_list(url: str, timeout: float = 30.0) -> list[dict]:
    with urllib.request.urlopen(url, timeout=timeout) as answer:  # raises unless 2xx
        rows = json.load(answer)
    if not isinstance(rows, list):
        raise ValueError(f"{url}: a JSON list is expected")
    return rows


class RestSource(DataSource):
    """Sources that answer with a JSON list, as a Spark data source: one partition each, fetched where it is read.

    Options: ``urls``, a JSON list; ``timeout`` in seconds.  Rows are (url, row) with the row's JSON.  A
    source that fails, answers late or with anything but a list fails its task; a task that runs again fetches again.
    """

    #: How a source is asked; subclasses may do it otherwise.
    fetch = staticmethod(fetch_json_list)

    @classmethod
    def name(cls) -> str:
        return "rest_json_lists"

    def schema(self) -> str:
        return "url string, row string"

    def reader(self, schema: T.StructType) -> RestReader:
        return RestReader(json.loads(self.options.get("urls", "[]")), float(self.options.get("timeout", 30)), self.fetch)


class RestReader(DataSourceReader):
    def __init__(self, urls: list[str], timeout: float, fetch: Callable[..., list[dict]]) -> None:
        self.urls, self.timeout, self.fetch = urls, timeout, fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(url) for url in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        for row in self.fetch(partition.value, self.timeout):
            yield partition.value, json.dumps(row)


def read_rest(spark: SparkSession, urls: Iterable[str], schema: str, fetch: Callable[..., list[dict]] | None = None, timeout: float = 30.0) -> DataFrame:
    """Rows of several REST sources; each is fetched in a task of its own.

    ``fetch(url)`` asks a source in another way than by a plain GET.
    """
    urls = list(urls)
    if not urls:
        return spark.createDataFrame([], schema)
    source = RestSource
    if fetch is not None:
        own = lambda url, _: fetch(url)
        label = f"rest_json_lists_{uuid.uuid4().hex}"
        source = type("OwnRestSource", (RestSource,), {"fetch": staticmethod(own), "name": classmethod(lambda cls: label)})
    spark.dataSource.register(source)
    rows = spark.read.format(source.name()).option("urls", json.dumps(urls)).option("timeout", str(timeout)).load()
    return rows.select(F.from_json("row", schema).alias("r")).select("r.*")


def read_raw(spark: SparkSession, root: str, days: Iterable[str] | None = None, payload: str | None = None) -> DataFrame:
    """Raw JSONL envelopes below ``root``, with their file path.

    The schema is declared, so types never depend on other runs.  ``days`` limits
    the scan to the folders of those dates.
    """
    payload = payload or schemas.PAYLOAD_DDL
    # a day may have no folder
    paths = [root] if days is None else [f"{root}/*/dt={d}" for d in days if matches(spark, f"{root}/*/dt={d}")]
    if not paths:
        return spark.createDataFrame([], f"meta struct<{schemas.META_DDL}>, payload struct<{payload}>, raw_path string")
    reader = spark.read.schema(f"meta struct<{schemas.META_DDL}>, payload struct<{payload}>").option("recursiveFileLookup", True)
    return reader.json(paths).withColumn("raw_path", F.col("_metadata.file_path"))


def read_table(spark: SparkSession, root: str, name: str, run_id: str | None = None, ingest_date: str | None = None) -> DataFrame:
    """A table of a layer; a run or date prunes partitions."""
    df = spark.read.option("mergeSchema", False).parquet(f"{root.rstrip('/')}/{name}")
    if ingest_date is not None:
        df = df.where(F.col("ingest_date") == F.lit(ingest_date).cast("date"))
    return df if run_id is None else df.where(F.col("run_id") == run_id)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a glob pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Whether a path exists in whatever store its scheme names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder holds anything but marks of jobs."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(place) and any(not f.getPath().getName().startswith(("_", ".")) for f in store.listStatus(place))


def list_runs(spark: SparkSession, root: str, day: str) -> list[str]:
    """Run ids among the raw files of a day, in order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/*/dt={day}").select("path")
    found = files.select(C.path_part(F.col("path"), r"run_id=([^/]+)").alias("run_id")).where("run_id is not null").distinct()
    return [r[0] for r in found.orderBy("run_id").collect()]


def lookup(config: dict, *path: str):
    """A value of a nested configuration; a missing key is a KeyError that names it."""
    at = config
    for i, key in enumerate(path):
        if not isinstance(at, dict) or key not in at:
            raise KeyError(".".join(path[: i + 1]))
        at = at[key]
    return at


def load_config(text: str) -> dict:
    """A configuration from JSON, or from YAML where a YAML parser is installed."""
    try:
        return json.loads(text) or {}
    except ValueError:
        import yaml

        return yaml.safe_load(text) or {}
