"""From raw envelopes to flat rows with resolved metadata."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark import schemas
from quillspark.functions import columns as C


def flatten(df: DataFrame, name: str = "payload") -> DataFrame:
    """Fields of struct ``name`` as columns; on a clash of names the field wins."""
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.StructType):
        return df
    fields = df.schema[name].dataType.names
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name and c not in fields], *[F.col(f"`{name}`.`{f}`") for f in fields])


def from_meta(df: DataFrame, field: str, *fallbacks: Column, meta: str = "meta") -> Column:
    """The column ``field``, else the field of ``meta``, else the fallbacks."""
    found = [F.col(field)] if field in df.columns else []
    if meta in df.columns and isinstance(df.schema[meta].dataType, T.StructType) and field in df.schema[meta].dataType.names:
        found.append(F.col(f"{meta}.{field}"))
    return F.coalesce(*[c.cast("string") for c in (*found, *fallbacks)] or [F.lit(None).cast("string")])


def normalize_raw(df: DataFrame, now: Column | None = None, unhashed: Iterable[str] = ()) -> DataFrame:
    """One flat row per raw record, with run_id, ingest_ts, source_type, hashes and raw_path.

    Payload columns outrank the envelope.  A hash that is there is kept; the
    fallback is over the data columns and run_id, without ``unhashed``.
    """
    df = flatten(df)
    if "raw_path" not in df.columns:
        # readers add it; rows that come from no file have none
        df = df.withColumn("raw_path", F.lit(None).cast("string"))
    late = [c for c in ("pod_name", "pod_type", "task_type", "source_name") if c not in df.columns or "meta" in df.columns]
    df = df.withColumns(
        {
            "run_id": from_meta(df, "run_id", C.path_part(F.col("raw_path"), r"run_id=([^/]+)")),
            "ingest_ts": F.coalesce(F.try_to_timestamp(from_meta(df, "ingest_ts")), now if now is not None else F.current_timestamp()),
            "source_type": from_meta(df, "source_type", F.lit("unknown")),
            **{c: from_meta(df, c) for c in late},
        }
    )
    outside = {"meta", "schema_hash", "record_hash", "raw_path", "ingest_ts", "source_type", "ingest_date", *unhashed}
    data = [c for c in df.columns if c not in outside] or ["run_id"]
    df = df.withColumns({"schema_hash": from_meta(df, "schema_hash", C.schema_hash(data)), "record_hash": from_meta(df, "record_hash", C.record_hash(df, data))})
    return df.drop("meta")


def legacy_bronze(df: DataFrame) -> DataFrame:
    """Raw envelopes as the older bronze table has them: flat rows whose batch falls back to the
    source file and whose evaluated step falls back to the step; the day is that of the ingest time."""
    require(df, ["meta", "payload"])
    field = lambda of, name: F.col(f"{of}.{name}") if name in df.schema[of].dataType.names else F.lit(None).cast("string")
    meta = {n: field("meta", n) for n in ("run_id", "ingest_ts", "source_name", "source_type", "pod_name", "pod_type", "task_type")}
    payload = {n: field("payload", n) for n in ("set_id", "prompt_id", "step_index")}
    made = {"ingest_date": F.to_date(F.try_to_timestamp(meta["ingest_ts"])), "batch_id": F.coalesce(field("payload", "batch_id"), field("meta", "source_file")), "evaluated_step_index": F.coalesce(field("payload", "evaluated_step_index"), payload["step_index"])}
    return df.select("*", *[c.alias(n) for n, c in (meta | made | payload).items()])


def trim_strings(df: DataFrame) -> DataFrame:
    """Every text column without spaces at its ends, in one projection."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.trim(f"`{c}`").alias(c) if c in text else F.col(f"`{c}`") for c in df.columns])


def require(df: DataFrame, names: Iterable[str] = schemas.BRONZE_REQUIRED) -> DataFrame:
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def with_ingest_date(df: DataFrame, day: str | None = None) -> DataFrame:
    """ingest_date as DATE: of the row, else of its path; ``day`` keeps the rows of that day."""
    own = F.try_to_date(F.col("ingest_date").cast("string")) if "ingest_date" in df.columns else F.lit(None).cast("date")
    df = df.withColumn("ingest_date", F.coalesce(own, C.date_of_path(F.col("raw_path"))))
    return df if day is None else df.where(F.col("ingest_date") == F.lit(day).cast("date"))


def single_value(df: DataFrame, name: str, given: str | None = None) -> str:
    """The one value of a column, or ``given``; none or several are an error."""
    if given:
        return given
    seen = [r[0] for r in df.select(name).where(F.col(name).isNotNull() & (F.col(name).cast("string") != "")).distinct().limit(2).collect()]
    if len(seen) != 1:
        raise ValueError(f"expected one value of {name}, found {'none' if not seen else 'several'}")
    return str(seen[0])


def in_batch(df: DataFrame, batch: str) -> DataFrame:
    """Rows of a batch: by the batch columns if there, else by the raw path."""
    own = [F.col(c) == batch for c in ("batch_name", "batch_id") if c in df.columns]
    if not own:
        own = [F.contains("raw_path", F.lit(f"{c}={batch}/")) for c in ("batch_name", "batch_id")]
    return df.where(own[0] | own[1] if len(own) > 1 else own[0])


def nonempty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df
