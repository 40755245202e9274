"""Source rows to raw envelopes, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark import schemas
from quillspark.functions import columns as C
from quillspark.operators import places


def normalize_payload(df: DataFrame, nested: str = "struct") -> DataFrame:
    """Source rows with typed columns and ``parse_errors``.

    Empty text is null; each cell of the nested columns is parsed once, if it looks
    like JSON; step indexes are ints if they are digits; reviewers default to their
    curators; violations are a list, never null.  What can't be parsed is named in
    parse_errors, with its text in rescued_data.

    ``nested="struct"`` gives the declared types: other fields go, text that is no
    JSON is null, a number in quotes counts as the number.  ``nested="variant"`` keeps
    every field, declared or not, and text that is no JSON as a string.
    """
    if nested not in ("struct", "variant"):
        raise ValueError(f"nested columns are 'struct' or 'variant', not {nested!r}")
    for name in (*schemas.PAYLOAD_TEXT,):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    df = df.select(*[C.empty_to_null(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`") for c in df.columns])
    # a projection of its own, so that Spark parses a cell once for the test and the value
    held = {n: f"__parsed_{n}" for n in schemas.JSON_COLUMNS if n in text}
    df = df.withColumns({h: C.json_variant(F.col(n)) for n, h in held.items()})
    faults = {n: F.when(C.looks_like_json(F.col(n)) & F.col(h).isNull(), F.lit(f"json_parse_error:{n}")) for n, h in held.items()}
    faults |= {n: C.int_error(F.col(n), n) for n in ("step_index", "evaluated_step_index") if n in text}
    errors = F.array_compact(F.array(*faults.values())) if faults else F.array().cast("array<string>")
    kept = F.map_filter(F.create_map(*[x for n, e in faults.items() for x in (F.lit(n), F.when(e.isNotNull(), F.col(n)))]), lambda _, v: v.isNotNull()) if faults else None
    rescued = F.when(F.size(kept) > 0, F.to_json(kept)) if faults else F.lit(None).cast("string")
    no_list = F.when(C.blank(F.col("violations")), F.array().cast("array<string>")).otherwise(F.array("violations")) if "violations" in text else None
    listed = F.coalesce(F.try_variant_get(F.col(held["violations"]), "$", "array<string>"), no_list) if "violations" in text else F.coalesce(C.as_strings(df, "violations"), F.array().cast("array<string>"))
    if nested == "variant":
        typed = {n: F.coalesce(F.col(held[n]), F.col(n).cast("variant")) if n in held else C.as_variant(df, n) for n in schemas.NESTED}
        typed["violations"] = F.to_variant_object(listed)
    else:
        typed = {n: F.try_variant_get(F.col(held[n]), "$", ddl) if n in held else C.as_struct(df, n, ddl) for n, ddl in schemas.NESTED.items()}
        typed["violations"] = listed
    for i in (1, 2):
        reviewer, curator = f"reviewer_curator_{i}_rating", f"curator_{i}_rating"
        typed[reviewer] = F.when(F.col(reviewer).isNull(), typed[curator]).otherwise(typed[reviewer])
    typed |= {n: C.digits_to_int(F.col(n)) if n in text else F.col(n).try_cast("int") for n in ("step_index", "evaluated_step_index")}
    return df.withColumns({"parse_errors": errors, "rescued_data": rescued, **typed}).drop(*held.values())


def nested_types(df: DataFrame) -> dict[str, Column]:
    """Aggregates that give the merged type of the objects in each nested column of a ``variant`` payload."""
    # an object, and nothing else, is a struct of no fields; its type is made once, by the aggregate
    whole = lambda n: F.when(F.try_variant_get(n, "$", "struct<>").isNotNull(), F.col(n))
    return {n: F.schema_of_variant_agg(whole(n)).alias(n) for n in schemas.NESTED if n in df.columns}


def undeclared(types: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """(column, field, type) of the fields, at any depth, that the declared types don't have."""
    out: list[tuple[str, str, str]] = []

    def compare(column: str, path: str, seen: T.DataType, declared: T.DataType) -> None:
        if isinstance(seen, T.ArrayType) and isinstance(declared, T.ArrayType):
            compare(column, f"{path}[]", seen.elementType, declared.elementType)
        elif isinstance(seen, T.StructType) and isinstance(declared, T.StructType):
            for f in seen.fields:
                at = f"{path}.{f.name}" if path else f.name
                if f.name in declared.names:
                    compare(column, at, f.dataType, declared[f.name].dataType)
                else:
                    out.append((column, at, f.dataType.simpleString()))

    for column, kind in types.items():
        if kind and kind.startswith("OBJECT<"):
            compare(column, "", schemas.parse(kind.replace("OBJECT<", "STRUCT<")), schemas.parse(schemas.NESTED[column]))
    return sorted(out)


def payload_drift(df: DataFrame) -> DataFrame:
    """(column, field, type): what the nested columns of a ``variant`` payload hold beyond their declared types, over all rows."""
    found = undeclared(df.agg(*nested_types(df).values()).first().asDict())
    return df.sparkSession.createDataFrame(found, "column string, field string, type string")


def raw_envelope(df: DataFrame, meta: dict[str, str], order: str | None = None) -> DataFrame:
    """(meta, payload) rows; the row number is the place in the file.

    ``order`` names a column that gives the place.  Without it the rows' own
    order counts, from 1 and without gaps: the batch is written once and numbered by file and row
    in it, so no task holds it and nothing depends on how often it is evaluated.
    """
    data = [c for c in df.columns if c != order]
    if order:
        place = F.col(order).cast("long")
    else:
        df, place = places.dense_places(df, name="__place"), F.col("__place") + 1
    fields = {k: F.lit(v) for k, v in meta.items()} | {"schema_hash": C.schema_hash(data), "record_hash": C.record_hash(df, data), "row_number": place}
    names = schemas.parse(schemas.META_DDL).names
    return df.select(F.struct(*[fields.get(n, F.lit(None).cast("string")).alias(n) for n in names]).alias("meta"), F.struct(*[F.col(f"`{c}`") for c in data]).alias("payload"))


def batch_id(df: DataFrame, path: str) -> str:
    """batch_id of the first row that has one, else the file's stem."""
    found = df.where(F.col("batch_id").isNotNull()).select("batch_id").first() if "batch_id" in df.columns else None
    return found[0] if found else path.rstrip("/").rpartition("/")[2].rpartition(".")[0] or path


def normalize_legacy(df: DataFrame) -> DataFrame:
    """Older rows under one set of names; an empty first choice gives way to the second."""
    names = {"feedback_id": ("feedback_id", "id"), "timestamp": ("timestamp", "created_at"), "comment": ("comment", "text"), "model": ("model", "model_name")}
    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return df.select(*[C.first_filled(*map(have, pair)).alias(n) for n, pair in names.items()], have("rating").alias("rating"))
