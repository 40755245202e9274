"""Column expressions: parsing, resolving and hashing.  All but the canonical form of fractions run in the JVM, none throws on bad data."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark import schemas


def blank(c: Column) -> Column:
    return c.isNull() | (F.length(F.trim(c)) == 0)


def empty_to_null(c: Column) -> Column:
    """Null for the empty string and no other."""
    return F.nullif(c, F.lit(""))


def looks_like_json(c: Column) -> Column:
    return F.substring(F.ltrim(c), 1, 1).isin("[", "{")


def json_variant(c: Column) -> Column:
    """Text that begins like JSON as a variant; null for other text and for what can't be parsed."""
    return F.when(looks_like_json(c), F.try_parse_json(c))


def digits_to_int(c: Column) -> Column:
    """An int from a text of digits only; null for others ("-1", "1.0")."""
    return F.when(c.rlike(r"\A[0-9]+\z"), c.try_cast("int"))


def int_error(c: Column, name: str) -> Column:
    return F.when(c.isNotNull() & digits_to_int(c).isNull(), F.lit(f"int_parse_error:{name}"))


def as_struct(df: DataFrame, name: str, ddl: str) -> Column:
    """Column ``name`` as the struct ``ddl``: text is parsed, another struct goes by field names, absent is null.

    A column that has the type already is left alone, so that unused fields are
    still pruned from the scan.
    """
    target = schemas.parse(ddl)
    if name not in df.columns:
        return F.lit(None).cast(target).alias(name)
    have = df.schema[name].dataType
    if have.simpleString() == target.simpleString():
        return F.col(name)
    if isinstance(have, T.StringType):
        return F.from_json(F.col(name), target).alias(name)
    if isinstance(have, (T.StructType, T.MapType, T.VariantType)):
        return F.from_json(F.to_json(F.col(name)), target).alias(name)
    return F.lit(None).cast(target).alias(name)


def as_variant(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a variant: nested values as they are, null fields left out; plain values as themselves."""
    have = df.schema[name].dataType
    nested = isinstance(have, (T.StructType, T.ArrayType, T.MapType))
    return (F.try_parse_json(F.to_json(F.col(name))) if nested else F.col(name).cast("variant")).alias(name)


def as_strings(df: DataFrame, name: str) -> Column:
    """Column ``name`` as an array of strings.

    Absent gives an empty array; an array keeps its items (a null one stays null);
    text is a JSON array, or nothing if blank, or one item.
    """
    kind = T.ArrayType(T.StringType())
    empty = F.array().cast(kind)
    if name not in df.columns:
        return empty.alias(name)
    have, c = df.schema[name].dataType, F.col(name)
    if isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: x.cast("string")).alias(name)
    if isinstance(have, T.StringType):
        listed = F.when(F.substring(F.ltrim(c), 1, 1) == "[", F.from_json(c, kind))
        return F.coalesce(listed, F.when(blank(c), empty).otherwise(F.array(c))).alias(name)
    if isinstance(have, (T.StructType, T.MapType)):
        return F.coalesce(F.from_json(F.to_json(c), kind), empty).alias(name)
    return empty.alias(name)


def jsonify(df: DataFrame, names: Iterable[str] = schemas.JSON_COLUMNS) -> DataFrame:
    """Nested columns among ``names`` as JSON text; text and absent ones are left."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.withColumns({n: F.to_json(n) for n in names if n in df.columns and isinstance(df.schema[n].dataType, nested)})


def two_source_mean(first: Sequence[Column], second: Sequence[Column], places: int = 4) -> Column:
    """Mean of two sources, each the first non-null of its columns; one side alone is that side."""
    a, b = F.coalesce(*first), F.coalesce(*second)
    return F.coalesce(F.round((a + b) / 2, places), a, b)


def penalised_mean(columns: Sequence[Column], places: int = 4) -> Column:
    """Mean over all columns with nulls as zero: a missing score costs."""
    return F.round(reduce(add, [F.coalesce(c, F.lit(0.0)) for c in columns]) / len(columns), places)


def path_part(path: Column, pattern: str) -> Column:
    """The first group of ``pattern`` in a path, null without a match."""
    return empty_to_null(F.regexp_extract(path, pattern, 1))


def date_of_path(path: Column) -> Column:
    """DATE from ``ingest_date=`` or else ``dt=`` in a path."""
    day = F.coalesce(path_part(path, r"ingest_date=(\d{4}-\d{2}-\d{2})"), path_part(path, r"dt=(\d{4}-\d{2}-\d{2})"))
    return F.try_to_date(day)


#: What JSON text escapes by a letter, and what by a number.
_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\f", "\\f"), ("\b", "\\b"))
_NUMBERED = tuple(c for c in map(chr, range(32)) if c not in "\n\r\t\f\b")


def _quoted(c: Column) -> Column:
    escaped = c
    for a, b in (*_ESCAPES, *((x, f"\\u{ord(x):04x}") for x in _NUMBERED)):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    # few texts have any of these
    return F.concat(F.lit('"'), F.when(c.rlike(r'[\x00-\x1f"\\\\]'), escaped).otherwise(c), F.lit('"'))


def _has_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_floats(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_floats(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_floats(kind.valueType)
    return isinstance(kind, (T.FloatType, T.DoubleType, T.VariantType))


def _is_text(kind: T.DataType) -> bool:
    """Whether canonical JSON has values of this type as quoted text."""
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.IntegralType, T.BooleanType, T.DecimalType))


def _canonical_struct(c: Column, fields: Sequence[T.StructField]) -> Column:
    """A struct that isn't null, its fields in this order; texts are quoted by one function for all of them, as code for each would be too large to be compiled."""
    none, plain = F.lit(None).cast("string"), lambda f: _is_text(f.dataType)
    parts = [
        F.struct(F.lit(json.dumps(f.name, ensure_ascii=False) + ":").alias("name"), (c.getField(f.name).cast("string") if plain(f) else none).alias("text"), (none if plain(f) else _canonical(c.getField(f.name), f.dataType)).alias("made"))
        for f in fields
    ]
    written = F.transform(F.array(*parts), lambda x: F.concat(x["name"], F.coalesce(x["made"], _quoted(x["text"]), F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(written, ",") if parts else F.lit(""), F.lit("}"))


def _canonical(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        if fields and all(_is_text(f.dataType) for f in fields):
            # Spark's JSON of texts is the same but for letters escaped by number, in other digits, and bytes that are no UTF-8.
            # Rows that have these go through a lambda: its code, which is long, is then not part of the stage's
            whole = F.to_json(F.struct(*[c.getField(f.name).cast("string").alias(f.name) for f in fields]), {"ignoreNullFields": "false"})
            odd = F.contains(whole, F.lit("\\u00")) | F.contains(whole, F.lit("\ufffd"))
            out = F.when(c.isNotNull(), F.when(odd, F.get(F.transform(F.array(c), lambda x: _canonical_struct(x, fields)), F.lit(0))).otherwise(whole))
        else:
            out = F.when(c.isNotNull(), _canonical_struct(c, fields))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _canonical(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        items = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(_quoted(e["key"].cast("string")), F.lit(":"), _canonical(e["value"], kind.valueType)))
        out = F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}"))
    elif isinstance(kind, (T.IntegralType, T.BooleanType, T.DecimalType)):
        out = c.cast("string")
    else:
        out = _quoted(c.cast("string"))
    return F.coalesce(out, F.lit("null"))


def canonical_json(c: Column, kind: T.DataType) -> Column:
    """JSON text of a value in one form: keys in order at every depth, no spaces, nulls kept, other letters as they are.

    Numbers with a fraction are written by Python, the shortest way that reads back the same, over Arrow columns;
    all else is an expression.  Dates and times are text.
    """
    return _written(c, lambda text: text) if _has_floats(kind) else _canonical(c, kind)


def _written(c: Column, then: Callable[[str], str]) -> Column:
    """``then`` of the canonical JSON that Python writes."""

    @F.pandas_udf("string")
    def written(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: then(json.dumps(json.loads(t)["v"], sort_keys=True, separators=(",", ":"), ensure_ascii=False)), na_action="ignore")

    # the name spares Spark making one from the expression, which it can't for a struct inside a Python function
    return written(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})).alias("canonical")


def record_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the row's canonical JSON over some columns of ``df``."""
    kind = T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns])
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    if _has_floats(kind):
        return _written(row, lambda text: hashlib.sha256(text.encode()).hexdigest())
    return F.sha2(_canonical(row, kind), 256)


def schema_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the JSON list of sorted names."""
    return F.sha2(F.to_json(F.array(*[F.lit(c) for c in sorted(columns)])), 256)


def dimension_key(c: Column) -> Column:
    return F.sha2(F.coalesce(c.cast("string"), F.lit("unknown")), 256)


def first_filled(*columns: Column) -> Column:
    """First column that is neither null nor empty."""
    return F.coalesce(*[empty_to_null(c.cast("string")) for c in columns])
