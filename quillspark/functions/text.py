"""Text expressions: tokens, overlap, redaction, routing and error classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark import schemas

# Patterns of what is redacted, in order.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
API_KEY = r"\bsk-[A-Za-z0-9]{20,}\b"
BEARER = r"(?i)\bBearer\s+[A-Za-z0-9._-]+\b"

# Words that tell a route or an error's class, in order.
DQ_WORDS = ("dq", "deadletter", "rule", "violation", "quality")
ERROR_WORDS = (
    ("IAM_PERMISSION", ("permission", "forbidden", "access denied")),
    ("AUTH", ("auth", "credential", "token")),
    ("SCHEMA_DRIFT", ("schema", "column", "field")),
    ("DQ_FAILURE", ("dq", "quality", "validation")),
    ("CONFIG", ("config", "missing", "invalid")),
    ("NETWORK", ("network", "timeout", "connection")),
    ("DEPENDENCY", ("dependency", "module", "import")),
)


def tokens(c: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def lexical_overlap(query: Column, text: Column) -> Column:
    """Share of the query's tokens that the text has."""
    q = tokens(query)
    return F.size(F.array_intersect(q, tokens(text))) / F.greatest(F.lit(1), F.size(q))


def sanitize(c: Column) -> Column:
    """Lower-case letters and digits, others as ``_``, none at the ends; ``na`` if nothing is left."""
    kept = F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "_"), r"\A_+|_+\z", "")
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("na"))


def redact(c: Column) -> Column:
    c = F.regexp_replace(c, EMAIL, "[REDACTED_EMAIL]")
    c = F.regexp_replace(c, API_KEY, "[REDACTED_API_KEY]")
    return F.regexp_replace(c, BEARER, "Bearer [REDACTED_TOKEN]")


def _has_any(c: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def route(query: Column, hint: Column | None = None) -> Column:
    """``dq`` or ``ops``: a valid hint wins, else words of the query decide."""
    found = F.when(F.coalesce(_has_any(F.lower(query), DQ_WORDS), F.lit(False)), F.lit("dq")).otherwise(F.lit("ops"))
    return found if hint is None else F.when(hint.isin("ops", "dq"), hint).otherwise(found)


def error_category(message: Column) -> Column:
    """Class of an error by its message; RUNTIME if no word tells."""
    low = F.lower(message)
    out = F.when(low.isNull(), F.lit("RUNTIME"))
    for category, words in ERROR_WORDS:
        out = out.when(_has_any(low, words), F.lit(category))
    return out.otherwise(F.lit("RUNTIME"))


def normal_category(c: Column) -> Column:
    up = F.upper(F.trim(c))
    return F.when(up.isin(*schemas.ERROR_CATEGORIES), up).otherwise(F.lit("RUNTIME"))
