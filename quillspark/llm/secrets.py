"""Secret scans with linking of multipart credentials, in DataFrame functions only.

Base spans are assignments to secret-like names, access identifiers and hex
runs.  Weak candidates (bare identifiers, bare mixed secrets, endpoints) mean
nothing alone.  An interval join links access identifiers with secrets that
begin or end at most ``scope`` code points away without overlapping, and both with
endpoints as near; weak candidates are reported only when complementary parts are
there: an identifier with a secret, a secret with an identifier, an endpoint
with both.  A weak candidate inside a base span adds nothing and is left out.
Each link tells its parts, its nearest endpoint and how close it is: on one
``line``, in one ``block`` without an empty line, or only ``near``.  The links of
an identifier are its group.

Matches and what lies between them are cut once; running sums over a text's pieces
give places, so a text of many matches costs in proportion to them.  The interval
join meets parts in bins of ``_BIN`` code points, so a text of many parts is many
keys, and one part only meets those near it.

Defined cases: null text is an empty text; texts of any length are scanned whole; a
text without spans has empty span lists; spans of one start are ordered by kind;
of equally near endpoints the first counts; rows that repeat are scanned alike,
each on its own; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm import common

# The base patterns; of letters and digits in a row the longest run counts, so that shorter ones need no match.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Parts that count only together.
WEAK_ACCESS = r"[A-Z0-9]{16,}"
WEAK_SECRET = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"https?://[!-~]+"

#: (kind, pattern, a quick necessary test, role); numbers order the kinds.
KINDS = (
    ("assign", ASSIGN, r"""[dDtTnNyY]["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""", "secret"),
    ("access", ACCESS, ACCESS, "access"),
    ("hex", HEX, HEX, "secret"),
    ("link_access", WEAK_ACCESS, WEAK_ACCESS, "access"),
    ("link_secret", WEAK_SECRET, WEAK_SECRET, "secret"),
    ("link_endpoint", ENDPOINT, r"https?://[!-~]", "endpoint"),
)
#: Between paragraphs: white space with two line ends.
EMPTY_LINE = r"\n[\x20\x09-\x0D]*\n"
_BIN = 4096
_PIECES = "array<struct<gap: int, size: int, good: boolean, lines: int, blocks: int>>"


def _passes(kind: str, text: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(text, ASSIGN, 2)) >= 12
    if kind == "link_access":
        return text.rlike("[A-Z]") & text.rlike("[0-9]")
    if kind == "link_secret":
        return text.rlike("[A-Z]") & text.rlike("[a-z]") & text.rlike("[0-9]")
    return F.lit(True)


def pieces_of(text: Column, number: int) -> Column:
    """Matches of one kind with what lies before each: lengths, line ends, empty lines, and whether it counts."""
    kind, pattern, quick, _ = KINDS[number]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    before = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    each = F.zip_with(
        before,
        found,
        lambda b, m: F.struct(
            F.length(b).alias("gap"),
            F.length(m).alias("size"),
            _passes(kind, m).alias("good"),
            (F.length(b) - F.length(F.replace(b, F.lit("\n"), F.lit("")))).alias("lines"),
            (F.size(F.split(b, EMPTY_LINE, -1)) - 1).alias("blocks"),
        ),
    )
    return F.when(text.rlike(quick), each).otherwise(F.array()).cast(_PIECES)


def _parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of every row of ``docs``; and its spans (row, start, kind, end, role, line, block)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lists = F.array(*[F.struct(F.lit(i).alias("kind"), pieces_of(text, i).alias("pieces")) for i in range(len(KINDS))])
    cut = common.checkpointed(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.filter(lists, lambda x: F.exists(x["pieces"], lambda p: p["good"])).alias("lists")))
    each = cut.select("row", F.explode("lists").alias("x")).select("row", "x.kind", F.posexplode("x.pieces").alias("at", "p")).select("row", "kind", "at", "p.*")
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # sums of whole texts may pass the range of an int
    total = lambda c: F.sum(c.cast("long")).over(so_far)
    role = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    placed = each.select("row", "kind", "good", "size", total(F.col("gap") + F.col("size")).alias("end"), total(F.col("lines")).alias("line"), total(F.col("blocks")).alias("block"))
    return cut.select("row", "doc_id"), placed.where("good").select("row", (F.col("end") - F.col("size")).alias("start"), "kind", "end", role.alias("role"), "line", "block")


def _near(left: DataFrame, right: DataFrame, scope: int, apart: bool) -> DataFrame:
    """Pairs (l, r) of spans at most ``scope`` code points apart, without those that overlap if ``apart``: an interval join by bins."""
    bins = lambda a, b: F.sequence(F.floor(F.greatest(a, F.lit(0)) / _BIN).cast("long"), F.floor(b / _BIN).cast("long"))
    one = left.select("row", F.struct(*left.columns).alias("l"), bins(F.col("start"), F.col("end")).alias("bl"))
    two = right.select("row", F.struct(*right.columns).alias("r"), bins(F.col("start") - scope, F.col("end") + scope).alias("br"))
    gap = F.greatest(F.col("r.start") - F.col("l.end"), F.col("l.start") - F.col("r.end"))
    met = one.select("row", "l", F.col("bl")[0].alias("fl"), F.explode("bl").alias("bin")).join(two.select("row", "r", F.col("br")[0].alias("fr"), F.explode("br").alias("bin")), ["row", "bin"])
    # of the bins where two spans meet, the first
    met = met.where(F.col("bin") == F.greatest("fl", "fr")).withColumn("gap", gap).where(F.col("gap") <= scope)
    return (met.where("gap >= 0") if apart else met).select("row", "l", "r", "gap")


def _linked(parts: DataFrame, scope: int) -> tuple[DataFrame, DataFrame]:
    """Links (row, access, secret, endpoint, scope), and the weak spans (row, start, kind, end) to report."""
    before = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    covered = F.coalesce(F.max(F.when(F.col("kind") <= 2, F.col("end"))).over(before) >= F.col("end"), F.lit(False))
    both = parts.groupBy("row").agg(F.bool_or(F.col("role") == "access").alias("a"), F.bool_or(F.col("role") == "secret").alias("s")).where("a and s").select("row")
    able = common.checkpointed(parts.join(both, "row", "left_semi").withColumn("covered", covered).where("kind <= 2 or not covered").drop("covered"))
    of = lambda role: able.where(F.col("role") == role)
    scope_kind = F.when(F.col("l.line") == F.col("r.line"), "line").when(F.col("l.block") == F.col("r.block"), "block").otherwise("near")
    pairs = common.checkpointed(_near(of("access"), of("secret"), scope, apart=True).select("row", F.col("l").alias("access"), F.col("r").alias("secret"), scope_kind.alias("scope")))
    by_access = _near(of("endpoint"), of("access"), scope, apart=False).select("row", F.col("r").alias("access"), F.col("l").alias("e"), F.col("gap").alias("g"))
    by_secret = _near(of("endpoint"), of("secret"), scope, apart=False).select("row", F.col("r").alias("secret"), F.col("l").alias("e"), F.col("gap").alias("h"))
    ends = pairs.join(by_access, ["row", "access"]).join(by_secret, ["row", "secret", "e"])
    nearest = ends.groupBy("row", "access", "secret").agg(F.min(F.struct(F.greatest("g", "h").alias("far"), F.col("e.start").alias("start"), F.col("e.end").alias("end"))).alias("n"))
    links = pairs.join(nearest, ["row", "access", "secret"], "left").select("row", "access", "secret", F.when(F.col("n").isNotNull(), F.struct("n.start", "n.end")).alias("endpoint"), "scope")
    # an endpoint needs an identifier and a secret near itself, which need not be near each other
    touched = by_access.select("row", "e").intersect(by_secret.select("row", "e")).select("row", "e.start", "e.kind", "e.end")
    weak = lambda c: pairs.select("row", f"{c}.start", f"{c}.kind", f"{c}.end").where("kind > 2")
    return links, weak("access").union(weak("secret")).distinct().union(touched)


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def linked_credentials(docs: DataFrame, scope: int = 200) -> DataFrame:
    """(doc_id, group, access_start, access_end, secret_start, secret_end, endpoint_start, endpoint_end, scope) of each link; the group is the identifier's place."""
    rows, parts = _parts(docs)
    links, _ = _linked(common.checkpointed(parts), scope)
    flat = [F.col(f"{p}.{end}").alias(f"{p}_{end}") for p in ("access", "secret", "endpoint") for end in ("start", "end")]
    return links.join(rows, "row").select("doc_id", F.col("access.start").alias("group"), *flat, "scope")


def secret_spans(docs: DataFrame, scope: int = 200) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, links) of each row of ``docs``.

    ``links`` names an identifier, its secret and their endpoint by their places, and the scope.
    """
    rows, parts = _parts(docs)
    parts = common.checkpointed(parts)
    links, weak = _linked(parts, scope)
    spans = parts.where("kind <= 2").select("row", "start", "kind", "end").union(weak)
    listed = spans.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("spans"))
    place = lambda p: F.concat_ws("-", F.col(f"{p}.start").cast("string"), F.col(f"{p}.end").cast("string"))
    spelled = F.concat_ws("/", place("access"), place("secret"), F.coalesce(F.nullif(place("endpoint"), F.lit("")), F.lit("none")), "scope")
    told = links.groupBy("row").agg(F.collect_list(F.struct(F.col("access.start").alias("a"), F.col("access.kind").alias("k"), F.col("secret.start").alias("s"), F.col("secret.kind").alias("l"), spelled.alias("link"))).alias("links"))
    told = told.select("row", F.array_join(F.transform(F.array_sort("links"), lambda x: x["link"]), ",").alias("links"))
    listed = listed.join(told, "row", "left").withColumnsRenamed({"row": "of"})
    held = F.coalesce("spans", F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>"))
    base = F.filter(held, lambda p: p["kind"] <= 2)
    count = lambda k: F.size(F.filter(held, lambda p: p["kind"] == k)).cast("long")
    return rows.join(listed, F.col("row") == F.col("of"), "left").select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(held).alias("spans"),
        F.coalesce("links", F.lit("")).alias("links"),
    )
