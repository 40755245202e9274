"""License scans in DataFrame functions only.

Texts and templates are normalised (lower case, runs of other characters than
letters and digits as one space, so that wrapped lines and comment marks don't
matter) and compared by the Dice coefficient of their sets of word bigrams.  What
is compared is a window of a template's length, wherever in a text it may stand: at
each place where bigrams with the template's anchor words line up with the
template's own.  A window of a bigrams can reach ``least`` with a template of b only
if a lies between least / (2 - least) * b and its inverse times b, so other
templates are pruned by size.

A match shares at least least / (2 - least) of a template's bigrams and the
anchors touch more than the rest, so every match has an anchor bigram, and texts
without an anchor word leave at once.  A place counts if a sixteenth of the anchor
bigrams line up there, so a repeated word of a long template makes no places.

Templates are rows of two broadcast tables of a size that ``most_bytes`` bounds, not
parts of an expression.  Of windows that begin within ``near`` words of each other
the best counts, so a license is not taken for its sister.

Defined cases: null and empty texts have no row, nor has a text of one word; texts
of any length are read whole; equally good licenses at one place all count; n_units
is the number of places of a license, those of one template that overlap as one; rows
that repeat a doc_id are one document; an empty table gives no rows; only doc_id and
text are read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm import common
from quillspark.llm.license_texts import TEMPLATES

#: Part of a template's anchor bigrams that have to line up.
_VOTES = 16


def words(text: str) -> list[str]:
    return re.sub(r"[^0-9a-z]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    cut = words(text)
    return sorted({f"{a} {b}" for a, b in zip(cut, cut[1:], strict=False)})


def anchors(grams: list[list[str]], least: float) -> list[set[str]]:
    """Words of each template, of which any window that reaches ``least`` with it has one.

    Long words first, and those that serve most templates, so that all have few.
    """
    missable = [len(g) - least / (2 - least) * len(g) + 1e-9 for g in grams]
    of: dict[str, list[tuple[int, str]]] = {}
    for t, own in enumerate(grams):
        for g in own:
            for w in set(g.split()):
                of.setdefault(w, []).append((t, g))
    touched: list[set[str]] = [set() for _ in grams]
    chosen: list[set[str]] = [set() for _ in grams]
    open_ = set(range(len(grams)))
    while open_:
        gains = {w: sum(1 / missable[t] for t, g in hits if t in open_ and g not in touched[t]) for w, hits in of.items()}
        best = max((w for w, gain in gains.items() if gain), key=lambda w: (len(w) > 5, gains[w], len(w), w))
        for t, g in of[best]:
            if t in open_:
                touched[t].add(g)
                chosen[t].add(best)
        open_ = {t for t in open_ if len(touched[t]) <= missable[t]}
    return chosen


def any_word(words: set[str]) -> str:
    """A pattern of any of some words as a whole, by first letter."""
    by: dict[str, list[str]] = {}
    for w in sorted(words):
        by.setdefault(w[0], []).append(re.escape(w[1:]))
    return rf"(?<![0-9a-z])(?:{'|'.join(f'{c}(?:{"|".join(rest)})' for c, rest in by.items())})(?![0-9a-z])"


def tables(templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8) -> tuple[list[tuple], list[tuple], set[str]]:
    """(number, license, words, votes, bigrams) of each template; (bigram, number, place) of its anchor bigrams; all anchor words."""
    known, lined, needed = [], [], set()
    templates = [t for t in templates if bigrams(t[1])]
    chosen = anchors([bigrams(text) for _, text in templates], least)
    for (license, text), own in zip(templates, chosen, strict=True):
        cut, grams = words(text), bigrams(text)
        if own:
            places = [(f"{a} {b}", len(known), i) for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if own & {a, b}]
            known.append((len(known), license, len(cut), math.ceil(len(places) / _VOTES), grams))
            lined += places
            needed |= own
    return known, lined, needed


def _broadcast(spark: SparkSession, rows: list[tuple], ddl: str, most_bytes: int) -> DataFrame:
    size = sum(len(x) if isinstance(x, str) else 8 if isinstance(x, int) else sum(map(len, x)) for r in rows for x in r)
    if size > most_bytes:
        raise ValueError(f"templates of {size} bytes are more than most_bytes")
    return F.broadcast(spark.createDataFrame(rows, ddl))


def license_scan(docs: DataFrame, least: float = 0.8, templates: tuple[tuple[str, str], ...] = TEMPLATES, near: int = 8, most_bytes: int = 50_000_000) -> DataFrame:
    """(doc_id, license, n_units, dice): licenses found in each document, dice the best, to 6 places."""
    spark = docs.sparkSession
    known, lined, needed = tables(templates, least)
    # texts with no anchor bigram keep no words
    marks = F.array(*[F.lit(g) for g in sorted({g for g, _, _ in lined})]).cast("array<string>")
    known = _broadcast(spark, known, "number int, license string, n int, votes int, grams array<string>", most_bytes)
    lined = _broadcast(spark, lined, "gram string, number int, place int", most_bytes)
    low = F.lower("text")
    pairs = lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))
    hopeful = docs.where(low.rlike(any_word(needed)) if needed else F.lit(False))
    cut = hopeful.select("doc_id", F.monotonically_increasing_id().alias("row"), F.split(F.trim(F.regexp_replace(low, "[^0-9a-z]+", " ")), " ").alias("w"))
    cut = common.checkpointed(cut.where("size(w) > 1").where(F.arrays_overlap(pairs("w"), marks)))
    grams = cut.select("row", F.posexplode(pairs("w")).alias("at", "gram"))
    places = grams.join(lined, "gram").groupBy("row", "number", (F.col("at") - F.col("place")).alias("start")).agg(F.count(F.lit(1)).alias("c"))
    places = places.join(known.drop("grams"), "number").where("c >= votes").select("row", "number", "license", "n", "start")
    first = F.greatest(F.col("start"), F.lit(0))
    window = F.slice("w", first + 1, F.col("n") + F.col("start") - first)
    own = F.array_distinct(pairs("v"))
    seen = places.join(cut, "row").select("doc_id", "row", "number", "license", "n", first.alias("start"), window.alias("v")).where("size(v) > 1").withColumn("g", own).drop("v")
    share = least / (2 - least)
    fits = (F.size("g") >= share * F.size("grams") - 1e-9) & (F.size("g") <= F.size("grams") / share + 1e-9)
    dice = 2.0 * F.size(F.array_intersect("g", "grams")) / (F.size("g") + F.size("grams"))
    scored = seen.join(known.select("number", "grams"), "number").where(fits).withColumn("dice", dice).where(F.col("dice") >= least)
    around = Window.partitionBy("row").orderBy("start").rangeBetween(-near, near)
    best = scored.select("doc_id", "row", "number", "license", "n", "start", "dice", F.max("dice").over(around).alias("top")).where("dice = top")
    # windows of a template that overlap are one place
    before = F.lag("start").over(Window.partitionBy("row", "number").orderBy("start"))
    units = best.withColumn("new", F.when(F.coalesce(F.col("start") - before >= F.col("n"), F.lit(True)), 1).otherwise(0))
    per = units.groupBy("doc_id", "row", "license", "number").agg(F.sum("new").alias("units"), F.max("dice").alias("dice"))
    per = per.groupBy("doc_id", "row", "license").agg(F.max("units").alias("units"), F.max("dice").alias("dice"))
    return per.groupBy("doc_id", "license").agg(F.sum("units").alias("n_units"), F.round(F.max("dice"), 6).alias("dice"))
