"""Interaction audit of five filters over all their orders.

Spark turns each document into a mask of the filters that it fails and adds the
documents up by part and mask, with those that quality or toxicity labels mark:
at most 32 cells a part, whatever its size.  Cells go to arrays, one row a part,
and the 120 orders are visited by adjacent transpositions, each order one swap
away from the one before.  A swap touches two steps, so only those are counted
anew, from how many documents pass a set of filters; a filter's removals over the
whole walk are its Shapley sum.  The walk works on many parts at once.

Whether a text is identical to one of a smaller id needs the smallest id of each
text: documents are added up by text hash, part, mask and labels first, so a text
that a third of all rows share is a few rows after the combining.

Defined cases: null text is empty; null source and empty source are one part, the
empty string; labels that repeat an id count once, as marked if any row marks it, null
labels mark nothing; rows that repeat an id are documents of their own, and of
identical texts under the smallest id none is a copy; a null id is neither smaller
nor larger than another; words are cut at bytes 0x20 and 0x09 to 0x0D; other columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import common

FILTERS = "ABCDE"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def transpositions(n: int) -> Iterator[int]:
    """Places whose neighbours to swap, one after another, to visit all orders of ``n`` things from the first.

    Each thing walks through the order of those before it, there and back.
    """
    if n < 2:
        return
    down = list(range(n - 2, -1, -1))
    before = list(transpositions(n - 1))
    for i, at in enumerate([*before, None]):
        yield from down if i % 2 == 0 else reversed(down)
        if at is not None:
            # the last thing stands in front after a walk down, behind after one up
            yield at + 1 if i % 2 == 0 else at


def orders(n: int) -> list[tuple[tuple[int, ...], int | None]]:
    """All orders as (order, swapped place), the first with none."""
    now = list(range(n))
    out: list[tuple[tuple[int, ...], int | None]] = [(tuple(now), None)]
    for at in transpositions(n):
        now[at], now[at + 1] = now[at + 1], now[at]
        out.append((tuple(now), at))
    return out


def passing(cells: np.ndarray) -> np.ndarray:
    """Documents that fail none of a set of filters, by set, from counts by exact mask; sets along the last axis."""
    out = cells.copy()
    size = cells.shape[-1]
    # sums over submasks; a set's passing documents are those whose mask lies in its complement
    for bit in range(size.bit_length() - 1):
        on = np.flatnonzero(np.arange(size) >> bit & 1)
        out[..., on] += out[..., on ^ (1 << bit)]
    return out[..., size - 1 - np.arange(size)]


def walk(cells: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Names of the orders, and counts (parts, orders, steps, 7) from ``cells`` (3, parts, 32) of documents, good and toxic ones."""
    n = len(FILTERS)
    left = passing(cells)
    every = left[0, :, 0]
    fails = np.stack([every - left[0, :, 1 << f] for f in range(n)], axis=1)
    alone = np.stack([cells[0, :, 1 << f] for f in range(n)], axis=1)
    visited = orders(n)
    out = np.zeros((cells.shape[1], len(visited), n, len(_COUNTS)), np.int64)
    total = np.zeros((cells.shape[1], n), np.int64)
    now = np.zeros((cells.shape[1], n, len(_COUNTS) - 1), np.int64)
    for i, (order, at) in enumerate(visited):
        for step in range(n) if at is None else (at, at + 1):
            f, before = order[step], sum(1 << g for g in order[:step])
            lost = left[:, :, before] - left[:, :, before | 1 << f]
            now[:, step] = np.stack([left[0, :, before | 1 << f], lost[0], fails[:, f] - lost[0], alone[:, f], lost[1], lost[2]], axis=1)
        out[:, i, :, :-1] = now
        total[:, list(order)] += now[:, :, 1]
    for i, (order, _) in enumerate(visited):
        out[:, i, :, -1] = total[:, list(order)]
    return ["".join(FILTERS[f] for f in order) for order, _ in visited], out


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in common.slices(batch, 64):
            cells = np.zeros((3, rows.num_rows, 1 << len(FILTERS)), np.int64)
            for i, own in enumerate(rows.column("cells").to_pylist()):
                for c in own:
                    cells[:, i, c["mask"]] = c["n"], c["good"], c["toxic"]
            names, counts = walk(cells)
            each = counts.shape[1] * counts.shape[2]
            flat = counts.reshape(-1, len(_COUNTS))
            columns = [pa.array(rows.column("part").to_pylist(), pa.string()).take(pa.array(np.repeat(np.arange(rows.num_rows), each)))]
            columns += [pa.array(np.tile(np.repeat(names, counts.shape[2]), rows.num_rows)), pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), rows.num_rows * len(names)))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(flat[:, c]) for c in range(flat.shape[1])]], ["part", "filter_order", "step", *_COUNTS])


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask): the filters that a text fails by itself, A to D from the lowest bit."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "part", "text", F.array_remove(F.split("text", common.GAP), "").alias("words"))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.regexp_count("text", F.lit("[A-Z]"))
    fails = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 2 * F.length("text"), F.col("text").rlike(r"[#$%&*|]"))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", F.sha2("text", 256).alias("digest"), mask.alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail, all five."""
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = masked(docs)
    rows = rows.join(marked, F.col("doc_id") == F.col("of"), "left").select("doc_id", "part", "digest", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    alike = ["digest", "part", "mask", "good", "toxic"]
    one = rows.groupBy(*alike, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    # n without an id, and under the smallest id, of each text, part and marks
    own = one.groupBy(*alike).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("firsts"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"))
    first = own.groupBy("digest").agg(F.min("first").alias("smallest")).withColumnRenamed("digest", "same")
    told = own.join(first, F.col("digest") == F.col("same")).withColumn("fresh", F.col("unnamed") + F.when(F.col("first") == F.col("smallest"), F.col("firsts")).otherwise(0))
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("fresh")).alias("n"))))
    each = told.select("part", "good", "toxic", both.alias("x")).where("x.n > 0")
    return each.groupBy("part", "x.mask").agg(F.sum("x.n").alias("n"), *[F.sum(F.when(F.col(c), F.col("x.n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all parts, orders and steps.

    ``docs``: (doc_id, text, source); ``labels``: (doc_id, quality, toxic).
    """
    by_part = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return by_part.mapInArrow(common.tidy(_audited), _SCHEMA)
