"""Scores of queries against items by blocks of matrices.

A block of queries is a few matrices: vectors, and which words each query has.  Items
pass by in Arrow batches, once, whatever the number of queries: products of matrices
give the scores of a batch against a block, and of these only the best few of each
query go on, so that what is shuffled is bounded by the result and the number of
tasks.  Up to ``block`` queries go to every task; beyond that queries and items are
dealt to a grid of blocks, each pair of which meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells of a matrix of items and words, or of items and queries, that are worked on at once.
CELLS = 4_000_000
#: Items and queries of some pairs.
Pairs = tuple[np.ndarray, np.ndarray]


@dataclass
class Asked:
    """A block of queries: columns ``query``, and where there are any ``vector``, ``tokens`` and ``tag``."""

    ids: pa.Array
    n: int
    vectors: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    words: pa.Array | None = None
    has: np.ndarray | None = None
    sizes: np.ndarray | None = None
    tags: np.ndarray | None = None

    @classmethod
    def of(cls, table: pa.Table) -> Asked:
        table = table.combine_chunks()
        out = cls(table.column("query").combine_chunks(), table.num_rows)
        if "vector" in table.column_names:
            out.vectors = _by_length(table.column("vector"))
        if "tokens" in table.column_names:
            lists = _lists(table.column("tokens"))
            words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
            out.words = pc.unique(words)
            out.has = np.zeros((len(out.words), out.n), np.float32)
            out.has[pc.index_in(words, out.words).to_numpy(), owner] = 1
            out.sizes = np.maximum(1, np.bincount(owner, minlength=out.n))
        if "tag" in table.column_names:
            out.tags = np.array(table.column("tag").to_pylist(), dtype=object)
        return out

    def overlap(self, tokens: pa.Array) -> np.ndarray:
        """Share of each query's words that each item has, items by queries."""
        rows = len(tokens)
        found = np.zeros((rows, len(self.words)), np.float32)
        at = pc.index_in(pc.list_flatten(tokens), self.words)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        found[pc.list_parent_indices(tokens).to_numpy()[known], at.drop_null().to_numpy()] = 1
        return (found @ self.has) / self.sizes

    def cosine(self, column: pa.Array, pairs: Pairs | None = None) -> np.ndarray:
        """Cosine of each item with each query, or of some pairs alone, 0 where there is none.

        A product of matrices may round equal items otherwise in other places; pairs are all added up alike.
        """
        out = np.zeros((len(column), self.n) if pairs is None else len(pairs[0]))
        for size, (at, unit) in _by_length(column).items():
            if size not in self.vectors:
                continue
            mine, own = self.vectors[size]
            if pairs is None:
                out[np.ix_(at, mine)] = unit @ own.T
                continue
            rows, queries = np.full(len(column), -1), np.full(self.n, -1)
            rows[at], queries[mine] = np.arange(len(at)), np.arange(len(mine))
            i, q = rows[pairs[0]], queries[pairs[1]]
            have = np.flatnonzero((i >= 0) & (q >= 0))
            for a in range(0, len(have), 20_000):
                some = have[a : a + 20_000]
                out[some] = (unit[i[some]] * own[q[some]]).sum(axis=1)
        return out


def _lists(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """Lists without nulls, which count as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.if_else(column.is_valid(), column, pa.scalar([], column.type)) if column.null_count else column


def _by_length(column: pa.ChunkedArray | pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors by length; vectors that are null, empty, zero or hold nulls are none."""
    lists = _lists(column)
    sizes = pc.list_value_length(lists).to_numpy()
    flat = pc.cast(pc.list_flatten(lists), pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    out = {}
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == size)
        rows = flat[starts[at][:, None] + np.arange(size)]
        norm = np.sqrt((rows * rows).sum(axis=1))
        able = norm > 0
        out[size] = at[able], rows[able] / norm[able][:, None]
    return out


Score = Callable[[Asked, pa.RecordBatch, Pairs | None], np.ndarray]
#: Order in which equal scores come.
TIE = "tie"


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    return found.sort_values(["q", "score", TIE], ascending=[True, False, True], kind="stable").groupby("q", sort=False).head(k)


def _ranked(asked: Asked, batches: Iterator[pa.RecordBatch], score: Score, k: int, names: list[str]) -> pd.DataFrame:
    """The best ``k`` items of each query over the batches, with columns ``names`` of the items."""
    best = pd.DataFrame({"q": np.zeros(0, np.int64), "score": np.zeros(0), **{n: np.zeros(0, object) for n in names}})
    least = np.full(asked.n, -np.inf)
    for batch in batches:
        for part in cut(batch, asked):
            like = score(asked, part, None)
            if len(like) > k:
                floor = np.partition(like, len(like) - k, axis=0)[len(like) - k]
            else:
                floor = like.min(axis=0)
            item, q = np.nonzero(like >= np.maximum(floor, least) - 1e-9)
            keep = np.isfinite(like[item, q])
            item, q = item[keep], q[keep]
            if not len(item):
                continue
            rows = part.select(names).to_pandas().iloc[item].reset_index(drop=True)
            rows.insert(0, "q", q)
            rows.insert(1, "score", score(asked, part, (item, q)))
            best = _best(pd.concat([best, rows]) if len(best) else rows, k)
            counts = best.groupby("q")["score"].agg(["size", "min"])
            full = counts[counts["size"] >= k]
            least[full.index.to_numpy()] = full["min"].to_numpy()
    return best


def cut(batch: pa.RecordBatch | pa.Table, asked: Asked) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose matrices are small enough."""
    words = len(asked.words) if asked.words is not None else 0
    rows = max(1, CELLS // max(1, asked.n, words))
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield from part.to_batches() if isinstance(part, pa.Table) else [part]


def _fields(schema: T.StructType, names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, schema[n].dataType) for n in names]


def _grid(queries: DataFrame, items: DataFrame, run, schema: T.StructType, query_rows: int, item_rows: int) -> DataFrame:
    """``run(asked, batches)`` on each pair of a block of queries and a block of items; each block is sent once to each of the others."""
    down, across = (max(1, -(-df.count() // rows)) for df, rows in ((queries, query_rows), (items, item_rows)))
    whole = F.struct(*[F.col(f"`{c}`") for c in items.columns])
    left = queries.withColumn("__i", F.pmod(F.xxhash64("query"), F.lit(down)).cast("int")).withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = items.withColumn("__j", F.pmod(F.xxhash64(whole), F.lit(across)).cast("int")).withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))

    def pair(q: pa.Table, i: pa.Table) -> pa.Table:
        batches = list(run(Asked.of(q), i.to_batches())) if q.num_rows and i.num_rows else []
        return pa.Table.from_batches(batches) if batches else pa.table({f.name: pa.array([], t) for f, t in zip(schema.fields, _arrow(schema), strict=True)})

    return left.groupBy("__i", "__j").cogroup(right.groupBy("__i", "__j")).applyInArrow(pair, schema)


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return [f.type for f in to_arrow_schema(schema)]


def over_blocks(queries: DataFrame, items: DataFrame, run, schema: T.StructType, block: int, item_rows: int = 50_000) -> DataFrame:
    """``run(asked, batches)`` over all queries and items, in one pass over the items.

    The queries are counted first: up to ``block`` are sent to all tasks, more make blocks of about so many.
    """
    head = queries.limit(block + 1).toArrow()
    if head.num_rows > block:
        return _grid(queries, items, run, schema, block, item_rows)
    asked = Asked.of(head)
    return items.mapInArrow(lambda batches: run(asked, batches) if asked.n else iter(()), schema)


def top_k(queries: DataFrame, items: DataFrame, k: int, score: Score, carry: list[str], block: int) -> DataFrame:
    """(query, score, ``carry``, tie) of the best ``k`` items of each query in each task; the best of all are among them.

    ``score`` gives a matrix, items by queries, with -inf for pairs that are none; equal scores are in order of ``tie``.
    """
    schema = T.StructType([T.StructField("query", queries.schema["query"].dataType), T.StructField("score", T.DoubleType()), *_fields(items.schema, [*carry, TIE])])

    def run(asked: Asked, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = _arrow(schema)
        best = _ranked(asked, batches, score, k, [*carry, TIE])
        if len(best):
            columns = [asked.ids.take(pa.array(best["q"].to_numpy(np.int64))), pa.array(best["score"].to_numpy(np.float64))]
            columns += [pa.array(best[n].tolist(), t) for n, t in zip([*carry, TIE], types[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], schema.names)

    return over_blocks(queries, items, run, schema, block)


def overlaps(queries: DataFrame, items: DataFrame, block: int, all_pairs: bool = False) -> DataFrame:
    """(query, item, overlap) of each query with each item of (item, tokens) that has a word of it, or with all items."""
    schema = T.StructType([T.StructField("query", queries.schema["query"].dataType), T.StructField("item", items.schema["item"].dataType), T.StructField("overlap", T.DoubleType())])

    def run(asked: Asked, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = _arrow(schema)
        for batch in batches:
            for part in cut(batch, asked):
                share = asked.overlap(_lists(part.column("tokens")))
                item, q = np.nonzero(share >= 0 if all_pairs else share)
                for at in range(0, len(item), 100_000):
                    some = slice(at, at + 100_000)
                    columns = [asked.ids.take(pa.array(q[some])), part.column("item").take(pa.array(item[some])), pa.array(share[item[some], q[some]])]
                    yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], schema.names)

    return over_blocks(queries, items, run, schema, block)
