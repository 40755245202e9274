"""Embedding near-duplicates by lattice hashing.

A unit vector is projected at random to several blocks of eight dimensions, and
each block is decoded to its nearest point of the E8 lattice; the points of a
table's blocks make its cell.  A vector is filed in its own cell of every table
and probes the cells next to it: those where one block moves to its second
nearest lattice point.  Vectors that meet in a cell are compared by cosine in
double precision, and a pair counts in the first table where it meets.

Equal vectors are one entry with a weight.  Cells over ``cell_rows`` entries are
dealt as pairs of sub-blocks, so no task holds more than two of them, and
tasks return counts and a spanning set of links, never all pairs.

Defined cases: vectors that are null, of zero norm, or hold null, NaN or
infinite components link with nothing and are their own component; vectors of
different lengths never link; a cosine equal to the threshold links; an id names one
vector: rows that repeat it count once, with the vector of the smallest digest; a
null id comes back as its own row with a null component; labels and other
columns are not read; an empty table gives no rows.  Every vector is indexed: nothing is fitted or sampled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import common


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8 (integer points with an even sum) to each row."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8, the union of D8 and D8 + 1/2, to each row, in halves."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], 2 * a, 2 * b).astype(np.int64)


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8, from their rule."""
    axes = np.eye(8)
    pairs = [s * axes[i] + t * axes[j] for i in range(8) for j in range(i) for s in (1, -1) for t in (1, -1)]
    halves = [v for bits in range(256) if (v := np.array([0.5 if bits >> i & 1 else -0.5 for i in range(8)])).sum() % 2 == 0]
    return np.array(pairs + halves)


ROOTS = _roots()


def neighbours(x: np.ndarray, home: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` lattice points nearest to each row after its own, and how much farther they are."""
    off = x - home / 2
    # |off - r|^2 - |off|^2 = |r|^2 - 2 off.r, and |r|^2 = 2
    more = 2.0 - 2.0 * off @ ROOTS.T
    best = np.argpartition(more, count, axis=1)[:, :count]
    return home[:, None, :] + (2 * ROOTS).astype(np.int64)[best], np.take_along_axis(more, best, axis=1)


@lru_cache(maxsize=16)
def _projections(tables: int, blocks: int, dim: int, seed: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Weights of the keys, and basis and shift of each table."""
    rng = np.random.default_rng([seed, dim])
    weigh = rng.integers(1, 2**62, (tables, blocks, 8), dtype=np.int64) * 2 + 1
    return weigh, [(np.linalg.qr(rng.standard_normal((max(dim, 8 * blocks), 8 * blocks)))[0][:dim], rng.uniform(0, 1, 8 * blocks)) for _ in range(tables)]


def cells(unit: np.ndarray, tables: int, blocks: int, probes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each vector's own cells (n, tables) and of those it probes (n, tables, probes)."""
    n, dim = unit.shape
    home = np.zeros((n, tables), np.int64)
    near = np.zeros((n, tables, probes), np.int64)
    weigh, projections = _projections(tables, blocks, dim, seed)
    for t, (basis, shift) in enumerate(projections):
        at = unit @ basis * (np.sqrt(dim) / width) + shift
        points = [at[:, 8 * b : 8 * b + 8] for b in range(blocks)]
        found = [nearest_e8(p) for p in points]
        with np.errstate(over="ignore"):
            part = [(f * weigh[t, b]).sum(axis=1) for b, f in enumerate(found)]
            home[:, t] = sum(part)
            if probes:
                moves = [neighbours(p, f, min(probes, 239)) for p, f in zip(points, found, strict=True)]
                keys = np.concatenate([(m[0] * weigh[t, b]).sum(axis=2) - part[b][:, None] + home[:, t][:, None] for b, m in enumerate(moves)], axis=1)
                far = np.concatenate([m[1] for m in moves], axis=1)
                near[:, t] = np.take_along_axis(keys, np.argsort(far, axis=1, kind="stable")[:, :probes], axis=1)
    return home, near


def _filed(batches: Iterator[pa.RecordBatch], kind: str, how: tuple) -> Iterator[pa.RecordBatch]:
    """(t, cell, dim, home, id) of every cell that a vector lives in or probes."""
    tables = how[0]
    for batch in batches:
        ids = batch.column("id").to_numpy()
        vectors = [np.frombuffer(v, kind) for v in batch.column("v").to_pylist()]
        dims = np.array([len(v) for v in vectors])
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            for a in range(0, len(own), 2000):
                part = own[a : a + 2000]
                home, near = cells(_unit([vectors[i] for i in part]), *how)
                every = np.concatenate([home[:, :, None], near], axis=2)
                n, width = len(part), every.shape[2]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), width), n)),
                        pa.array(every.ravel()),
                        pa.array(np.full(every.size, dim, np.int32)),
                        pa.array(np.tile(np.arange(width) == 0, n * tables)),
                        pa.array(np.repeat(ids[part], tables * width)),
                    ],
                    ["t", "cell", "dim", "home", "id"],
                )


def _unit(vectors: list[np.ndarray] | np.ndarray) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _near(unit: np.ndarray, raw: np.ndarray, rows: np.ndarray, here: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``rows`` and ``here`` with at least this cosine.

    Products of rounded unit vectors decide but for those next to the threshold, where
    the product of the vectors themselves over the root of their squares does.
    """
    like = unit[rows] @ unit[here].T
    r, c = np.nonzero(like >= cosine - 1e-9)
    edge = np.flatnonzero(like[r, c] <= cosine + 1e-9)
    keep = np.ones(len(r), bool)
    for a in range(0, len(edge), 20_000):
        part = edge[a : a + 20_000]
        x, y = raw[rows[r[part]]], raw[here[c[part]]]
        keep[part] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1)) >= cosine
    return rows[r[keep]], here[c[keep]]


class _Cell:
    """The entries of one cell, or of two of its sub-blocks."""

    def __init__(self, t: int, pdf: pd.DataFrame, cosine: float, kind: str, across: bool) -> None:
        self.t, self.cosine, self.across = t, cosine, across
        self.home, self.ids = pdf["home"].to_numpy(bool), pdf["id"].to_numpy(np.int64)
        self.weight, self.sub = pdf["weight"].to_numpy(np.int64), pdf["sub"].to_numpy()
        self.raw = np.array([np.frombuffer(v, kind) for v in pdf["v"]], dtype=np.float64)
        self.unit, self.here = _unit(self.raw), np.flatnonzero(self.home)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs, a few hundred rows at a time: of two residents once, a prober and a resident as they stand."""
        for a in range(0, len(self.ids), 512):
            r, c = _near(self.unit, self.raw, np.arange(a, min(a + 512, len(self.ids))), self.here, self.cosine)
            ok = (self.ids[r] != self.ids[c]) & (~self.home[r] | (self.ids[r] < self.ids[c]))
            if self.across:
                ok &= self.sub[r] != self.sub[c]
            yield r[ok], c[ok]

    def used(self) -> np.ndarray:
        """Entries that have a near one."""
        out = np.zeros(len(self.ids), bool)
        for r, c in self.pairs():
            out[r] = out[c] = True
        return np.flatnonzero(out)

    def links(self, keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Links counted here of each entry, and links that span them; ``keys`` of the entries that are used."""
        t, ids, n = self.t, self.ids, len(self.ids)
        counts, group, links = np.zeros(n), np.arange(n), []
        for r, c in self.pairs():
            for e in range(0, len(r), 20_000):
                i, j = r[e : e + 20_000], c[e : e + 20_000]
                ki, kj = keys[i, : t + 1], keys[j, : t + 1]
                # met in table s: one probes or lives where the other lives
                meets = ((ki == kj[:, :, :1]) | (kj == ki[:, :, :1])).any(axis=2)
                first = ~meets[:, :t].any(axis=1)
                # within this table a pair may meet in both home cells; it counts in the one of the smaller id's home
                less = ids[i] < ids[j]
                lived, other = np.where(less, ki[:, t, 0], kj[:, t, 0]), np.where(less, kj[:, t, 0], ki[:, t, 0])
                cell = kj[:, t, 0]
                small_probed = (np.where(less[:, None], kj[:, t], ki[:, t]) == lived[:, None]).any(axis=1)
                first &= (cell == lived) | (~small_probed & (cell == other))
                i, j = i[first], j[first]
                for k, o in ((i, j), (j, i)):
                    counts += np.bincount(k, self.weight[o], n)
                links += [(int(ids[i[x]]), int(ids[j[x]])) for x in _joining(group, i, j)]
        return counts, links


def _keys(own: list[tuple[_Cell, np.ndarray]], how: tuple) -> Iterator[np.ndarray]:
    """Keys of the used entries of each cell; those of several cells are made together, an id's once."""
    ids = np.concatenate([c.ids[u] for c, u in own])
    units = np.concatenate([c.unit[u] for c, u in own])
    every, first, back = np.unique(ids, return_index=True, return_inverse=True)
    made = np.empty((len(every), how[0], 1 + how[2]), np.int64)
    for a in range(0, len(every), 2000):
        home, near = cells(units[first[a : a + 2000]], *how)
        made[a : a + 2000, :, 0], made[a : a + 2000, :, 1:] = home, near
    at = 0
    for c, u in own:
        keys = np.zeros((len(c.ids), how[0], 1 + how[2]), np.int64)
        keys[u] = made[back[at : at + len(u)]]
        at += len(u)
        yield keys


def _joining(group: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Places of the pairs that join two groups; ``group`` then has the joined ones.

    Only one pair of each two groups is looked at singly, so pairs inside a group cost a comparison.
    """
    low, high = np.minimum(group[i], group[j]), np.maximum(group[i], group[j])
    apart = np.flatnonzero(low != high)
    if not len(apart):
        return []
    _, first = np.unique(low[apart] * len(group) + high[apart], return_index=True)
    up = np.arange(len(group))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for x in apart[first].tolist():
        p, q = top(low[x]), top(high[x])
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append(x)
    while (up[up] != up).any():
        up = up[up]
    group[:] = up[group]
    return out


def _cell_links(key, pdf: pd.DataFrame, cosine: float, kind: str, how: tuple) -> pd.DataFrame:
    """Rows (id, n, null) of counts and (u, null, v) of links, over the cells of one group."""
    out: list[tuple[int, int, int, bool]] = []
    held: dict[int, list[tuple[_Cell, np.ndarray]]] = {}
    size = 0

    def settle() -> None:
        for own in held.values():
            for (cell, _), keys in zip(own, _keys(own, how), strict=True):
                counts, links = cell.links(keys)
                some = np.flatnonzero(counts)
                out.extend((i, n, 0, False) for i, n in zip(cell.ids[some].tolist(), counts[some].astype(np.int64).tolist(), strict=True))
                out.extend((u, 0, v, True) for u, v in links)
        held.clear()

    for (t, _, dim), own in pdf.groupby(["t", "cell", "dim"], sort=True):
        if len(own) < 2 or not own["home"].any():
            continue
        cell = _Cell(int(t), own, cosine, kind, key[1] != key[2])
        if len(used := cell.used()):
            held.setdefault(int(dim), []).append((cell, used))
            size += len(used)
        # so many entries' keys are held at once
        if size >= 8192:
            settle()
            size = 0
    settle()
    return pd.DataFrame(out, columns=["id", "n", "v", "link"]).astype({"id": "int64", "n": "int64", "v": "int64", "link": "bool"})


#: (tables, blocks, width), one grid for tables of every size.  Measured on pairs at cosine 0.9 in 64
#: dimensions with three probes: recall 0.98, and unlike vectors meet with probability 4e-5.
GRID = (20, 3, 2.4)


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, grid: tuple[int, int, float] = GRID, probes: int = 3, cell_rows: int = 4096, seed: int = 11
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    parts = common.shuffle_partitions(spark)
    e = F.transform("embedding", lambda c: c.cast("double"))
    fit = F.col("embedding").isNotNull() & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(e, lambda c: c != 0.0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fit, e).alias("e"))
    usable = rows.where("e is not null and vec_id is not null")

    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"

    def shaped(batches):
        for b in batches:
            flat = [np.array(v, dtype="<f8") for v in b.column("e").to_pylist()]
            # a common power of two keeps squares finite and changes no cosine; -0.0 and 0.0 are one value
            flat = [(v / 2.0 ** np.floor(np.log2(np.abs(v).max())) + 0.0).astype(kind).tobytes() for v in flat]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([hashlib.blake2b(v, digest_size=16).digest() for v in flat], pa.binary()), pa.array(flat, pa.binary())], ["vec_id", "h", "v"])

    named = usable.mapInArrow(common.tidy(shaped), "vec_id long, h binary, v binary")
    entered = common.checkpointed(named.groupBy("vec_id").agg(F.min(F.struct("h", "v")).alias("s")).select("vec_id", "s.h", "s.v"))
    heads = entered.groupBy("h").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    entries = common.checkpointed(heads.join(entered.select(F.col("vec_id").alias("id"), "v"), "id").select("id", "weight", "v"))
    n = entries.count()
    tables, blocks, width = grid
    how = (tables, blocks, probes, width, seed)
    spread = entries.select("id", "v").repartition(parts, "id")
    filed = common.checkpointed(spread.mapInArrow(common.tidy(lambda it: _filed(it, kind, how)), "t int, cell long, dim int, home boolean, id long"))
    sizes = filed.groupBy("t", "cell", "dim").agg(F.count(F.lit(1)).alias("rows"), F.max("home").alias("lived")).where("rows > 1 and lived").select("t", "cell", "dim", F.ceil(F.col("rows") / cell_rows).cast("int").alias("subs"))
    placed = (
        filed.join(sizes, ["t", "cell", "dim"])
        .withColumn("sub", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
        .withColumn("place", F.pmod(F.xxhash64("t", "cell", "dim"), F.when(F.col("subs") == 1, F.lit(8 * parts)).otherwise(F.lit(2**40))))
        .withColumn("i", F.least("sub", "other"))
        .withColumn("j", F.greatest("sub", "other"))
        .select("place", "i", "j", "sub", "t", "cell", "dim", "home", "id")
        .join(entries, "id")
    )
    met = common.checkpointed(placed.groupBy("place", "i", "j").applyInPandas(lambda key, pdf: _cell_links(key, pdf, cosine, kind, how), "id long, n long, v long, link boolean"))
    counts = met.where("not link").groupBy("id").agg(F.sum("n").alias("n"))
    comps = common.components(met.where("link").select(F.col("id").alias("u"), "v"), n)
    classes = heads.join(counts, "id", "left").join(comps, F.col("id") == F.col("node"), "left")
    classes = classes.select(F.col("h").alias("of"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linked = entered.join(classes, F.col("h") == F.col("of")).select("vec_id", "n_links", "component_id")
    every = rows.groupBy("vec_id").agg(F.lit(0).cast("long").alias("none"))
    out = every.join(linked.withColumnRenamed("vec_id", "of"), F.col("vec_id") == F.col("of"), "left")
    return out.select(
        "vec_id", F.coalesce("n_links", "none").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept")
    )
