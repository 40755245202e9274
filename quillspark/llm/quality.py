"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every text is summarised by counts and ratios of its bytes and words; source,
language, id and labels are no inputs.  Trees grow level by level on binned
statistics of a bounded sample of labelled rows, and are flattened into arrays
(tree x node) that numpy walks for all rows of a batch at once.

Defined cases: null text is an empty text and gets a score like any other; texts of
any length are counted whole; a score equal to the threshold predicts 1; rows with
the same text get the same score; of a labelled id with several rows one is learnt; labels without a match are unused,
a document labelled twice counts by its larger label; without two classes of
labels the score is the share of good labels (0.5 without any); an empty table
gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import common, rules

_CLASSES = {"bang": b"!", "pipe": b"|", "hash": b"#", "dollar": b"$", "percent": b"%", "amp": b"&", "star": b"*", "digit": b"0123456789", "newline": b"\n", "stop": b".", "comma": b",", "angle": b"<>", "bracket": b"{}[]()"}


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics for each text."""
    counts = rules.text_counts(data, offsets)
    chars = np.maximum(counts[:, 1], 1).astype(float)
    kinds = []
    for members in _CLASSES.values():
        flag = np.zeros(256, dtype=bool)
        flag[list(members)] = True
        kinds.append(rules._per_text(flag[data], offsets) / chars)
    return np.column_stack([rules.ratios(counts), np.log1p(counts), *kinds])


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 10, shrink: float = 1.0) -> dict[str, np.ndarray]:
    """Boosted trees on the logistic loss, flattened: children of node i are 2i + 1 and 2i + 2."""
    share = float(y.mean()) if len(y) else 0.5
    nodes = 2 ** (depth + 1) - 1
    out = {"feature": np.full((trees, nodes), -1, np.int32), "cut": np.zeros((trees, nodes)), "value": np.zeros((trees, nodes)), "base": np.array([share])}
    if not len(y) or share in (0.0, 1.0):
        return out
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    width, n_features = bins + 1, x.shape[1]
    flat = binned + np.arange(n_features) * width
    margin = np.full(len(y), np.log(share / (1 - share)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-12)
        at = np.zeros(len(y), np.int64)
        done = np.zeros(len(y), dtype=bool)
        for level in range(depth + 1):
            first, count = 2**level - 1, 2**level
            local = at - first
            gs, hs = (np.bincount(local[~done], w[~done], count) for w in (g, h))
            out["value"][t, first : first + count] = -rate * gs / (hs + shrink)
            if level == depth or done.all():
                break
            key = (local[~done, None] * (n_features * width) + flat[~done]).ravel()
            shape = (count, n_features, width)
            hist = [np.bincount(key, np.repeat(w, n_features), int(np.prod(shape))).reshape(shape).cumsum(axis=2) for w in (g[~done], h[~done], np.ones((~done).sum()))]
            gl, hl, nl = hist
            gt, ht, nt = (v[:, :, -1:] for v in hist)
            gain = gl**2 / (hl + shrink) + (gt - gl) ** 2 / (ht - hl + shrink) - gt**2 / (ht + shrink)
            gain[(nl < least) | (nt - nl < least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            f, b = best // width, best % width
            split = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            for i in np.flatnonzero(split):
                out["feature"][t, first + i], out["cut"][t, first + i] = f[i], edges[f[i]][b[i]]
            done |= ~done & ~split[np.clip(local, 0, count - 1)]
            go = ~done
            at[go] = 2 * at[go] + 1 + (binned[go, f[local[go]]] > b[local[go]])
        margin += walk(out, x, t)
    return out


def walk(model: dict[str, np.ndarray], x: np.ndarray, t: int) -> np.ndarray:
    feature, cut = model["feature"][t], model["cut"][t]
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(int(np.log2(len(feature) + 1))):
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            break
        at = np.where(inner, 2 * at + 1 + (x[rows, np.maximum(f, 0)] > cut[at]), at)
    return model["value"][t][at]


def score(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    base = float(model["base"][0])
    if base in (0.0, 1.0) or not (model["feature"] >= 0).any():
        return np.full(len(x), base)
    margin = np.full(len(x), np.log(base / (1 - base)))
    for t in range(len(model["feature"])):
        margin += walk(model, x, t)
    return 1 / (1 + np.exp(-margin))


def _featured(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data, offsets in common.text_chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(list(features(data, offsets)), pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(common.tidy(run), f"doc_id {kind}, x array<double>")


def held_out(doc_id, folds: int = 5):
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = 12_000, **grown) -> dict[str, np.ndarray]:
    """A model from at most ``rows`` labelled documents outside the held-out fold, the first by hash of their ids."""
    own = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("of")).agg(F.max("quality").alias("quality"))
    picked = F.broadcast(own.orderBy(F.xxhash64("of"), "of").limit(rows))
    seen = _featured(docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("of"), "left_semi")).join(picked, F.col("doc_id") == F.col("of"))
    # one row to an id, so that the bound holds where ids repeat
    seen = seen.groupBy("doc_id").agg(F.min("x").alias("x"), F.max("quality").alias("quality")).toPandas()
    if not len(seen):
        return grow(np.zeros((0, 1)), np.zeros(0), **grown)
    x = np.array(seen["x"].tolist(), dtype=float)
    order = np.lexsort((*x.T[:4], seen["doc_id"].to_numpy()))
    return grow(x[order], (seen["quality"].to_numpy()[order] == 1).astype(float), **grown)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fit) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    model = fit_quality(docs, labels, **fit)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data, offsets in common.text_chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(score(model, features(data, offsets)))], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(common.tidy(run), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
