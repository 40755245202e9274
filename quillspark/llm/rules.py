"""Quality rules: an isolation forest on rule statistics.

Base statistics count words, code points in words, symbols, repeated lines and
words in repeated windows of whole texts.  Ratios of them go through isolation
trees, grown on a bounded sample of labelled good rows; a document's mean
path length over random splits says how anomalous it is.  The cut is calibrated
on all labelled rows that grew no tree, scored where they lie: it leaves at most ``good_loss`` of the good
ones and falls no lower than the bad ones need.

Defined cases: null text is an empty text; texts of any length are counted whole; a
text without words fails the base rule; a score equal to the cut is rejected; rows that
repeat are judged alike; of a labelled id with several rows one counts for the trees; an empty table gives no rows; without
usable labels only the base rule decides.  Only doc_id, text and the labels are
read; ``passing`` returns every column as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import common

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts that only the trees see.
EXTRA = ("n_upper", "n_letters", "n_marks", "n_lines", "n_same_next", "n_distinct")
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "!?;:_~^=+@{}[]\\/\"'`"]] = True
_CONTINUED = np.zeros(256, dtype=bool)
_CONTINUED[0x80:0xC0] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of COUNTS and EXTRA for each text."""
    texts = len(offsets) - 1
    starts, ends, doc = common.words(data, offsets)
    n_words = np.bincount(doc, minlength=texts)
    spaced = np.zeros(256, dtype=bool)
    spaced[[0x20, *range(0x09, 0x0E)]] = True
    word_chars = _per_text(~spaced[data] & ~_CONTINUED[data], offsets)
    hashes = common.word_hashes(data, starts, ends, lower=False)
    repeated, same_next, distinct = np.zeros((3, texts), dtype=np.int64)
    if len(hashes):
        same_next = np.bincount(doc[1:][(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=texts)
        order = np.lexsort((hashes, doc))
        new = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])])
        distinct = np.bincount(doc[order][new], minlength=texts)
    if len(hashes) > 2:
        with np.errstate(over="ignore"):
            three = common.mix(hashes[:-2] * np.uint64(0x9FB21C651E98DF25) + common.mix(hashes[1:-1] * np.uint64(0xD6E8FEB86659FD93) + common.mix(hashes[2:])))
        at = np.flatnonzero(doc[:-2] == doc[2:])
        three = three[at]
        order = np.lexsort((three, doc[at]))
        h, d = three[order], doc[at][order]
        twin = np.zeros(len(h) + 1, dtype=bool)
        twin[1:-1] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
        hit = at[order[twin[1:] | twin[:-1]]]
        marked = np.zeros(len(hashes), dtype=bool)
        for j in range(3):
            marked[hit + j] = True
        repeated = np.bincount(doc[marked], minlength=texts)
    raw, dup, lines = data.tobytes(), np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    for i in range(texts):
        own = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        lines[i], dup[i] = len(own), len(own) - len(set(own))
    letters = _LETTER[data]
    return np.column_stack(
        [n_words, word_chars, _per_text(_SYMBOLS[data], offsets), dup, repeated, _per_text(_UPPER[data], offsets), _per_text(letters, offsets), _per_text(_MARK[data], offsets), lines, same_next, distinct]
    ).astype(np.int64)


def ratios(counts: np.ndarray) -> np.ndarray:
    """What the trees split on: ratios, so that a long clean text is like a short one."""
    n_words, chars, symbols, dup, repeat, upper, letters, marks, lines, same, distinct = counts.astype(float).T
    w, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    # distinct words fall as a power of the length (Heaps), repeats rise with it
    return np.column_stack([chars / w, symbols / w, dup / np.maximum(lines, 1), repeat / w, upper / np.maximum(letters, 1), marks / w, same / w, np.log(np.maximum(distinct, 1)) / np.log(w + 1), letters / c])


def grow_forest(rows: np.ndarray, trees: int = 200, sample: int = 256, margin: float = 0.5, seed: int = 5) -> dict[str, np.ndarray]:
    """Isolation trees as arrays: (tree, node) of feature, cut and, at leaves, path length.

    A split takes any feature alike, at a uniform place in the node's own range
    widened by ``margin`` of the whole range.  So a statistic that never varies
    among the good rows still parts those rows that have another value.
    """
    rng = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(max(2, min(sample, len(rows))))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int32)
    cut, path = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    low, high = rows.min(axis=0), rows.max(axis=0)
    scale = np.where(high > low, high - low, 1.0)
    for t in range(trees):
        own = rows[rng.choice(len(rows), min(sample, len(rows)), replace=False)]
        todo = [(0, 0, own)]
        while todo:
            at, level, x = todo.pop()
            span = (x.max(axis=0) - x.min(axis=0)) if len(x) else np.zeros(rows.shape[1])
            if level == depth or len(x) <= 1 or not span.any():
                path[t, at] = level + _mean_path(len(x))
                continue
            f = int(rng.integers(rows.shape[1]))
            a, b = x[:, f].min() - margin * scale[f], x[:, f].max() + margin * scale[f]
            feature[t, at], cut[t, at] = f, rng.uniform(a, b)
            left = x[:, f] < cut[t, at]
            todo += [(2 * at + 1, level + 1, x[left]), (2 * at + 2, level + 1, x[~left])]
    return {"feature": feature, "cut": cut, "path": path, "norm": np.array([_mean_path(min(sample, len(rows)))])}


def _mean_path(n: int) -> float:
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def anomaly(forest: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """2 ** (- mean path / expected path) of each row, all rows of a tree at once."""
    total = np.zeros(len(rows))
    for feature, cut, path in zip(forest["feature"], forest["cut"], forest["path"], strict=True):
        at = np.zeros(len(rows), np.int64)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            go = rows[np.arange(len(rows)), np.maximum(f, 0)] >= cut[at]
            at = np.where(inner, 2 * at + 1 + go, at)
        total += path[at]
    return 2.0 ** (-(total / len(forest["path"])) / max(forest["norm"][0], 1e-9))


def calibrated(good: np.ndarray, bad: np.ndarray, good_loss: float) -> float:
    """Least score to reject: above all but ``good_loss`` of the good, midway to the bad above it."""
    if not len(good):
        return 2.0
    edge = float(np.quantile(good, 1 - good_loss))
    above = bad[bad > edge]
    return (edge + float(np.quantile(above, 0.02))) / 2 if len(above) else edge + 1e-9


def _ranked(scores: DataFrame, rank: int, bins: int = 4096, few: int = 10_000) -> float:
    """The score at ``rank`` from 0, by histograms that narrow down to ``few`` rows."""
    while True:
        least, most, n = scores.agg(F.min("score"), F.max("score"), F.count(F.lit(1))).first()
        if least == most:
            return least
        if n <= few:
            return scores.orderBy("score").select("score").collect()[rank][0]
        bin_of = F.least(F.lit(bins - 1), F.floor((F.col("score") - least) / (most - least) * bins))
        counts = sorted((r["bin"], r["count"]) for r in scores.groupBy(bin_of.alias("bin")).count().collect())
        for at, count in counts:
            if rank < count:
                break
            rank -= count
        scores = scores.where(bin_of == at)


def _quantile(scores: DataFrame, q: float, n: int) -> float:
    """``np.quantile`` of the ``n`` scores."""
    at = (n - 1) * q
    a, b = int(np.floor(at)), int(np.ceil(at))
    x, y = _ranked(scores, a), _ranked(scores, b)
    return x + (y - x) * (at - a)


def calibrated_over(scores: DataFrame, good_loss: float) -> float:
    """``calibrated`` over a table of (score, good)."""
    good, bad = scores.where("good"), scores.where("not good")
    n = good.count()
    if not n:
        return 2.0
    edge = _quantile(good, 1 - good_loss, n)
    above = bad.where(F.col("score") > edge)
    n = above.count()
    return (edge + _quantile(above, 0.02, n)) / 2 if n else edge + 1e-9


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, EXTRA) of each row of ``docs`` (doc_id, text)."""
    names = [*COUNTS, *EXTRA]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data, offsets in common.text_chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *map(pa.array, text_counts(data, offsets).T)], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(common.tidy(run), f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names))


def _labels(labels: DataFrame) -> DataFrame:
    return labels.groupBy(F.col("doc_id").alias("of")).agg(F.max("quality").alias("quality")).where("of is not null and quality is not null")


def labelled_counts(docs: DataFrame, labels: DataFrame, rows: int) -> pd.DataFrame:
    """Counts and label of at most ``rows`` labelled documents, the first by hash of their ids."""
    picked = _labels(labels).orderBy(F.xxhash64("of"), "of").limit(rows)
    # the limited side is small by that bound
    every = counted(docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("of"), "left_semi")).join(F.broadcast(picked), F.col("doc_id") == F.col("of")).drop("of")
    # one row to an id, so that the bound holds where ids repeat
    names = [c for c in every.columns if c != "doc_id"]
    return every.groupBy("doc_id").agg(F.min(F.struct(*names)).alias("s")).select("doc_id", "s.*").toPandas()


def _scored(docs: DataFrame, forest: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, score) of the rows of ``docs`` that pass the base rule."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for chunk, data, offsets in common.text_chunks(batch, "text"):
                failed, score, _ = _judge(text_counts(data, offsets), forest, 2.0)
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id").filter(pa.array(~failed)), pa.array(score[~failed])], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(common.tidy(run), f"doc_id {kind}, score double")


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = 4000, good_loss: float = 0.001, trees: int = 200, seed: int = 5, most_broadcast: int = 500_000) -> tuple[dict[str, np.ndarray] | None, float]:
    """A forest from at most ``rows`` labelled rows, and its cut from all others; (None, 2.0) without good ones.

    Up to ``most_broadcast`` labels go to the texts, beyond that both are joined by a shuffle.
    """
    seen = labelled_counts(docs, labels, rows).sort_values(["doc_id", *COUNTS])
    counts = seen[[*COUNTS, *EXTRA]].to_numpy(np.int64)
    able = ~base_failed(counts)
    x, good = ratios(counts)[able], (seen["quality"].to_numpy() == 1)[able]
    if good.sum() < 8:
        return None, 2.0
    own = x[good]
    forest = grow_forest(own[::2], trees=trees, seed=seed)
    grew = seen["doc_id"].to_numpy()[able][good][::2].tolist()
    # at most half of ``rows``
    spent = docs.sparkSession.createDataFrame([(v,) for v in grew], f"spent {labels.schema['doc_id'].dataType.simpleString()}").distinct()
    held = common.checkpointed(_labels(labels).join(F.broadcast(spent), F.col("of") == F.col("spent"), "left_anti"), 0)
    # only labelled texts are scored here
    held = F.broadcast(held) if held.count() <= most_broadcast else held
    some = docs.select("doc_id", "text").join(held.select("of"), F.col("doc_id") == F.col("of"), "left_semi")
    scores = _scored(some, forest).join(held, F.col("doc_id") == F.col("of")).select("score", (F.col("quality") == 1).alias("good"))
    return forest, calibrated_over(common.checkpointed(scores), good_loss)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])


def _judge(counts: np.ndarray, forest, cut: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    failed = base_failed(counts)
    score = anomaly(forest, ratios(counts)) if forest is not None and len(counts) else np.zeros(len(counts))
    return failed, score, ~failed & (score < cut)


def judged(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """(doc_id, COUNTS, base_failed, kept, anomaly) of each row of ``docs``."""
    forest, cut = fit_rules(docs, labels, **fit)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for chunk, data, offsets in common.text_chunks(batch, "text"):
                counts = text_counts(data, offsets)
                failed, score, kept = _judge(counts, forest, cut)
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *map(pa.array, [*counts.T[: len(COUNTS)], failed, kept, score])], ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"
    return docs.select("doc_id", "text").mapInArrow(common.tidy(run), schema)


def passing(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    forest, cut = fit_rules(docs, labels, **fit)

    def run(batches):
        for batch in batches:
            for chunk, data, offsets in common.text_chunks(batch, "text"):
                yield chunk.filter(pa.array(_judge(text_counts(data, offsets), forest, cut)[2]))

    return docs.mapInArrow(common.tidy(run), docs.schema)
