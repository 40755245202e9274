"""Packing into optimal length buckets, over one small histogram.

Lengths fall into a fixed grid: every length up to 512 and 128 steps per
doubling beyond, so the histogram of any corpus has a bounded number of rows.
Dynamic programming over it chooses at most ``buckets`` boundaries with the
least padding, counting a document as padded to its bucket's longest document.
A length is what the tokenizer makes of a text, with its end id, or its words
without one.  Inside a bucket, batches take as many documents as fit ``budget`` tokens at
the padded length.  Buckets are dealt to shards of about ``shard_rows``
documents by hash, so no task ranks a whole hot bucket; each shard's last batch
may be short.

Defined cases: null or empty text has the end id alone, or length 0 in words; texts of
any length are measured whole; a document longer than the
budget is a batch of its own; ties in length are broken by hash of id and text,
and rows that repeat are interchangeable; an empty table gives no rows; other
columns pass unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm import common
from quillspark.llm.token_store import Encoder

_EXACT, _STEPS = 512, 128


def grid(length: Column) -> Column:
    """Number of a length's place in the grid, rising with it."""
    log = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double") / _EXACT) * _STEPS)
    return F.when(length <= _EXACT, length).otherwise(_EXACT + 1 + log).cast("long")


def boundaries(top: np.ndarray, count: np.ndarray, total: np.ndarray, buckets: int) -> list[int]:
    """Ends (positions) of the buckets with the least padding, by dynamic programming.

    ``top``: longest document of each place, rising; ``count`` and ``total``: its
    documents and their summed length.  Fewer buckets win a tie.
    """
    n = len(top)
    if not n:
        return []
    counts, totals = (np.concatenate([[0.0], np.cumsum(v, dtype=float)]) for v in (count, total))
    i = np.arange(n)
    # cost[a, b]: padding of places a..b as one bucket
    cost = np.where(i[:, None] <= i[None, :], top[None, :] * (counts[1:][None, :] - counts[:-1][:, None]) - (totals[1:][None, :] - totals[:-1][:, None]), np.inf)
    best, back = cost[0].copy(), [np.zeros(n, np.int64)]
    ends = [best[-1]]
    layers = [best]
    for _ in range(1, min(buckets, n)):
        shifted = np.concatenate([[np.inf], layers[-1][:-1]])
        through = shifted[:, None] + cost
        back.append(through.argmin(axis=0))
        layers.append(through.min(axis=0))
        ends.append(layers[-1][-1])
    k, at, out = int(np.argmin(ends)), n - 1, []
    while True:
        out.append(at)
        if k == 0:
            return out[::-1]
        at, k = int(back[k][at]) - 1, k - 1


def histogram(sized: DataFrame) -> list:
    return sized.groupBy(grid(F.col("length")).alias("place")).agg(F.max("length").alias("top"), F.count(F.lit(1)).alias("count"), F.sum("length").alias("total")).orderBy("place").collect()


def token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, length, tie) of each row: ids of its text by a tokenizer file, the end id among them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = Encoder.of(path)
        try:
            for batch in batches:
                for chunk, data, offsets in common.text_chunks(batch, "text"):
                    _, counts = encoder.encode(data, offsets)
                    yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(counts + 1), chunk.column("tie")], ["doc_id", "length", "tie"])
        finally:
            # a worker lives on for other stages
            encoder.forget()

    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("tie")).mapInArrow(common.tidy(run), f"doc_id {kind}, length long, tie long")


def packed(docs: DataFrame, tokenizer: str | None = None, buckets: int = 16, budget: int = 65_536, shard_rows: int = 20_000) -> DataFrame:
    """(doc_id, length, bucket, bucket_length, batch_id, position) of each row of ``docs`` (doc_id, text)."""
    if tokenizer is None:
        sized = docs.select("doc_id", common.word_count(F.col("text")).alias("length"), F.xxhash64("doc_id", "text").alias("tie"))
    else:
        sized = token_lengths(docs, tokenizer)
    sized = common.checkpointed(sized)
    rows = histogram(sized)
    top, count, total = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("top", "count", "total"))
    places = np.array([r["place"] for r in rows], dtype=np.int64)
    bucket, longest, shards = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("int")
    first = 0
    ends = boundaries(top, count, total, buckets)
    for b, end in reversed(list(enumerate(ends))):
        first = ends[b - 1] + 1 if b else 0
        here = F.col("place") <= int(places[end])
        # numbered from the last: each shorter bucket's test goes first
        bucket = F.when(here, F.lit(b)).otherwise(bucket)
        longest = F.when(here, F.lit(int(top[end]))).otherwise(longest)
        shards = F.when(here, F.lit(int(-(-count[first : end + 1].sum() // shard_rows)))).otherwise(shards)
    put = sized.withColumn("place", grid(F.col("length"))).withColumn("bucket", bucket.cast("int")).withColumn("bucket_length", longest.cast("long"))
    put = put.withColumn("shard", F.pmod(F.xxhash64("tie", F.lit("shard")), shards).cast("long"))
    fits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1)))).cast("long")
    at = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("length", "tie", "doc_id")) - 1
    out = put.withColumn("at", at)
    batch = F.concat_ws("-", "bucket", "shard", F.floor(F.col("at") / fits).cast("long"))
    return out.select("doc_id", "length", "bucket", "bucket_length", batch.alias("batch_id"), (F.col("at") % fits).cast("long").alias("position"))
