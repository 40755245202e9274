"""Pieces shared by the training-data operators.

Text is cut into words by the byte class ``[^\\x20\\x09-\\x0D]+``; every byte of a
multi-byte UTF-8 character is outside that class, so cutting bytes and cutting
characters give the same words.
"""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java character class of one word.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of text that the vectorised code works on at once.
CHUNK_BYTES = 2_000_000

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_PLAIN = np.arange(256, dtype=np.uint8)
_LOWER = _PLAIN.copy()
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def checkpointed(df: DataFrame, rows: int | None = None, per_file: int = 250_000) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``; a temporary one is
    set only where the session names none, as in local tests.  ``rows``, where
    about known, sets the number of files, so that small tables in many shuffle
    partitions don't become many tiny files.
    """
    shared_folder(df.sparkSession)
    return (df if rows is None else df.coalesce(1 + rows // per_file)).checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's, else a temporary one for local runs."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        named = tempfile.mkdtemp(prefix="quillspark-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediate data in whatever store its scheme names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as ``df`` has a column of that name."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(text: Column) -> Column:
    """Number of words of a text, null counting as empty, inside the JVM."""
    gaps = F.size(F.split(text, GAP))
    edges = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    return F.when(text.isNull() | ~text.rlike(WORD), F.lit(0)).otherwise(gaps - edges).cast("long")


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that copies of its texts stay small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def text_chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with their text as (slice, bytes, offsets); null text is empty."""
    for part in slices(batch):
        texts = part.column(column).cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield part.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def release() -> None:
    """Gives memory that this worker no longer uses back to the machine; workers live for many tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def tidy(f: Callable) -> Callable:
    """``f`` over batches, with ``release`` at its end."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            release()

    return run


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words and the text that each belongs to."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~_WS[data]
    first = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    before[first] = False
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    after[first[first > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word's bytes, A-Z as a-z if ``lower``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(sizes.max()) - 1, _BASE, np.uint64)]), dtype=np.uint64)
        values = _TABLE[(_LOWER if lower else _PLAIN)[data[np.repeat(starts, sizes) + within]]] * powers[within]
        sums = np.add.reduceat(values, np.cumsum(sizes) - sizes)
        return mix(sums + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes under zstandard: planes of high bytes cost nothing."""
    v = np.ascontiguousarray(values, dtype="<i8")
    return zstandard.ZstdCompressor(level=1).compress(v.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").reshape(-1)


def components(edges: DataFrame, rows: int, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): component is its smallest reachable node.

    Alternating large-star and small-star rounds on minima: each round is
    aggregations with map-side combining and equi-joins whose hot keys adaptive
    execution can split; nothing is gathered on the driver but a row count and
    a checksum.  An edge with a null end is no edge; no edges give no rows.
    ``rows`` is about the number of nodes, for the number of files.
    """
    now = checkpointed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows)
    seen = None
    for _ in range(rounds):
        check = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if check[0] == 0 or tuple(check) == seen:
            break
        seen = tuple(check)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        now = checkpointed(
            large.join(small, F.col("u") == F.col("k"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .union(small.select("k", "m"))
            .distinct(),
            check[0],
        )
    else:
        raise RuntimeError("connected components did not settle")
    each = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")), F.struct(F.col("v").alias("node"), F.col("v").alias("component")))
    return now.select(F.explode(each).alias("x")).select("x.*").distinct()
