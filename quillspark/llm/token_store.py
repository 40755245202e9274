"""Token ids as binary shards with one zstandard dictionary.

Texts are cut at single spaces between visible characters, where the
tokenizer's own pattern always cuts, and each distinct piece is encoded once per
worker by the tokenizers library; a bounded table holds what is known, and what
it says is believed only after the bytes were compared.  Texts that hold the
string of an added token are given to the tokenizer whole.  Every document's ids
are serialised and compressed on their own where the text is read, against a
dictionary that was trained on a bounded sample; only frames are shuffled into
order, and any document of a shard can be read without its neighbours.

A shard image is, little-endian: b"QSTOK1", bytes per id (u1), sha256 of the
dictionary, number of documents (u8), then for each document its id (i8), a null
flag of the id (u1), its number of ids (u8) and the end of its frame (u8),
and the frames.  Images are rows of a Parquet folder, so that they reach any store
that Spark writes to and survive retried tasks; shards follow ascending doc_id,
and each row names its first and last doc_id, so that a lookup prunes by them.
Ids take two bytes where the tokenizer's largest id fits, four otherwise.

Defined cases: null and empty texts have only the end id; texts of any length are
encoded whole; strings of special tokens in a text are what the library makes of
them (their ids), or ordinary text with ``special_as_text``; rows that repeat are
stored each; ties of doc_id are ordered by a hash of the text, null ids come
first; an empty table gives an empty folder; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm import common

MAGIC = b"QSTOK1"
_HEAD = struct.Struct("<6sB32sQ")
_KNOWN_MOST = 2_000_000
_SLOTS = 1 << 22
_TOKENIZERS: dict[tuple[str, bool], "Encoder"] = {}


def _slot(hashes: np.ndarray, second: bool = False) -> np.ndarray:
    return ((hashes >> np.uint64(32) if second else hashes) & np.uint64(_SLOTS - 1)).astype(np.int64)


class Encoder:
    """Ids of many texts by one tokenizer, each distinct piece encoded once while it is known."""

    def __init__(self, path: str, special_as_text: bool = False):
        # tasks are parallel already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if special_as_text:
            self.tokenizer.encode_special_tokens = True
        added = {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = [c for c in added.values() if c]
        # only a byte-level tokenizer that cuts by its pattern can take pieces
        cut = self.tokenizer.pre_tokenizer
        plain = cut.__class__.__name__ == "ByteLevel" and cut.use_regex and not cut.add_prefix_space
        plain = plain and self.tokenizer.normalizer is None and self.tokenizer.truncation is None and self.tokenizer.padding is None
        self.pieces = plain and not any(b" " in c for c in self.added)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.largest = max([0, *vocabulary.values(), *added])
        # a byte-level token stands for as many bytes as it has characters
        self.bytes_of = np.zeros(self.largest + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self.forget()

    @staticmethod
    def of(path: str, special_as_text: bool = False) -> "Encoder":
        key = (path, special_as_text)
        if key not in _TOKENIZERS:
            _TOKENIZERS[key] = Encoder(path, special_as_text)
        return _TOKENIZERS[key]

    def width(self, end_id: int) -> int:
        """Bytes that every id and the end id fit."""
        return 2 if max(self.largest, end_id) < 1 << 16 else 4

    def forget(self) -> None:
        """Drops the known pieces; the tokenizer stays."""
        # row 0 is nobody's: a slot without a piece points to it
        self.slots = np.zeros(_SLOTS, np.int32)
        self.rows, self.used_ids, self.used_raw = 1, 0, 0
        # row i has bytes at[i] .. at[i + 1] - 1 of raw and ids begin[i] .. begin[i + 1] - 1
        self.known, self.at, self.begin = np.zeros(1024, np.uint64), np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.ids, self.raw = np.zeros(1024, np.uint32), np.zeros(1024, np.uint8)

    def _put(self, name: str, used: int, values: np.ndarray) -> None:
        """Values behind the used part of an array that grows by halves."""
        have = getattr(self, name)
        if used + len(values) > len(have):
            wider = np.zeros(max(used + len(values), len(have) * 3 // 2), have.dtype)
            wider[:used] = have[:used]
            setattr(self, name, have := wider)
        have[used : used + len(values)] = values

    def _plainly(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        made = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        return np.fromiter((i for m in made for i in m), np.uint32), np.array([len(m) for m in made], np.int64)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        # pieces that begin with a single space and end visibly are cut apart in a row just as they were in their texts
        plain = np.array([len(p) > 1 and p[0] == 0x20 and p[1] != 0x20 and 0x21 <= p[-1] < 0x7F and p.isascii() and len(p.split()) == 1 for p in pieces], dtype=bool)
        rows, alone = np.flatnonzero(plain), np.flatnonzero(~plain)
        groups = [rows[i : i + 64] for i in range(0, len(rows), 64)]
        flat, _ = self._plainly([b"".join(pieces[i] for i in g) for g in groups] + [pieces[i] for i in alone])
        # the bytes of the ids tell which piece each belongs to
        ordered = np.concatenate([rows, alone])
        sizes = np.fromiter((len(pieces[i]) for i in ordered), np.int64, len(pieces))
        until = np.searchsorted(np.cumsum(self.bytes_of[flat]), np.cumsum(sizes)) + 1
        self._put("known", self.rows, hashes[ordered])
        self._put("begin", self.rows + 1, self.used_ids + until)
        self._put("at", self.rows + 1, self.used_raw + np.cumsum(sizes))
        self._put("ids", self.used_ids, flat)
        self._put("raw", self.used_raw, np.frombuffer(b"".join(pieces[i] for i in ordered), np.uint8))
        # a piece whose first slot is taken goes to its second, whoever was there
        own, rows = hashes[ordered], np.arange(self.rows, self.rows + len(pieces), dtype=np.int32)
        taken = self.slots[_slot(own)] != 0
        self.slots[_slot(own[~taken])] = rows[~taken]
        self.slots[_slot(own[taken], second=True)] = rows[taken]
        self.rows, self.used_ids, self.used_raw = self.rows + len(pieces), self.used_ids + len(flat), self.used_raw + int(sizes.sum())

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in ``data``, and how many each text has."""
        texts = len(offsets) - 1
        raw = data.tobytes()
        if not self.pieces:
            return self._plainly([raw[offsets[i] : offsets[i + 1]] for i in range(texts)])
        if any(c in raw for c in self.added):
            own = [raw[offsets[i] : offsets[i + 1]] for i in range(texts)]
            odd = np.array([any(c in t for c in self.added) for t in own], dtype=bool)
            if odd.any():
                rest = [t for t, o in zip(own, odd, strict=True) if not o]
                made = (self._plainly([t for t, o in zip(own, odd, strict=True) if o]), self.encode(np.frombuffer(b"".join(rest), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in rest], dtype=np.int64)])))
                per = np.zeros(texts, np.int64)
                per[odd], per[~odd] = made[0][1], made[1][1]
                to = np.repeat(odd, per)
                ids = np.zeros(len(to), np.uint32)
                ids[to], ids[~to] = made[0][0], made[1][0]
                return ids, per
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(texts, np.int64)
        ends = np.append(starts[1:], len(data))
        doc = np.searchsorted(offsets, starts, "right") - 1
        at = self._places(data, raw, starts, ends)
        begin = self.begin[at]
        count = self.begin[at + 1] - begin
        per = np.bincount(doc, count, texts).astype(np.int64)
        ids = self.ids[np.repeat(begin, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)]
        return ids, per

    def _places(self, data: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row of each piece among the known ones; new ones are learnt, and no hash is believed."""
        hashes = common.word_hashes(data, starts, ends, lower=False)
        if self.rows > _KNOWN_MOST:
            self.forget()
        at = self.slots[_slot(hashes)].astype(np.int64)
        sizes = ends - starts
        other = np.flatnonzero((self.known[at] != hashes) | (at == 0))
        at[other] = self.slots[_slot(hashes[other], second=True)]
        new = np.flatnonzero((self.known[at] != hashes) | (at == 0))
        if len(new):
            unique, first, place = np.unique(hashes[new], return_index=True, return_inverse=True)
            base = self.rows
            self._learn(unique, [raw[a:b] for a, b in zip(starts[new[first]].tolist(), ends[new[first]].tolist(), strict=True)])
            row = np.empty(len(unique), np.int64)
            row[np.searchsorted(unique, self.known[base : self.rows])] = np.arange(base, self.rows)
            at[new] = row[place]
        edge, begin = np.cumsum(sizes) - sizes, self.at[at]
        # pieces follow each other without gaps
        same = data[starts[0] : ends[-1]] == self.raw[np.minimum(np.repeat(begin - edge, sizes) + np.arange(int(sizes.sum())), self.used_raw - 1)]
        longer = self.at[at + 1] - begin != sizes
        if not same.all() or longer.any():
            wrong = np.flatnonzero((np.add.reduceat(~same, edge) > 0) | longer)
            pieces = [raw[a:b] for a, b in zip(starts[wrong].tolist(), ends[wrong].tolist(), strict=True)]
            # two pieces of one hash: each gets a row of its own, that no slot leads to
            for i, piece in zip(wrong.tolist(), pieces, strict=True):
                slots = [_slot(hashes[i : i + 1]), _slot(hashes[i : i + 1], second=True)]
                kept, at[i] = [self.slots[x] for x in slots], self.rows
                self._learn(hashes[i : i + 1], [piece])
                for x, v in zip(slots, kept, strict=True):
                    self.slots[x] = v
        return at


_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
#: First bytes of two-byte characters none of which is white space.
_TWO = np.zeros(256, dtype=bool)
_TWO[0xC3:0xE0] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of texts and of single spaces that stand between visible characters."""
    if not len(data):
        return np.zeros(0, np.int64)
    space = np.flatnonzero(data == 0x20)
    space = space[(space > 0) & (space < len(data) - 1)]
    before, after = data[space - 1], data[space + 1]
    wide = (before >= 0x80) & _TWO[data[np.maximum(space - 2, 0)]] & (space > 1)
    cut = space[(_VISIBLE[before] | wide) & (_VISIBLE[after] | _TWO[after])]
    first = offsets[:-1][np.diff(offsets) > 0]
    starts = np.zeros(len(data) + 1, dtype=bool)
    starts[first] = True
    # a space that ends or begins a text has its neighbour in another text
    cut = cut[~starts[cut + 1] & ~starts[cut]]
    starts[cut] = True
    return np.flatnonzero(starts[:-1])


def trained(samples: list[bytes], size: int = 64 * 1024) -> bytes:
    """A dictionary from serialised id arrays; of too few, their last bytes; of none, nothing."""
    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def image(docs: list[tuple[int | None, int, bytes]], width: int, dictionary: bytes) -> bytes:
    """A shard of (doc_id, number of ids, frame)."""
    n = len(docs)
    ids = np.array([0 if d[0] is None else d[0] for d in docs], "<i8")
    null = np.array([d[0] is None for d in docs], "u1")
    count = np.array([d[1] for d in docs], "<u8")
    end = np.cumsum([len(d[2]) for d in docs]).astype("<u8")
    return b"".join([_HEAD.pack(MAGIC, width, hashlib.sha256(dictionary).digest(), n), ids.tobytes(), null.tobytes(), count.tobytes(), end.tobytes(), *(d[2] for d in docs)])


class Shard:
    """Reads an image; ``ids(i)`` decompresses document i alone."""

    def __init__(self, raw: bytes, dictionary: bytes):
        magic, self.width, digest, self.n = _HEAD.unpack_from(raw)
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError("not a token shard of this dictionary")
        at = _HEAD.size
        ids = np.frombuffer(raw, "<i8", self.n, at)
        null = np.frombuffer(raw, "u1", self.n, at := at + 8 * self.n)
        self.counts = np.frombuffer(raw, "<u8", self.n, at := at + self.n).astype(np.int64)
        self.ends = np.frombuffer(raw, "<u8", self.n, at := at + 8 * self.n).astype(np.int64)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null, strict=True)]
        self.raw, self.base = raw, at + 8 * self.n
        own = _dictionary(dictionary)
        self._open = zstandard.ZstdDecompressor(dict_data=own) if own else zstandard.ZstdDecompressor()

    def places(self, doc_id: int) -> range:
        """Numbers of the documents of an id; those without an id come first and are left out."""
        if not hasattr(self, "_named"):
            self._first = next((i for i, d in enumerate(self.doc_ids) if d is not None), self.n)
            self._named = np.array(self.doc_ids[self._first :], np.int64)
        a, b = (int(np.searchsorted(self._named, doc_id, side)) for side in ("left", "right"))
        return range(self._first + a, self._first + b)

    def ids(self, i: int) -> np.ndarray:
        a = self.base + (int(self.ends[i - 1]) if i else 0)
        got = np.frombuffer(self._open.decompress(self.raw[a : self.base + int(self.ends[i])]), f"<u{self.width}")
        if len(got) != self.counts[i]:
            raise ValueError(f"document {i} of the shard is damaged")
        return got


def _encoded(batch: pa.RecordBatch, encoder: Encoder, end_id: int, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of a batch with each text's ids, the end id last."""
    if max(encoder.largest, end_id) >> 8 * width or end_id < 0:
        raise ValueError(f"a token id does not fit {width} bytes")
    for chunk, data, offsets in common.text_chunks(batch, "text"):
        ids, counts = encoder.encode(data, offsets)
        ends = np.cumsum(counts)
        own = np.insert(ids, ends, end_id).astype(f"<u{width}")
        edge = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
        yield chunk, [own[edge[i] : edge[i + 1]] for i in range(len(counts))]


def train(docs: DataFrame, path: str, end_id: int, width: int, special_as_text: bool = False, rows: int = 1000, most: int = 8_000_000) -> bytes:
    """A dictionary from the first ``rows`` texts by hash, up to ``most`` bytes of ids in all and a thousandth of that each."""

    def run(batches):
        for batch in batches:
            for _, made in _encoded(batch, Encoder.of(path, special_as_text), end_id, width):
                yield pa.RecordBatch.from_arrays([pa.array([i.tobytes()[: most // 1000] for i in made], pa.binary())], ["s"])

    # one text to an id, so that the bound holds where ids repeat
    ids = docs.where("doc_id is not null").select(F.col("doc_id").alias("__of"), F.xxhash64("doc_id", F.lit("dictionary")).alias("h")).distinct().orderBy("h", "__of").limit(rows).select("__of")
    picked = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("__of"), "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    samples, total = [], 0
    for s in sorted(bytes(r["s"]) for r in picked.mapInArrow(common.tidy(run), "s binary").collect()):
        if total + len(s) <= most:
            samples.append(s)
            total += len(s)
    return trained(samples)


def write(docs: DataFrame, folder: str, path: str, end_id: int, width: int | None = None, shard_bytes: int = 4_000_000, level: int = 3, special_as_text: bool = False) -> bytes:
    """Writes the shards of ``docs`` (doc_id, text) to ``folder``; returns the dictionary."""
    spark = docs.sparkSession
    width = width or Encoder(path).width(end_id)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train(docs, path, end_id, width, special_as_text)

    # ranges of ids from the ids alone, so that texts are read and encoded once and only frames move
    parts = common.shuffle_partitions(spark)
    found = docs.where("doc_id is not null").approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = np.unique(np.array(found, np.float64))

    def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _dictionary(dictionary)
        squeeze = zstandard.ZstdCompressor(level=level, dict_data=own) if own else zstandard.ZstdCompressor(level=level)
        for batch in batches:
            for chunk, made in _encoded(batch, Encoder.of(path, special_as_text), end_id, width):
                ids = chunk.column("doc_id")
                # equal ids have equal doubles and so one range; those without an id come first
                to = np.searchsorted(bounds, ids.cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy(zero_copy_only=False), "left")
                columns = [pa.array(to.astype(np.int32)), ids, chunk.column("tie"), pa.array([len(i) for i in made], pa.int64()), pa.array([squeeze.compress(i.tobytes()) for i in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "tie", "n", "frame"])

    frames = docs.withColumn("tie", F.xxhash64("text")).mapInArrow(common.tidy(squeezed), "part int, doc_id long, tie long, n long, frame binary")
    ordered = frames.repartitionById(parts, F.col("part")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "frame")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, int, bytes]] = []

        def row():
            named = [h[0] for h in held if h[0] is not None]
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "n_docs": len(held), "n_ids": sum(h[1] for h in held), "first_id": min(named, default=None), "last_id": max(named, default=None), "image": image(held, width, dictionary)}], schema
            )

        for batch in batches:
            for own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "frame")), strict=True):
                held.append(own)
                size += len(own[2]) + 25
                if size >= shard_bytes:
                    yield row()
                    held, seq, size = [], seq + 1, 0
        if held:
            yield row()

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("image", pa.binary())])
    # images are compressed already
    ordered.select("doc_id", "n", "frame").mapInArrow(common.tidy(run), "part int, seq int, n_docs long, n_ids long, first_id long, last_id long, image binary").write.mode("errorifexists").option("compression", "none").parquet(f"{folder}/shards")
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    return dictionary


def lookup(spark: SparkSession, folder: str, doc_ids: Iterable[int]) -> DataFrame:
    """(doc_id, ids) of a list of ids: shards that can't hold one are not read, and only the asked frames are opened."""
    wanted = sorted({int(i) for i in doc_ids})
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("image").to_pylist():
                shard = Shard(raw, dictionary)
                found = [(i, shard.ids(n).tolist()) for i in wanted for n in shard.places(i)]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["doc_id", "ids"])

    shards = spark.read.parquet(f"{folder}/shards")
    if not wanted:
        return spark.createDataFrame([], "doc_id long, ids array<long>")
    # the ends of the list prune row groups; which of the others hold one is told by the list itself
    near = shards.where((F.col("last_id") >= wanted[0]) & (F.col("first_id") <= wanted[-1]))
    near = near.where(F.exists(F.lit(wanted), lambda w: (w >= F.col("first_id")) & (w <= F.col("last_id"))))
    return near.select("image").mapInArrow(common.tidy(run), "doc_id long, ids array<long>")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a folder, from its files."""
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])
    shards = spark.read.parquet(f"{folder}/shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"]
        for batch in batches:
            for part, seq, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "image")), strict=True):
                shard = Shard(raw, dictionary)
                crc = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in range(shard.n)]
                columns = [[part] * shard.n, [seq] * shard.n, shard.doc_ids, np.cumsum(shard.counts) - shard.counts, shard.counts, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), *[pa.int64()] * 4), strict=True)], names)

    docs = shards.select("part", "seq", "image").mapInArrow(common.tidy(run), "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    # shard totals: one row per shard_bytes of data
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    base = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    within = shards.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("offset"))
    starts = within.join(base, "part").select("part", "seq", (F.col("base") + F.col("offset")).alias("from"))
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("from") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def stored(docs: DataFrame, path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` to a new folder and reads it back.

    Without ``folder``, a folder below the shared checkpoint folder serves; it
    is removed when the digests of its documents are saved.
    """
    spark = docs.sparkSession
    own = folder or f"{common.shared_folder(spark)}/token-store-{uuid.uuid4().hex}"
    write(docs, own, path, end_id)
    if folder:
        return read(spark, own)
    out = common.checkpointed(read(spark, own))
    common.remove(spark, own)
    return out
