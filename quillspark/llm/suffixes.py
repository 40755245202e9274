"""Removal of repeated byte strings by a distributed, sparse suffix array.

Every string of ``length`` bytes has one anchor: of the starts of its grams of
``GRAM`` bytes, the one with the least hash, the leftmost of equals.  Equal
strings have their anchor at the same place, so only suffixes that begin at
anchors need sorting, one in about 130 bytes; an anchor speaks for the run of
window starts that chose it.

1. Suffixes are tokens: the first eight bytes, a hash of the gram, a hash of all
   that the anchor's windows cover, and a tie-break.  Splitters sampled from some
   documents deal them to buckets by these leading tokens, so that a string that
   is in a third of all documents spreads over many buckets.
2. A bucket sorts its suffixes by multikey quicksort and compares neighbours; the
   last suffix of a bucket is compared with the first of the next one.  Neighbours
   with equal context repeat as a whole.  Neighbours that share the gram alone may
   repeat in part, and only those go on.
3. Those take the bytes around their gram along.  The suffixes of one gram are
   compared window by window, by the left part and the right part; grams of more
   than ``most`` suffixes count their windows by an aggregation instead, which
   combines before the shuffle.

Spans found are united per document and cut out of its bytes.  All of the table
is indexed, only splitters come from a sample (``sample_docs``); contexts are equal when
the first bytes and two hashes of 64 bits are.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing; rows that
repeat an id, a text or both are documents of their own, so of equal texts all
go; null ids come back as null; other columns are not read; text is cut as bytes, so
what is kept need not be valid UTF-8; texts of any length are worked on in parts;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm import common

GRAM = 144
#: Bytes worked on at once; places in them take ``_PLACE_BITS``.
_PART = 1 << 18
_PLACE_BITS = 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LEFT = np.uint64(0xC2B2AE3D27D4EB4F)
_RIGHT = np.uint64(0x165667B19E3779F9)
_BYTES = np.random.default_rng(20250117).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}
_FACTS = "kind int, bucket int, t0 long, key long, ctx long, a long, b long, at long"
_REPEATED, _PARTLY, _FIRST, _LAST = range(4)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 2 * _PART)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values, in three passes."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Anchors of all windows of ``length`` bytes inside the pieces between ``bounds``.

    lo and hi: first and last window start that an anchor speaks for; pos: its
    place; t0, key, ctx: its tokens.
    """
    n = len(data)
    up, down = _powers(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[:n], out=sums[1:])
        grams = common.mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
        low = np.uint64((1 << _PLACE_BITS) - 1)
        ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        chosen = (_least(ranked, length - GRAM + 1) & low).astype(np.int64)
        edge = np.zeros(n + 2, np.int32)
        np.add.at(edge, bounds[:-1], 1)
        np.add.at(edge, np.maximum(bounds[1:] - length + 1, bounds[:-1]), -1)
        valid = np.cumsum(edge)[: len(chosen)] > 0
        chosen = np.where(valid, chosen, -1)
        new = np.flatnonzero(np.diff(chosen, prepend=-2) != 0)
        last = np.append(new[1:], len(chosen)) - 1
        keep = chosen[new] >= 0
        lo, hi = new[keep], last[keep]
        pos = chosen[lo]
        first = np.ascontiguousarray(data[pos[:, None] + np.arange(8)]).view(">u8").ravel().astype(np.uint64)
        ctx = (sums[hi + length] - sums[lo]) * down[lo]
        ctx = common.mix(ctx + (pos - lo).astype(np.uint64) * _LEFT + (hi - lo).astype(np.uint64) * _RIGHT)
    return {"lo": lo, "hi": hi, "pos": pos, "t0": (first ^ np.uint64(1 << 63)).view(np.int64), "key": grams[pos].view(np.int64), "ctx": ctx.view(np.int64)}


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, bounds, row of each piece, its start in the text); long texts in pieces that share all but one byte of a window."""
    texts = batch.column("data").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    held, size = [], 0
    for row in range(len(texts)):
        a, z = int(offsets[row]), int(offsets[row + 1])
        for start in range(a, z - length + 1, _PART):
            end = min(z, start + _PART + length - 1)
            if held and size + end - start > 2 * _PART:
                yield _joined(raw, held)
                held, size = [], 0
            held.append((row, start, end, start - a))
            size += end - start
    if held:
        yield _joined(raw, held)


def _joined(raw: np.ndarray, held: list[tuple[int, int, int, int]]):
    data = np.concatenate([raw[s:e] for _, s, e, _ in held])
    bounds = np.concatenate([[0], np.cumsum([e - s for _, s, e, _ in held])])
    return data, bounds, np.array([r for r, *_ in held]), np.array([h[3] for h in held], np.int64)


def _suffixes(batch: pa.RecordBatch, length: int) -> Iterator[dict[str, np.ndarray]]:
    """Tokens and owners of the suffixes of a batch's texts; ``lo`` and ``pos`` count from the start of the text.

    Of a run of neighbouring anchors with one context, as in a text of one letter,
    two are suffixes and the rest one span that is known to repeat.
    """
    owners = [batch.column(c).to_numpy() for c in ("a", "b")]
    for data, bounds, rows, starts in _pieces(batch, length):
        found = anchors(data, bounds, length)
        piece = np.searchsorted(bounds, found["lo"], "right") - 1
        shift = starts[piece] - bounds[piece]
        found |= {c: found[c] + shift for c in ("lo", "hi", "pos")}
        found |= {"a": owners[0][rows[piece]], "b": owners[1][rows[piece]]}
        like = np.zeros(len(piece), bool)
        if len(piece) > 1:
            like[1:] = (piece[1:] == piece[:-1]) & (found["key"][1:] == found["key"][:-1]) & (found["ctx"][1:] == found["ctx"][:-1])
        third = like.copy()
        third[1:] &= like[:-1]
        # of each run from the third on: its first takes the last one's end
        begins = third & ~np.concatenate([[False], third[:-1]])
        ends = third & ~np.concatenate([third[1:], [False]])
        known = np.zeros(len(piece), bool)
        known[begins] = True
        found["hi"][begins] = found["hi"][ends]
        keep = ~third | begins
        out = {c: v[keep] for c, v in found.items()}
        out["known"] = known[keep]
        with np.errstate(over="ignore"):
            whose = out["a"].view(np.uint64) * _LEFT + out["b"].view(np.uint64) * _RIGHT + out["pos"].astype(np.uint64)
            out["tie"] = common.mix(whose).view(np.int64)
        yield out


def _tokens(rows: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([rows[c] for c in ("t0", "key", "ctx", "tie")], axis=1)


def _bucket_of(tokens: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """How many splitters are not above each row, token by token, by bisection."""
    low, high = np.zeros(len(tokens), np.int64), np.full(len(tokens), len(splitters), np.int64)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        at = splitters[np.minimum(mid, len(splitters) - 1)]
        less, same = np.zeros(len(tokens), bool), np.ones(len(tokens), bool)
        for c in range(tokens.shape[1]):
            less |= same & (at[:, c] < tokens[:, c])
            same &= at[:, c] == tokens[:, c]
        below = open_ & (less | same)
        low, high = np.where(below, mid + 1, low), np.where(open_ & ~below, mid, high)
    return low


def multikey_order(tokens: np.ndarray, small: int = 256) -> np.ndarray:
    """Order of the rows of ``tokens`` by multikey quicksort.

    A part is split in three by a pivot at one token; the middle goes on with the
    next token; parts of up to ``small`` rows are sorted at once.
    """
    out, at = np.empty(len(tokens), np.int64), 0
    todo = [(np.arange(len(tokens)), 0)]
    while todo:
        part, depth = todo.pop()
        if depth == tokens.shape[1]:
            out[at : at + len(part)], at = part, at + len(part)
        elif len(part) <= small:
            rest = tokens[part, depth:]
            out[at : at + len(part)], at = part[np.lexsort(rest.T[::-1])], at + len(part)
        else:
            values = tokens[part, depth]
            pivot = np.partition(values[:: max(1, len(part) // 9)], 4)[4]
            todo += [(p, d) for p, d in ((part[values > pivot], depth), (part[values == pivot], depth + 1), (part[values < pivot], depth)) if len(p)]
    return out


def _at(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Place, bytes before it and run of window starts, packed."""
    return rows["pos"] << 18 | (rows["pos"] - rows["lo"]) << 9 | (rows["hi"] - rows["lo"])


def _unpacked(at: Column) -> tuple[Column, Column, Column]:
    pos, left, run = F.shiftright(at, 18), F.shiftright(at, 9).bitwiseAND(F.lit(511)), at.bitwiseAND(F.lit(511))
    return pos, pos - left, pos - left + run


def _neighbours(table: pa.Table) -> pa.Table:
    """Facts of one bucket: spans that repeat, suffixes that may repeat in part, its first and last suffix."""
    rows = {c: table.column(c).to_numpy() for c in ("bucket", "t0", "key", "ctx", "a", "b", "at")}
    if rows["bucket"][0] < 0:
        kinds = [(_REPEATED, np.arange(len(rows["at"])), rows["t0"], rows["key"])]
    else:
        with np.errstate(over="ignore"):
            whose = rows["a"].view(np.uint64) * _LEFT + rows["b"].view(np.uint64) * _RIGHT + (rows["at"] >> 18).astype(np.uint64)
        order = multikey_order(_tokens(rows | {"tie": common.mix(whose).view(np.int64)}))
        rows = {c: v[order] for c, v in rows.items()}
        gram = (rows["t0"][1:] == rows["t0"][:-1]) & (rows["key"][1:] == rows["key"][:-1])
        whole = gram & (rows["ctx"][1:] == rows["ctx"][:-1])
        either = lambda pair: np.concatenate([pair, [False]]) | np.concatenate([[False], pair])
        lo = (rows["at"] >> 18) - (rows["at"] >> 9 & 511)
        repeated, partly = np.flatnonzero(either(whole)), np.flatnonzero(either(gram & ~whole))
        kinds = [(_REPEATED, repeated, lo[repeated], (lo + (rows["at"] & 511))[repeated])]
        kinds += [(kind, at, rows["t0"][at], rows["key"][at]) for kind, at in ((_PARTLY, partly), (_FIRST, np.array([0])), (_LAST, np.array([len(order) - 1])))]
    cat = lambda f: np.concatenate([f(*k) for k in kinds])
    columns = {"kind": cat(lambda k, at, *_: np.full(len(at), k, np.int32)), "bucket": cat(lambda k, at, *_: rows["bucket"][at]), "t0": cat(lambda k, at, x, y: x), "key": cat(lambda k, at, x, y: y)}
    columns |= {c: cat(lambda k, at, *_, c=c: rows[c][at]) for c in ("ctx", "a", "b", "at")}
    return pa.table({c: pa.array(v) for c, v in columns.items()})


def _splitters(docs: DataFrame, length: int, sample_docs: int, bucket_rows: int) -> np.ndarray:
    """Tokens between buckets of about ``bucket_rows`` suffixes, from a sample of documents."""
    total = docs.count()
    rate = min(1.0, sample_docs / max(1, total))
    each = max(1, min(64, 1_000_000 // sample_docs))

    def taken(batches):
        for batch in batches:
            for part in common.slices(batch, 64):
                for rows in _suffixes(part, length):
                    tokens = _tokens(rows)[~rows["known"]]
                    if len(tokens):
                        some = tokens[np.argsort(tokens[:, 3])[: each * part.num_rows]]
                        yield pa.RecordBatch.from_arrays([pa.array([len(tokens)], pa.int64()), pa.array([some.tobytes()], pa.binary())], ["n", "tokens"])

    found = docs.sample(False, rate, 7).mapInArrow(common.tidy(taken), "n long, tokens binary").collect()
    if not found:
        return np.zeros((0, 4), np.int64)
    lists = [np.frombuffer(r["tokens"], np.int64).reshape(-1, 4) for r in found]
    tokens = np.concatenate(lists)
    weight = np.concatenate([np.full(len(x), r["n"] / len(x)) for r, x in zip(found, lists, strict=True)])
    order = multikey_order(tokens)
    tokens, weight = tokens[order], weight[order]
    buckets = int(np.ceil(weight.sum() / rate / bucket_rows))
    at = np.searchsorted(np.cumsum(weight), weight.sum() * np.arange(1, buckets) / max(1, buckets))
    return np.unique(tokens[np.minimum(at, len(tokens) - 1)], axis=0)


def _windows(members: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each member's window at every distance of its start from the gram, and whether the member has it.

    A window is so many bytes left of the gram, the gram, and the rest right of it.
    """
    side = length - GRAM
    up, _ = _powers(side + 1)
    n = members.num_rows
    sums = []
    for name in ("left", "right"):
        grid = np.zeros((n, side), np.uint8)
        texts = members.column(name).to_pylist()
        for i, t in enumerate(texts):
            own = np.frombuffer(t, np.uint8)
            grid[i, : len(own)] = own[::-1] if name == "left" else own
        with np.errstate(over="ignore"):
            sums.append(np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(_BYTES[grid] * up[:side], axis=1, dtype=np.uint64)], axis=1))
    t0, key = (members.column(c).to_numpy().view(np.uint64)[:, None] for c in ("t0", "key"))
    with np.errstate(over="ignore"):
        hashes = common.mix(common.mix(sums[0] + key) * _LEFT + sums[1][:, ::-1] * _RIGHT + t0)
    pos, lo, hi = (members.column(c).to_numpy()[:, None] for c in ("pos", "lo", "hi"))
    far = np.arange(side + 1)[None, :]
    return hashes, (far >= pos - hi) & (far <= pos - lo)


def _partly(members: pa.Table, length: int) -> pa.RecordBatch:
    """Spans of windows that two members have in common; members are those of whole grams."""
    hashes, has = _windows(members, length)
    rows, far = np.nonzero(has)
    values = hashes[rows, far]
    # equal windows are equally far from their gram; the distance and the gram are part of the hash's input, so one sort serves all
    order = np.lexsort((far, values))
    same = (values[order][1:] == values[order][:-1]) & (far[order][1:] == far[order][:-1])
    hit = np.zeros(len(order), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    rows, far = rows[hit], far[hit]
    begins = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(far, prepend=-9) != 1))
    ends = np.append(begins[1:], len(rows)) - 1
    own = rows[begins] if len(rows) else np.zeros(0, np.int64)
    pos = members.column("pos").to_numpy()[own]
    spans = (pos - far[ends], pos - far[begins]) if len(rows) else (pos, pos)
    return pa.RecordBatch.from_arrays([pa.array(members.column(c).to_numpy()[own]) for c in ("a", "b")] + [pa.array(s) for s in spans], ["a", "b", "lo", "hi"])


def _by_gram(batches: Iterator[pa.RecordBatch], length: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """``_partly`` over rows in order of gram, whole grams together, about ``at_once`` rows at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < at_once:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        t0, key = (table.column(c).to_numpy() for c in ("t0", "key"))
        new = np.flatnonzero((t0[1:] != t0[:-1]) | (key[1:] != key[:-1])) + 1
        # the last gram may go on in the next batch
        cuts = [0, *[int(c) for c in new[np.unique(np.searchsorted(new, np.arange(at_once, len(t0) + at_once, at_once)).clip(max=len(new) - 1))]]] if len(new) else [0]
        for a, z in zip(cuts, cuts[1:], strict=False):
            yield _partly(table.slice(a, z - a), length)
        held = table.slice(cuts[-1]).to_batches()
        size = table.num_rows - cuts[-1]
    if size:
        yield _partly(pa.Table.from_batches(held).combine_chunks(), length)


def _around(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes around the gram of each suffix of a document's list."""
    for batch in batches:
        for part in common.slices(batch, 256):
            out: list[tuple] = []
            for a, b, data, suffixes in zip(*[part.column(c).to_pylist() for c in ("a", "b", "data", "suffixes")], strict=True):
                for s in suffixes:
                    pos, left, run = s["at"] >> 18, s["at"] >> 9 & 511, s["at"] & 511
                    lo, hi = pos - left, pos - left + run
                    out.append((s["t0"], s["key"], s["many"], a, b, pos, lo, hi, data[lo:pos], data[pos + GRAM : hi + length]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["t0", "key", "many", "a", "b", "pos", "lo", "hi", "left", "right"])


def _listed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every window of a suffix as a row, for grams of too many suffixes."""
    for batch in batches:
        for part in common.slices(batch, 1024):
            table = pa.Table.from_batches([part])
            hashes, has = _windows(table, length)
            rows, far = np.nonzero(has)
            own = [pa.array(part.column(c).to_numpy()[rows]) for c in ("t0", "key", "a", "b")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(hashes[rows, far].view(np.int64)), pa.array(far), pa.array(part.column("pos").to_numpy()[rows] - far)], ["t0", "key", "a", "b", "w", "far", "lo"])


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.slices(batch, 256):
            out: list[tuple[int, int, int, str]] = []
            for data, spans in zip(part.column("data").to_pylist(), part.column("spans").to_pylist(), strict=True):
                digest, end, removed, runs = hashlib.sha256(), 0, 0, 0
                view = memoryview(data)
                for lo, hi in sorted((s["lo"], s["hi"] + length) for s in spans or ()):
                    if lo > end or not runs:
                        digest.update(view[end:lo])
                        runs += 1
                        end = lo
                    removed += max(0, hi - end)
                    end = max(end, hi)
                digest.update(view[end:])
                out.append((len(data), removed, runs, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c) for c in zip(*out, strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(keyed: DataFrame, length: int = 400, sample_docs: int = 4000, bucket_rows: int = 32_000, most: int = 8192) -> DataFrame:
    """(a, b, lo, hi): window starts from ``lo`` to ``hi`` of document (a, b) whose strings start elsewhere too.

    ``keyed``: (a, b, data), the document's key and bytes.
    """
    if not GRAM + 8 <= length <= GRAM + 500:
        raise ValueError(f"length must be between {GRAM + 8} and {GRAM + 500}")
    spark = keyed.sparkSession
    parts = common.shuffle_partitions(spark)
    long = keyed.where(F.octet_length("data") >= length)
    splitters = _splitters(long, length, sample_docs, bucket_rows)

    def dealt(batches):
        for batch in batches:
            for part in common.slices(batch):
                for rows in _suffixes(part, length):
                    bucket = _bucket_of(_tokens(rows), splitters)
                    known = rows["known"]
                    bucket[known] = -1 - np.abs(rows["tie"][known]) % (len(splitters) + 1)
                    rows["t0"], rows["key"] = np.where(known, rows["lo"], rows["t0"]), np.where(known, rows["hi"], rows["key"])
                    rows["at"] = np.where(known, 0, _at(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *[pa.array(rows[c]) for c in ("t0", "key", "ctx", "a", "b", "at")]], ["bucket", "t0", "key", "ctx", "a", "b", "at"])

    suffixes = long.mapInArrow(common.tidy(dealt), "bucket int, t0 long, key long, ctx long, a long, b long, at long")
    facts = common.checkpointed(suffixes.groupBy("bucket").applyInArrow(_neighbours, _FACTS))

    last, first = facts.where(F.col("kind") == _LAST), facts.where(F.col("kind") == _FIRST)
    names = ("t0", "key", "ctx", "a", "b", "at")
    across = last.select(F.col("bucket").alias("bucket"), *[F.col(c).alias(f"l_{c}") for c in names]).join(first.select((F.col("bucket") - 1).alias("bucket"), *names), "bucket")
    across = across.where("t0 = l_t0 and key = l_key")
    both = F.explode(F.array(*[F.struct(*[F.col(f"{p}{c}").alias(c) for c in ("t0", "key", "a", "b", "at")], (F.col("ctx") == F.col("l_ctx")).alias("whole")) for p in ("", "l_")]))
    across = across.select(both.alias("x")).select("x.*")

    _, lo, hi = _unpacked(F.col("at"))
    repeated = facts.where(F.col("kind") == _REPEATED).select("a", "b", F.col("t0").alias("lo"), F.col("key").alias("hi")).union(across.where("whole").select("a", "b", lo, hi))
    # a suffix that both its neighbours and the next bucket call for goes once
    asked = facts.where(F.col("kind") == _PARTLY).select("t0", "key", "a", "b", "at").union(across.where("not whole").drop("whole")).distinct()
    crowded = asked.groupBy("t0", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("t0", "key", F.lit(True).alias("many"))
    crowded = common.checkpointed(crowded, 1)
    none = crowded.isEmpty()
    asked = asked.withColumn("many", F.lit(False)) if none else asked.join(crowded, ["t0", "key"], "left").withColumn("many", F.coalesce("many", F.lit(False)))
    lists = asked.groupBy("a", "b").agg(F.collect_list(F.struct("t0", "key", "many", "at")).alias("suffixes"))
    around = long.join(lists, ["a", "b"]).select("a", "b", "data", "suffixes")
    around = around.mapInArrow(common.tidy(lambda it: _around(it, length)), "t0 long, key long, many boolean, a long, b long, pos long, lo long, hi long, left binary, right binary")
    if not none:
        around = common.checkpointed(around)
    grouped = around.where("not many").repartition(parts, "t0", "key").sortWithinPartitions("t0", "key")
    spans = repeated.union(grouped.mapInArrow(common.tidy(lambda it: _by_gram(it, length, 2048)), "a long, b long, lo long, hi long"))
    if not none:
        listed = around.where("many").mapInArrow(common.tidy(lambda it: _listed(it, length)), "t0 long, key long, a long, b long, w long, far long, lo long")
        listed = common.checkpointed(listed)
        twice = listed.groupBy("t0", "key", "w", "far").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        spans = spans.union(listed.join(twice, ["t0", "key", "w", "far"], "left_semi").select("a", "b", "lo", F.col("lo").alias("hi")))
    return spans


def without_repeats(docs: DataFrame, length: int = 400, sample_docs: int = 4000, bucket_rows: int = 32_000, most: int = 8192) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text)."""
    doc_id, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("a"), F.xxhash64(text, doc_id.isNull()).alias("b"), text.cast("binary").alias("data"))
    spans = repeated_spans(keyed.drop("doc_id"), length, sample_docs, bucket_rows, most)
    spans = spans.groupBy("a", "b").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed.join(spans, ["a", "b"], "left").select("doc_id", "data", "spans").mapInArrow(common.tidy(lambda it: _cut(it, length)), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
