"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when their sets of ``k``-word shingles have a Jaccard
similarity of at least ``percent`` / 100.  Shingles are compared by 52 bits of a
hash, so two sets are taken for what they are but for a chance of about
n * m / 2**52 that two different shingles of sets of n and m fall together; beyond
that no link is missed:

1. Every text is cut into shingles (hashes of lower-cased words).  Texts
   with the same word sequence are collapsed on the way, in the task that reads
   them and then across tasks, so copies are never listed twice per task.
2. A first reading counts shingles that repeat within a share of a task and sums
   them over tasks; the ``hot_most`` most frequent of them come last in every
   order and need no list.  What is still listed has at most postings / hot_most
   documents, or stays under about ``_COMMON`` documents and one a share in each
   task, so no task gathers a hot list.  All other postings go to inverted lists by
   hash range, as packed blocks; over ``fan`` ranges they take two hops, so that
   blocks stay full however many ranges there are.  A list of one document is
   dropped there: it can't add to any overlap.  The rest goes back to its
   documents with the exact list length.
3. A document needs T = ceil(percent * n / 100) shared shingles for any link,
   so one with fewer shared shingles leaves.  The others sort their lists by
   (length, hash): the n - T + 1 shortest are the short lists, and any link has
   one of them in common.
4. Documents with a common short list form blocks (connected components).  A
   block is searched like a graph: a document asks those not yet reached, by
   DivideSkip, which merges its short lists, keeps documents that reach T - L, and
   binary-probes its L long lists; what it links to is reached and asks next.
   So a group of near copies is merged about once, not once for each member.  Blocks
   over ``block_rows`` documents or ``block_postings`` postings first meet a few
   pivots, which connects most of a large group of near copies; then only pairs of
   sub-blocks that can still join something are dealt out, so no task holds more
   than two of them.

Defined cases: null or empty text has no shingles and links with nothing; a
text with fewer than ``k`` words has its whole word sequence as its one
shingle; texts of any length are read whole; every row is a document, so rows that
repeat an id, or have none, are searched each with its own text, and a component
is named by the smallest id in it (null if it has none); ties at the threshold
link; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import common

#: Bits of a shingle hash that the lists keep.
_BITS = 52
_POSTINGS = 1_000_000
_LISTED = "kind int, part int, a binary, b binary, c binary, d binary"
_FOUND = "kind int, part int, u array<long>, v array<long>, a binary, b binary, c binary, d binary"
_COLS = ["kind", "part", "u", "v", "a", "b", "c", "d"]
_MU = 0.0085
#: Texts of a task that make a shingle a candidate for a hot one.
_COMMON = 32
#: Counts that a task holds before it drops small ones.
_COUNTS = 1_000_000
#: List length that stands for a hot list.
_HOT = 1 << 40
#: Rows to a file of documents with their lists.
_WIDE = 5000
#: Pivots of a large block.
_PIVOTS = 16


def shingle_hashes(word_hash: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs, sorted by document, and each document's count."""
    n = np.bincount(doc, minlength=n_docs)
    starts = np.cumsum(n) - n
    with np.errstate(over="ignore"):
        h = word_hash.copy()
        for j in range(1, min(k, len(h))):
            h[: len(h) - j] = h[: len(h) - j] * np.uint64(0x2545F4914F6CDD1D) + word_hash[j:]
        h = common.mix(h)
        here = np.arange(len(h)) + k <= np.repeat(starts + n, n)
        for d in np.flatnonzero((n > 0) & (n < k)):
            v = np.uint64(n[d])
            for w in word_hash[starts[d] : starts[d] + n[d]]:
                v = v * np.uint64(0x2545F4914F6CDD1D) + w
            h[starts[d]], here[starts[d]] = common.mix(np.array([v]))[0], True
    h, doc = h[here] >> np.uint64(64 - _BITS), doc[here]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new].astype(np.int64), np.bincount(doc[new], minlength=n_docs)


def _common(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(h, c) of shingles in ``_COMMON`` or more texts of a task; texts that are equal count once.

    Within each share of a task a shingle in one text is not counted, so counts
    are low by one a share at most.
    """
    firsts: set[bytes] = set()
    held: list[np.ndarray] = []
    seen = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
    pending: list[tuple[np.ndarray, np.ndarray]] = []

    def flush():
        if held:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            pending.append((h[c > 1], c[c > 1].astype(np.int64)))
            held.clear()

    def settle():
        h, place = np.unique(np.concatenate([seen[0], *(p[0] for p in pending)]), return_inverse=True)
        c = np.bincount(place, np.concatenate([seen[1], *(p[1] for p in pending)]), len(h)).astype(np.int64)
        pending.clear()
        while len(h) > _COUNTS // 2:
            keep = c > np.median(c)
            h, c = h[keep], c[keep]
        seen[:] = h, c

    size = 0
    for batch in batches:
        for _, data, offsets in common.text_chunks(batch, "text"):
            starts, ends, doc = common.words(data, offsets)
            hashes = common.word_hashes(data, starts, ends, lower=True)
            bounds = np.searchsorted(doc, np.arange(len(offsets)))
            fresh = np.zeros(len(offsets) - 1, dtype=bool)
            for i in np.flatnonzero(np.diff(bounds)):
                digest = hashlib.blake2b(hashes[bounds[i] : bounds[i + 1]].tobytes(), digest_size=16).digest()
                fresh[i] = digest not in firsts
                firsts.add(digest)
            of, h, _ = shingle_hashes(hashes, doc, len(offsets) - 1, k)
            held.append(h[fresh[of]])
            size += len(held[-1])
            if size >= _POSTINGS:
                flush()
                size = 0
                if len(seen[0]) + sum(len(p[0]) for p in pending) > _COUNTS:
                    settle()
    flush()
    settle()
    h, c = seen
    yield pa.RecordBatch.from_arrays([pa.array(h[c >= _COMMON]), pa.array(c[c >= _COMMON])], ["h", "c"])


def _blocks(h: np.ndarray, ids: np.ndarray, n: np.ndarray, bounds: np.ndarray, first: int = 0) -> list[tuple]:
    """Postings as packed blocks of kind 2, one to each range between the bounds."""
    order = np.argsort(h, kind="stable")
    h, ids, n = h[order], ids[order], n[order]
    table, place = np.unique(ids, return_inverse=True)
    sizes = np.zeros(len(table), np.int64)
    sizes[place] = n
    cuts, made = np.searchsorted(h, bounds), []
    for p, own in enumerate(zip([0, *cuts], [*cuts, len(h)], strict=True)):
        if own[0] < own[1]:
            used, local = np.unique(place[own[0] : own[1]], return_inverse=True)
            part = h[own[0] : own[1]]
            made.append((2, first + p, common.pack(np.diff(part, prepend=0)), common.pack(local), common.pack(np.diff(table[used], prepend=0)), common.pack(sizes[used])))
    return made


def _unblocked(pdf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h, id, n) of packed blocks."""
    hs, ids, ns = [], [], []
    for a, b, c, d in zip(pdf["a"], pdf["b"], pdf["c"], pdf["d"], strict=True):
        local = common.unpack(b)
        hs.append(np.cumsum(common.unpack(a)))
        ids.append(np.cumsum(common.unpack(c))[local])
        ns.append(common.unpack(d)[local])
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (hs, ids, ns))


def _starts(ranges: int) -> np.ndarray:
    """Least hashes of the ranges but the first."""
    return np.array([i * (1 << _BITS) // ranges for i in range(1, ranges)], np.int64)


def _split(batches: Iterator[pa.RecordBatch], coarse: int, fine: int) -> Iterator[pa.RecordBatch]:
    """Blocks of coarse ranges as blocks of the ``fine`` ranges inside each; blocks of other kinds pass."""
    starts = _starts(coarse * fine)
    held: dict[int, list[tuple]] = {}
    size: dict[int, int] = {}

    def flush(at: int):
        own = pd.DataFrame(held.pop(at), columns=["a", "b", "c", "d"])
        size.pop(at)
        return _rows(_blocks(*_unblocked(own), starts[at * fine : (at + 1) * fine - 1], at * fine))

    for batch in batches:
        for kind, part, *blobs in zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "a", "b", "c", "d")), strict=True):
            if kind != 2:
                yield _rows([(kind, part, *blobs)])
                continue
            held.setdefault(part, []).append(tuple(blobs))
            # eight bytes a posting at most
            size[part] = size.get(part, 0) + sum(map(len, blobs))
            if size[part] >= 4 * _POSTINGS or sum(size.values()) >= 32 * _POSTINGS:
                yield flush(max(size, key=size.get))
    for at in list(held):
        yield flush(at)


def _rows(made: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(types)], ["kind", "part", "a", "b", "c", "d"])


def _listed(batches: Iterator[pa.RecordBatch], ranges: int, coarse: int, parts: int, k: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Kind 0: documents with their sizes; 1: first texts of each word sequence; 2: postings by coarse hash range; 3: hot postings by document.

    Every block is dealt by (kind, part): kind 0 at random, the others by hash.
    """
    firsts: dict[bytes, int] = {}
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    docs: list[tuple[int, int, int]] = []
    sums: list[tuple[int, int, int]] = []

    def flush():
        made = []
        if docs:
            ids, at, n = (np.array(x, np.int64) for x in zip(*docs, strict=True))
            made.append((0, int(ids[0]) % ranges, common.pack(ids), common.pack(at), common.pack(n), b""))
        if sums:
            part, digest, ids = (np.array(x, np.int64) for x in zip(*sums, strict=True))
            order = np.argsort(part, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                made.append((1, int(part[own[0]]), common.pack(digest[own]), common.pack(ids[own]), b"", b""))
        if held:
            h, ids, n = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(hot):
                found = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
                made += _by_document(h[found], ids[found], np.full(int(found.sum()), _HOT), n[found], parts)
                h, ids, n = h[~found], ids[~found], n[~found]
            made += _blocks(h, ids, n, _starts(coarse))
        held.clear()
        docs.clear()
        sums.clear()
        return _rows(made)

    size = 0
    for batch in batches:
        for chunk, data, offsets in common.text_chunks(batch, "text"):
            starts, ends, doc = common.words(data, offsets)
            hashes = common.word_hashes(data, starts, ends, lower=True)
            bounds = np.searchsorted(doc, np.arange(len(offsets)))
            ids = chunk.column("doc_id").to_pylist()
            fresh, first = np.zeros(len(ids), dtype=bool), []
            for i in range(len(ids)):
                if ids[i] is not None and bounds[i] < bounds[i + 1]:
                    digest = hashlib.blake2b(hashes[bounds[i] : bounds[i + 1]].tobytes(), digest_size=16).digest()
                    if digest not in firsts:
                        firsts[digest], fresh[i] = ids[i], True
                        whole = int.from_bytes(digest[:8], "little", signed=True)
                        sums.append((int.from_bytes(digest[8:], "little") % ranges, whole, ids[i]))
                    first.append(firsts[digest])
                else:
                    first.append(ids[i])
            of, h, n = shingle_hashes(hashes, doc, len(ids), k)
            docs += [(d, f, int(c)) for d, f, c in zip(ids, first, n, strict=True) if d is not None]
            keep = fresh[of]
            if keep.any():
                own = np.array([-1 if d is None else d for d in ids], np.int64)
                held.append((h[keep], own[of[keep]], n[of[keep]]))
                size += int(keep.sum())
            if size >= _POSTINGS or len(docs) >= 100_000:
                yield flush()
                size = 0
    yield flush()


def _freed(out: pd.DataFrame) -> pd.DataFrame:
    common.release()
    return out


def _by_document(h: np.ndarray, ids: np.ndarray, df: np.ndarray, n: np.ndarray, parts: int) -> list[tuple]:
    """Postings as packed blocks of kind 3, by the documents' part."""
    to = (common.mix(ids.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((h, ids, to))
    cuts = np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(order) else []
    return [(3, int(to[own[0]]), *(common.pack(x[own]) for x in (ids, h, df, n))) for own in cuts]


def _shared(key, pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    """One range's lists: blocks of the postings in lists of two documents or more, by the documents' part."""
    kind, part = int(key[0]), int(key[1])
    none = np.zeros(0, np.int64)
    if kind == 3:
        return pd.DataFrame([(3, part, none, none, *(common.pack(np.concatenate([common.unpack(x) for x in pdf[c]])) for c in "abcd"))], columns=_COLS)
    if kind == 0:
        ids, at, n = (np.concatenate([common.unpack(x) for x in pdf[c]]) for c in "abc")
        return pd.DataFrame([[0, 0, ids, n, None, None, None, None], [1, 0, ids[ids != at], at[ids != at], None, None, None, None]], columns=_COLS)
    if kind == 1:
        digest, ids = (np.concatenate([common.unpack(x) for x in pdf[c]]) for c in "ab")
        order = np.lexsort((ids, digest))
        digest, ids = digest[order], ids[order]
        new = np.ones(len(ids), dtype=bool)
        new[1:] = digest[1:] != digest[:-1]
        least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        return pd.DataFrame([[2, 0, ids[ids != least], least[ids != least], None, None, None, None]], columns=_COLS)
    h, ids, ns = _unblocked(pdf)
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    df = np.diff(np.append(first, len(h)))
    many = np.repeat(df > 1, df)
    order, h, df = order[many], h[many], np.repeat(df, df)[many]
    ids, ns = ids[order], ns[order]
    return pd.DataFrame([(kind, part, none, none, *blobs) for kind, part, *blobs in _by_document(h, ids, df, ns, parts)], columns=_COLS)


def _needing(key, pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Documents that could link: their shared lists by (length, hash), and how many of those are short."""
    ids, h, df, ns = (np.concatenate([common.unpack(x) for x in pdf[c]]) for c in "abcd")
    order = np.lexsort((h, df, ids))
    ids, h, ns = ids[order], h[order], ns[order]
    out = []
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else []
    for a, b in zip(first, [*first[1:], len(ids)], strict=True):
        n = int(ns[a:b].max())
        need = -(-percent * n // 100)
        own = h[a:b][np.concatenate([[True], h[a + 1 : b] != h[a : b - 1]])]
        if len(own) >= need:
            short = n - need + 1 - (n - len(own))
            out.append((int(ids[a]), n, own[: max(short, 0)], own.astype("<i8").tobytes()))
    return pd.DataFrame(out, columns=["doc_id", "n", "short", "lists"])


def divide_skip(short: list[np.ndarray], long_lists: np.ndarray, keys: np.ndarray, n_docs: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents in at least ``need`` of a query's lists, with their counts.

    ``short`` are sorted inverted lists to merge; ``long_lists`` are the numbers
    of the lists to probe, in ``keys``: all postings as sorted list * n_docs + doc.
    """
    if not short:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    merged = np.sort(np.concatenate(short), kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
    found, count = merged[edge], np.diff(np.append(edge, len(merged)))
    able = count >= need - len(long_lists)
    found, count = found[able], count[able]
    if len(found) and len(long_lists):
        width = max(1, 2_000_000 // len(long_lists))
        for a in range(0, len(found), width):
            wanted = long_lists[:, None] * n_docs + found[None, a : a + width]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            count[a : a + width] += (keys[at] == wanted).sum(axis=0)
    enough = count >= need
    return found[enough], count[enough]


def linked_in_block(ids: np.ndarray, n: np.ndarray, lists: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links enough to connect every linked pair of a block; with ``side``, only pairs across it.

    The links are walked as a graph: each document asks once, among those not
    yet reached.  A document that is reached needs no other link, and all that it
    has links with is found when its own turn comes.
    """
    m = len(ids)
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    token, number = np.unique(np.concatenate(lists) if m else np.zeros(0, np.int64), return_inverse=True)
    number = number.astype(np.int32)
    at = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(m, dtype=np.int32), sizes)
    order = np.lexsort((doc, number))
    by_number, posted = number[order], doc[order]
    del order, doc
    left = np.ones(m, dtype=bool)
    listed = m

    def indexed():
        keys = by_number.astype(np.int64) * m + posted
        begin = np.searchsorted(by_number, np.arange(len(token) + 1))
        return keys, begin, np.diff(begin)

    keys, begin, length = indexed()
    links = []
    for first in range(m):
        todo = [first] if left[first] else []
        left[first] = False
        while todo:
            x = todo.pop()
            remain = int(left.sum())
            if not remain:
                break
            if remain <= listed // 2:
                # lists shrink as documents are reached
                keep = left[posted]
                by_number, posted, listed = by_number[keep], posted[keep], remain
                keys, begin, length = indexed()
            own = number[at[x] : at[x] + sizes[x]]
            own = own[length[own] > 0]
            need = -(-percent * int(n[x]) // 100)
            if len(own) < need:
                continue
            own = own[np.argsort(length[own], kind="stable")]
            longest = min(need - 1, int(need / (_MU * np.log2(max(2, length[own[-1]])) + 1)))
            cut = len(own) - longest
            found, count = divide_skip([posted[begin[t] : begin[t + 1]] for t in own[:cut]], own[cut:], keys, m, need)
            good = left[found] & (100 * count >= percent * (n[found] + n[x] - count))
            if side is not None:
                good &= side[found] != side[x]
            for y in found[good].tolist():
                left[y] = False
                todo.append(y)
                links.append((int(ids[x]), int(ids[y])))
    return links


def _linked(key, pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    across = key[1] != key[2]
    links = linked_in_block(
        pdf["doc_id"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), [np.frombuffer(x, "<i8") for x in pdf["lists"]], percent, pdf["sub"].to_numpy() if across else None
    )
    return pd.DataFrame(links, columns=["u", "v"])


def _block_links(able: DataFrame, n_able: int, blocks: DataFrame, parts: int, percent: int, block_rows: int, block_postings: int) -> DataFrame:
    """Links (u, v) that connect what is linked inside each block."""
    run = lambda df: df.groupBy("place", "i", "j").applyInPandas(lambda key, pdf: _freed(_linked(key, pdf, percent)), "u long, v long")
    # how many blocks of the bound a set of documents makes, by documents or by postings
    pieces = lambda rows, held: F.ceil(F.greatest(rows / block_rows, held / block_postings)).cast("int")
    held = F.sum(F.octet_length("lists") / 8)
    own = blocks.join(able.select("doc_id", F.octet_length("lists").alias("bytes")), F.col("doc_id") == F.col("node"))
    sizes = own.groupBy("component").agg(pieces(F.count(F.lit(1)), F.sum(F.col("bytes") / 8)).alias("subs"))
    member = common.checkpointed(able.join(blocks.join(sizes, "component"), F.col("doc_id") == F.col("node")).drop("node"), n_able, _WIDE)
    none = F.lit(0)
    small = member.where("subs <= 1").select(F.pmod(F.xxhash64("component"), F.lit(parts)).alias("place"), none.alias("i"), none.alias("j"), none.alias("sub"), "doc_id", "n", "lists")
    links = run(small)
    large = member.where("subs > 1")
    if large.isEmpty():
        return links
    # every document of a large block meets the block's pivots, in sub-blocks
    slot = F.pmod(F.xxhash64("doc_id", F.lit("pivot")), F.lit(_PIVOTS))
    pivots = large.groupBy("component", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("doc_id"), "doc_id", "n", "lists")).alias("p")).select("component", "p.doc_id", "p.n", "p.lists")
    subs = large.select("component", "subs").distinct()
    cut = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col("subs")).cast("int")
    spread = large.join(pivots.select(F.col("doc_id").alias("__p")), F.col("doc_id") == F.col("__p"), "left_anti").withColumn("i", cut("meet"))
    meeting = spread.select(F.col("component").alias("place"), "i", "doc_id", "n", "lists").union(
        pivots.join(subs, "component").select(F.col("component").alias("place"), F.explode(F.sequence(none, F.col("subs") - 1)).alias("i"), "doc_id", "n", "lists")
    )
    first = common.checkpointed(run(meeting.select("place", "i", F.col("i").alias("j"), none.alias("sub"), "doc_id", "n", "lists")))
    known = common.components(first, n_able)
    # the largest component of a block needs no comparison inside itself
    named = large.join(known.select(F.col("node").alias("__n"), F.col("component").alias("got")), F.col("doc_id") == F.col("__n"), "left").drop("__n")
    named = common.checkpointed(named.withColumn("got", F.coalesce("got", "doc_id")), n_able, _WIDE)
    counted = named.groupBy("component", "got").agg(F.count(F.lit(1)).alias("c"), held.alias("held"))
    most = counted.groupBy("component").agg(F.max(F.struct("c", F.col("got").alias("main"), "held")).alias("m"), F.sum("c").alias("all"), F.sum("held").alias("held"))
    most = most.select(F.col("component").alias("__c"), "m.main", pieces(F.col("m.c"), F.col("m.held")).alias("k"), pieces(F.col("all") - F.col("m.c"), F.col("held") - F.col("m.held")).alias("r"))
    dealt = named.join(most, F.col("component") == F.col("__c")).where("r > 0").withColumn("is_main", F.col("got") == F.col("main"))
    mine = F.when(F.col("is_main"), F.pmod(F.xxhash64("doc_id"), F.col("k"))).otherwise(F.col("k") + F.pmod(F.xxhash64("doc_id"), F.col("r"))).cast("int")
    others = F.sequence(F.when(F.col("is_main"), F.col("k")).otherwise(none), F.col("k") + F.col("r") - 1)
    dealt = dealt.withColumn("sub", mine).withColumn("other", F.explode(others))
    rest = run(dealt.select(F.col("component").alias("place"), F.least("sub", "other").alias("i"), F.greatest("sub", "other").alias("j"), "sub", "doc_id", "n", "lists"))
    return links.union(first).union(rest)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a key of each row in ``__key``, and (__key, __own) of those whose id is no key.

    An id that one row has is its key.  Rows that share an id or have none, few if
    any, are written with keys above all ids.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("__id"))
    shared = common.checkpointed(ids.groupBy("__id").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1 or __id is null").select("__id"))
    if shared.isEmpty():
        return docs.withColumn("__key", F.col("doc_id").cast("long")), None
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    top = ids.agg(F.coalesce(F.max("__id"), F.lit(0))).first()[0]
    odd = common.checkpointed(docs.join(shared, same, "left_semi").withColumn("__key", F.lit(top) + 1 + F.monotonically_increasing_id()))
    alone = docs.join(shared, same, "left_anti").withColumn("__key", F.col("doc_id").cast("long"))
    return alone.union(odd), odd.select("__key", F.col("doc_id").cast("long").alias("__own"))


def ngram_jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, **bounds) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    keyed, odd = _keyed(docs.select("doc_id", "text"))
    found = _classes(keyed.select(F.col("__key").alias("doc_id"), "text"), k, percent, **bounds)
    if odd is None:
        return found
    found = common.checkpointed(found)
    named = found.join(odd, F.col("doc_id") == F.col("__key"), "left").withColumn("doc_id", F.when(F.col("__key").isNull(), F.col("doc_id")).otherwise(F.col("__own")))
    least = named.groupBy(F.col("component_id").alias("__c")).agg(F.min("doc_id").alias("__least"))
    return named.join(least, F.col("component_id") == F.col("__c")).select("doc_id", "n_shingles", F.col("__least").alias("component_id"))


def _classes(docs: DataFrame, k: int, percent: int, block_rows: int = 1000, block_postings: int = 1_000_000, hot_most: int = 200_000, fan: int = 1024) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``docs`` (doc_id, text) with unique ids."""
    spark = docs.sparkSession
    # a task holds one range at a time; each range sends a block to each part of the documents
    parts = common.shuffle_partitions(spark)
    # ranges, where they are more than a flush should be split into, are reached in two hops
    fine = -(-2 * parts // fan)
    coarse = -(-2 * parts // fine)
    ranges = coarse * fine
    often = docs.select("text").mapInArrow(common.tidy(lambda it: _common(it, k)), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    hot = np.sort(np.array([r["h"] for r in often.orderBy(F.desc("c"), "h").limit(hot_most).select("h").collect()], np.int64))
    hot = spark.sparkContext.broadcast(hot)
    listed = docs.mapInArrow(common.tidy(lambda it: _listed(it, ranges, coarse, parts, k, hot.value)), _LISTED)
    if fine > 1:
        listed = listed.repartition(coarse, "kind", "part").mapInArrow(common.tidy(lambda it: _split(it, coarse, fine)), _LISTED)
    found = common.checkpointed(listed.groupBy("kind", "part").applyInPandas(lambda key, pdf: _freed(_shared(key, pdf, parts)), _FOUND))
    pairs = lambda kind: found.where(F.col("kind") == kind).select(F.explode(F.arrays_zip("u", "v")).alias("x")).select("x.u", "x.v")
    later = pairs(2)
    able = (
        found.where("kind = 3")
        .groupBy("part")
        .applyInPandas(lambda key, pdf: _freed(_needing(key, pdf, percent)), "doc_id long, n long, short array<long>, lists binary")
        .join(later.select(F.col("u").alias("doc_id")).distinct(), "doc_id", "left_anti")
    )
    able = common.checkpointed(able)
    n_docs, n_able = found.where("kind = 0").agg(F.coalesce(F.sum(F.size("u")), F.lit(0))).first()[0], able.count()
    short = able.select("doc_id", F.explode("short").alias("h"))
    heads = short.groupBy("h").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1").select("h", "head")
    blocks = common.components(short.join(heads, "h").where("doc_id <> head").select(F.col("doc_id").alias("u"), F.col("head").alias("v")), n_able)
    links = _block_links(able.drop("short"), n_able, blocks, parts, percent, block_rows, block_postings)
    joined = common.components(pairs(1).union(later).union(links), n_docs)
    return pairs(0).join(joined, F.col("u") == F.col("node"), "left").select(F.col("u").alias("doc_id"), F.col("v").alias("n_shingles"), F.coalesce("component", "u").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, most_broadcast: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group of links one row stays.

    That is the one with the smallest id, those without an id last; of several
    rows of that id any one.  A row that is nobody's copy stays, whatever its id; other
    columns pass, whatever their names.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("doc_id"), F.col("text"))
    keyed, odd = _keyed(whole)
    found = _classes(keyed.select(F.col("__key").alias("doc_id"), "text"), k, percent)
    if odd is None:
        gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    else:
        found = common.checkpointed(found)
        named = found.join(odd, F.col("doc_id") == F.col("__key"), "left").withColumn("__own", F.when(F.col("__key").isNull(), F.col("doc_id")).otherwise(F.col("__own")))
        stays = named.groupBy("component_id").agg(F.min(F.struct(F.col("__own").isNull(), "__own", "doc_id")).alias("__m"))
        gone = named.join(stays, "component_id").where(F.col("doc_id") != F.col("__m.doc_id")).select(F.col("doc_id").alias("__gone"))
    gone = common.checkpointed(gone)
    gone = F.broadcast(gone) if gone.count() <= most_broadcast else gone
    return keyed.join(gone, F.col("__key") == F.col("__gone"), "left_anti").select("__row.*")
