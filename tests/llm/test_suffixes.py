"""Repeated byte strings against a plain table of all windows."""

import hashlib
import random

import numpy as np
import pytest

from quillspark.llm import queries, suffixes


def plain(texts, length):
    """(bytes, removed, runs, hash of the rest) of each text, from a table of all windows."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for p in range(len(d) - length + 1):
            w = hash(d[p : p + length])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - length + 1):
            if seen[hash(d[p : p + length])] > 1:
                gone[p : p + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(c for c, g in zip(d, gone, strict=False) if not g)).hexdigest()))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def prose(rng, n):
    return "".join(rng.choice("abcdefgh éß\n") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage, other = prose(rng, 460), prose(rng, 900)
    out = [None, "", "short", prose(rng, 399), "a" * 3000, "ab" * 700 + prose(rng, 300), "a" * 399]
    out += [prose(rng, 500) + passage + prose(rng, rng.randrange(900)) for _ in range(30)]
    out += [other, other, other[:700], other[100:] + prose(rng, 10), other[:450] + "x" + other[451:]]
    for _ in range(20):  # near copies with a letter changed here and there
        copy = list(other)
        for _ in range(3):
            copy[rng.randrange(len(copy))] = "z"
        out.append("".join(copy))
    out += [prose(rng, 200) + passage[:410] + prose(rng, 50) + passage[30:] * 2]
    long = prose(rng, 5000)
    return [*out, long * 3, long[:3000]]


@pytest.mark.parametrize("how", [{}, {"bucket_rows": 20, "sample_docs": 30}, {"most": 3}, {"bucket_rows": 7, "sample_docs": 60, "most": 2}])
def test_all_repeats_of_odd_texts(spark, texts, how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(((i, *w) for i, w in enumerate(plain(texts, 400))), key=str)
    assert rows_of(suffixes.without_repeats(df, **how)) == want


def test_long_texts_are_cut_in_pieces(spark, monkeypatch):
    rng = random.Random(6)
    data = np.frombuffer(prose(rng, 9000).encode() + b"q" * 700, np.uint8)
    whole = suffixes.anchors(data, np.array([0, len(data)]), 400)
    rows = [prose(rng, 3000) * 2 + prose(rng, 1500), prose(rng, 800)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([3, 4]), pa.array([data.tobytes(), rows[0].encode()], pa.binary())], ["a", "b", "data"])
    monkeypatch.setattr(suffixes, "_PART", 1000)
    starts = [set(), set()]
    for found in suffixes._suffixes(batch, 400):
        for a, lo, hi in zip(found["a"], found["lo"], found["hi"], strict=True):
            starts[a - 1] |= set(range(lo, hi + 1))
    assert starts[0] == set(range(len(data) - 399)) and starts[1] == set(range(len(rows[0].encode()) - 399))
    assert whole["lo"][0] == 0 and whole["hi"][-1] == len(data) - 400 and (whole["lo"][1:] == whole["hi"][:-1] + 1).all()
    assert ((whole["pos"] >= whole["hi"]) & (whole["pos"] <= whole["lo"] + 400 - suffixes.GRAM)).all()


def test_repeated_rows_null_ids_and_other_columns(spark):
    rng = random.Random(7)
    a, b = prose(rng, 600), prose(rng, 600)
    rows = [(1, a, 1), (1, a, 2), (1, b, 3), (None, b, 4), (None, None, 5), (2, prose(rng, 500), 6)]
    df = spark.createDataFrame(rows, "doc_id int, text string, bucket int").withColumns({"data": queries.F.lit(1), "key": queries.F.lit("k")})
    want = sorted(((i, *w) for (i, *_), w in zip(rows, plain([r[1] for r in rows], 400), strict=True)), key=str)
    assert rows_of(suffixes.without_repeats(df)) == want
    assert suffixes.without_repeats(df.limit(0)).collect() == []


def test_multikey_order_sorts():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 5, (3000, 4))
    got = tokens[suffixes.multikey_order(tokens, 16)]
    assert [tuple(r) for r in got] == sorted(map(tuple, tokens))
    marks = np.unique(tokens[::100], axis=0)
    want = [sum(tuple(m) <= tuple(t) for m in marks) for t in tokens[:200]]
    assert suffixes._bucket_of(tokens[:200], marks).tolist() == want
    assert suffixes._bucket_of(tokens[:5], np.zeros((0, 4), np.int64)).tolist() == [0] * 5


def test_query_against_all_windows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], *w) for r, w in zip(docs, plain([r["text"] for r in docs], 400), strict=True)), key=str)
    assert rows_of(queries.op12_suffix_array_dedup(spark, sf_dir)) == want
