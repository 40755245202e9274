import random

import numpy as np
import pytest

from llm_tools import LOWER, Union, words
from quillspark.llm import ngram_join


def brute(rows, k=5, percent=80):
    sets = {}
    for i, t in rows:
        w = words((t or "").translate(LOWER))
        sets[i] = {tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))} if w else set()
    u, ids = Union(sets), sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                u.join(a, b)
    return {i: (len(s), u.top(i)) for i, s in sets.items()}


def rows_of(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 60, 200]))] for _ in range(12)]
    out = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            w += passage
        text = rng.choice([" ", "\n", "\t "]).join(w)
        out.append((1000 - i, text.upper() if rng.random() < 0.2 else text))
    return out + [(2000, None), (2001, ""), (2002, " \n")]


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 4096), (3, 8)])
def test_components_match_brute_force(docs, seed, block):
    rows = rows_of(seed)
    out = ngram_join.ngram_jaccard_components(docs(*rows), block_rows=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows)


def test_hot_lists_and_large_blocks(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "_COMMON", 2)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            w[rng.randrange(120)] = f"z{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    rows += [(500 + i, t) for i, t in rows_of(12, 60)]
    for most, block in ((200_000, 20), (40, 50), (0, 7)):
        out = ngram_join.ngram_jaccard_components(docs(*rows).coalesce(1), block_rows=block, hot_most=most).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows)


def test_ranges_in_two_hops_and_blocks_by_postings(docs):
    rows = rows_of(13)
    want = brute(rows)
    for bounds in ({"fan": 2}, {"fan": 3, "block_postings": 300}, {"block_postings": 40, "block_rows": 50}):
        out = ngram_join.ngram_jaccard_components(docs(*rows), **bounds).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == want


def test_rows_that_share_an_id_are_documents_of_their_own(docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, None), (1, a), (1, b), (2, a + " end"), (None, b), (None, c), (7, c), (8, ""), (8, ""), (9, a)]
    out = [tuple(r) for r in ngram_join.ngram_jaccard_components(docs(*rows)).collect()]
    assert sorted(out, key=str) == sorted([(1, 0, 1), (1, 36, 1), (1, 36, 1), (2, 37, 1), (None, 36, 1), (None, 36, 7), (7, 36, 7), (8, 0, 8), (8, 0, 8), (9, 36, 1)], key=str)
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.one_of_each(docs(*rows)).collect()]
    assert sorted(kept, key=str) == sorted([(1, None), (1, a), (1, b), (7, c), (8, ""), (8, "")], key=str)


def test_long_near_copies_are_merged_about_once():
    import time

    rng = np.random.default_rng(4)
    base = np.sort(rng.choice(1 << 40, 20_000, replace=False))
    lists = []
    for _ in range(150):
        own = base.copy()
        own[rng.integers(0, len(own), 200)] = rng.integers(1 << 40, 1 << 41, 200)
        lists.append(np.unique(own))
    began = time.perf_counter()
    links = ngram_join.linked_in_block(np.arange(150), np.array([len(x) for x in lists]), lists, 80)
    assert len(links) == 149 and time.perf_counter() - began < 20


def test_clashing_names_pass(docs):
    from pyspark.sql import functions as F

    df = docs((1, "a b c d e f"), (2, "a b c d e f"), (2, "z"))
    for name in ("__key", "__row", "__gone", "__own", "__id", "__n", "__twice", "__at", "__m", "__c", "node", "component"):
        df = df.withColumn(name, F.lit(name))
    out = ngram_join.one_of_each(df)
    assert out.columns == df.columns and sorted((r["doc_id"], r["text"], r["__key"]) for r in out.collect()) == [(1, "a b c d e f", "__key"), (2, "z", "__key")]


def test_other_sizes_and_thresholds(docs):
    rows = rows_of(5)
    out = ngram_join.ngram_jaccard_components(docs(*rows), k=3, percent=50).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows, 3, 50)


def test_ties_at_the_threshold_link(docs):
    # sets of 9 and 9 with 8 in common: 8 / 10 is exactly the threshold
    a = [f"a{i}" for i in range(13)]
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_jaccard_components(docs((1, " ".join(a)), (2, " ".join([*a[:12], "z"])))).collect()}
    assert out == {1: 1, 2: 1}


def test_odd_rows(clashing, none):
    out = [tuple(r) for r in ngram_join.ngram_jaccard_components(clashing).collect()]
    by = {r[0]: r[1:] for r in out if r[0] is not None}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[5] == (1, 5) and by[4][1] == 4
    assert len(by) == 6 and sorted(r[1:] for r in out if r[0] is None) == [(0, None), (1, None)]
    assert ngram_join.ngram_jaccard_components(none).collect() == []


def test_one_of_each_keeps_one_document_of_a_group(docs, clashing):
    rows = rows_of(7)
    kept = [r["doc_id"] for r in ngram_join.one_of_each(docs(*rows)).collect()]
    assert sorted(kept) == sorted({c for _, c in brute(rows).values()})
    out = ngram_join.one_of_each(clashing)
    assert out.columns == clashing.columns and sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 0, 1, 2, 3, 4, 5, 6]
    wide = ngram_join.one_of_each(docs(*rows), most_broadcast=0)
    assert sorted(r["doc_id"] for r in wide.collect()) == sorted(kept)


def test_divide_skip_counts_as_plain_merging_does():
    rng = np.random.default_rng(0)
    for _ in range(30):
        lists = [np.sort(rng.choice(50, rng.integers(1, 40), replace=False)) for _ in range(8)]
        keys = np.concatenate([i * 50 + x for i, x in enumerate(lists)])
        plain = np.bincount(np.concatenate(lists), minlength=50)
        for need in (1, 3, 6, 8):
            order = sorted(range(8), key=lambda i: len(lists[i]))
            cut = 8 - min(need - 1, 5)
            found, count = ngram_join.divide_skip([lists[i] for i in order[:cut]], np.array(order[cut:], dtype=np.int64), keys, 50, need)
            assert found.tolist() == np.flatnonzero(plain >= need).tolist() and count.tolist() == plain[plain >= need].tolist()
