import hashlib
import itertools

import numpy as np
import pytest

from llm_tools import words
from quillspark.llm import mixing, packing


def shares(sizes, weights=(5, 2, 1), limit=3.0):
    """Targets by handing out the excess again and again."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += left * w[s] / total
        left = sum(max(0.0, target[s] - limit * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= limit * sizes[s] - 1e-9:
                target[s] = limit * sizes[s]
                open_.discard(s)
    return target


def corpus():
    names = ["a", "b", "c", "Z", "é", None, "tiny", "zero"]
    out, i = [], 0
    for s, n in zip(names, (300, 200, 250, 100, 60, 90, 2, 1), strict=True):
        for j in range(n):
            out.append((i, None if s == "zero" else " ".join(["w"] * (1 + (i * 7 + j) % 40)), s))
            i += 1
    return out


def test_mixture_matches_plain_arithmetic(docs):
    rows = corpus()
    size = {i: len(words(t)) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    sizes = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    target = shares(sizes)
    out = mixing.mixture(docs(*rows)).collect()
    assert len(out) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        draw = int(hashlib.md5(f"17:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        assert r["copies"] == int(rate + 1e-12) + (draw < rate - int(rate + 1e-12)) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.2 * target[s] + 60 for s in sizes)
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mixture(docs(*rows).repartition(7)).collect()))


def test_mixed_emits_the_copies(docs):
    rows = corpus()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixture(docs(*rows)).collect()}
    seen = dict.fromkeys(copies, 0)
    for r in mixing.mixed(docs(*rows)).collect():
        seen[r["doc_id"]] += 1
    assert seen == copies


def test_mixing_odd_rows(clashing, none):
    out = mixing.mixture(clashing).collect()
    assert len(out) == clashing.count() and sum(r["target"] for r in {(r["source_size"], r["target"]): r for r in out}.values()) == pytest.approx(sum(r["size"] for r in out))
    assert mixing.mixed(clashing).columns == clashing.columns
    assert mixing.mixture(none).collect() == [] and mixing.mixed(none).collect() == []


def test_boundaries_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(25):
        top = np.sort(rng.choice(np.arange(1, 200), 9, replace=False))
        count = rng.integers(1, 50, 9)
        total = top * count - rng.integers(0, 5, 9)
        for k in (1, 2, 4, 20):
            cost = lambda ends: sum(top[b] * count[a : b + 1].sum() - total[a : b + 1].sum() for a, b in zip([0, *(e + 1 for e in ends[:-1])], ends, strict=True))
            best = min(cost((*c, 8)) for n in range(min(k, 9)) for c in itertools.combinations(range(8), n))
            ends = packing.boundaries(top, count, total, k)
            assert len(ends) <= k and cost(ends) == best
    assert packing.boundaries(np.zeros(0), np.zeros(0), np.zeros(0), 4) == []


def test_batches_hold_every_row_once_within_the_budget(docs):
    rows = [(i, " ".join(["w"] * ((i * 37) % 900))) for i in range(1500)] + [(9999, " ".join(["w"] * 5000)), (7, " ".join(["w"] * 259))]
    out = packing.packed(docs(*rows), buckets=6, budget=2048, shard_rows=300).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(r[0] for r in rows)
    batches = {}
    for r in out:
        batches.setdefault(r["batch_id"], []).append(r)
        assert r["length"] <= r["bucket_length"]
    for b in batches.values():
        assert len({r["bucket"] for r in b}) == 1 and sorted(r["position"] for r in b) == list(range(len(b)))
        assert len(b) == 1 or len(b) * b[0]["bucket_length"] <= 2048
    # without shards, only the last batch of a bucket may be short
    whole = packing.packed(docs(*rows), buckets=6, budget=2048).collect()
    for bucket in {r["bucket"] for r in whole}:
        own = [r for r in whole if r["bucket"] == bucket]
        fits = max(1, 2048 // max(1, own[0]["bucket_length"]))
        assert len({r["batch_id"] for r in own}) == -(-len(own) // fits)


def test_packing_odd_rows(clashing, none):
    out = packing.packed(clashing).collect()
    assert len(out) == clashing.count() and {r["length"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert packing.packed(none).collect() == []


def plain_packing(lengths, ends, tops, budget):
    """Sizes of the batches of each bucket, one document after the other."""
    out = []
    for b, (low, high) in enumerate(zip([-1, *ends], ends, strict=False)):
        own = [n for n in lengths if low < n <= high]
        fits = max(1, budget // max(1, tops[b]))
        out += [(b, min(fits, len(own) - i)) for i in range(0, len(own), fits)]
    return sorted(out)


def test_batches_are_filled_as_plainly(docs):
    from collections import Counter

    from tokenizers import Tokenizer

    from quillspark.llm.queries import tokenizer_path

    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["word"] * int(rng.choice([0, 1, 3, 30, 200, 450])))) for i in range(300)]
    for path in (None, tokenizer_path()):
        tokens = Tokenizer.from_file(path) if path else None
        lengths = [len(tokens.encode(t, add_special_tokens=False).ids) + 1 if path else len(words(t)) for _, t in rows]
        out = packing.packed(docs(*rows), path, buckets=3, budget=2000).collect()
        assert {r["doc_id"]: r["length"] for r in out} == dict(enumerate(lengths))
        # the best three buckets by trying all
        seen = sorted(set(lengths))
        cost = lambda ends: sum(min(e for e in ends if e >= n) - n for n in lengths)
        least = min(cost((*ends, seen[-1])) for k in range(3) for ends in itertools.combinations(seen[:-1], k))
        tops = sorted({r["bucket_length"] for r in out})
        assert sum(r["bucket_length"] - r["length"] for r in out) == least == cost(tops)
        assert sorted(Counter(r["batch_id"] for r in out).values()) == sorted(n for _, n in plain_packing(lengths, tops, tops, 2000))
