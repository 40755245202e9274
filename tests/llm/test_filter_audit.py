"""The filters' audit against filters run one after another."""

import itertools
import math
import re

from quillspark.llm import filter_audit, queries


def plain(docs, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[at] == 1} for at in (0, 1))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))

    def fails(i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        tests = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search("[#$%&*|]", text)), i is not None and i > first[text])
        return {f for f, bad in zip("ABCDE", tests, strict=True) if bad}

    out, sums = {}, {}
    for part in {s or "" for *_, s in docs}:
        own = [(i, fails(i, t or "")) for i, t, s in docs if (s or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order):
                gone = [i for i, bad in left if f in bad]
                redundant = sum(f in bad for _, bad in own) - len(gone)
                left = [(i, bad) for i, bad in left if f not in bad]
                out[part, order, step + 1] = (len(left), len(gone), redundant, sum(bad == {f} for _, bad in own), sum(i in good for i in gone), sum(i in toxic for i in gone))
                sums[part, f] = sums.get((part, f), 0) + len(gone)
    return sorted((*k, *v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def test_orders_are_one_swap_apart():
    for n in range(1, 6):
        visited = filter_audit.orders(n)
        assert len({o for o, _ in visited}) == len(visited) == math.factorial(n)
        for (a, _), (b, at) in itertools.pairwise(visited):
            assert [i for i in range(n) if a[i] != b[i]] == [at, at + 1] and sorted(b) == sorted(a)


def test_odd_rows(spark, docs, clashing, none):
    words = " ".join(f"w{i}" for i in range(250))
    rows = [(i, words, "s") for i in (7, 7, 3, None)] + [(8, words + " #", "t"), (9, words.upper(), None), (10, "a " * 300, ""), (11, "a " * 300, "t"), (12, None, "t"), (13, "", None), (14, words + "x", "s"), (None, None, "s")]
    labels = [(7, 1, 0), (7, 0, 1), (3, None, None), (None, 1, 1), (8, 0, 1), (9, 1, 1), (14, 1, 0), (99, 1, 1)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", queries.F.lit(1))
    got = filter_audit.interactions(docs(*rows), known)
    assert sorted(map(tuple, got.collect())) == plain(rows, labels)
    assert filter_audit.interactions(none, known).collect() == []
    odd = [(r["doc_id"], r["text"], r["source"]) for r in clashing.collect()]
    assert sorted(map(tuple, filter_audit.interactions(clashing, known).collect())) == plain(odd, labels)


def test_query_against_plain_filters(spark, sf_dir):
    rows = sorted(map(tuple, queries.QUERIES["op13_filter_interactions"](spark, sf_dir).collect()))
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(*c).collect()]
    want = plain(read("documents", "doc_id", "text", "source"), read("labels", "doc_id", "quality", "toxic"))
    assert rows == want
