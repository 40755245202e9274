import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_tools import words
from quillspark.llm import quality, rules


def counts(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


def good(rng):
    return "\n".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(8, 20))).capitalize() + "." for _ in range(rng.randint(6, 12)))


def bad(rng):
    text = good(rng)
    return rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "### "), text.replace(" ", " | "), " ".join(x for x in words(text)[:9] for _ in range(12))])


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows = [(i, bad(rng) if i % 4 == 0 else good(rng)) for i in range(500)]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return table, spark.createDataFrame([(i, int(i % 4 != 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int"), dict(rows)


def test_base_counts_match_brute_force(docs, labelled):
    rng = random.Random(1)
    odd = [(i, "".join(rng.choice(["a b c", " ", "\n", "\n\n", "x", "é|", "日本 ", "#", "\t", "a b c\n", "\x1f", " "]) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows = [*odd, (900, None), (901, ""), *[(1000 + i, t) for i, t in list(labelled[2].items())[:60]]]
    out = rules.judged(docs(*rows), labelled[1]).collect()
    assert {r["doc_id"]: tuple(r[c] for c in rules.COUNTS) for r in out} == {i: counts(t) for i, t in rows}
    for r in out:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_forest_keeps_good_rows_and_rejects_bad_ones(labelled):
    table, labels, _ = labelled
    out = {r["doc_id"]: r["kept"] for r in rules.judged(table, labels).collect()}
    assert np.mean([out[i] for i in out if i % 4]) > 0.97 and np.mean([out[i] for i in out if i % 4 == 0]) < 0.2
    assert out == {r["doc_id"]: r["kept"] for r in rules.judged(table.repartition(5), labels.repartition(3)).collect()}
    assert sorted(r["doc_id"] for r in rules.passing(table, labels).collect()) == sorted(i for i, k in out.items() if k)


def test_paths_isolate_what_is_apart():
    rng = np.random.default_rng(0)
    rows = np.column_stack([rng.normal(0, 1, 800), np.zeros(800)])
    score = rules.anomaly(rules.grow_forest(rows), np.array([[0.0, 0.0], [9.0, 0.0], [0.0, 4.0]]))
    assert score[0] < score[1] and score[0] < score[2]


def test_rules_odd_rows(clashing, none, labelled):
    labels = labelled[1]
    assert rules.judged(clashing, labels).count() == clashing.count()
    assert rules.passing(clashing, labels).columns == clashing.columns
    assert rules.judged(none, labels).collect() == [] and rules.judged(clashing, labels.limit(0)).count() == clashing.count()


def test_trees_separate_held_out_rows(labelled):
    table, labels, texts = labelled
    out = {r["doc_id"]: r for r in quality.scored(table, labels).collect()}
    held = [r for r in out.values() if r["held_out"]]
    assert 50 < len(held) < 150 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 != 0) for r in held]) > 0.95
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    again = {r["doc_id"]: r["score"] for r in quality.scored(table.repartition(6), labels.repartition(2)).collect()}
    assert again == {i: r["score"] for i, r in out.items()}


def test_held_out_labels_are_never_learned(labelled):
    from pyspark.sql import functions as F

    table, labels, _ = labelled
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda x: {r["doc_id"]: r["score"] for r in quality.scored(table, x).collect()}
    assert scores(labels) == scores(flipped)


def test_flat_trees_match_a_walk_by_hand():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float)
    model = quality.grow(x, y, trees=15)

    def one(row):
        margin = np.log(y.mean() / (1 - y.mean()))
        for t in range(15):
            at = 0
            while model["feature"][t, at] >= 0:
                at = 2 * at + 1 + int(row[model["feature"][t, at]] > model["cut"][t, at])
            margin += model["value"][t, at]
        return 1 / (1 + np.exp(-margin))

    got = quality.score(model, x)
    assert np.allclose(got, [one(r) for r in x]) and np.mean((got > 0.5) == (y > 0.5)) > 0.9


def test_quality_odd_rows(clashing, none, labelled):
    labels = labelled[1]
    out = quality.scored(clashing, labels).collect()
    assert len(out) == clashing.count() and all(r["held_out"] is not None and 0 <= r["score"] <= 1 for r in out)
    assert quality.scored(none, labels).collect() == []
    assert {r["score"] for r in quality.scored(clashing, labels.limit(0)).collect()} == {0.5}


def test_the_cut_comes_from_all_labelled_rows(spark, labelled):
    docs, labels, _ = labelled
    forest, cut = rules.fit_rules(docs, labels, rows=60, good_loss=0.01)
    seen = rules.labelled_counts(docs, labels, 10**6)
    grew = rules.labelled_counts(docs, labels, 60).sort_values(["doc_id", *rules.COUNTS])

    def usable(part):
        counts = part[[*rules.COUNTS, *rules.EXTRA]].to_numpy(np.int64)
        return part[~rules.base_failed(counts)]

    grown = usable(grew)
    spent = set(grown[grown["quality"] == 1]["doc_id"].tolist()[::2])
    rest = usable(seen[~seen["doc_id"].isin(spent)])
    score = rules.anomaly(forest, rules.ratios(rest[[*rules.COUNTS, *rules.EXTRA]].to_numpy(np.int64)))
    good = rest["quality"].to_numpy() == 1
    assert good.sum() > 60 and cut == pytest.approx(rules.calibrated(score[good], score[~good], 0.01), abs=1e-12)


@pytest.mark.parametrize("n,q", [(1, 0.5), (2, 0.999), (101, 0.02), (1000, 0.999), (50, 0.5)])
def test_quantiles_of_a_table_are_those_of_the_array(spark, n, q):
    values = np.random.default_rng(n).random(n)
    table = spark.createDataFrame([(float(v),) for v in values], "score double")
    assert rules._quantile(table, q, n) == pytest.approx(np.quantile(values, q), abs=1e-12)


def test_ranks_by_histograms(spark):
    values = np.round(np.random.default_rng(8).random(700) ** 9, 3)
    table = spark.createDataFrame([(float(v),) for v in values], "score double")
    for rank in (0, 1, 350, 690, 699):
        assert rules._ranked(table, rank, bins=8, few=5) == np.sort(values)[rank]


def plain_grown(x, y, trees, depth, rate, least, shrink):
    """Margins of boosted trees by trying every cut of every feature at every node, one row at a time."""
    share = sum(y) / len(y)
    margin = [np.log(share / (1 - share))] * len(y)

    def leaf(rows, g, h):
        return -rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + shrink)

    def fall(rows, g, h, left):
        best = (1e-9, None)
        for f in range(len(x[0])):
            for cut in sorted({x[i][f] for i in rows})[:-1]:
                low, high = [i for i in rows if x[i][f] <= cut], [i for i in rows if x[i][f] > cut]
                part = lambda r: sum(g[i] for i in r) ** 2 / (sum(h[i] for i in r) + shrink)
                gain = part(low) + part(high) - part(rows)
                if min(len(low), len(high)) >= least and gain > best[0] + 1e-9:
                    best = (gain, (low, high))
        if not left or best[1] is None:
            return {i: leaf(rows, g, h) for i in rows}
        return fall(best[1][0], g, h, left - 1) | fall(best[1][1], g, h, left - 1)

    for _ in range(trees):
        p = [1 / (1 + np.exp(-m)) for m in margin]
        step = fall(list(range(len(y))), [a - b for a, b in zip(p, y, strict=True)], [a * (1 - a) for a in p], depth)
        margin = [m + step[i] for i, m in enumerate(margin)]
    return margin


def test_grown_trees_match_plain_ones():
    rng = np.random.default_rng(6)
    # few distinct values, so that bins and values are the same cuts
    x = rng.integers(0, 6, (60, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (rng.random(60) < 0.2)).astype(float)
    model = quality.grow(x, y, trees=4, depth=2, rate=0.3, bins=64, least=5)
    want = plain_grown(x.tolist(), y.tolist(), 4, 2, 0.3, 5, 1.0)
    assert np.allclose(quality.score(model, x), 1 / (1 + np.exp(-np.array(want))))


def test_path_lengths_match_a_plain_walk():
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(300, 4))
    forest = rules.grow_forest(rows, trees=20, sample=64, seed=3)
    probe = np.concatenate([rows[:30], rng.normal(size=(30, 4)) * 5])

    def depth(x):
        total = 0.0
        for feature, cut, path in zip(forest["feature"], forest["cut"], forest["path"], strict=True):
            at, level = 0, 0
            while feature[at] >= 0:
                at, level = 2 * at + (1 if x[feature[at]] < cut[at] else 2), level + 1
            assert path[at] >= level
            total += path[at]
        return total / 20

    want = [2 ** (-depth(x) / forest["norm"][0]) for x in probe]
    assert np.allclose(rules.anomaly(forest, probe), want)
    harmonic = lambda n: sum(1 / i for i in range(1, n))
    assert all(abs(rules._mean_path(n) - (2 * harmonic(n) - 2 * (n - 1) / n)) < 1.1 / (n - 1) for n in range(3, 40))


def test_repeated_labelled_ids_are_learnt_once(docs, spark):
    rows = [(i % 5, f"word{i} of a text " * 20) for i in range(50)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    assert len(rules.labelled_counts(docs(*rows), labels, 4)) == 4
