import numpy as np
import pytest

from llm_tools import Union
from quillspark.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.9):
    usable = {i: np.array(v, dtype=float) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    ids = sorted(usable)
    u, n = Union([i for i, _ in rows]), dict.fromkeys([i for i, _ in rows], 0)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = usable[a], usable[b]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                u.join(a, b)
                n[a] += 1
                n[b] += 1
    return {i: (n[i], u.top(i), u.top(i) == i) for i in n}


def clusters(seed, n=400, dim=64, spread=0.03):
    rng = np.random.default_rng(seed)
    bases = rng.normal(size=(60, dim))
    bases /= np.linalg.norm(bases, axis=1)[:, None]
    which = np.minimum(rng.integers(0, 120, n), 59)
    v = bases[which] + rng.normal(size=(n, dim)) * spread * rng.random((n, 1))
    alone = rng.random(n) < 0.5
    v[alone] = rng.normal(size=(alone.sum(), dim))
    return [(int(i), [float(np.float32(c)) for c in x]) for i, x in enumerate(v)]


def as_table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("seed,cell_rows", [(1, 4096), (2, 16)])
def test_links_match_brute_force(spark, seed, cell_rows):
    rows = clusters(seed)
    rows += [(1000 + i, rows[i][1]) for i in range(40)] + [(1100, [2 * c for c in rows[0][1]])]
    want = brute(rows)
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice.near_duplicates(as_table(spark, rows), cell_rows=cell_rows).collect()}
    assert out.keys() == want.keys() and all(out[i][0] <= want[i][0] for i in out)
    assert sum(o[0] for o in out.values()) >= 0.97 * sum(w[0] for w in want.values()) > 0
    assert np.mean([out[i][1] == want[i][1] for i in out]) > 0.97


def test_recall_on_pairs_at_the_edge(spark):
    rng = np.random.default_rng(9)
    a = rng.normal(size=(300, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    c = 0.905 * a + np.sqrt(1 - 0.905**2) * b
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, c]))]
    found = sum(r["n_links"] for r in lattice.near_duplicates(as_table(spark, rows)).collect()) / 2
    assert 0.9 * 300 <= found <= 300


def test_pairs_at_the_threshold_itself(spark):
    """Vectors of small integers, of which many pairs have a cosine of exactly 0.9; integers tell what is due."""
    every = np.array(np.meshgrid(*[np.arange(8)] * 4)).reshape(4, -1).T
    every = every[(every.sum(axis=1) > 0) & (np.gcd.reduce(every, axis=1) == 1)]
    dot, size = every @ every.T, (every**2).sum(axis=1)
    a, b = np.nonzero(np.triu(100 * dot**2 == 81 * np.multiply.outer(size, size)))
    assert len(a) > 780
    some = np.unique(np.concatenate([a, b])[np.random.default_rng(3).permutation(2 * len(a))[:500]])
    rows = [(1, [0, 1, 2, 2]), (2, [1, 3, 9, 3]), *[(10 + i, every[v].tolist()) for i, v in enumerate(some)]]
    v = np.array([v for _, v in rows])
    dot, size = v @ v.T, (v**2).sum(axis=1)
    near = 100 * dot**2 >= 81 * np.multiply.outer(size, size)
    exact = (100 * dot**2 == 81 * np.multiply.outer(size, size)).sum() // 2
    table = as_table(spark, [(i, [float(c) for c in v]) for i, v in rows])
    out = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(table).collect()}
    assert exact > 100 and [out[i] for i, _ in rows] == (near.sum(axis=1) - 1).tolist()
    only = {r["vec_id"]: tuple(r)[1:] for r in lattice.near_duplicates(as_table(spark, [(i, [float(c) for c in v]) for i, v in rows[:2]])).collect()}
    assert only == {1: (1, 1, True), 2: (1, 1, False)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [3.0, 0.0]), (9, [1.0]), (10, [1e-30, 0.0]), (11, [-1.0, 0.0])]
    table = as_table(spark, [*rows, (7, [1.0, 0.0]), (None, [1.0, 0.0])]).withColumnRenamed("label", "id")
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice.near_duplicates(table).collect()}
    assert out.pop(None) == (0, None, True)
    assert out == brute(rows) and out[7] == (2, 7, True) and out[10] == (2, 7, False)
    assert lattice.near_duplicates(table.limit(0)).collect() == []


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)) * 2
    got = lattice.nearest_e8(x) / 2
    near = ((x - got) ** 2).sum(1)
    for r in lattice.ROOTS:
        assert (near <= ((x - got - r) ** 2).sum(1) + 1e-9).all()
    # points of E8: all integers or all halves, with an even sum
    assert (np.mod(got, 1) == np.mod(got[:, :1], 1)).all() and (np.mod(got.sum(1), 2) == 0).all()
    assert len(lattice.ROOTS) == 240 and np.allclose((lattice.ROOTS**2).sum(1), 2)


def test_float64_vectors(spark):
    table = spark.createDataFrame([(1, [1.0, 0.1]), (2, [1.0, 0.1000001]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r)[:3] for r in lattice.near_duplicates(table).collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_recall_of_the_one_grid_at_the_edge(spark):
    rng = np.random.default_rng(21)
    a = rng.normal(size=(1000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    c = 0.9005 * a + np.sqrt(1 - 0.9005**2) * b
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, c]))]
    v = np.concatenate([a, c])
    due = np.count_nonzero(np.triu(v @ v.T >= 0.9, 1))
    found = sum(r["n_links"] for r in lattice.near_duplicates(as_table(spark, rows)).collect()) / 2
    assert 0.97 * due <= found <= due


@pytest.mark.parametrize("dim", [16, 64, 256, 768])
def test_recall_at_the_threshold(dim):
    """Pairs at cosine 0.9 just meet: the share that lives or probes where the other lives."""
    rng = np.random.default_rng(dim)
    n = 400
    a = rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(n, dim))
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.9005 * a + np.sqrt(1 - 0.9005**2) * b / np.linalg.norm(b, axis=1)[:, None]
    tables, blocks, width = lattice.GRID
    (ha, na), (hb, nb) = (lattice.cells(v, tables, blocks, 3, width, 11) for v in (a, b))
    meets = (ha == hb) | (na == hb[:, :, None]).any(axis=2) | (nb == ha[:, :, None]).any(axis=2)
    assert meets.any(axis=1).mean() >= 0.9
