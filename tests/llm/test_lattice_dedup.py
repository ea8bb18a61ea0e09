"""E8 decoding and near-duplicate links against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from eventmarts.llm import lattice_dedup as L

SCHEMA = "vec_id long, embedding array<float>, label int, kept string"


def test_neighbours_and_decoding():
    near = L.neighbours()
    assert len({tuple(v) for v in near}) == 240 and np.allclose((near ** 2).sum(axis=1), 2)
    x = np.random.default_rng(1).uniform(-3, 3, (2000, 8))
    point = L.decode_e8(x)
    doubled = np.rint(point * 2)
    assert (doubled % 2 == doubled[:, :1] % 2).all() and (point.sum(axis=1) % 2 == 0).all()
    assert ((x - point) ** 2).sum(axis=1).max() <= 1 + 1e-9  # the covering radius
    for v in near:  # no neighbour is nearer
        assert (((x - point - v) ** 2).sum(axis=1) >= ((x - point) ** 2).sum(axis=1) - 1e-9).all()


def brute(rows):
    ok = [(i, np.array(v, float), b) for i, v, b, _ in rows if v and b is not None and None not in v
          and np.isfinite(np.array(v, float)).all() and any(v)]
    near = {i: {j for j, w, c in ok if j != i and b == c and len(v) == len(w)
                and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98} for i, v, b in ok}
    out = {i: (i, 0, True) for i, *_ in rows}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (min(seen), len(near[i]), i == min(seen))
    return out


def _vectors(seed=1, dim=32):
    rng = np.random.default_rng(seed)
    rows, f = [], lambda v: [float(x) for x in np.float32(v)]
    for k in range(60):
        centre = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 6)):
            rows.append((len(rows), f(centre + rng.normal(0, rng.choice([0.02, 0.1, 0.14]), dim)), int(k % 3), "x"))
    hot = rng.standard_normal(dim)
    rows += [(1000 + k, f(hot + rng.normal(0, 0.08, dim)), 1, "x") for k in range(120)]
    rows += [(2000 + k, f(hot), 1, "x") for k in range(40)]
    rows += [(3000, None, 1, "x"), (3001, [], 1, "x"), (3002, [0.0] * dim, 1, "x"), (3003, [None] + [1.0] * (dim - 1), 1, "x"),
             (3004, [float("nan")] + [1.0] * (dim - 1), 1, "x"), (3005, [float("inf")] + [1.0] * (dim - 1), 1, "x"),
             (3006, f(hot), None, "x"), (3007, f(hot), 2, "x"), (3008, f(hot[:9]), 1, "x"), (3009, f(hot[:9] * 2), 1, "x"),
             (3010, [2.0], 1, "x"), (3011, [3.0], 1, "x")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_links_equal_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(L, "CELL_VECTORS", 16)
    rows = _vectors()
    out = {r["vec_id"]: (r["component_id"], r["n_links"], r["kept"])
           for r in L.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute(rows)
    assert sum(n for _, n, _ in want.values()) > 10_000
    assert out == want


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    for dim in (16, 64, 384):
        u = rng.standard_normal((1000, dim))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        w = rng.standard_normal((1000, dim))
        w -= (w * u).sum(axis=1, keepdims=True) * u
        w /= np.linalg.norm(w, axis=1, keepdims=True)
        v = 0.98 * u + np.sqrt(1 - 0.98 ** 2) * w
        (a, pa_), (b, pb) = (L.hash_vectors(x, np.zeros(1000, np.int64)) for x in (u, v))
        met = (a == b) | (pa_ == b[:, :, None]).any(axis=2) | (pb == a[:, :, None]).any(axis=2)
        assert met.any(axis=1).mean() >= 0.999


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (None, [2.0, 0.0], 1, "x"), (None, [0.0, 1.0], 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sorted((r["vec_id"] or 0, r["component_id"] or 0, r["n_links"], r["kept"]) for r in L.near_duplicates(df).collect())
    assert out == [(0, 0, 0, True), (0, 1, 2, False), (1, 1, 2, True), (1, 1, 2, True)]
    assert L.near_duplicates(df.limit(0)).count() == 0
