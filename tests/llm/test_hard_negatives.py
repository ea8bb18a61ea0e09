"""The Hilbert curve, zone bounds, and mined negatives against brute force."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from eventmarts.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, x string, pos long, block long"


@pytest.mark.parametrize("dim,bits", [(1, 3), (2, 1), (2, 4), (3, 3), (5, 2)])
def test_the_curve_visits_every_cell_by_unit_steps(dim, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dim)))
    keys = [bytes(k) for k in H.hilbert(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product():
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (5, 40, 16))
    a = rng.integers(-300, 300, (30, 16))
    least, most = H.bounds(a, x.min(axis=1), x.max(axis=1))
    s = np.einsum("ad,bnd->abn", a, x)
    assert (least <= s.min(axis=2)).all() and (most >= s.max(axis=2)).all()
    one = x[:, 0]  # zones of a single vector are exact
    least, most = H.bounds(a, one, one)
    assert (least == a @ one.T).all() and (most == least).all()
    big = np.array([[1 << 27, -(1 << 27) + 1]])
    assert H.products(big, big)[0, 0] == (1 << 54) + ((1 << 27) - 1) ** 2


def brute(rows):
    ok = []
    for i, v, b, *_ in rows:
        if v and b is not None and None not in v and all(math.isfinite(c) for c in v):
            ok.append((i, (b + 1) % 10 if i is not None and i % 7 == 0 else b, [math.floor(256 * c) for c in v]))
    size = max((len(v) for *_, v in ok), key=lambda n: (sum(len(v) == n for *_, v in ok), n), default=0)
    ok = [r for r in ok if len(r[2]) == size]
    out = []
    key = lambda t: (-t[0], t[1] is None, t[1] or 0)
    for p, (i, b, v) in enumerate(ok):
        if i is None or i % 50:
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))  # noqa: E731, B023
        same = sorted(((score(w), j) for q, (j, c, w) in enumerate(ok) if c == b and q != p), key=key)[:5]
        other = sorted(((score(w), j) for j, c, w in ok if c != b), key=key)
        for ps, j in same:
            inside = [(s, k) for s, k in other if 50 * ps <= 100 * s <= 95 * ps][:3]
            out += [(i, j, r + 1, k, ps, s) for r, (s, k) in enumerate(inside)]
    return sorted(out, key=str)


def _rows(seed=1, n=900, dim=12):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((6, dim))
    v = centre[rng.integers(0, 6, n)] + 0.5 * rng.standard_normal((n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(int(i), [float(c) for c in np.float32(x)], int(rng.integers(0, 10)), "x", -1, -2)
            for i, x in zip(rng.permutation(3 * n)[:n], v)]
    hot = rows[0][1]
    rows += [(5000 + k, hot, 3, "x", -1, -2) for k in range(150)]  # a hot vector, many ties
    rows += [(6000 + k, hot, k % 9, "x", -1, -2) for k in range(40)]
    return rows + [
        (7000, None, 1, "x", 0, 0), (7050, [], 1, "x", 0, 0), (7100, [None] + [1.0] * (dim - 1), 1, "x", 0, 0),
        (7150, [float("nan")] + [1.0] * (dim - 1), 1, "x", 0, 0), (7200, hot, None, "x", 0, 0), (7250, [1.0], 1, "x", 0, 0),
        (7300, [float("inf")] * dim, 1, "x", 0, 0), (7350, [0.0] * dim, 2, "x", 0, 0), (None, hot, 4, "x", 0, 0)]


def _out(df):
    return sorted([tuple(r) for r in H.mine(df).collect()], key=str)


@pytest.mark.parametrize("small", [False, True])
def test_negatives_equal_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, shelves and pages
        for name, value in (("BLOCK_ROWS", 7), ("SHELF_BLOCKS", 3), ("PAGE_SHELVES", 4)):
            monkeypatch.setattr(H, name, value)
    rows = _rows()
    want = brute(rows)
    assert len(want) > 100
    assert _out(spark.createDataFrame(rows, SCHEMA)) == want


def test_negative_scores_repeated_rows_and_empty_tables(spark):
    rows = [(50, [-1.0, 0.3], 1, "x", 0, 0), (50, [-1.0, 0.3], 1, "x", 0, 0), (51, [1.0, 0.0], 1, "x", 0, 0),
            (52, [-0.7, 0.0], 2, "x", 0, 0), (53, [0.0, 0.0], 2, "x", 0, 0), (100, [0.0, 0.0], 2, "x", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _out(df) == brute(rows)
    assert H.mine(df.limit(0)).count() == 0 and H.mine(df.where("vec_id = 51")).count() == 0


def test_zones_leave_blocks_unread(spark, monkeypatch):
    """Clusters far apart: an anchor's windows need few of the shelves."""
    for name, value in (("BLOCK_ROWS", 8), ("SHELF_BLOCKS", 2)):
        monkeypatch.setattr(H, name, value)
    rng = np.random.default_rng(4)
    dim = 16
    centre = np.eye(dim)[rng.integers(0, dim, 1600)]
    rows = [(i, [float(c) for c in np.float32(v)], int(np.argmax(m)) % 10, "x", 0, 0)
            for i, (v, m) in enumerate(zip(centre + 0.02 * rng.standard_normal((1600, dim)), centre))]
    df = H.quantised(spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "cast(label as long) label", "embedding"), 256)
    index = H.Index(df, dim)
    anchors = index.rows.where("vec_id % 50 = 0").selectExpr(
        "pos as apos", "vec_id as anchor_id", "label", "x", "array(20000L) as lows", "array(70000L) as highs")
    read = sum(index.plan(anchors, False, first).count() for first in (True, False))
    assert index.shelves >= 100 and read < 0.25 * 32 * index.shelves
    assert _out(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
