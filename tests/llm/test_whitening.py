"""Spectrum slicing against a dense solver; whitening against a plain computation."""

from __future__ import annotations

import numpy as np
import pytest
from eventmarts.llm import spectrum as S
from eventmarts.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long"


def _symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    a = q * np.array(values, float) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    range(1, 65), [5.0], [3.0] * 12, [9, 9, 9, 4, 4, 1, 0, 0, 0], [1e9, 1, 1 + 1e-9, 1e-9, 0],
    [7 - 1e-12 * k for k in range(6)] + [1.0] * 20, [2, 1, 0, -1, -2]])
def test_leading_pairs(values):
    a = _symmetric(list(values))
    e, v = S.leading(a, 16)
    want = np.sort(np.array(list(values), float))[::-1][:16]
    scale = np.abs(a).sum(axis=1).max()
    assert np.abs(e - want).max() <= 1e-13 * scale * len(a)
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-12
    assert np.abs(a @ v - v * e).max() <= 1e-12 * scale
    assert (np.diff(e) <= 0).all()


def test_counts_are_inertia():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 8, 40):
        for _ in range(20):
            a = rng.integers(-3, 4, (n, n)).astype(float)  # zero pivots on the way
            a = a + a.T
            for s in rng.uniform(-10, 10, 5):
                assert S.count_above(a, s) == (np.linalg.eigvalsh(a) > s).sum()
    assert S.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_zero_and_empty_matrices():
    e, v = S.leading(np.zeros((3, 3)), 16)
    assert e.tolist() == [0, 0, 0] and v.shape == (3, 3)
    assert len(S.leading(np.zeros((0, 0)), 16)[0]) == 0


def _rows(dim=20, n=150, seed=3):
    rng = np.random.default_rng(seed)
    v = np.float32(rng.standard_normal((n, dim)) * np.linspace(1, 0.2, dim) @ rng.standard_normal((dim, dim)))
    rows = [(i, [float(c) for c in x], 1, "x", 5) for i, x in enumerate(v)]
    rows += [(1000 + k, rows[0][1], None, "x", 5) for k in range(80)]  # a hot vector
    rows += [(5, rows[5][1], 1, "x", 5), (None, rows[6][1], 1, "x", 5)]
    return rows


BAD = [(2000, None, 1, "x", 5), (2001, [], 1, "x", 5), (2002, [None] + [1.0] * 19, 1, "x", 5),
       (2003, [float("nan")] + [1.0] * 19, 1, "x", 5), (2004, [float("-inf")] + [1.0] * 19, 1, "x", 5),
       (2005, [1e30] * 20, 1, "x", 5), (2006, [1.0] * 19, 1, "x", 5)]


def test_whitening_equals_a_plain_computation(spark):
    rows = _rows()
    out = W.whiten(spark.createDataFrame(rows + BAD, SCHEMA)).collect()
    assert len(out) == 16 * len(rows)
    whole = lambda v: [int(np.floor(64 * float(c))) + 1_000_000 for c in v]
    fit = sorted({tuple(whole(r[1])) for r in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    assert n == 150 and {r["n"] for r in out} == {n}
    x = np.array(fit, float)
    cov = np.cov(x.T, bias=True)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:16], v[:, ::-1][:, :16]
    by = {}
    for r in out:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    sign = None
    for i, emb, *_ in rows:
        y = whole(emb)
        want = (np.array([n * a - s for a, s in zip(y, sums)]) / n) @ v / np.sqrt(e)
        got = np.array([by[i, k][0]["whitened"] for k in range(1, 17)])
        sign = np.sign(got * want) if sign is None else sign
        assert np.abs(got - sign * want).max() < 1e-9
        assert int(by[i, 1][0]["deviation"]) == sum((n * a - s) ** 2 for a, s in zip(y, sums))
    for k in range(16):
        assert by[0, k + 1][0]["explained"] == pytest.approx(e[k] / np.trace(cov), rel=1e-12)
    assert len(by[5, 1]) == 2 and len(by[None, 1]) == 1
    assert out[0]["identity_error"] < 1e-9


def test_large_entries_stay_exact(spark):
    big = [(i, [float(1 << 41) * ((i * 7) % 5), float(i * i)], 1, "x", 5) for i in range(9)]
    out = W.whiten(spark.createDataFrame(big, SCHEMA)).collect()
    fit = [(64 * (1 << 41) * ((i * 7) % 5) + 1_000_000, 64 * i * i + 1_000_000) for i in range(9)]
    sums = [sum(c) for c in zip(*fit)]
    want = {i: sum((9 * a - s) ** 2 for a, s in zip(f, sums)) for i, f in enumerate(fit)}
    assert {r["vec_id"]: int(r["deviation"]) for r in out} == want
    assert len(out) == 9  # the other direction has no variance beside this one


def test_rank_and_empty_tables(spark):
    few = spark.createDataFrame(_rows(20, 4)[:4], SCHEMA)
    out = W.whiten(few).collect()
    assert {r["component"] for r in out} == {1, 2, 3} and out[0]["identity_error"] < 1e-9
    assert W.whiten(few.limit(1)).count() == 0 and W.whiten(few.limit(0)).count() == 0
    assert W.whiten(spark.createDataFrame(BAD[:2], SCHEMA)).count() == 0


def test_sums_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    one, many = (sorted(W.whiten(df.repartition(p)).where("vec_id is not null").collect()) for p in (1, 7))
    assert [(r["vec_id"], r["component"], r["explained"], r["deviation"]) for r in one] == \
        [(r["vec_id"], r["component"], r["explained"], r["deviation"]) for r in many]
