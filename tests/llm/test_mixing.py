"""Targets against the iterated definition, segments against the axis they are cut from."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from eventmarts.llm import mixing as M
from pyspark.sql import functions as F


def iterated(sizes, weights):
    """Share by weight, stop at twice the size, share the excess again."""
    goal = Fraction(3, 2) * sum(sizes)
    out = [Fraction(0)] * len(sizes)
    open_ = set(range(len(sizes)))
    while open_:
        left = goal - sum(out[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > 2 * sizes[i]}
        if not over:
            for i in open_:
                out[i] = share[i]
            break
        for i in over:
            out[i] = Fraction(2 * sizes[i])
        open_ -= over
    return [float(x) for x in out]


def test_targets():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 9)
        sizes = [rng.choice([0, 1, rng.randint(0, 50), rng.randint(0, 10_000)]) for _ in range(n)]
        weights = [M.WEIGHTS[i % 3] for i in range(n)]
        assert M.targets(sizes, weights) == pytest.approx(iterated(sizes, weights), rel=1e-12)


def test_split_tree_keeps_quotas_and_mixes():
    quotas = np.array([1000, 0, 3, 500])
    parts = M.split_tree(quotas, 7, np.random.default_rng(1))
    assert (parts.sum(axis=0) == quotas).all() and np.ptp(parts.sum(axis=1)) <= 3
    assert (parts[:, 0] > 80).all() and (parts[:, 3] > 30).all()
    # the draw is hypergeometric: mean and variance of one shard over many trees
    draws = np.array([M.split_tree(np.array([60, 40]), 4, np.random.default_rng(s))[2, 0] for s in range(800)])
    assert abs(draws.mean() - 15) < 0.3 and abs(draws.var() - 25 * .6 * .4 * 75 / 99) < 0.8


def _rows(n_sources=4, n=400, seed=3):
    rng = random.Random(seed)
    source = lambda: rng.choice(["a"] * 5 + ["b", "c", None][:n_sources - 1])
    return [(i, " ".join(f"w{k}" for k in range(rng.choice([0, 3, 50, 400]))), source()) for i in range(n)]


def test_mix_takes_the_targets(documents):
    docs = documents(_rows())
    mixed = M.mix(docs, block=16, shard_words=5000).collect()
    again = M.mix(docs.repartition(7), block=16, shard_words=5000).collect()
    key = lambda r: r["doc_id"]
    assert sorted(mixed, key=key) == sorted(again, key=key)
    by: dict = {}
    shards: dict = {}
    for r in mixed:
        taken = sum(s["n_words"] for s in r["segments"])
        assert taken <= 2 * r["size"] and all(s["n_words"] > 0 for s in r["segments"])
        for epoch in (0, 1):  # disjoint, gapless parts of each epoch
            own = sorted((s["first_word"], s["n_words"]) for s in r["segments"] if s["epoch"] == epoch)
            assert [a for a, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1])
        s = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        s[0] += taken
        s[1] += r["size"]
        for x in r["segments"]:
            shards[x["shard"]] = shards.get(x["shard"], 0) + x["n_words"]
    assert all(abs(t - target) <= 0.5 and size == n for t, size, target, n in by.values())
    assert len(shards) > 5 and max(shards.values()) < 5000 + 16 * 8


def test_runs_of_the_prefix_sum_do_not_matter(documents):
    docs = documents(_rows())
    one = sorted(M.lay_out(docs, digits=0)[0].collect(), key=str)
    assert all(sorted(M.lay_out(docs, digits=k)[0].collect(), key=str) == one for k in (None, 1, 3))


def test_mixed_documents_hold_the_words_taken(documents):
    docs = documents(_rows() + [(7, "same id again", "b"), (None, "no id here", "b"), (900, None, None)])
    plan = M.mix(docs).groupBy("source").agg(F.sum(M.words_taken(F.col("segments"))).alias("n"))
    want = {r["source"]: r["n"] for r in plan.collect() if r["n"]}
    out = M.mixed_documents(docs)
    got = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(M.word_count(F.col("text"))).alias("n")).collect()}
    assert got == want and out.columns == docs.columns
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0


def test_mixed_documents_are_the_parts_of_the_mix(documents, monkeypatch):
    """Every part that ``mix`` lists, cut from its text; no copy of the texts is written."""
    rows = [(i, t and " ".join(f"{w}-{i}" for w in t.split()), s) for i, t, s in _rows(n=150)]
    rows += [(1000, " \t" + "\n ".join(f"long{k}" for k in range(200_000)), "a")]  # several shards
    docs = documents(rows)
    segments = {r["doc_id"]: r["segments"] for r in M.mix(docs).collect()}
    want = []
    for i, text, _ in rows:
        spans = [m.span() for m in M._WORD.finditer(text)]
        for s in segments[i]:
            part = spans[s["first_word"]:s["first_word"] + s["n_words"]]
            want.append((i, text if s["n_words"] == len(spans) else text[part[0][0]:part[-1][1]]))
    assert len([1 for i, _ in want if i == 1000]) > 3
    written, stored = [], M.stored
    monkeypatch.setattr(M, "stored", lambda df, name: (written.append(df.schema.simpleString()), stored(df, name))[1])
    out = M.mixed_documents(docs)
    assert not [s for s in written if "text" in s]
    got = [tuple(r) for r in out.select("doc_id", "text").collect()]
    assert sorted(got) == sorted(want)
    assert [tuple(r) for r in M.mixed_documents(docs.repartition(5)).select("doc_id", "text").collect()] == got


def test_empty_tables_and_textless_sources(documents):
    assert M.mix(documents([])).count() == 0 and M.mixed_documents(documents([])).count() == 0
    out = M.mix(documents([(1, None, "a"), (2, " ", "a"), (2, "x y", None)])).collect()
    assert sorted((r["size"], r["target"], M.math.floor(r["target"])) for r in out) == [(0, 0, 0), (0, 0, 0), (2, 3, 3)]


def test_hypergeometric_draws_are_exact():
    """Log probabilities sum to one; draws follow them; urns far beyond 10**9 work."""
    rng = np.random.default_rng(3)
    for good, bad, n in [(5, 7, 4), (100, 3, 50), (20, 30, 45), (1, 9, 3), (40, 40, 40), (3, 3, 6), (0, 4, 2), (4, 0, 2), (4, 4, 0)]:
        p = np.exp([M.log_hypergeometric(x, good, bad, n) for x in range(n + 1)])
        assert abs(p.sum() - 1) < 1e-9
        draws = np.bincount([M.hypergeometric(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1)
        some = p * 20_000 > 5
        assert ((draws[some] - 20_000 * p[some]) ** 2 / (20_000 * p[some])).sum() < some.sum() + 5 * some.sum() ** 0.5 + 10
        assert draws[p < 1e-12].sum() == 0
    good, bad, n = 6 * 10 ** 12, 14 * 10 ** 12, 10 ** 13
    x = np.array([M.hypergeometric(rng, good, bad, n) for _ in range(4000)], float)
    sd = (n * 0.3 * 0.7 * 0.5) ** 0.5
    assert abs(x.mean() - 3e12) < 5 * sd / 4000 ** 0.5 and abs(x.std() / sd - 1) < 0.06


def test_plan_of_a_hundred_terabytes(monkeypatch):
    sizes = [("a", 10 ** 13), ("b", 6 * 10 ** 12), (None, 4 * 10 ** 12), ("c", 1)]
    plan = M.make_plan(sizes, max_plan=1 << 12)
    shards = 1 << 10
    total = np.zeros(shards, np.int64)
    for s, n in sizes:
        p = plan[s]
        parts = np.diff(np.concatenate([[0], p.ends]))
        assert len(np.unique(p.shards)) == len(p.shards)  # disjoint, each shard once
        assert 0 <= p.ends[-1] - p.quota < M.BLOCK_WORDS  # exact block quotas
        total[p.shards] += parts // M.BLOCK_WORDS
    assert total.max() - total.min() <= 1  # shards are of one size
    assert sum(p.quota for p in plan.values()) == pytest.approx(3 * 10 ** 13, rel=1e-9)
