"""Extendible-hash dedup against a plain dictionary."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from eventmarts.llm import exact_dedup as D
from pyspark.sql import functions as F

ROWS = ([(i, f"text {i % 40}", "s") for i in range(200)] + [(500 + i, "hot " * 50, "s") for i in range(300)]
        + [(900, None, "s"), (901, "", None), (902, " ", "s"), (903, "Text 1", "s"), (904, "text 1 ", "s"),
           (905, "é", "s"), (906, "é", "s"), (907, "長" * 200_000, "s"), (908, "長" * 200_000, "s"), (909, "長" * 199_999, "s")]
        + [(950, "again", "s")] * 3 + [(None, "no id", "s"), (None, "no id", "s"), (None, "one id", "s"), (960, "one id", "s")])


def brute(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            keep = i == top and not kept
            kept |= keep
            out.append((i, top, len(ids), keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def _out(df):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
                   for r in D.dedup(df).collect()], key=str)


@pytest.mark.parametrize("collide", [0, 5])
def test_equals_a_dictionary(spark, documents, monkeypatch, collide):
    if collide:  # different texts share a key and are told apart by their bytes
        monkeypatch.setattr(D, "_key", lambda body: F.pmod(F.xxhash64(body), F.lit(collide)) - 2)
    assert _out(documents(ROWS).repartition(6)) == brute(ROWS)


def test_clashing_columns_and_empty_table(spark, documents):
    df = documents([(1, "a", "s"), (2, "a", "t")]).selectExpr("*", "1 as row", "2 as key", "3 as sha", "4 as n", "5 as keep_id")
    assert [(r[0], r[1], r[2], r[3]) for r in _out(df)] == [(1, 2, 2, False), (2, 2, 2, True)]
    assert D.dedup(df.limit(0)).count() == 0


def test_buckets_split_by_bits():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 61, 3000, dtype=np.uint64),
                                     np.arange(500, dtype=np.uint64)]))  # and a run of close keys
    start, depth = D.split_buckets(keys, 3, 64)
    ends = np.append(start[1:], len(keys))
    for s, e, d in zip(start, ends, depth):
        assert 0 < e - s <= 64
        lead = {int(k) >> (64 - int(d)) for k in keys[s:e]}
        assert len(lead) == 1
        parent = int(keys[s]) >> (65 - int(d))  # it was split because its parent was overfull
        assert d == 3 or sum((int(k) >> (65 - int(d))) == parent for k in keys) > 64
    assert depth.max() > depth.min() + 10
    assert len(D.split_buckets(keys[:0], 3, 64)[0]) == 0


def test_index_files(spark, documents, monkeypatch):
    monkeypatch.setattr(D, "BUCKET_KEYS", 2)
    _, index = D.index_documents(documents(ROWS))
    table = D.directory(index).collect()
    assert all(r["keys"] <= 2 and r["depth"] <= r["global_depth"] for r in table)
    assert len(table) > 20 and len({r["global_depth"] for r in table}) > 1
    assert index.count() == len({t or "" for _, t, _ in ROWS})
    for r in index.collect():
        assert (r["key"] % (1 << 64)) >> (64 - r["depth"]) == r["prefix"] % (1 << 64)


def test_texts_that_change_between_reads_are_noticed(spark, documents):
    docs = documents([(1, "a", "s"), (2, "a", "s"), (3, "b", "s")])
    rows = D.keyed(docs)
    entries = rows.groupBy("key", "sha").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
    links = D.chains(docs.where("doc_id <> 1"), entries.select("key"))
    with pytest.raises(Exception, match="differ in their bytes"):
        D.build_index(entries, links).collect()
