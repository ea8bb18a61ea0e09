"""The Bloom filter holds back no member, few others, and copes with none and with too many."""

from __future__ import annotations

import pytest
from eventmarts.plans import bloom
from pyspark.sql import functions as F


@pytest.mark.parametrize("most", [28, 15])
def test_members_pass(spark, monkeypatch, most):
    monkeypatch.setattr(bloom, "MOST_BITS", most)
    ids = spark.range(60_000).select(F.xxhash64("id").alias("h"), "id")
    held = bloom.Bloom(ids.where("id < 20000"), "h")
    out = ids.where(held.may_hold(F.col("h"))).selectExpr(
        "count(if(id < 20000, 1, null)) as members", "count(if(id >= 20000, 1, null)) as others").first()
    assert out["members"] == 20_000
    assert out["others"] < 1_500 if most == 28 else out["others"] <= 40_000


def test_no_members(spark):
    ids = spark.range(100).select(F.xxhash64("id").alias("h"))
    assert ids.where(bloom.Bloom(ids.limit(0), "h").may_hold(F.col("h"))).count() == 0
