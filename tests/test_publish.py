"""Publication as one step: crashes, concurrent writers, old readers, clearing."""

from __future__ import annotations

import os

import pytest

from eventmarts.operators import quality
from eventmarts.plans import pipeline
from eventmarts.sinks import publish as P
from eventmarts.sources.bronze import read_mart
from tests.conftest import HIST_ROOT, STREAM_ROOT

STRICT = [t for t in quality.MODEL_TESTS if t[2] != "user_id"]
TABLES = ("stg_events_stream", "stg_events_historical", "fct_events", "fct_sessions", "dim_date",
          "mart_funnel_analysis", "mart_dau_wau_mau", "mart_retention")


def _table(spark, wh, name, value):
    path = os.path.join("_runs", f"r{value}", name)
    spark.range(value).write.parquet(os.path.join(wh, path))
    return {"": path}


def test_versions_follow_each_other(spark, scratch):
    wh = os.path.join(scratch, "wh")
    assert P.current(spark, wh) == P.Version() and P.read_published(spark, wh, "t") is None
    one = P.publish(spark, wh, {"t": _table(spark, wh, "t", 3)}, 0)
    old = P.read_published(spark, wh, "t")
    two = P.publish(spark, wh, {"t": _table(spark, wh, "t", 5)}, one.number)
    assert read_mart(spark, f"{wh}/t").count() == 5 and old.count() == 3
    assert P.read_published(spark, wh, "t", one).count() == 3 and P.current(spark, wh) == two
    with pytest.raises(P.StalePublication):
        P.publish(spark, wh, {"t": {"": "elsewhere"}}, one.number)
    assert P.current(spark, wh) == two
    assert [f for f in os.listdir(os.path.join(wh, P.FOLDER)) if "elsewhere" in f] == []


def test_retire_clears_what_no_kept_version_names(spark, scratch):
    wh = os.path.join(scratch, "wh")
    for n in (1, 2, 3, 4):
        # the second version keeps the first run's table
        tables = {"t": _table(spark, wh, "t", n)} | ({"u": {"": "_runs/r1/t"}} if n < 4 else {})
        P.publish(spark, wh, tables, n - 1)
    assert P.retire(spark, wh, keep=2) == 1  # r2; r1 is still named by version 3
    assert sorted(os.listdir(os.path.join(wh, "_runs"))) == ["r1", "r3", "r4"]
    assert P.retire(spark, wh, keep=1) == 2 and read_mart(spark, f"{wh}/t").count() == 4
    assert P.retire(spark, os.path.join(scratch, "none")) == 0


@pytest.fixture(scope="module")
def first_warehouse(spark, tmp_path_factory):
    wh = str(tmp_path_factory.mktemp("publish") / "wh")
    pipeline.run_pipeline(spark, pipeline.Paths(STREAM_ROOT, HIST_ROOT, wh), gate=False, tests=STRICT)
    return wh


def _contents(spark, wh):
    return {t: sorted(map(str, read_mart(spark, f"{wh}/{t}").collect())) for t in TABLES}


@pytest.mark.parametrize("fail_at", [1, 3, 5, 8, 9])
def test_a_crash_between_any_two_tables_leaves_the_old_warehouse(spark, first_warehouse, monkeypatch, fail_at):
    """The build dies at its n-th write (9: after all writes, at the publication itself)."""
    before, n = _contents(spark, first_warehouse), [0]
    write = pipeline.write_mart

    def dies(*a, **k):
        n[0] += 1
        if n[0] == fail_at:
            raise OSError("lost")
        return write(*a, **k)

    monkeypatch.setattr(pipeline, "write_mart", dies)
    if fail_at == 9:
        monkeypatch.setattr(pipeline, "publish", lambda *_: dies() if n[0] == 8 else None)
    other = pipeline.Paths(STREAM_ROOT, os.path.join(HIST_ROOT, "dt=2021-11-01"), first_warehouse)
    with pytest.raises(OSError, match="lost"):
        pipeline.run_pipeline(spark, other, gate=False, tests=STRICT)
    assert _contents(spark, first_warehouse) == before
    if fail_at == 9:  # and the next run replaces all of it
        monkeypatch.undo()
        out = pipeline.run_pipeline(spark, other, gate=False, tests=STRICT)
        after = _contents(spark, first_warehouse)
        assert after != before and set(out) == set(TABLES)
        assert all(after[t] == sorted(map(str, spark.read.parquet(out[t]).collect())) for t in TABLES)


def test_every_table_is_written_once(spark, scratch, monkeypatch):
    written = []
    write = pipeline.write_mart
    monkeypatch.setattr(pipeline, "write_mart", lambda df, path, *a: (written.append(path), write(df, path, *a)))
    wh = os.path.join(scratch, "wh")
    out = pipeline.run_pipeline(spark, pipeline.Paths(STREAM_ROOT, HIST_ROOT, wh), gate=False, tests=STRICT)
    assert sorted(written) == sorted(out.values()) and len(written) == 8
