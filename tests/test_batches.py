"""Ingest by micro-batches: replays of any age land once, the gate keeps every line, a retry changes nothing."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from eventmarts.sources.raw import read_event_stream
from eventmarts.streaming import landed
from eventmarts.streaming.batches import (
    gate_report,
    ingest_batches,
    land_batch,
    read_gated,
)


def _line(i, day=1, **more):
    fields = {"event_id": f"e{i}", "user_id": "u", "event_type": "click",
              "event_timestamp": f"2024-01-{day:02d}T10:00:00Z", **more}
    return "{" + ",".join(f'"{k}":null' if v is None else f'"{k}":"{v}"' for k, v in fields.items()) + "}"


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def _tree(spark, out):
    return sorted(r.value for r in spark.read.text(out).collect())


def _drain(spark, landing, out, ckpt, **options):
    ingest_batches(read_event_stream(spark, "text", path=landing, max_files_per_trigger=1), out, ckpt,
                   trigger={"availableNow": True}, **options).awaitTermination()


@pytest.mark.parametrize("words", [1 << 26, 2])
def test_replays_of_any_age_land_once_and_no_new_id_is_lost(spark, scratch, monkeypatch, words):
    """Across restarts, across a lost checkpoint, and with a filter so full that it tells nothing."""
    monkeypatch.setattr(landed, "WORDS", words)
    landing, out, state = (os.path.join(scratch, d) for d in ("landing", "bronze", "state"))
    first = [_line(i, 1 + i % 3) for i in range(40)] + [_line(900, event_timestamp="soon"), "half a line"]
    again = [_line(i, 1 + i % 3) for i in range(0, 40, 2)] + [_line(900, event_timestamp="soon")]
    new = [_line(i, 1 + i % 3) for i in range(40, 80)]
    for part in (first + first[:5], again + new, again, ["half a line"]):
        _lines(spark, part).coalesce(1).write.mode("append").text(landing)
        _drain(spark, landing, out, os.path.join(scratch, "c"), landed=state)
    want = sorted([*first, *new, "half a line"])
    assert _tree(spark, out) == want
    # a new checkpoint delivers everything again: only lines without an id are added
    _drain(spark, landing, out, os.path.join(scratch, "c2"), landed=state)
    assert _tree(spark, out) == sorted([*want, "half a line", "half a line"])


@pytest.mark.parametrize("words", [1 << 26, 2])
def test_a_batch_tried_again_changes_nothing(spark, scratch, monkeypatch, words):
    monkeypatch.setattr(landed, "WORDS", words)
    out, state = os.path.join(scratch, "bronze"), os.path.join(scratch, "state")
    a, b = _lines(spark, [_line(i) for i in range(9)]), _lines(spark, [_line(i) for i in range(5, 14)])
    land_batch(a, out, "r", 0, state, True)
    for _ in range(3):
        land_batch(b, out, "r", 1, state, True)
        assert _tree(spark, out) == sorted(_line(i) for i in range(14))
    assert {(r.batch, r.verdict): r.lines for r in gate_report(spark, out).where("lines > 0").collect()} == {
        (0, "good"): 9, (1, "good"): 5}


def test_pieces_are_merged_and_only_touched_dates_are_read(spark, scratch, monkeypatch):
    monkeypatch.setattr(landed, "MOST_PIECES", 3)
    out, state = os.path.join(scratch, "bronze"), os.path.join(scratch, "state")
    land_batch(_lines(spark, [_line(500, 9)]), out, "r", 0, state)
    for n in range(1, 8):
        land_batch(_lines(spark, [_line(10 * n + k, 1) for k in range(4)] + [_line(10, 1)]), out, "r", n, state)
    for table in ("ids", "filter"):
        assert len(os.listdir(os.path.join(state, table, "event_date=2024-01-01"))) <= 4
        assert len(os.listdir(os.path.join(state, table, "event_date=2024-01-09"))) == 1
    assert _tree(spark, out) == sorted([_line(500, 9)] + [_line(10 * n + k, 1) for n in range(1, 8) for k in range(4)])
    view = landed.LandedIds(spark, state, "r", 99)
    read = view._read("ids", ["2024-01-01"]).inputFiles()
    assert read and all("event_date=2024-01-01" in f for f in read)


def test_ids_that_are_new_read_no_landed_id(spark, scratch):
    state = os.path.join(scratch, "state")
    land_batch(_lines(spark, [_line(i) for i in range(20)]), os.path.join(scratch, "b"), "r", 0, state)
    new = landed.placed(_lines(spark, [_line(i) for i in range(20, 40)]).select(
        F.get_json_object("value", "$.event_id").alias("event_id"), F.lit("2024-01-01").alias("event_date"), "value"))
    left = landed.LandedIds(spark, state, "r", 1).unseen(new)
    assert left.count() == 20 and not any("/ids/" in f for f in left.inputFiles())


def test_the_same_id_on_another_date_is_another_record(spark, scratch):
    out, state = os.path.join(scratch, "bronze"), os.path.join(scratch, "state")
    land_batch(_lines(spark, [_line(1, 1)]), out, "r", 0, state)
    land_batch(_lines(spark, [_line(1, 2), _line(1, 1)]), out, "r", 1, state)
    assert _tree(spark, out) == [_line(1, 1), _line(1, 2)]


def test_gate_keeps_every_line_with_its_reason(spark, scratch):
    landing, out = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    good = [_line(1), _line(2, event_type="purchase")]
    dead = {"half a {": "malformed", "[1]": "malformed", "": "malformed", _line(3, user_id=None): "missing_field",
            '{"event_id":"4"}': "missing_field", _line(5, event_type="refund"): "unknown_type"}
    for part in (good[:1] + list(dead)[:3], good[1:] + list(dead)[3:] + ["half a {"]):
        _lines(spark, part).coalesce(1).write.mode("append").text(landing)
        _drain(spark, landing, out, os.path.join(scratch, "c"), gated=True)
    kept, left = read_gated(spark, out)
    assert sorted(r.event_id for r in kept.collect()) == ["e1", "e2"]
    assert sorted((r.value, r.verdict) for r in left.collect()) == sorted([*dead.items(), ("half a {", "malformed")])
    counted = {r.verdict: r.n for r in gate_report(spark, out).groupBy("verdict").agg(F.sum("lines").alias("n")).collect()}
    assert counted == {"good": 2, "malformed": 4, "missing_field": 2, "unknown_type": 1}


def test_batches_of_nothing(spark, scratch):
    out, state = os.path.join(scratch, "bronze"), os.path.join(scratch, "state")
    land_batch(_lines(spark, []), out, "r", 0, state, True)
    land_batch(_lines(spark, [_line(1)]), out, "r", 1, state, True)
    land_batch(_lines(spark, []), out, "r", 2, state, True)
    assert _tree(spark, out) == [_line(1)]


def test_a_batch_is_parsed_once_and_moves_ids_alone(spark, scratch, monkeypatch):
    out, state = os.path.join(scratch, "bronze"), os.path.join(scratch, "state")
    land_batch(_lines(spark, [_line(i) for i in range(9)]), out, "r", 0, state)
    kept, keep = {}, landed.LandedIds.keep
    monkeypatch.setattr(landed.LandedIds, "keep", lambda self, df, name: kept.setdefault(name, keep(self, df, name)))
    released = []
    release = landed.LandedIds.release
    monkeypatch.setattr(landed.LandedIds, "release", lambda self: (release(self), released.append(self._scratch)))
    land_batch(_lines(spark, [_line(i) for i in range(5, 14)]), out, "r", 1, state)
    assert [n for n, df in kept.items() if "value" in df.columns] == ["records"]
    assert set(kept) == {"records", "suspects", "known", "fresh"}
    assert _tree(spark, out) == sorted(_line(i) for i in range(14))
    assert [os.path.exists(p) for p in released] == [False]
