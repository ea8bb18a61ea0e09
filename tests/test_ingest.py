"""Historical CSV ingest, the bronze readers, and the streaming ingest."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from eventmarts.operators import staging
from eventmarts.plans.pipeline import ingest_historical
from eventmarts.schema import EVENT_ID_NAMESPACE
from eventmarts.sinks.bronze import write_mart
from eventmarts.sources.bronze import (
    load_bronze_events,
    read_historical_bronze,
    read_mart,
    read_stream_bronze,
)
from eventmarts.sources.raw import read_event_stream
from eventmarts.streaming.ingest import drain, ingest_stream, parse_records
from tests.conftest import HIST_ROOT, STREAM_ROOT

DAY = 86_400_000
START = 1_636_545_600_125  # 2021-11-10T12:00:00.125Z


def _csv(scratch, rows, name="raw.csv"):
    path = os.path.join(scratch, name)
    with open(path, "w") as f:
        f.write("timestamp,visitorid,event,itemid,transactionid\n")
        f.writelines(",".join("" if v is None else str(v) for v in r) + "\n" for r in rows)
    return path


def _ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def _uuid(visitor, at, event, item):
    return str(uuid.uuid5(uuid.UUID(EVENT_ID_NAMESPACE), f"{visitor}-{at}-{event}-{item}"))


def test_replays_are_one_record_and_neighbours_stay(spark, scratch):
    rows = [(START, 7, "view", 31, None)] * 4 + [
        (START + 1, 7, "view", 31, None),  # a millisecond later
        (START, 8, "view", 31, None), (START, 7, "view", 32, None), (START, 7, "addtocart", 31, None),
        (START, 7, "lottery", 31, None)]  # no known event: not read
    out = os.path.join(scratch, "out")
    res = ingest_historical(spark, _csv(scratch, rows), out)
    assert (res.rows_read, res.rows_dropped, res.rows_written) == (8, 3, 5)
    want = sorted({_uuid(v, t, e, i) for t, v, e, i, _ in rows if e != "lottery"})
    assert _ids(read_historical_bronze(spark, out)) == want


def test_record_fields(spark, scratch):
    rows = [(START, 7, "transaction", 31, "4000.0"), (START + DAY, 7, "view", 31, None)]
    out = os.path.join(scratch, "out")
    ingest_historical(spark, _csv(scratch, rows), out)
    bought, seen = (read_historical_bronze(spark, out).orderBy("dt").collect())
    assert (bought.user_id, bought.event_type, str(bought.dt)) == ("hist-7", "purchase", "2021-11-10")
    # a transaction id with a fraction is the whole number
    assert bought.event_properties.replace(" ", "") == '{"item_id":"31","transaction_id":"4000"}'
    assert seen.event_properties.replace(" ", "") == '{"item_id":"31"}'
    assert (bought.event_timestamp, seen.session_id) == ("2021-11-10T12:00:00.125Z", None)


def test_null_parts_of_the_key_do_not_share_an_id(spark, scratch):
    rows = [(START, None, "view", 31, None), (START, 31, "view", None, None), (None, START, "view", 31, None)]
    df = spark.createDataFrame(rows, "timestamp long, visitorid long, event string, itemid long, t long")
    from eventmarts.operators.historical import historical_event_id

    assert df.select(historical_event_id()).distinct().count() == 3


def test_files_are_those_of_this_write(spark, scratch):
    out = os.path.join(scratch, "out")
    many = _csv(scratch, [(START + k, k % 9, "view", k, None) for k in range(60)]
                + [(START + DAY, 1, "view", 1, None)])
    first = ingest_historical(spark, many, out, max_records_per_file=10)
    before = sorted(tuple(r) for r in read_historical_bronze(spark, out).collect())
    assert first == ingest_historical(spark, many, out, max_records_per_file=10)
    assert sorted(tuple(r) for r in read_historical_bronze(spark, out).collect()) == before
    assert first.files >= 7 and len(before) == 61
    one = _csv(scratch, [(START + DAY, 1, "view", 1, None)], "one.csv")
    res = ingest_historical(spark, one, out)
    assert (res.rows_written, res.files) == (1, 1)  # the other date's files are not counted
    assert sorted(tuple(r) for r in read_historical_bronze(spark, out).collect()) == before
    none = ingest_historical(spark, _csv(scratch, [], "none.csv"), out)
    assert (none.rows_written, none.files) == (0, 0)


def test_staging_reads_the_fixture_tree(spark):
    st = {r.event_id: r for r in staging.stage_stream(read_stream_bronze(spark, STREAM_ROOT)).collect()}
    assert (st["w-02"].url, st["w-02"].referrer, st["w-03"].element_id) == ("/tea", "mail", "pot")
    # partition values are those of the flush, the event date is the event's own
    assert (str(st["w-10"]._ingested_dt), st["w-10"]._ingested_hour, str(st["w-10"].event_date)) == (
        "2022-03-09", 23, "2022-03-10")
    old = {r.event_id: r for r in staging.stage_historical(read_historical_bronze(spark, HIST_ROOT)).collect()}
    assert (old["o-04"].item_id, old["o-04"].transaction_id, old["o-08"].user_id) == ("32", "501", None)


def test_bad_line_fails_or_quarantines(spark, scratch):
    root = os.path.join(scratch, "bronze", "dt=2022-03-07", "hour=08")
    os.makedirs(root)
    with open(os.path.join(root, "events-x.jsonl"), "w") as f:
        f.write('{"event_id":"1","event_type":"click"}\n{"event_id":\n')
    base = os.path.join(scratch, "bronze")
    with pytest.raises(Exception):
        read_stream_bronze(spark, base).collect()
    good, bad = read_stream_bronze(spark, base, on_bad="quarantine")
    assert [r.event_id for r in good.collect()] == ["1"] and [r.value for r in bad.collect()] == ['{"event_id":']


def test_load_bronze_events(spark, scratch):
    assert load_bronze_events(spark, os.path.join(scratch, "missing")).count() == 0
    os.makedirs(os.path.join(scratch, "empty"))
    assert load_bronze_events(spark, os.path.join(scratch, "empty")).count() == 0
    assert load_bronze_events(spark, os.path.dirname(HIST_ROOT)).count() == 25
    with pytest.raises(Exception, match="nosuchstore"):  # only a missing path is empty
        load_bronze_events(spark, "nosuchstore://x/y")


def _land(spark, scratch, lines, files=1, mode="append"):
    landing = os.path.join(scratch, "landing")
    df = lines if hasattr(lines, "select") else spark.createDataFrame([(x,) for x in lines], "value string")
    df.select("value").coalesce(files).write.mode(mode).text(landing)
    return landing


def _drained(spark, scratch, landing, dedup=None):
    out = os.path.join(scratch, "bronze")
    ingest_stream(read_event_stream(spark, "text", path=landing, max_files_per_trigger=1), out,
                  os.path.join(scratch, "ckpt"), trigger={"availableNow": True},
                  dedup_watermark=dedup).awaitTermination()
    return spark.read.text(out)


def _fixture_lines(spark):
    return spark.read.text(STREAM_ROOT).select("value")


def test_stream_matches_batch_and_restarts(spark, scratch):
    lines = _fixture_lines(spark)
    early = lines.where(F.col("value").contains("visit-1"))
    landing = _land(spark, scratch, early)
    assert _drained(spark, scratch, landing).count() == early.count() == 5
    _land(spark, scratch, lines.where(~F.col("value").contains("visit-1")))
    _drained(spark, scratch, landing)
    _drained(spark, scratch, landing)  # nothing new
    got = staging.stage_stream(read_stream_bronze(spark, os.path.join(scratch, "bronze")))
    want = staging.stage_stream(read_stream_bronze(spark, STREAM_ROOT))
    cols = ["event_id", "event_timestamp", "url", "element_id"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


def _line(event_id, at):
    return f'{{"event_id":"{event_id}","event_timestamp":"{at}"}}'


def test_replay_check_loses_nothing_else(spark, scratch):
    batches = [[_line("e1", "2022-03-07T12:00:00Z"), "half a line", "half a line"],
               [_line("e2", "2022-03-07T12:30:00Z"), _line("e1", "2022-03-07T12:00:00Z")],
               # hours late, and a time that is none
               [_line("e3", "2022-03-07T09:00:00Z"), _line("e4", "2022-03-07T12:40:00Z"), _line("e5", "soon")],
               [_line("e3", "2022-03-07T09:00:00Z"), "half a line", '{"event_id":null}']]
    for b in batches:
        landing = _land(spark, scratch, b)
    got = sorted(r.value for r in _drained(spark, scratch, landing, "1 hour").collect())
    assert got == sorted([batches[0][0], batches[1][0], *batches[2], *["half a line"] * 3, '{"event_id":null}'])


def test_streaming_staging_matches_batch(spark, scratch):
    landing = _land(spark, scratch, _fixture_lines(spark), 2)
    staged = staging.stage_stream(parse_records(read_event_stream(spark, "text", path=landing)))
    (staged.writeStream.format("memory").queryName("staged_fixture")
     .option("checkpointLocation", os.path.join(scratch, "c2"))
     .trigger(availableNow=True).start().awaitTermination())
    cols = ["event_id", "url", "element_id", "event_date"]
    want = staging.stage_stream(read_stream_bronze(spark, STREAM_ROOT)).select(*cols)
    assert sorted(map(str, spark.table("staged_fixture").select(*cols).collect())) == sorted(
        map(str, want.collect()))


def test_read_mart_and_drain(spark, scratch):
    path = os.path.join(scratch, "mart")
    write_mart(spark.range(5).selectExpr("id", "'stream' as source"), path, ("source",))
    assert read_mart(spark, path).where("source = 'stream'").count() == 5
    landing = _land(spark, scratch, _fixture_lines(spark))
    q = ingest_stream(read_event_stream(spark, "text", path=landing), os.path.join(scratch, "b"),
                      os.path.join(scratch, "c"), trigger={"processingTime": "1 second"})
    drain(q)
    assert not q.isActive and spark.read.text(os.path.join(scratch, "b")).count() == 12
