from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
STREAM_ROOT = os.path.join(DATA, "shop", "events")
HIST_ROOT = os.path.join(DATA, "shop", "events_historical")


@pytest.fixture(scope="session")
def spark():
    from eventmarts.session import build_session

    ckpt = tempfile.mkdtemp(prefix="eventmarts-test-ckpt-")
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="eventmarts-test-")


@pytest.fixture(scope="session")
def fixture_models(spark):
    from eventmarts.plans.pipeline import build_models
    from eventmarts.sources.bronze import read_historical_bronze, read_stream_bronze

    return build_models(read_stream_bronze(spark, STREAM_ROOT),
                        read_historical_bronze(spark, HIST_ROOT))


def rows(df, *cols):
    """Sorted plain tuples of the given columns."""
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
