"""The shared folder: read from the session, never machine-local on a cluster."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from eventmarts import session


def _fake(master, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    conf = {} if folder is None else {"spark.checkpoint.dir": folder}
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(
        get=lambda k, default=None: conf.get(k, default), set=conf.__setitem__))


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_fake(master))
    assert session.shared_dir(_fake(master, "hdfs://n/x"), "a").startswith("hdfs://n/x/a/")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_master_may_do_without(master):
    assert session.shared_dir(_fake(master)) != session.shared_dir(_fake(master))


def test_a_written_table_reads_back(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as none", "struct(id as x) as s")
    back = session.materialize(df, "t")
    assert back.schema.names == df.schema.names and sorted(back.collect()) == sorted(df.collect())
