"""The checkpoint folder and the sized helpers."""

from types import SimpleNamespace

import pytest

from sitewright import session


def fake(master, conf, current=None):
    seen = {}
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=lambda d: seen.update(dir=d))
    spark = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: conf.get(k, d)))
    return SimpleNamespace(sparkSession=spark, checkpoint=lambda: "done"), seen


def test_checkpoint_folder_of_the_session():
    df, seen = fake("yarn", {"spark.checkpoint.dir": "hdfs:/shared"})
    assert session.materialise(df) == "done" and seen == {"dir": "hdfs:/shared"}
    df, seen = fake("yarn", {}, current="hdfs:/set")
    assert session.materialise(df) == "done" and seen == {}
    df, seen = fake("local[2]", {})
    assert session.materialise(df) == "done" and "sitewright" in seen["dir"]
    df, _ = fake("yarn", {})
    with pytest.raises(RuntimeError):
        session.materialise(df)


def test_spread_only_widens(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 10, 1, cores + 3)
    assert session.spread(wide) is wide


def test_local_table_is_broadcast(spark, monkeypatch):
    plan = lambda df: spark.range(5).join(df, "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(session.local_table(spark, [(1,)], "id bigint"))
    monkeypatch.setattr(session, "BYTES_TO_BROADCAST", 0)
    assert "broadcast" not in plan(session.local_table(spark, [(1,)], "id bigint"))
