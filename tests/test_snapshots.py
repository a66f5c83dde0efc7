"""Versioned snapshot store: publish, resolve, pruned read."""

import pytest
from pyspark.sql import functions as F

from quarry.sources.snapshots import SnapshotTable


def test_publish_resolve_read(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir + "/feat")
    assert t.resolve() == (None, None)
    v0 = t.publish(spark.range(10).withColumn("x", F.col("id") * 2))
    v1 = t.publish(spark.range(25).withColumn("y", F.lit("a")))  # overwrite schema too
    assert (v0["version"], v1["version"]) == (0, 1)
    ver, ts = t.resolve()
    assert ver == 1 and ts.startswith("20")
    assert t.resolve(0)[0] == 0
    with pytest.raises(ValueError):
        t.resolve(7)
    assert t.read(0).count() == 10 and t.read().count() == 25
    assert t.read(0).columns == ["id", "x"] and t.read().columns == ["id", "y"]
    assert sorted(tuple(r) for r in t.read(0).collect()) == [(i, 2 * i) for i in range(10)]
    assert {r["y"] for r in t.read(1).collect()} == {"a"}
    assert all("snapshot_version=0" in f for f in t.read(0).inputFiles())
    with pytest.raises(ValueError):
        t.read(7)


def test_failed_publish_invisible(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir + "/feat2")
    t.publish(spark.range(3))
    bad = spark.range(5).withColumn("boom", F.raise_error(F.lit("fail")))
    with pytest.raises(Exception):
        t.publish(bad)
    assert t.resolve()[0] == 0 and t.read().count() == 3
