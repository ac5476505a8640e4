import pytest

from quire import session


class Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master


class Session:
    def __init__(self, master, folder=None):
        self.sparkContext, self.conf = Context(master), {"spark.checkpoint.dir": folder}


def test_scratch_lies_where_the_cluster_says():
    assert session.shared_dir(Session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/quire/x-")
    first, second = (session.shared_dir(Session("local[2]"), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("yarn"), "x")


def test_spread_leaves_large_inputs_alone(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    small = spark.read.parquet(str(tmp_path / "one"))
    assert session.spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 50)
    assert session.spread(many) is many
    monkeypatch.setattr(session, "SPREAD_BELOW_BYTES", 10)
    assert session.spread(small) is small
