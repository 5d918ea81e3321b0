import pytest

from gridscale.session import settled, shared_folder


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, conf=None, folder=None):
        self.sparkContext = FakeContext(master, folder)
        self.conf = {"spark.sql.warehouse.dir": "file:/warehouse"} | ({} if conf is None else {"spark.checkpoint.dir": conf})


def test_the_folder_the_cluster_names_is_used():
    assert shared_folder(FakeSession("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/gridscale-")
    assert shared_folder(FakeSession("yarn", None, "hdfs:///set")).startswith("hdfs:///set/gridscale-")


def test_without_a_named_folder_only_local_mode_works():
    local = FakeSession("local[2]")
    first, second = shared_folder(local), shared_folder(local)
    assert first != second and first.startswith("file:/warehouse/gridscale-shared/")
    assert local.sparkContext.getCheckpointDir() is None
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(FakeSession(master))


def test_settled_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a INT, b STRING")
    kept = settled(df)
    assert kept.schema == df.schema and sorted(kept.collect()) == sorted(df.collect())
