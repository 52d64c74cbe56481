import pytest

from logweir.plans import shared
from logweir.sources.sample_tables import adapt


class Conf:
    def get(self, name, default=None):
        return default


class Context:
    applicationId = "app"

    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class Session:
    def __init__(self, master):
        self.conf, self.sparkContext = Conf(), Context(master)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session(master))


def test_run_folders_are_removed(spark):
    kept = shared.stored(spark.range(3))
    assert kept.count() == 3
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert shared.clear_runs(spark) >= 1
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def test_stored_keeps_the_schema_of_an_empty_table(spark):
    empty = shared.stored(spark.range(3).filter("id > 5").selectExpr("id", "'a' AS b"))
    assert empty.count() == 0 and empty.columns == ["id", "b"]


def test_adapter_reads_any_json(spark):
    table = spark.createDataFrame(
        [(1, 2, "click", 0.0, '{ "z": 1, "k":7 }')],
        "event_id long, user_id long, event_type string, value double, props string",
    ).selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' AS ts")
    row = adapt(table).first()
    assert (row.repo_id, row.repo_name) == (7, "org/repo7")
