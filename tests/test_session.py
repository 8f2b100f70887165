import glob

import pytest

from annexport.session import CHECKPOINT_DIR, scratch_path, shared_folder, sized_settings, staged, staging
from annexport.sources.tables import StagedTables


def test_partitions_are_sized_by_bytes():
    settings = sized_settings(10 * 2**40, cores=4000)
    assert settings["spark.sql.shuffle.partitions"] == "81920"
    assert sized_settings(1, cores=8)["spark.sql.shuffle.partitions"] == "8"
    assert settings["spark.sql.adaptive.enabled"] == "true"


def test_shared_folder_is_the_one_named(spark):
    named = spark.conf.get(CHECKPOINT_DIR)
    assert shared_folder(spark) == named
    assert scratch_path(spark, "x").startswith(named + "/")


def test_cluster_must_name_a_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
        shared_folder(Session())


def test_staged_rows_are_fixed_and_planned_by_size(spark):
    small = staged(spark.range(10), "small")
    again = staged(spark.range(20), "small")
    assert (small.count(), again.count()) == (10, 20)
    big = spark.range(1000).withColumnRenamed("id", "n")
    joined = big.join(small, big.n == small.id)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_staged_tables_are_read_once(spark, tmp_path):
    class Source:
        reads = 0

        def table(self, name):
            Source.reads += 1
            return spark.range(3).selectExpr("id", "id * 2 AS twice", "'x' AS big")

    source = StagedTables(Source(), {"t": ("id", "twice")})
    assert source.table("t").columns == ["id", "twice"]
    assert source.table("t").count() == source.table("t").distinct().count() == 3
    assert Source.reads == 1


def test_staged_folders_of_an_export_are_deleted(spark):
    with staging(spark) as stage:
        rows = stage(spark.range(5), "gone")
        assert rows.count() == 5
        folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert glob.glob(f"{folder}/part-*")
    assert not glob.glob(folder)
    with pytest.raises(ValueError, match="stop"), staging(spark) as stage:
        folder = stage(spark.range(1), "gone").inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        raise ValueError("stop")
    assert not glob.glob(folder)


def test_local_session_without_a_folder_stages_below_the_warehouse(spark):
    class Context:
        master = "local[2]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return "file:/w/" if key == "spark.sql.warehouse.dir" else default

    assert shared_folder(Session()) == "file:/w/_staged"


def test_staged_tables_refuse_unlisted_tables(spark):
    with pytest.raises(ValueError, match="t has no entry"):
        StagedTables(None, {}).table("t")
