from __future__ import annotations

import pytest

from tidebook import session


def test_partitions_follow_the_data():
    small = session.settings(10 * 1024**2, cores=8)
    large = session.settings(30 * 1024**4, cores=4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) == 245_760


def test_settings_are_known_to_spark(spark):
    for key, value in session.settings(1024**3, cores=4).items():
        assert spark.conf.get(key) is not None or value
        assert spark.conf.isModifiable(key)


def test_cut_lineage_keeps_rows_and_drops_the_plan(spark):
    frame = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    cut = session.cut_lineage(frame)
    assert cut.exceptAll(frame).count() == 0 and cut.count() == 7
    assert "Range" not in cut._jdf.queryExecution().executedPlan().toString()
    assert session.checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_a_cluster_must_name_its_folder():
    class Context:
        master = "spark://somewhere"

        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        @staticmethod
        def get(key, default):
            return default

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session)
