import pytest

from stratamart.session import pin_utc, shared_dir, shuffle_partitions


class Settings(dict):
    def set(self, name, value):
        self[name] = value


class Session:
    """Just enough of a session to ask where its shared folder is."""

    def __init__(self, master, **conf):
        self.conf = Settings(conf)
        self.sparkContext = type("Context", (), {"master": master})()


def test_the_cluster_names_the_shared_folder():
    named = Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_dir(named) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))


def test_a_local_session_may_have_its_own():
    local = Session("local[2]")
    assert shared_dir(local) == shared_dir(local) != shared_dir(Session("local[2]"))


def test_partitions_grow_with_the_shuffle():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(10 * 1024**4) == 52429


def test_results_are_in_utc(spark):
    zone = "spark.sql.session.timeZone"
    spark.conf.set(zone, "America/Lima")
    assert pin_utc(spark).conf.get(zone) == "UTC"
