from tidewater.session import GB, MB, checkpoint_dir, scratch_path, sizing_conf


def test_sizing_at_scale():
    c = sizing_conf(100 * 1024 * GB, 8000)
    n = int(c["spark.sql.shuffle.partitions"])
    assert n == 409_600  # 256 MB each, no cap
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 * MB


def test_sizing_small_input_keeps_two_waves():
    c = sizing_conf(40 * MB, 8)
    assert int(c["spark.sql.shuffle.partitions"]) == 16
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 16 * MB


def test_checkpoint_dir_from_session(spark):
    d = checkpoint_dir(spark)
    assert d
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(d.rstrip("/"))


def test_no_partition_cap_unless_asked():
    huge = sizing_conf(100 * 1024**4, 8000)
    assert int(huge["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    assert sizing_conf(100 * 1024**4, 8000, max_partitions=1000)["spark.sql.shuffle.partitions"] == "1000"


def test_the_cluster_settings_stay(monkeypatch):
    """Defaults are set only where the configuration does not name the key."""
    from tidewater import session

    asked = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, master):
            return self

        def config(self, k, v):
            asked[k] = v
            return self

        def getOrCreate(self):
            return "session"

    class Conf:
        def contains(self, key):
            return key == "spark.sql.adaptive.enabled"

    monkeypatch.setattr(session, "SparkConf", Conf)
    monkeypatch.setattr(session, "SparkSession", type("S", (), {"builder": Builder()}))
    assert session.build_session("local[1]", extra={"spark.x": "1"}, shuffle_partitions=7) == "session"
    assert "spark.sql.adaptive.enabled" not in asked and asked["spark.speculation"] == "false"
    assert asked["spark.x"] == "1" and asked["spark.sql.shuffle.partitions"] == "7"
