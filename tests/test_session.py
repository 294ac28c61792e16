"""Scratch folders come from the session's checkpoint setting."""

from tablefit.session import checkpoint_root, local_path, scratch_dir


def test_scratch_dirs_live_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b                                   # a new folder per call
    assert a.startswith(root.rstrip("/")) and "/tablefit/x-" in a
    assert local_path("file:/tmp/a") == "/tmp/a"


def test_configured_dir_is_read_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None)
    assert configured
    assert checkpoint_root(spark) == spark.sparkContext.getCheckpointDir()
