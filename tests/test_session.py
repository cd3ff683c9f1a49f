"""Scratch folders come from the session's shared folder and are never reused."""

from chartwise.session import done_marker, path_exists, scratch_path, shared_dir


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert shared_dir(spark) == root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/x-") and b.startswith(root + "/x-")


def test_done_marker_follows_committed_output(spark):
    path = scratch_path(spark, "marker")
    assert not path_exists(spark, path) and not done_marker(spark, path)
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path) and done_marker(spark, path)
