"""Publishing: reruns keep the closed history, a crash between the writes stays invisible."""

from dimforge.sources.sinks import publish_versioned, read_versioned


def _rows(spark, values):
    return spark.createDataFrame(values, "k string, sk long, open boolean")


def test_rerun_of_a_closing_batch_keeps_history(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = _rows(spark, []).schema
    publish_versioned(root, 1, _rows(spark, [("a", 1, True), ("b", 2, True)]), _rows(spark, []))
    publish_versioned(root, 2, _rows(spark, [("a", 3, True), ("b", 2, True)]), _rows(spark, [("a", 1, False)]))
    before = sorted(map(tuple, read_versioned(spark, root, schema).collect()))
    # the rerun finds every row unchanged and closes nothing
    publish_versioned(root, 2, _rows(spark, [("a", 3, True), ("b", 2, True)]), _rows(spark, []))
    assert sorted(map(tuple, read_versioned(spark, root, schema).collect())) == before
    assert ("a", 1, False) in before and len(before) == 3


def test_crash_between_the_writes_leaves_the_previous_state(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = _rows(spark, []).schema
    publish_versioned(root, 1, _rows(spark, [("a", 1, True)]), _rows(spark, []))
    _rows(spark, [("a", 1, False)]).write.parquet(f"{root}/history/closed_by=2")
    assert [tuple(r) for r in read_versioned(spark, root, schema).collect()] == [("a", 1, True)]
    # a snapshot without its marker is not complete
    _rows(spark, [("a", 3, True)]).write.parquet(f"{root}/current/v=2")
    (tmp_path / "t/current/v=2/_SUCCESS").unlink()
    assert [tuple(r) for r in read_versioned(spark, root, schema).collect()] == [("a", 1, True)]
    publish_versioned(root, 2, _rows(spark, [("a", 3, True)]), _rows(spark, [("a", 1, False)]))
    assert sorted(map(tuple, read_versioned(spark, root, schema).collect())) == [("a", 1, False), ("a", 3, True)]
