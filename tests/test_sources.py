"""Delimited text, JDBC options, versioned publish, missing targets."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dimforge.session import scratch_path
from dimforge.sources import scans, sinks


def _write_text(spark, lines):
    path = scratch_path(spark, "text")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    return path


def test_delimited_quotes_doubled_quotes_and_empty_fields(spark):
    path = _write_text(spark, ['id,name,note', '1,"Smith, J","said ""hi"""', '2,,x', '3,"",'])
    rows = {r.id: r for r in scans.read_delimited(spark, path, ["id", "name", "note"]).collect()}
    assert rows["1"].name == "Smith, J" and rows["1"].note == 'said "hi"'
    assert rows["2"].name is None
    assert rows["3"].note is None


def test_delimited_header_only_and_other_delimiter(spark):
    path = _write_text(spark, ["a|b"])
    assert scans.read_delimited(spark, path, ["a", "b"], delimiter="|").count() == 0
    path2 = _write_text(spark, ["a|b", "x|y|z"])
    assert scans.read_delimited(spark, path2, ["a", "b"], delimiter="|").first().b == "y"


def test_jdbc_partition_options():
    base = scans.jdbc_options("jdbc:postgresql://h/db", "(select * from t) q", user="u", password="p")
    opts = scans.jdbc_partitioned_options(base, "sk", 1, 1000, 8)
    assert opts["partitionColumn"] == "sk" and opts["numPartitions"] == "8"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000"
    assert scans.jdbc_partitioned_options(base, "sk", 5, 6, 8)["numPartitions"] == "2"
    assert "min(sk)" in scans.partition_bounds_query("(select * from t) q", "sk")


def test_missing_target_is_empty_other_errors_raise(spark):
    schema = StructType([StructField("k", StringType())])
    missing = scratch_path(spark, "nothing-here")
    assert scans.target_or_empty(spark, missing, schema).count() == 0


def test_versioned_publish_round_trip(spark):
    schema = StructType([StructField("sk", LongType()), StructField("k", StringType()),
                         StructField("is_current", StringType())])
    root = scratch_path(spark, "versioned")
    assert sinks.read_versioned(spark, root, schema).count() == 0
    cur1 = spark.createDataFrame([(1, "a", "Y"), (2, "b", "Y")], schema)
    sinks.publish_versioned(root, 1, cur1, cur1.limit(0))
    cur2 = spark.createDataFrame([(1, "a", "Y"), (3, "b", "Y")], schema)
    closed = spark.createDataFrame([(2, "b", "N")], schema)
    sinks.publish_versioned(root, 2, cur2, closed)
    assert sinks.snapshot_versions(spark, root) == [1, 2]
    got = sorted(tuple(r) for r in sinks.read_versioned(spark, root, schema).collect())
    assert got == [(1, "a", "Y"), (2, "b", "N"), (3, "b", "Y")]


def test_schema_align_by_name(spark):
    from dimforge.operators.schema import align_to_schema

    schema = StructType([StructField("ID", LongType()), StructField("NAME", StringType()),
                         StructField("MISSING", StringType())])
    df = spark.createDataFrame([("x", "12", "extra")], "name string, id string, other string")
    out = align_to_schema(df, schema)
    assert out.columns == ["ID", "NAME", "MISSING"]
    assert tuple(out.first()) == (12, "x", None)
    bad = spark.createDataFrame([("x", "notanumber")], "name string, id string")
    assert align_to_schema(bad, schema).first().ID is None


def test_upper_names_and_typed_defaults(spark):
    from dimforge.operators.schema import upper_names, with_defaults

    df = spark.createDataFrame([("x",)], "plcy_num string")
    out = with_defaults(upper_names(df), [("CASE_MASTR_ID", -99, "int"), ("PLCY_NM", None, "string")])
    assert out.columns == ["PLCY_NUM", "CASE_MASTR_ID", "PLCY_NM"]
    assert dict(out.dtypes) == {"PLCY_NUM": "string", "CASE_MASTR_ID": "int", "PLCY_NM": "string"}
    assert tuple(out.first()) == ("x", -99, None)


def test_unreadable_target_raises_instead_of_starting_over(spark):
    """Only a missing path means "initial load"; a path that holds something
    else must fail, never be treated as an empty target and overwritten."""
    import pytest

    schema = StructType([StructField("k", StringType())])
    path = scratch_path(spark, "not-parquet")
    spark.createDataFrame([("x",)], "value string").write.text(path)
    with pytest.raises(Exception):
        scans.target_or_empty(spark, path, schema).count()
