"""One bad row per check, and the nulls that each check must let pass."""

import pytest
from pyspark.sql import functions as F

from skyledger.operators import quality as q


def found(report):
    assert report.columns == ["check", "table_name", "rule", "value", "row_count"]
    return sorted((r["value"], r["row_count"]) for r in report.collect())


def test_primary_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "k string, n int")
    assert found(q.primary_key(df, "t", ["k", "n"])) == [("a|1", 2), ("b|NULL", 1)]


def test_unique_key(spark):
    df = spark.createDataFrame([("x", None), ("x", None), (None, None), (None, None), ("y", "1")], "k string, v string")
    assert found(q.unique_key(df, "t", ["k", "v"])) == [("x|NULL", 2)]


def test_foreign_key(spark):
    child = spark.createDataFrame([("a", "1"), ("a", "9"), ("a", "9"), ("z", None), (None, "1")], "k string, v string")
    parent = spark.createDataFrame([("a", "1"), ("a", None)], "pk string, pv string")
    assert found(q.foreign_key(child, "t", ["k", "v"], parent, "p", ["pk", "pv"])) == [("a|9", 2)]


def test_null_safe_key(spark):
    child = spark.createDataFrame([("a", None), ("b", None), ("a", "9"), (None, None)], "k string, v string")
    parent = spark.createDataFrame([("a", None), ("b", "1")], "k string, v string")
    assert found(q.null_safe_key(child, "t", ["k", "v"], parent, "p", ["k", "v"])) == [("a|9", 1), ("b|NULL", 1)]


def test_key_against_itself(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "x")], "code string, parent string")
    assert found(q.foreign_key(df, "t", ["parent"], df, "t", ["code"])) == [("x", 1)]


def test_not_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert found(q.not_null(df, "t", "k")) == [("NULL", 1)]
    assert found(q.not_null(df.filter("k = 'a'"), "t", "k")) == []


def test_parent_in_domains(spark):
    df = spark.createDataFrame([("S1",), ("Earth",), ("Mars",), (None,)], "parent string")
    ids = spark.createDataFrame([("S1",)], "id string")
    worlds = spark.createDataFrame([("Earth",)], "name string")
    assert found(q.parent_in_domains(df, "t", "parent", [(ids, "id"), (worlds, "name")])) == [("Mars", 1)]


def test_one_parent_by_name(spark):
    df = spark.createDataFrame([("Sun", "Sun"), ("Moon", "Earth"), ("X", "Moon"), ("Moon", "Sun")], "name string, parent string")
    assert found(q.one_parent_by_name(df, "t", "name", "parent")) == [("Earth: no match", 1), ("Moon: several matches", 1)]


def test_reconciled(spark):
    master = spark.createDataFrame([(1,), (None,)], "rho int")
    detail = spark.createDataFrame([("a",), ("b",)], "id string")
    assert found(q.reconciled(master, F.col("rho").isNotNull(), detail, "t", "r")) == [("loaded 1, staged 2", 1)]
    assert found(q.reconciled(master, F.col("rho").isNotNull(), detail.limit(1), "t", "r")) == []


def test_row_floor(spark):
    df = spark.range(3)
    assert found(q.row_floor(df, "t", 3)) == []
    assert found(q.row_floor(df, "t", 4)) == [("at least 4 expected, 3 found", 3)]


def test_types(spark):
    df = spark.sql("SELECT true AS b, 1.5D AS d, 'x' AS s, TIMESTAMP_NTZ'2020-01-01 00:00:00' AS t, 1L AS n")
    assert found(q.allowed_types(df, "t")) == [("b(boolean)", 0)]


def test_width_profile(spark):
    df = spark.createDataFrame([("é", "abc", 1), ("ab", None, 2)], "a string, b string, n int")
    assert sorted(tuple(r) for r in q.width_profile(df, "t").collect()) == [("t", "a", 2), ("t", "b", 3)]


def test_header_drift(spark):
    registry = spark.createDataFrame([("a", "#x\ty"), ("b", "#x"), ("c", "#x\ty"), ("d", "#x"), ("e", "#x")], "source string, header string")
    actual = spark.createDataFrame([("a", "#x\ty"), ("b", "#x\ty"), ("c", "#x\tz"), ("d", None)], "source string, first_line string")
    report = q.header_drift(actual, registry)
    assert sorted(r["table_name"] for r in report.collect()) == ["b", "c", "d", "e"]


def test_require_none(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(q.CheckFailed, match=r"primary key t \[k\]: a \(2 rows\)"):
        q.require_none(q.primary_key(df, "t", ["k"]))
    q.require_none(q.primary_key(df.distinct(), "t", ["k"]))
