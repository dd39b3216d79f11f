"""Corrections, lookups and numbering against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators.corrections import Case, Fix, Regex, Replace, Strip, correct, correct_audited, correct_from_table, exact
from skyledger.operators.lookups import (
    distinct_union,
    full_outer_values,
    left_detail,
    repeated_names,
    route,
    tagged_union,
    with_key_count,
    with_membership,
    with_surrogate,
)
from skyledger.operators.numbering import read_numbered_lines, with_row_numbers
from skyledger.plans import tables
from skyledger.plans.shape import bridge, token_map, unreadable_cells


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_match_and_fallback(spark):
    df = spark.createDataFrame([("CC", "LC46"), ("CC?", "LC46"), ("NIIP-5?", "P"), (None, "LC46"), ("X??", None)], "site string, pad string")
    fix = Fix(
        "site",
        cases=(Case("CCA", when={"site": ("CC",), "pad": ("LC46",)}), Case("GIK-5", when={"site": ("NIIP-5",)}, strip="?")),
        steps=(Strip("?"),),
    )
    assert [r["site"] for r in correct(df, [fix]).collect()] == ["CCA", "CC", "GIK-5", None, "X"]


def test_fixes_read_the_uncorrected_row(spark):
    df = spark.createDataFrame([("a", "a")], "x string, y string")
    out = correct(df, [exact("x", {"a": "b"}), Fix("y", cases=(Case("seen", when={"x": ("a",)}),))])
    assert tuple(out.head()) == ("b", "seen")


def test_steps_in_order_and_empty_is_null(spark):
    df = spark.createDataFrame([("aab",), ("b",), (None,)], "x string")
    out = correct(df, [Fix("x", steps=(Replace("a", "b"), Regex("^b+$")))])
    assert [r[0] for r in out.collect()] == [None, None, None]


def test_rules_table_takes_the_first_rule(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    rules = spark.createDataFrame([("a", "late", 2), ("a", "early", 1), ("b", None, 1)], "old string, new string, place int")
    assert rows(correct_from_table(df, rules, "x", "old", "new", "place")) == rows(
        spark.createDataFrame([("early",), (None,), (None,)], "x string")
    )


def test_token_map_leaves_correct_values(spark):
    df = spark.createDataFrame([("AlTP-H-3062/AlTP-H-3062M?",)], "x string").withColumn("k", F.lit(1))
    out = bridge(df, {"k": "k"}, "x", "item", tidy=token_map({"AlTP-H-3062": "AlTP-H-3062M"}, lambda c: F.replace(c, F.lit("?"), F.lit(""))))
    assert [r["item"] for r in out.collect()] == ["AlTP-H-3062M", "AlTP-H-3062M"]


def test_bridge_drops_marks_and_trims(spark):
    df = spark.createDataFrame([("a", "X / Y"), ("b", "-"), ("c", None), ("d", "//")], "k string, l string")
    assert rows(bridge(df, {"k": "k"}, "l", "item")) == [("a", "X"), ("a", "Y")]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")
    lookup = spark.createDataFrame([("a", 7), ("a", 5), ("c", 9)], "label string, key int")
    assert rows(with_surrogate(df, lookup, "name", "label", "key", "k")) == [(1, "a", 5), (2, "b", None), (3, None, None)]
    assert rows(repeated_names(df, lookup, "name", "label")) == [("a", 2, 1)]
    known = with_membership(df, lookup, "name", "label", "known")
    assert rows(known) == [(1, "a", True), (2, "b", False), (3, None, False)]
    assert rows(known.select("id", *route(F.col("name"), F.col("known"), "hit", "miss"))) == [(1, "a", None), (2, None, "b"), (3, None, None)]
    assert left_detail(df, lookup, "name", "label").count() == 4
    assert rows(full_outer_values(df, "name", lookup, "label")) == sorted([("a", "a"), ("b", None), (None, None), (None, "c")], key=repr)


def test_empty_lookups(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    empty = spark.createDataFrame([], "label string, key int")
    assert rows(with_surrogate(df, empty, "name", "label", "key", "k")) == [(1, "a", None)]
    assert rows(with_membership(df, empty, "name", "label", "known")) == [(1, "a", False)]
    assert rows(repeated_names(df, empty, "name", "label")) == []


def test_key_count_like_a_window(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, None), (None, None), ("b", 2)], "k string, n int")
    window = df.withColumn("c", F.count("*").over(Window.partitionBy("k", "n")))
    assert rows(with_key_count(df, ["k", "n"], "c")) == rows(window)


def test_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    assert rows(distinct_union(a, b)) == [(1,), (2,), (3,)]
    assert rows(tagged_union({"a": a, "b": b}, "tag").groupBy("tag").count()) == [("a", 3), ("b", 2)]


def test_unreadable_cells(spark):
    df = spark.createDataFrame([(1, "5", "Inf", "2016"), (2, "x", "NaN", "never")], "id int, n string, d string, t string")
    report = unreadable_cells(df, ["id"], numbers=["n"], doubles=["d"], dates=["t"])
    assert rows(report) == [(2, "d", "NaN"), (2, "n", "x"), (2, "t", "never")]


def test_row_numbers_with_a_hot_value(spark, tmp_path):
    """A third of the rows share the order key, and some rows are full duplicates."""
    data = [(0 if i % 3 == 0 else random.Random(i).randint(1, 50), i // 2) for i in range(3000)]
    spark.createDataFrame(data, "k int, v int").write.parquet(str(tmp_path / "t"))
    out = with_row_numbers(spark.read.parquet(str(tmp_path / "t")), ["k"]).orderBy("row_number").collect()
    assert [r["row_number"] for r in out] == list(range(1, 3001))
    assert [r["k"] for r in out] == sorted(k for k, _ in data)
    assert sorted((r["k"], r["v"]) for r in out) == sorted(data)


@pytest.mark.parametrize("split", ["64b", "1000b", "128m"])
def test_line_numbers_over_many_splits(spark, tmp_path, split):
    for name, n in (("a.tsv", 500), ("b.tsv", 3)):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        out = read_numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(out) == 503
    assert all(r["value"] == f"{r['file'].rsplit('/', 1)[1]} {r['line_number']}" for r in out)


def test_parsers_run_on_a_stream(spark, tmp_path):
    """The expressions keep no state, so a stream of files can use them as they are."""
    from skyledger.plans.shape import typed

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("1.5M\t2016 Jun  8?\n-\t-\n")
    stream = spark.readStream.schema("n string, d string").option("sep", "\t").csv(str(tmp_path / "in"))
    query = typed(stream, numbers=["n"], dates=["d"]).writeStream.format("memory").queryName("parsed").start()
    query.processAllAvailable()
    query.stop()
    assert rows(spark.sql("SELECT n, CAST(d AS STRING), d_precision FROM parsed")) == sorted(
        [(1500000.0, "2016-06-08 00:00:00", "Days"), (None, None, None)], key=repr
    )


def test_an_audit_counts_what_each_rule_decides(spark):
    df = spark.createDataFrame([("a", "k"), ("a?", "k"), ("b", None), (None, "k"), ("c?", "m"), ("?", "m")], "x string, y string")
    fixes = [
        Fix("x", cases=(Case("A", when={"x": ("a",)}, strip="?"), Case("B", when={"x": ("b",), "y": ("k",)})), steps=(Strip("?"), Replace("c", "d"))),
        exact("y", {"k": None, "z": "never"}),
    ]
    out, audit = correct_audited(df, fixes)
    plain = correct(df, fixes)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    assert [row[:4] for row in audit.hits()] == [
        ("x", 1, "case", 2), ("x", 2, "case", 0), ("x", 3, "step", 2), ("x", 4, "step", 1), ("y", 1, "case", 3), ("y", 2, "case", 0),
    ]
    empty, audit = correct_audited(df.limit(0), fixes)
    assert empty.collect() == [] and {row[3] for row in audit.hits()} == {0}


def test_cases_that_an_earlier_one_covers():
    wide, narrow = Case("w", when={"x": ("a", "b")}), Case("n", when={"x": ("a",), "y": ("k",)})
    assert Fix("x", cases=(wide, narrow)).covered() == [2]
    assert Fix("x", cases=(narrow, wide)).covered() == []
    assert Fix("x", cases=(wide, Case("s", when={"x": ("a",)}, strip="?"))).covered() == []
    assert Fix("x", cases=(Case("l", like={"x": "^a"}), Case("m", like={"x": "^a"}, when={"y": ("k",)}), Case("o", like={"x": "^b"}))).covered() == [2]


def test_no_rule_of_the_tables_is_covered():
    fixes = [*tables.LAUNCH_FIXES, tables.PAYLOAD_ORG_FIX, *tables.SATELLITE_FIXES, *tables.PAYLOAD_FIXES]
    assert {fix.column: fix.covered() for fix in fixes if fix.covered()} == {}
