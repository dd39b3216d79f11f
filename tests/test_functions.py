"""Numbers, text, lists and codes."""

import math

import pytest
from pyspark.sql import functions as F

from skyledger.functions import text as t
from skyledger.functions.codes import code_positions, group_parts, is_orbital, launch_code_parts
from skyledger.functions.lists import explode_list, list_items
from skyledger.functions.numbers import decorated_double, decorated_number, is_bad_double, is_bad_number
from skyledger.functions.sql import register_functions

NUMBERS = [
    ("-", None), (None, None), ("", None), ("?", None), ("12?", 12.0), ("1?2", 12.0), ("1.5M", 1500000.0), ("1.1M", 1100000.0),
    ("2yr", 730.52), ("1.1yr", 401.786), ("2yr?", 730.52), ("1E3", 1000.0), ("1E3M", 1e9), ("2yrM", 2e6), (".5", 0.5),
    ("5.", 5.0), ("-3", -3.0), ("+4", 4.0), (" 7", 7.0), ("5.97E24", 5.97e24), ("M", None),
]
BAD_NUMBERS = ["abc", "5d", "5f", "Inf", "NaN", "1e400", "1,000", "--1", "0x1p3", "5 M x", "- "]
DOUBLES = [("-", None), (None, None), ("Inf", math.inf), ("Inf?", math.inf), ("42000", 42000.0), ("42000?", 42000.0), ("?", None)]
BAD_DOUBLES = ["-Inf", "NaN", "3M", "Infinity", "1e400", "2yr"]


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def values(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_numbers(spark):
    df = column(spark, [s for s, _ in NUMBERS])
    assert values(df, decorated_number("s")) == [n for _, n in NUMBERS]
    assert not any(values(df, F.coalesce(is_bad_number("s"), F.lit(False))))


def test_doubles(spark):
    df = column(spark, [s for s, _ in DOUBLES])
    assert values(df, decorated_double("s")) == [n for _, n in DOUBLES]
    assert not any(values(df, F.coalesce(is_bad_double("s"), F.lit(False))))


def test_bad_numbers(spark):
    df = column(spark, BAD_NUMBERS)
    assert values(df, decorated_number("s", strict=False)) == [None] * len(BAD_NUMBERS)
    assert all(values(df, is_bad_number("s")))
    for text in BAD_NUMBERS:
        with pytest.raises(Exception, match="Not a number"):
            values(column(spark, [text]), decorated_number("s"))


def test_bad_doubles(spark):
    df = column(spark, BAD_DOUBLES)
    assert values(df, decorated_double("s", strict=False)) == [None] * len(BAD_DOUBLES)
    assert all(values(df, is_bad_double("s")))
    with pytest.raises(Exception, match="Not a number or infinity"):
        values(column(spark, ["-Inf"]), decorated_double("s"))


def test_clean(spark):
    df = column(spark, ["-", " - ", "  a ", "   ", "", None])
    assert values(df, t.clean(F.col("s"))) == [None, "-", "a", None, None, None]


def test_text_helpers(spark):
    df = column(spark, ["a/b/c", "abc", "/c", "a/", None])
    s = F.col("s")
    assert values(df, t.before_first(s, "/")) == ["a", "abc", None, "a", None]
    assert values(df, t.before_last(s, "/")) == ["a/b", None, None, "a", None]
    assert values(df, t.after_last(s, "/")) == ["c", "abc", "c", None, None]
    df = column(spark, ["AB??", "??", "A?B", None])
    assert values(df, t.strip_end(s)) == ["AB", None, "A?B", None]
    assert values(df, t.remove(s, "?")) == ["AB", None, "AB", None]
    df = column(spark, ["one two  three", "one", " one", None])
    assert values(df, t.first_token(s)) == ["one", "one", "one", None]
    assert values(df, t.after_first_blank(s)) == ["two  three", None, "one", None]
    assert values(df, t.glue(s, F.lit(None), F.lit("x")))[3] == "x"
    assert values(df, t.piece(s, 2, 2)) == ["ne", "ne", "on", None]


def test_lists(spark):
    df = column(spark, ["A/B", "A//B", "/A/", None, "", "A/B,C", "[x]"])
    assert values(df, list_items(F.col("s"))) == [["A", "B"], ["A", "B"], ["A"], None, [], ["A", "B,C"], ["[x]"]]
    assert values(df, list_items(F.col("s"), "/,"))[5] == ["A", "B", "C"]
    assert values(df, list_items(F.col("s"), "[]^-"))[6] == ["x"]
    assert explode_list(df, "s", "item").count() == 8


def test_codes(spark):
    df = column(spark, ["OS", "DF", "XU50", "A", "!", "YS"])
    assert values(df, is_orbital(F.col("s"))) == [1, 1, 1, 0, 0, 0]
    parts = launch_code_parts(F.col("s"))
    assert values(df, parts["category"]) == ["O", "D", "X", "A", "!", "Y"]
    assert values(df, parts["status"]) == ["S", "F", "U", None, None, "S"]
    assert values(df, parts["success_fraction"]) == [None, None, "50", None, None, None]
    for bad in ("-S", "Z", None):
        with pytest.raises(Exception, match="neither orbital nor suborbital"):
            values(column(spark, [bad]), is_orbital(F.col("s")))
    assert values(column(spark, ["-S", None]), is_orbital(F.col("s"), strict=False)) == [None, None]
    row = column(spark, ["P- A"]).select(*code_positions(F.col("s"), list("abcde"))).head()
    assert tuple(row) == ("P", None, None, "A", None)


def test_group_parts(spark):
    df = spark.createDataFrame([(0, "A/B/Smith,Jones", 0), (1, "Smith", 0), (2, "C/X/D", 1), (3, "C", 1)], "i int, g string, o int")
    parts = group_parts(F.col("g"), F.col("o"))
    assert values(df, parts["agencies"]) == ["A/B", None, None, None]
    assert values(df, parts["investigators"]) == ["Smith,Jones", "Smith", None, None]
    assert values(df, parts["service_type"]) == [None, None, "C", "C"]
    assert values(df, parts["customer_types"]) == [None, None, "D", None]


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql(
        "SELECT clean_text(' a ') a, clean_text('-') b, decorated_to_number('1.5M') c, decorated_to_double('Inf') d,"
        " is_orbital('OS') e, list_to_array('A/,B', '/,') f"
    ).head()
    assert tuple(row) == ("a", None, 1500000.0, math.inf, 1, ["A", "B"])
    spark.createDataFrame([(1, "A//B"), (2, None)], "k int, l string").createOrReplaceTempView("cells")
    rows = spark.sql("SELECT k, item FROM cells, LATERAL list_items(l, '/')").collect()
    assert sorted(tuple(r) for r in rows) == [(1, "A"), (1, "B")]
    with pytest.raises(Exception, match="Not a number"):
        spark.sql("SELECT decorated_to_number(s) FROM VALUES ('abc') t(s)").collect()
