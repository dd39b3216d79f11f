"""Imprecise dates: the known vectors, the gaps around them, and a round trip."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.functions.dates import MONTHS, bad_dates, with_vague_dates
from skyledger.functions.sql import register_functions

VECTORS = [
    ("2016 Jun  8 2355:57", "2016-06-08 23:55:57", "Second"),
    ("2016 Jun  8 2355:57?", "2016-06-08 23:55:57", "Seconds"),
    ("2016 Jun  8 2355", "2016-06-08 23:55:00", "Minute"),
    ("2016 Jun  8 2355?", "2016-06-08 23:55:00", "Minutes"),
    ("2016 Jun  8.98", "2016-06-08 23:31:12", "Centiday"),
    ("2016 Jun  8.98?", "2016-06-08 23:31:12", "Centidays"),
    ("2016 Jun  8 23h", "2016-06-08 23:00:00", "Hour"),
    ("2016 Jun  8 23h?", "2016-06-08 23:00:00", "Hours"),
    ("2016 Jun  8.9", "2016-06-08 21:36:00", "Hour"),
    ("2016 Jun  8.9?", "2016-06-08 21:36:00", "Hours"),
    ("2016 Jun 10.5", "2016-06-10 12:00:00", "Hour"),
    ("2016 Jun 11.5?", "2016-06-11 12:00:00", "Hours"),
    ("2016 Jun  8", "2016-06-08 00:00:00", "Day"),
    ("2016 Jun  8?", "2016-06-08 00:00:00", "Days"),
    ("2016 Jun 30", "2016-06-30 00:00:00", "Day"),
    ("2016 Jun 30?", "2016-06-30 00:00:00", "Days"),
    ("2016 Jun", "2016-06-01 00:00:00", "Month"),
    ("2016 Jun?", "2016-06-01 00:00:00", "Months"),
    ("2016 Q2", "2016-04-01 00:00:00", "Quarter"),
    ("2016 Q2?", "2016-04-01 00:00:00", "Quarters"),
    ("2016", "2016-01-01 00:00:00", "Year"),
    ("2016?", "2016-01-01 00:00:00", "Years"),
    ("2010s", "2010-01-01 00:00:00", "Decade"),
    ("2010s?", "2010-01-01 00:00:00", "Decades"),
    ("21C", "2000-01-01 00:00:00", "Century"),
    ("21C?", "2000-01-01 00:00:00", "Centuries"),
    ("3M", "2000-01-01 00:00:00", "Millenium"),
    ("3M?", "2000-01-01 00:00:00", "Millenia"),
    ("700?", "0700-01-01 00:00:00", "Years"),
    ("927 Jul 12", "0927-07-12 00:00:00", "Day"),
    ("?", None, None),
    (None, None, None),
    ("-", None, None),
    ("*", None, None),
    ("BC 146 Jun 28", "-0146-06-28 00:00:00", "Day"),
    ("2016 Jun   8", "2016-06-08 00:00:00", "Day"),
    ("2016 Jun  18", "2016-06-18 00:00:00", "Day"),
]
GAPS = [
    ("", None, None),
    ("2016 Q1", "2016-01-01 00:00:00", "Quarter"),
    ("2016 Q3", "2016-07-01 00:00:00", "Quarter"),
    ("2016 Q4", "2016-10-01 00:00:00", "Quarter"),
    ("927 Jul", "0927-07-01 00:00:00", "Month"),
    ("BC 146", "-0146-01-01 00:00:00", "Year"),
    ("BC 0146 Jun", "-0146-06-01 00:00:00", "Month"),
    ("BC 0146 Jun 28 0000:00", "-0146-06-28 00:00:00", "Second"),
    ("2016 Jun   8 2355", "2016-06-08 23:55:00", "Minute"),
    ("2016 Jun  18 2355?", "2016-06-18 23:55:00", "Minutes"),
    ("2016 Jun 8 23h", "2016-06-08 23:00:00", "Hour"),
    ("2015 Feb ?", "2015-02-01 00:00:00", "Months"),
    ("2016 Feb 29", "2016-02-29 00:00:00", "Day"),
]
BAD = [
    "2021 Feb 30", "2021 Jan  0", "2021 Fen 14", "2023 Mar 19 0048??", "2016 Jun  8 2355:57.345", "2016 Q5",
    "0000", "1M", "1C", "2016 Jun  8 2400", "2016 Jun  8 2360", "2016 Jun  8 2355:60", "99M", "soon", "2016 Jun  8 235",
]


def parsed(spark, texts, strict=True):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string").withColumn("d", F.col("s"))
    out = with_vague_dates(df, {"d": ("date", "word")}, strict)
    rows = out.select("s", F.col("date").cast("string"), "word").orderBy("i").collect()
    return [tuple(row) for row in rows]


def test_vectors(spark):
    expected = VECTORS + GAPS
    assert parsed(spark, [v[0] for v in expected]) == expected


def test_sql_functions_agree(spark):
    register_functions(spark)
    expected = VECTORS + GAPS
    spark.createDataFrame([(v[0],) for v in expected], "s string").createOrReplaceTempView("vectors")
    query = "SELECT s, CAST(vague_to_date(s) AS STRING) d, vague_to_precision(s) p FROM vectors"
    rows = {row["s"]: (row["d"], row["p"]) for row in spark.sql(query).collect()}
    assert rows == {s: (d, p) for s, d, p in expected}


@pytest.mark.parametrize("text", BAD)
def test_strict_names_the_value(spark, text):
    with pytest.raises(Exception, match="Unreadable date"):
        parsed(spark, [text])


def test_report_mode(spark):
    assert parsed(spark, BAD, strict=False) == [(text, None, None) for text in BAD]
    df = spark.createDataFrame([(t, t) for t in BAD + ["2016", "-", None]], "k string, d string")
    rows = bad_dates(df, ["k"], ["d"]).collect()
    assert sorted(row["value"] for row in rows) == sorted(BAD)
    assert {row["column"] for row in rows} == {"d"}


def render(ts: dt.datetime, kind: str, doubt: bool) -> tuple[str, dt.datetime]:
    """Text at a precision, and the first moment of that period."""
    day = f"{ts.year:04d} {MONTHS[ts.month - 1]} {ts.day:2d}"
    start = ts.replace(hour=0, minute=0, second=0)
    texts = {
        "Year": (f"{ts.year:04d}", start.replace(month=1, day=1)),
        "Decade": (f"{ts.year // 10 * 10:04d}s", start.replace(year=ts.year // 10 * 10, month=1, day=1)),
        "Quarter": (f"{ts.year:04d} Q{(ts.month + 2) // 3}", start.replace(month=(ts.month + 2) // 3 * 3 - 2, day=1)),
        "Month": (day[:8], start.replace(day=1)),
        "Day": (day, start),
        "Hour": (f"{day} {ts.hour:02d}h", ts.replace(minute=0, second=0)),
        "Minute": (f"{day} {ts.hour:02d}{ts.minute:02d}", ts.replace(second=0)),
        "Second": (f"{day} {ts.hour:02d}{ts.minute:02d}:{ts.second:02d}", ts),
    }
    text, first = texts[kind]
    return text + ("?" if doubt else ""), first


moments = st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 1, 1)).map(
    lambda t: t.replace(microsecond=0)
)
kinds = st.sampled_from(["Year", "Decade", "Quarter", "Month", "Day", "Hour", "Minute", "Second"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(moments, kinds, st.booleans()), min_size=50, max_size=200))
def test_rendered_moments_come_back(spark, cases):
    rendered = [render(*case) for case in cases]
    got = parsed(spark, [text for text, _ in rendered])
    for (text, date, word), (_, first), (_, kind, doubt) in zip(got, rendered, cases):
        assert date == first.strftime("%Y-%m-%d %H:%M:%S").rjust(19, "0"), text
        assert word == kind + ("s" if doubt else "")
