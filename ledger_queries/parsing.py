"""Dates, numbers, cleaning and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_queries.cells import day, quarter
from ledger_queries.registry import Tables, query
from skyledger.functions.codes import code_positions, group_parts, is_orbital, launch_code_parts
from skyledger.functions.dates import with_vague_dates
from skyledger.functions.numbers import decorated_double, decorated_number
from skyledger.functions.sql import register_functions
from skyledger.functions.text import NULL_MARK, after_first_blank, before_last, clean, first_token, glue, piece, remove, yes_no
from skyledger.operators.corrections import correct, exact
from skyledger.plans.shape import unreadable_cells

# Order dates as text: the priority picks the precision, a finished order is doubted.
ORDER_TEXT = f"""
concat(CASE o_orderpriority WHEN '1-URGENT' THEN {day("o_orderdate")} WHEN '2-HIGH' THEN date_format(o_orderdate, 'yyyy MMM')
  WHEN '3-MEDIUM' THEN CAST(year(o_orderdate) AS STRING) WHEN '4-NOT SPECIFIED' THEN {quarter("o_orderdate")}
  ELSE concat(substr(CAST(year(o_orderdate) AS STRING), 1, 3), '0s') END, CASE o_orderstatus WHEN 'F' THEN '?' ELSE '' END)
"""

ORDER_DATES = """
SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate WHEN '2-HIGH' THEN date_trunc('month', o_orderdate)
    WHEN '3-MEDIUM' THEN date_trunc('year', o_orderdate) WHEN '4-NOT SPECIFIED' THEN date_trunc('quarter', o_orderdate)
    ELSE date_trunc('decade', o_orderdate) END AS start,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Day' WHEN '2-HIGH' THEN 'Month' WHEN '3-MEDIUM' THEN 'Year'
    WHEN '4-NOT SPECIFIED' THEN 'Quarter' ELSE 'Decade' END || CASE o_orderstatus WHEN 'F' THEN 's' ELSE '' END AS precision
FROM orders"""


def order_dates(t: Tables) -> DataFrame:
    text = t.orders.select("o_orderkey", F.expr(ORDER_TEXT).alias("text"))
    return with_vague_dates(text, {"text": ("start", "precision")})


@query(
    "q_vague_precision_summary",
    f"SELECT precision, count(*) AS orders, min(start) AS first_start, max(start) AS last_start FROM ({ORDER_DATES}) GROUP BY precision",
)
def vague_precision_summary(t: Tables) -> DataFrame:
    return order_dates(t).groupBy("precision").agg(
        F.count("*").alias("orders"), F.min("start").alias("first_start"), F.max("start").alias("last_start")
    )


@query("q_vague_row_values", ORDER_DATES)
def vague_row_values(t: Tables) -> DataFrame:
    return order_dates(t)


@query("q_vague_sql_functions", ORDER_DATES)
def vague_sql_functions(t: Tables) -> DataFrame:
    """The same through the session functions."""
    register_functions(t.spark)
    text = t.orders.select("o_orderkey", F.expr(ORDER_TEXT).alias("text"))
    return text.selectExpr("o_orderkey", "vague_to_date(text) AS start", "vague_to_precision(text) AS precision")


@query(
    "q_vague_time_of_day",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, CASE l_returnflag || l_linestatus
        WHEN 'AF' THEN l_shipdate + to_minutes(l_linenumber * 60 + m) WHEN 'AO' THEN l_shipdate + to_seconds(l_linenumber * 3600 + m * 61)
        WHEN 'NF' THEN l_shipdate + to_hours(l_linenumber) WHEN 'NO' THEN l_shipdate + to_seconds(l_linenumber * 8640)
        WHEN 'RF' THEN l_shipdate + to_seconds(m * 864) ELSE l_shipdate + to_minutes(l_linenumber * 60 + m) END AS start,
      CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Minute' WHEN 'AO' THEN 'Second' WHEN 'NF' THEN 'Hour' WHEN 'NO' THEN 'Hour'
        WHEN 'RF' THEN 'Centiday' ELSE 'Minutes' END AS precision
    FROM (SELECT *, CAST(l_quantity AS BIGINT) AS m FROM lineitem)""",
)
def vague_time_of_day(t: Tables) -> DataFrame:
    """Line number as the hour, quantity as minutes, seconds or hundredths of a day."""
    clock = "' 0', l_linenumber, lpad(CAST(l_quantity AS INT), 2, '0')"
    text = f"""concat({day("l_shipdate")}, CASE concat(l_returnflag, l_linestatus)
      WHEN 'AF' THEN concat({clock}) WHEN 'AO' THEN concat({clock}, ':', lpad(CAST(l_quantity AS INT), 2, '0'))
      WHEN 'NF' THEN concat(' ', l_linenumber, 'h') WHEN 'NO' THEN concat('.', l_linenumber)
      WHEN 'RF' THEN concat('.', lpad(CAST(l_quantity AS INT), 2, '0')) ELSE concat({clock}, '?') END)"""
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", F.expr(text).alias("text"))
    return with_vague_dates(df, {"text": ("start", "precision")})


@query(
    "q_vague_large_units",
    """
    SELECT o_orderkey, y AS start_year, CASE o_orderpriority WHEN '1-URGENT' THEN 'Millenium' WHEN '2-HIGH' THEN 'Centuries'
      WHEN '3-MEDIUM' THEN 'Decade' WHEN '4-NOT SPECIFIED' THEN 'Year' ELSE 'Years' END AS precision
    FROM (SELECT *, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN year(o_orderdate) // 1000 * 1000
      WHEN '2-HIGH' THEN year(o_orderdate) // 100 * 100 WHEN '3-MEDIUM' THEN year(o_orderdate) // 10 * 10
      WHEN '4-NOT SPECIFIED' THEN 1800 - year(o_orderdate) ELSE year(o_orderdate) - 1500 END AS INTEGER) AS y FROM orders)""",
)
def vague_large_units(t: Tables) -> DataFrame:
    """Millennia, centuries, decades, years before the era and three-digit years."""
    y = "year(o_orderdate)"
    text = f"""CASE o_orderpriority WHEN '1-URGENT' THEN concat({y} div 1000 + 1, 'M') WHEN '2-HIGH' THEN concat({y} div 100 + 1, 'C?')
      WHEN '3-MEDIUM' THEN concat({y} div 10, '0s') WHEN '4-NOT SPECIFIED' THEN concat('BC ', {y} - 1800)
      ELSE concat({y} - 1500, '?') END"""
    df = with_vague_dates(t.orders.select("o_orderkey", F.expr(text).alias("text")), {"text": ("start", "precision")})
    return df.select("o_orderkey", F.year("start").alias("start_year"), "precision")


@query(
    "q_vague_sentinels",
    """
    SELECT o_orderpriority, count(*) AS orders, count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS dated
    FROM orders GROUP BY o_orderpriority""",
)
def vague_sentinels(t: Tables) -> DataFrame:
    text = f"""CASE o_orderpriority WHEN '1-URGENT' THEN '-' WHEN '2-HIGH' THEN '*' WHEN '3-MEDIUM' THEN '?'
      WHEN '5-LOW' THEN {day("o_orderdate")} END"""
    df = with_vague_dates(t.orders.select("o_orderpriority", F.expr(text).alias("text")), {"text": ("start", "precision")})
    return df.groupBy("o_orderpriority").agg(F.count("*").alias("orders"), F.count("start").alias("dated"))


@query(
    "q_vague_bad_report",
    """
    SELECT o_orderkey, 'ordered' AS "column", strftime(o_orderdate, '%Y Jux %d') AS value FROM orders WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT o_orderkey, 'price', CAST(o_custkey AS VARCHAR) || 'x' FROM orders WHERE o_orderstatus = 'P'""",
)
def vague_bad_report(t: Tables) -> DataFrame:
    """Misspelt months and junk numbers, one report row per bad cell."""
    df = t.orders.selectExpr(
        "o_orderkey",
        f"CASE o_orderpriority WHEN '5-LOW' THEN date_format(o_orderdate, \"yyyy 'Jux' dd\") ELSE {day('o_orderdate')} END AS ordered",
        "CASE o_orderstatus WHEN 'P' THEN concat(o_custkey, 'x') ELSE concat(o_custkey, '?') END AS price",
    )
    return unreadable_cells(df, ["o_orderkey"], numbers=["price"], dates=["ordered"])


@query(
    "q_number_suffix",
    """
    SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN NULL WHEN 'MEDIUM' THEN CAST(p_size AS DOUBLE)
      WHEN 'LARGE' THEN CAST(p_size * 1000000 AS DOUBLE) WHEN 'PROMO' THEN CAST(CAST(p_size AS DECIMAL(9, 0)) * 365.26 AS DOUBLE)
      ELSE p_retailprice END AS amount FROM part""",
)
def number_suffix(t: Tables) -> DataFrame:
    df = t.part.selectExpr(
        "p_partkey",
        """CASE p_type WHEN 'SMALL' THEN '-' WHEN 'MEDIUM' THEN concat(p_size, '?') WHEN 'LARGE' THEN concat(p_size, 'M')
        WHEN 'PROMO' THEN concat(p_size, 'yr?') ELSE CAST(p_retailprice AS STRING) END AS text""",
    )
    return df.select("p_partkey", decorated_number("text").alias("amount"))


@query(
    "q_number_infinity",
    """
    SELECT p_type, count(*) AS parts, count(CASE WHEN p_brand = 'Brand#1' THEN 1 END) AS infinite,
      max(CASE WHEN p_brand <> 'Brand#1' THEN p_retailprice END) AS largest_finite FROM part GROUP BY p_type""",
)
def number_infinity(t: Tables) -> DataFrame:
    df = t.part.selectExpr("p_type", "CASE WHEN p_brand = 'Brand#1' THEN 'Inf?' ELSE CAST(p_retailprice AS STRING) END AS text")
    value = df.select("p_type", decorated_double("text").alias("v"))
    infinite = F.col("v") == float("inf")
    return value.groupBy("p_type").agg(
        F.count("*").alias("parts"), F.count_if(infinite).alias("infinite"), F.max(F.when(~infinite, F.col("v"))).alias("largest_finite")
    )


@query(
    "q_clean_sentinel",
    """
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '-' WHEN 'FURNITURE' THEN NULL
      ELSE c_mktsegment END AS segment FROM customer""",
)
def clean_sentinel(t: Tables) -> DataFrame:
    """A bare mark is null, a padded mark is a dash, blanks are null."""
    raw = """CASE c_mktsegment WHEN 'BUILDING' THEN '-' WHEN 'MACHINERY' THEN ' - ' WHEN 'FURNITURE' THEN '   '
      ELSE concat('  ', c_mktsegment, ' ') END"""
    return t.customer.select("c_custkey", F.expr(raw).alias("raw")).select("c_custkey", clean(F.col("raw")).alias("segment"))


@query(
    "q_is_orbital",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END AS orbital,
      CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'P' THEN 'D' ELSE 'O' END AS category,
      CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'S' END AS status,
      CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR) END AS success_fraction FROM orders""",
)
def orbital(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey", "CASE o_orderstatus WHEN 'F' THEN concat('AF', o_custkey) WHEN 'P' THEN 'D' ELSE 'OS' END AS code"
    )
    parts = launch_code_parts(F.col("code"))
    return df.select("o_orderkey", is_orbital(F.col("code")).alias("orbital"), *[c.alias(n) for n, c in parts.items()])


@query(
    "q_code_bytes",
    "SELECT c_custkey, " + ", ".join(f"nullif(trim(substr(c_name, {i * 2}, 1)), '') AS byte_{i}" for i in range(1, 10)) + " FROM customer",
)
def code_bytes(t: Tables) -> DataFrame:
    """Every other character of the name, as positions of a code."""
    every_other = F.concat(*[F.substring("c_name", i * 2, 1) for i in range(1, 10)])
    df = t.customer.select("c_custkey", every_other.alias("code"))
    return df.select("c_custkey", *code_positions(F.col("code"), [f"byte_{i}" for i in range(1, 10)]))


@query(
    "q_group_split",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'C' || o_custkey || '/Lab' END AS agencies,
      CASE o_orderstatus WHEN 'F' THEN 'Smith,Jones' END AS investigators,
      CASE o_orderstatus WHEN 'O' THEN 'G' WHEN 'P' THEN 'C' || o_custkey END AS service_type,
      CASE o_orderstatus WHEN 'P' THEN 'D' END AS customer_types FROM orders""",
)
def group_split(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        """CASE o_orderstatus WHEN 'F' THEN concat('C', o_custkey, '/Lab/Smith,Jones') WHEN 'O' THEN 'G'
        ELSE concat('C', o_custkey, '/X/D') END AS cell""",
        "CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END AS orbital",
    )
    parts = group_parts(F.col("cell"), F.col("orbital"))
    return df.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query(
    "q_first_token",
    """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS token, split_part(p_name, ' ', 2) || CASE p_type WHEN 'PROMO' THEN '*' ELSE '' END AS rest,
      CASE p_type WHEN 'PROMO' THEN 'Yes' ELSE 'No' END AS marked FROM part""",
)
def split_first_token(t: Tables) -> DataFrame:
    df = t.part.selectExpr("p_partkey", "concat(replace(p_name, ' ', '   '), CASE p_type WHEN 'PROMO' THEN '*' ELSE '' END) AS cell")
    c = F.col("cell")
    return df.select("p_partkey", first_token(c).alias("token"), after_first_blank(c).alias("rest"), yes_no(c.contains("*")).alias("marked"))


@query(
    "q_null_default",
    """
    SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'Sun' WHEN s_nationkey = 1 THEN 'Sun' WHEN s_nationkey = 2 THEN 'Earth-Moon System'
      ELSE 'N' || s_nationkey END AS primary_name FROM supplier""",
)
def null_default(t: Tables) -> DataFrame:
    df = t.supplier.selectExpr(
        "s_suppkey",
        "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_nationkey = 1 THEN 'Sol' WHEN s_nationkey = 2 THEN 'EMB' ELSE concat('N', s_nationkey) END AS raw",
    )
    filled = df.select("s_suppkey", F.coalesce("raw", F.lit("Sun")).alias("primary_name"))
    return correct(filled, [exact("primary_name", {"Sol": "Sun", "EMB": "Earth-Moon System"})])


@query(
    "q_text_functions",
    r"""
    SELECT page_id, nullif(substr(url, 9), '') AS tail, nullif(regexp_extract(url, '^(.*)/', 1), '') AS before_last_slash,
      nullif(replace(url, 'https://', ''), '') AS bare, lpad(CAST(page_id AS VARCHAR), 6, '0') AS padded,
      length(url) AS characters, strlen(url) AS bytes, regexp_replace(url, '[0-9]+', '#', 'g') AS masked,
      regexp_extract(url, '[0-9]+') AS first_number, 'p' || page_id AS glued FROM pages""",
)
def text_functions(t: Tables) -> DataFrame:
    """The scalar text functions, on whole page addresses."""
    url = F.col("url")
    return t.pages.select(
        "page_id",
        piece(url, 9).alias("tail"),
        before_last(url, "/").alias("before_last_slash"),
        remove(url, "https://").alias("bare"),
        F.lpad(F.col("page_id").cast("string"), 6, "0").alias("padded"),
        F.char_length(url).cast("long").alias("characters"),
        F.octet_length(url).cast("long").alias("bytes"),
        F.regexp_replace(url, "[0-9]+", "#").alias("masked"),
        F.regexp_extract(url, "[0-9]+", 0).alias("first_number"),
        glue(F.lit("p"), F.lit(None).cast("string"), F.col("page_id").cast("string")).alias("glued"),
    )


@query(
    "q_filter_predicates",
    """
    SELECT count(*) AS lines FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE p_type NOT IN ('SMALL', 'PROMO') AND p_name LIKE '%o%' AND l_returnflag IN ('A', 'R') AND l_linestatus <> 'F'""",
)
def filter_predicates(t: Tables) -> DataFrame:
    """Null-mark, list and pattern filters; all of them reach the scans."""
    parts = t.part.filter(~F.col("p_type").isin("SMALL", "PROMO") & F.col("p_name").like("%o%"))
    lines = t.lineitem.filter(F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") != "F") & (F.col("l_returnflag") != NULL_MARK))
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).agg(F.count("*").alias("lines"))
