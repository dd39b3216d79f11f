"""Lists, corrections, joins, sets, windows and order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_queries.registry import Tables, query
from skyledger.functions.lists import explode_list
from skyledger.functions.text import remove, strip_end, yes_no
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
from skyledger.operators.numbering import with_row_numbers
from skyledger.plans.shape import bridge, token_map
from skyledger.session import materialised


def part_lists(t: Tables) -> DataFrame:
    """Three items and an empty one per part; the name is doubted."""
    return t.part.selectExpr("p_partkey", "concat('/', p_brand, '/', p_type, '//', p_name, '?/') AS cell")


@query("q_list_explode", "SELECT p_partkey, unnest([p_brand, p_type, p_name]) AS item FROM part")
def list_explode(t: Tables) -> DataFrame:
    rows = explode_list(part_lists(t), "cell", "item")
    return rows.select("p_partkey", remove(F.col("item"), "?").alias("item"))


@query(
    "q_list_bridge_distinct",
    """
    SELECT p_brand AS brand, item, count(*) AS n FROM (SELECT p_brand, unnest([p_type, p_name, p_type]) AS item FROM part)
    GROUP BY ALL HAVING count(*) >= 2""",
)
def list_bridge_distinct(t: Tables) -> DataFrame:
    """Bridge rows whose (brand, item) key repeats."""
    cells = t.part.selectExpr("p_brand", "concat(p_type, '/', p_name, '?/', p_type) AS cell")
    rows = bridge(cells, {"brand": "p_brand"}, "cell", "item", tidy=lambda c: remove(c, "?"))
    return rows.groupBy("brand", "item").agg(F.count("*").alias("n")).filter("n >= 2")


@query(
    "q_list_flag",
    """
    SELECT event_id, unnest([event_type, 'user' || user_id]) AS category, unnest(['Yes', 'No']) AS is_secret FROM events""",
)
def list_flag(t: Tables) -> DataFrame:
    cells = t.events.selectExpr("event_id", "concat(event_type, '*?/user', user_id, '??') AS cell")
    rows = explode_list(cells, "cell", "item")
    item = F.col("item")
    return rows.select("event_id", strip_end(strip_end(item, "?"), "*").alias("category"), yes_no(item.contains("*")).alias("is_secret"))


@query(
    "q_list_charset_delim",
    """
    SELECT doc_id, count(*) AS items, max(strlen(item)) AS longest FROM (
      SELECT doc_id, unnest(regexp_split_to_array(text, '[ ,.\n]')) AS item FROM documents)
    WHERE item <> '' GROUP BY doc_id""",
)
def list_charset_delim(t: Tables) -> DataFrame:
    """Whole texts split at a set of delimiter characters."""
    rows = explode_list(t.documents.select("doc_id", "text"), "text", "item", " ,.\n")
    return rows.groupBy("doc_id").agg(F.count("*").alias("items"), F.max(F.octet_length("item")).cast("long").alias("longest"))


@query(
    "q_rules_first_match",
    """
    SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CARS' WHEN 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM customer""",
)
def rules_first_match(t: Tables) -> DataFrame:
    return correct(t.customer.select("c_custkey", "c_mktsegment"), [exact("c_mktsegment", {"AUTOMOBILE": "CARS", "BUILDING": None})])


@query(
    "q_rules_table",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_type = 'PROMO' THEN p_name ELSE 'Item ' || l_partkey END AS label
    FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def rules_table(t: Tables) -> DataFrame:
    """Corrections from a table as large as the data has distinct values."""
    lines = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_partkey", "concat('Item ', l_partkey) AS label")
    rules = t.part.filter("p_type = 'PROMO'").selectExpr("concat('Item ', p_partkey) AS wrong", "p_name AS right", "1 AS place")
    return correct_from_table(lines, rules, "label", "wrong", "right", "place")


#: Rules on orders, one of which no row can reach.
AUDITED = (
    Fix(
        "o_orderpriority",
        cases=(
            Case("now", when={"o_orderpriority": ("1-URGENT",), "o_orderstatus": ("F",)}),
            Case("soon", when={"o_orderpriority": ("1-URGENT", "2-HIGH")}),
            Case("late", when={"o_orderpriority": ("2-HIGH",), "o_orderstatus": ("O",)}),
        ),
        steps=(Replace("-", " "), Strip("MW"), Regex("^[0-9] LO$", "low"), Replace("?")),
    ),
    Fix("o_orderstatus", cases=(Case(None, like={"o_orderstatus": "^[PX]$"}),)),
)


@query(
    "q_rule_hits",
    """
    WITH o AS (SELECT o_orderpriority AS p, o_orderstatus AS s FROM orders),
    rest AS (SELECT replace(p, '-', ' ') AS a, p FROM o WHERE NOT coalesce(p IN ('1-URGENT', '2-HIGH'), false)),
    hits AS (
      SELECT 'o_orderpriority' AS column_name, 1 AS rule, 'case' AS kind, count(*) AS hits, false AS covered FROM o WHERE p = '1-URGENT' AND s = 'F'
      UNION ALL SELECT 'o_orderpriority', 2, 'case', count(*), false FROM o WHERE p IN ('1-URGENT', '2-HIGH') AND NOT coalesce(p = '1-URGENT' AND s = 'F', false)
      UNION ALL SELECT 'o_orderpriority', 3, 'case', 0, true
      UNION ALL SELECT 'o_orderpriority', 4, 'step', count(*), false FROM rest WHERE a <> p
      UNION ALL SELECT 'o_orderpriority', 5, 'step', count(*), false FROM rest WHERE rtrim(a, 'MW') <> a
      UNION ALL SELECT 'o_orderpriority', 6, 'step', count(*), false FROM rest WHERE regexp_matches(rtrim(a, 'MW'), '^[0-9] LO$')
      UNION ALL SELECT 'o_orderpriority', 7, 'step', 0, false
      UNION ALL SELECT 'o_orderstatus', 1, 'case', count(*), false FROM o WHERE regexp_matches(s, '^[PX]$'))
    SELECT *, (SELECT count(*) FROM o WHERE p IN ('1-URGENT', '2-HIGH')) AS renamed FROM hits""",
)
def rule_hits(t: Tables) -> DataFrame:
    """How many rows each rule of a correcting pass decided, those never hit and those never reached too, beside the rows that came out renamed."""
    out, audit = correct_audited(t.orders, AUDITED)
    renamed = materialised(out, "corrected").agg(F.count_if(F.col("o_orderpriority").isin("now", "soon")).alias("renamed"))
    hits = t.spark.createDataFrame(audit.hits(), "column_name string, rule int, kind string, hits long, covered boolean")
    # one row of one number
    return hits.select("*", F.lit(renamed.head()["renamed"]).cast("long").alias("renamed"))


@query(
    "q_rules_pair",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'DONE'
      WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'P' THEN 'PART' ELSE o_orderstatus END AS o_orderstatus,
      o_orderpriority FROM orders""",
)
def rules_pair(t: Tables) -> DataFrame:
    fix = Fix(
        "o_orderstatus",
        cases=(
            Case("DONE", when={"o_orderstatus": ("F",), "o_orderpriority": ("1-URGENT", "2-HIGH")}),
            Case(None, when={"o_orderstatus": ("O",), "o_orderpriority": ("5-LOW",)}),
        ),
        steps=(Regex("^P$", "PART"),),
    )
    return correct(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), [fix])


@query(
    "q_rules_sequential",
    """
    SELECT p_partkey, nullif(regexp_replace(regexp_replace(replace(replace(p_name, 'hot', 'warm'), 'warm ', ''), '^(red|blue)', 'dark'), 'ring$', ''), '') AS p_name
    FROM part""",
)
def rules_sequential(t: Tables) -> DataFrame:
    steps = (Replace("hot", "warm"), Replace("warm "), Regex("^(red|blue)", "dark"), Regex("ring$"))
    return correct(t.part.select("p_partkey", "p_name"), [Fix("p_name", steps=steps)])


@query(
    "q_rules_tokens",
    """
    SELECT p_partkey, unnest([CASE p_type WHEN 'PROMO' THEN 'DEAL' ELSE p_type END, p_type || 'X']) AS item FROM part""",
)
def rules_tokens(t: Tables) -> DataFrame:
    """Whole items are corrected; an item that only contains the wrong one is not."""
    cells = t.part.selectExpr("CAST(p_partkey AS BIGINT) AS key", "concat(p_type, '/', p_type, 'X?') AS cell")
    tidy = token_map({"PROMO": "DEAL"}, lambda c: remove(c, "?"))
    return bridge(cells, {"p_partkey": "key"}, "cell", "item", tidy=tidy)


@query(
    "q_rules_guarded",
    """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL ELSE 'T' || o_custkey END AS tag FROM orders""",
)
def rules_guarded(t: Tables) -> DataFrame:
    """A trailing counter goes; a tag that is only a mark and a counter is none."""
    raw = """CASE o_orderpriority WHEN '1-URGENT' THEN '-    199' WHEN '2-HIGH' THEN concat('T', o_custkey, '   199') ELSE concat('T', o_custkey) END"""
    tail = r"\s+199$"
    fix = Fix("tag", cases=(Case(None, like={"tag": "-" + tail}),), steps=(Regex(tail),))
    return correct(t.orders.select("o_orderkey", F.expr(raw).alias("tag")), [fix])


@query(
    "q_tuple_not_in",
    """
    SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM (
      SELECT l_returnflag, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus END AS l_linestatus, l_linenumber FROM lineitem)
    WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'R' AND l_linestatus = 'O')) GROUP BY ALL""",
)
def tuple_not_in(t: Tables) -> DataFrame:
    """Two pairs excluded; where a null leaves the answer unknown the row goes too."""
    df = t.lineitem.selectExpr("l_returnflag", "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus END AS l_linestatus", "l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    excluded = ((flag == "A") & (status == "F")) | ((flag == "R") & (status == "O"))
    return df.filter(~excluded).groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query(
    "q_union_tagged",
    """
    SELECT 'customer' AS source, count(*) AS n, min(c_acctbal) AS lowest, max(c_acctbal) AS highest FROM customer
    UNION ALL SELECT 'supplier', count(*), min(s_acctbal), max(s_acctbal) FROM supplier""",
)
def union_tagged(t: Tables) -> DataFrame:
    frames = {
        "customer": t.customer.selectExpr("c_name AS name", "c_acctbal AS balance"),
        "supplier": t.supplier.selectExpr("s_name AS name", "s_acctbal AS balance"),
    }
    return tagged_union(frames, "source").groupBy("source").agg(
        F.count("*").alias("n"), F.min("balance").alias("lowest"), F.max("balance").alias("highest")
    )


@query(
    "q_union_distinct",
    """
    SELECT DISTINCT p_size, unnest([p_brand, p_type]) AS item, 'left' AS side FROM part
    UNION SELECT DISTINCT p_size, unnest([p_type, p_name]), 'right' FROM part""",
)
def union_distinct(t: Tables) -> DataFrame:
    """Two list columns, each tagged, without repeats; then one row per item."""
    a = t.part.selectExpr("p_size", "concat(p_brand, '/', p_type) AS cell", "'left' AS side")
    b = t.part.selectExpr("p_size", "concat(p_type, '//', p_name) AS cell", "'right' AS side")
    return explode_list(distinct_union(a, b), "cell", "item").select("p_size", "item", "side").distinct()


@query("q_union_additions", "SELECT DISTINCT p_type AS kind FROM part UNION SELECT 'Spectrum' UNION SELECT 'PrSM'")
def union_additions(t: Tables) -> DataFrame:
    extra = t.spark.createDataFrame([("Spectrum",), ("PrSM",)], "kind string")
    return t.part.select(F.col("p_type").alias("kind")).unionByName(extra).distinct()


@query(
    "q_left_detail",
    """
    SELECT o_orderpriority, count(*) AS orders, count(lines) AS with_lines, CAST(sum(coalesce(lines, 0)) AS BIGINT) AS lines
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    GROUP BY o_orderpriority""",
)
def left_join_detail(t: Tables) -> DataFrame:
    # One row per order on both sides, so no key is hot and the aggregate's partitions serve the join.
    detail = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    joined = left_detail(t.orders.select("o_orderkey", "o_orderpriority"), detail, "o_orderkey", "l_orderkey")
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), F.count("lines").alias("with_lines"), F.sum(F.coalesce("lines", F.lit(0))).alias("lines")
    )


@query(
    "q_lookup_route",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NOT NULL THEN l_partkey END AS listed_part,
      CASE WHEN p_partkey IS NULL THEN l_partkey END AS other_part
    FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_retailprice > 950) ON p_partkey = l_partkey""",
)
def lookup_route(t: Tables) -> DataFrame:
    known = t.part.filter("p_retailprice > 950")
    lines = with_membership(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), known, "l_partkey", "p_partkey", "listed")
    return lines.select("l_orderkey", "l_linenumber", *route(F.col("l_partkey"), F.col("listed"), "listed_part", "other_part"))


@query(
    "q_lookup_surrogate",
    """
    SELECT a.p_partkey, b.id FROM part a JOIN (SELECT p_name, min(p_partkey) AS id FROM part GROUP BY p_name) b USING (p_name)""",
)
def lookup_surrogate(t: Tables) -> DataFrame:
    """A surrogate id by a name that repeats: the lowest, and no row multiplied."""
    lookup = t.part.selectExpr("p_name AS name", "p_partkey AS key")
    return with_surrogate(t.part.select("p_partkey", "p_name"), lookup, "p_name", "name", "key", "id").select("p_partkey", "id")


@query(
    "q_lookup_fanout",
    """
    SELECT p_name AS name, matches, row_count FROM (SELECT p_name, count(*) AS matches FROM part GROUP BY p_name HAVING count(*) > 1)
    JOIN (SELECT p_name, count(*) AS row_count FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_name) USING (p_name)""",
)
def lookup_fanout(t: Tables) -> DataFrame:
    """Names that would multiply rows, found by counting both sides."""
    lines = t.lineitem.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return repeated_names(lines, t.part, "p_name", "p_name")


@query(
    "q_full_outer_names",
    """
    SELECT a.kind AS p_type, b.kind AS event_type FROM (SELECT DISTINCT p_type AS kind FROM part) a
    FULL JOIN (SELECT DISTINCT CASE event_type WHEN 'click' THEN 'PROMO' ELSE event_type END AS kind FROM events) b ON a.kind = b.kind""",
)
def full_outer_names(t: Tables) -> DataFrame:
    events = t.events.selectExpr("CASE event_type WHEN 'click' THEN 'PROMO' ELSE event_type END AS event_type")
    return full_outer_values(t.part, "p_type", events, "event_type")


@query(
    "q_listagg_columns",
    """
    SELECT p_brand, string_agg(p_type || ':' || n, ',' ORDER BY p_type) AS kinds, CAST(sum(n) AS BIGINT) AS parts
    FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) GROUP BY p_brand""",
)
def listagg(t: Tables) -> DataFrame:
    """Ordered list per group; the items are counted first, so a list stays short."""
    counted = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    item = F.concat("p_type", F.lit(":"), F.col("n").cast("string"))
    kinds = F.array_join(F.array_sort(F.collect_list(item)), ",")
    return counted.groupBy("p_brand").agg(kinds.alias("kinds"), F.sum("n").alias("parts"))


@query(
    "q_window_numbers",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS same_key
    FROM lineitem""",
)
def window_count(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return with_key_count(lines, ["l_orderkey", "l_linenumber"], "same_key")


@query(
    "q_line_number",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_number FROM orders",
)
def line_number(t: Tables) -> DataFrame:
    """A stable number over a total order, without sorting in one task."""
    return with_row_numbers(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
