"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_queries import cells
from ledger_queries.registry import Tables, query
from skyledger.operators import quality
from skyledger.plans import tables as recipes
from skyledger.plans.pipeline import check_floors, check_table
from skyledger.plans.shape import Inputs
from skyledger.sources.registry import SourceSpec


def report(check: str, table: str, rule: str, rows: str) -> str:
    """SQL of a report over a query with `value` and `n`."""
    return f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{rule}' AS rule, value, CAST(n AS BIGINT) AS row_count FROM ({rows})"


@query(
    "q_pk_report",
    report(
        "primary key",
        "lineitem",
        "l_orderkey, l_linenumber",
        "SELECT l_orderkey || '|' || l_linenumber AS value, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    ),
)
def pk_report(t: Tables) -> DataFrame:
    return quality.primary_key(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"])


@query(
    "q_unique_nullable",
    report(
        "unique key",
        "vehicle",
        "name, variant",
        """SELECT coalesce(name, 'NULL') || '|' || coalesce(variant, 'NULL') AS value, count(*) AS n FROM (
        SELECT CASE p_type WHEN 'SMALL' THEN NULL ELSE p_name END AS name, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN NULL ELSE p_brand END AS variant
        FROM part) WHERE name IS NOT NULL OR variant IS NOT NULL GROUP BY name, variant HAVING count(*) > 1""",
    ),
)
def unique_nullable(t: Tables) -> DataFrame:
    """Equal nulls repeat a key; rows with only nulls are exempt."""
    df = t.part.selectExpr(
        "CASE p_type WHEN 'SMALL' THEN NULL ELSE p_name END AS name",
        "CASE WHEN p_type IN ('SMALL', 'PROMO') THEN NULL ELSE p_brand END AS variant",
    )
    return quality.unique_key(df, "vehicle", ["name", "variant"])


@query(
    "q_orphans",
    report(
        "foreign key",
        "documents",
        "doc_id -> labels(doc_id)",
        "SELECT CAST(doc_id AS VARCHAR) AS value, 1 AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    ),
)
def orphans(t: Tables) -> DataFrame:
    """Documents that nobody labelled."""
    return quality.foreign_key(t.documents, "documents", ["doc_id"], t.labels, "labels", ["doc_id"])


@query(
    "q_orphan_orders",
    report(
        "foreign key",
        "orders",
        "o_custkey -> customer(c_custkey)",
        """SELECT CAST(o_custkey AS VARCHAR) AS value, count(*) AS n FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""",
    ),
)
def orphan_orders(t: Tables) -> DataFrame:
    """Orders of customers without a positive balance."""
    sound = t.customer.filter("c_acctbal >= 0")
    return quality.foreign_key(t.orders, "orders", ["o_custkey"], sound, "customer", ["c_custkey"])


@query(
    "q_orphans_composite",
    report(
        "foreign key",
        "conversations",
        "conv_id, next_turn -> conversations(conv_id, turn)",
        """SELECT conv_id || '|' || next_turn AS value, count(*) AS n FROM (
        SELECT conv_id, CASE WHEN role <> 'assistant' THEN turn + 1 END AS next_turn FROM conversations) c
        WHERE next_turn IS NOT NULL AND NOT EXISTS (SELECT 1 FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn = c.next_turn)
        GROUP BY conv_id, next_turn""",
    ),
)
def orphans_composite(t: Tables) -> DataFrame:
    """Turns that should be answered but are not; answers point nowhere and are skipped."""
    child = t.conversations.selectExpr("conv_id", "CASE WHEN role <> 'assistant' THEN turn + 1 END AS next_turn")
    return quality.foreign_key(
        child, "conversations", ["conv_id", "next_turn"], t.conversations, "conversations", ["conv_id", "turn"]
    )


@query(
    "q_parent_polymorphic",
    report(
        "parent in domains",
        "orders",
        "parent",
        """SELECT parent AS value, count(*) AS n FROM (
        SELECT CASE o_orderstatus WHEN 'O' THEN 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') WHEN 'F' THEN 'NATION_' || (o_custkey % 30) END AS parent
        FROM orders) WHERE parent IS NOT NULL AND parent NOT IN (SELECT s_name FROM supplier UNION ALL SELECT n_name FROM nation) GROUP BY parent""",
    ),
)
def parent_polymorphic(t: Tables) -> DataFrame:
    """Parents that are neither a supplier nor a nation."""
    child = t.orders.selectExpr(
        "CASE o_orderstatus WHEN 'O' THEN concat('Supplier#', lpad(o_custkey, 9, '0')) WHEN 'F' THEN concat('NATION_', o_custkey % 30) END AS parent"
    )
    return quality.parent_in_domains(child, "orders", "parent", [(t.supplier, "s_name"), (t.nation, "n_name")])


@query(
    "q_parent_self",
    report(
        "one parent",
        "part",
        "parent_name -> name",
        """SELECT coalesce(w.parent_name, 'NULL') || CASE WHEN matches IS NULL THEN ': no match' ELSE ': several matches' END AS value, children AS n
        FROM (SELECT parent_name, count(*) AS children FROM (SELECT CASE p_type WHEN 'PROMO' THEN 'gone ' || p_brand ELSE p_name END AS parent_name FROM part) GROUP BY 1) w
        LEFT JOIN (SELECT p_name, count(*) AS matches FROM part GROUP BY p_name) h ON w.parent_name = h.p_name
        WHERE matches IS NULL OR matches <> 1""",
    ),
)
def parent_self(t: Tables) -> DataFrame:
    """Parent names that no row, or more than one row, carries."""
    df = t.part.selectExpr("p_name AS name", "CASE p_type WHEN 'PROMO' THEN concat('gone ', p_brand) ELSE p_name END AS parent_name")
    return quality.one_parent_by_name(df, "part", "name", "parent_name")


@query(
    "q_null_safe_join",
    report(
        "null-safe key",
        "lines",
        "part, variant <=> part(part, variant)",
        """SELECT part || '|' || coalesce(variant, 'NULL') AS value, count(*) AS n FROM (
        SELECT l_partkey AS part, CASE l_linestatus WHEN 'O' THEN l_returnflag END AS variant FROM lineitem) c
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'A' WHEN 'LARGE' THEN 'R' END AS variant FROM part) p
          WHERE p.p_partkey = c.part AND p.variant IS NOT DISTINCT FROM c.variant) GROUP BY part, variant""",
    ),
)
def null_safe_join(t: Tables) -> DataFrame:
    """Composite keys where a null variant matches a null variant."""
    child = t.lineitem.selectExpr("l_partkey AS part", "CASE l_linestatus WHEN 'O' THEN l_returnflag END AS variant")
    parent = t.part.selectExpr("p_partkey AS part", "CASE p_type WHEN 'SMALL' THEN 'A' WHEN 'LARGE' THEN 'R' END AS variant")
    return quality.null_safe_key(child, "lines", ["part", "variant"], parent, "part", ["part", "variant"])


@query(
    "q_not_null",
    report("not null", "lineitem", "variant", "SELECT 'NULL' AS value, count(*) AS n FROM lineitem WHERE l_linestatus = 'F'"),
)
def not_null(t: Tables) -> DataFrame:
    df = t.lineitem.selectExpr("CASE l_linestatus WHEN 'O' THEN l_returnflag END AS variant")
    return quality.not_null(df, "lineitem", "variant")


@query(
    "q_row_floor",
    f"""
    SELECT 'row floor' AS "check", source AS table_name, 'count' AS rule, 'at least ' || floor || ' expected, ' || n || ' found' AS value, n AS row_count
    FROM (SELECT 'orgs' AS source, 10 AS floor, (SELECT count(*) FROM customer) AS n
      UNION ALL SELECT 'launch', 1000000000, (SELECT count(*) FROM orders)
      UNION ALL SELECT 'satcat', 1000000000, (SELECT count(*) FROM lineitem WHERE {cells.OBJECT_CATALOG} = 'satcat')
      UNION ALL SELECT 'deepcat', 1, (SELECT count(*) FROM lineitem WHERE {cells.OBJECT_CATALOG} = 'deepcat')
      UNION ALL SELECT 'pdeepcat', 1, 0) WHERE n < floor""",
)
def row_floor(t: Tables) -> DataFrame:
    """Sources with too few rows, also one that has none at all."""
    floors = {"orgs": 10, "launch": 1_000_000_000, "satcat": 1_000_000_000, "deepcat": 1, "pdeepcat": 1}
    sources = {name: SourceSpec(name, ("x",), floor) for name, floor in floors.items()}
    staged = {"orgs": cells.orgs(t), "launch": cells.launch(t), "object": cells.objects(t)}
    return check_floors(staged, sources)


@query(
    "q_reconciliation",
    report(
        "reconciliation",
        "world",
        "spin rows",
        """SELECT 'loaded ' || got || ', staged ' || staged AS value, staged - got AS n FROM (
        SELECT (SELECT count(*) FROM supplier WHERE s_acctbal < 0) AS got, (SELECT count(*) FROM supplier) AS staged)""",
    ),
)
def reconciliation(t: Tables) -> DataFrame:
    """Detail rows that never reached their master table."""
    world = recipes.world(Inputs({"worlds": cells.worlds(t), "spin": cells.spin(t)}))
    return quality.reconciled(world, F.col("w_spin_rho").isNotNull(), t.supplier, "world", "spin rows")


WIDE = {
    "region": ("r_name",),
    "nation": ("n_name",),
    "customer": ("c_name", "c_mktsegment"),
    "supplier": ("s_name",),
    "part": ("p_name", "p_brand", "p_type"),
    "orders": ("o_orderstatus", "o_orderpriority"),
    "lineitem": ("l_returnflag", "l_linestatus"),
    "events": ("event_type", "props"),
    "documents": ("text", "lang", "source"),
    "pages": ("url", "html"),
    "benchmark": ("text",),
    "conversations": ("role", "text"),
}


@query(
    "q_width_profile",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, max(strlen({c})) AS max_bytes FROM {table}"
        for table, columns in WIDE.items()
        for c in columns
    ),
)
def width_profile(t: Tables) -> DataFrame:
    """Widest value of every string column, one pass per table."""
    return quality.union_reports(quality.width_profile(getattr(t, table), table) for table in WIDE)


@query(
    "q_type_whitelist",
    """
    SELECT * FROM (VALUES ('embeddings', 1, 'vec_id', 'bigint', true, (SELECT count(vec_id) FROM embeddings)),
      ('embeddings', 2, 'embedding', 'array<float>', false, (SELECT count(embedding) FROM embeddings)),
      ('embeddings', 3, 'label', 'int', true, (SELECT count(label) FROM embeddings)),
      ('events', 1, 'event_id', 'bigint', true, (SELECT count(event_id) FROM events)),
      ('events', 2, 'ts', 'timestamp_ntz', true, (SELECT count(ts) FROM events)),
      ('events', 3, 'user_id', 'bigint', true, (SELECT count(user_id) FROM events)),
      ('events', 4, 'event_type', 'string', true, (SELECT count(event_type) FROM events)),
      ('events', 5, 'value', 'double', true, (SELECT count(value) FROM events)),
      ('events', 6, 'props', 'string', true, (SELECT count(props) FROM events)))
      v(table_name, position, column_name, data_type, is_allowed, filled)""",
)
def type_whitelist(t: Tables) -> DataFrame:
    """Column types as rows, whether an export can write them, and how many values they hold."""
    frames = {"embeddings": t.embeddings, "events": t.events}
    filled = quality.union_reports(
        df.agg(*[F.count(c).alias(c) for c in df.columns]).select(
            F.lit(name).alias("table_name"),
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in df.columns])),
        )
        for name, df in frames.items()
    )
    return quality.column_types(frames, t.spark).join(filled, ["table_name", "column_name"])


@query("q_freshness", "SELECT max(o_orderdate) AS latest, count(*) AS orders FROM orders")
def freshness(t: Tables) -> DataFrame:
    return t.orders.agg(F.max("o_orderdate").alias("latest"), F.count("*").alias("orders"))


@query(
    "q_bad_value_origin",
    f"""
    SELECT {cells.OBJECT_CATALOG} AS s_catalog, count(*) AS n
    FROM lineitem WHERE l_linenumber = 7 GROUP BY ALL""",
)
def bad_value_origin(t: Tables) -> DataFrame:
    """Which source holds a value that no recipe can read."""
    rows = quality.value_origins(cells.objects(t), "s_catalog", "Launch_Tag", "-          UNK")
    return rows.groupBy("s_catalog").agg(F.count("*").alias("n"))


@query(
    "q_table_checks",
    report(
        "primary key",
        "launch_point_org",
        "lpo_site_code, lpo_lp_code, lpo_o_code",
        "SELECT NULL AS value, 0 AS n FROM part WHERE false",
    )
    + " UNION ALL "
    + report(
        "foreign key",
        "launch_point_org",
        "lpo_site_code, lpo_lp_code -> launch_point(lp_site_code, lp_code)",
        "SELECT NULL AS value, 0 AS n FROM part WHERE false",
    )
    + " UNION ALL "
    + report(
        "foreign key",
        "launch_point_org",
        "lpo_o_code -> organization(o_code)",
        """SELECT org AS value, count(*) AS n FROM (SELECT unnest(CASE p_type WHEN 'PROMO' THEN ['CN', 'DVNG'] WHEN 'SMALL' THEN []
        ELSE ['C' || p_size, 'PRCX'] END) AS org FROM part) WHERE org NOT IN (SELECT 'C' || c_custkey FROM customer) GROUP BY org""",
    ),
)
def table_checks(t: Tables) -> DataFrame:
    """Every check of one bridge table: types, key and both references."""
    built = {
        "organization": recipes.organization(Inputs({"orgs": cells.orgs(t)})),
        "launch_point": recipes.launch_point(Inputs({"lp": cells.lp(t)})),
        "launch_point_org": recipes.launch_point_org(Inputs({"lp": cells.lp(t)})),
    }
    return check_table("launch_point_org", built)
