"""Files: written to the shared folder, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_queries import cells
from ledger_queries.registry import Tables, query
from skyledger.operators import quality
from skyledger.operators.numbering import read_numbered_lines
from skyledger.plans.shape import Inputs
from skyledger.plans.tables import launch
from skyledger.session import scratch
from skyledger.sinks.csv_files import dump_query, export_sorted_csv, read_csv_export, write_csv
from skyledger.sinks.snapshots import new_run, publish, read_snapshot, register_views, write_table
from skyledger.sinks.sql_script import insert_batches, row_statements, write_script
from skyledger.sources.registry import OBJECT_CATALOGS, SourceSpec, registry_frame
from skyledger.sources.sql_scripts import read_script
from skyledger.sources.text_files import first_lines, header_columns, newest_files, read_log, read_source, read_sources


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", folders_by: str | None = None, compression: str = "none") -> None:
    """A catalog as text: every part file starts with the ``#`` header."""
    named = df.withColumnRenamed(df.columns[0], f"#{df.columns[0]}")
    write_csv(named, path, mode, delimiter="\t", folders_by=folders_by, compression=compression)


def spec_of(name: str, df: DataFrame) -> SourceSpec:
    return SourceSpec(name, tuple(df.columns), 1)


@query("q_tsv_roundtrip", "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM customer")
def tsv_roundtrip(t: Tables) -> DataFrame:
    """Written with a header per part file; read back without headers and comments."""
    df = t.customer.select([F.col(c).cast("string") for c in t.customer.columns])
    root, spec = scratch(t.spark, "tsv"), spec_of("customer", df)
    write_tsv(df, spec.path(root))
    t.spark.range(1).select(F.lit("# a comment").alias("line")).write.mode("append").text(spec.path(root))
    return read_source(t.spark, root, spec)


@query(
    "q_tagged_scan",
    """
    SELECT (["""
    + ", ".join(f"'{name}'" for name in OBJECT_CATALOGS)
    + f"""])[1 + l_partkey % {len(OBJECT_CATALOGS)}] AS s_catalog, count(*) AS objects,
      count(DISTINCT l_partkey) AS names, CAST(sum(l_quantity) AS BIGINT) AS mass, count(DISTINCT l_orderkey) AS launches,
      count(*) FILTER (l_linestatus = 'F') AS unmade FROM lineitem GROUP BY ALL""",
)
def tagged_scan(t: Tables) -> DataFrame:
    """All catalog files with all columns, written in one pass and read in one scan, each row tagged with its file."""
    root = scratch(t.spark, "catalogs")
    files = F.array(*[F.lit(f"{name}.tsv") for name in OBJECT_CATALOGS])
    place = F.trim("Satcat").cast("long") % len(OBJECT_CATALOGS)
    staged = cells.objects(t).drop("s_catalog")
    write_tsv(staged.withColumn("file", F.get(files, place.cast("int"))), root, folders_by="file", compression="gzip")
    specs = [spec_of(f"file={name}", staged) for name in OBJECT_CATALOGS]
    rows = read_sources(t.spark, root, specs, "s_catalog")
    return rows.groupBy(F.substring_index("s_catalog", "=", -1).alias("s_catalog")).agg(
        F.count("*").alias("objects"),
        F.countDistinct("Name").alias("names"),
        F.sum(F.col("Mass").cast("double")).cast("long").alias("mass"),
        F.countDistinct(F.regexp_extract("JCAT", "J([0-9]+)-", 1)).alias("launches"),
        F.count_if(F.col("Manufacturer") == "-").alias("unmade"),
    )


HEADERS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
}


def written_headers(t: Tables) -> tuple[str, dict[str, SourceSpec]]:
    root, specs = scratch(t.spark, "headers"), {}
    for name, columns in HEADERS.items():
        df = getattr(t, name).select(*columns)
        specs[name] = spec_of(name, df)
        write_tsv(df, specs[name].path(root))
    return root, specs


@query(
    "q_header_split",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{name}', {i}, 'col{i:03d}', '{c}', (SELECT count(*) FROM {name}))"
        for name, columns in HEADERS.items()
        for i, c in enumerate(columns, 1)
    )
    + ") v(source, position, staging_column, column_name, row_count)",
)
def header_split(t: Tables) -> DataFrame:
    """Column names and numbers from first lines, with the rows below them."""
    root, specs = written_headers(t)
    split = header_columns(first_lines(t.spark, root, specs.values()), "source", "first_line")
    counts = quality.row_counts({name: read_source(t.spark, root, spec) for name, spec in specs.items()})
    return split.join(counts, split.source == counts.table_name).drop("table_name")


@query(
    "q_header_drift",
    """
    WITH h AS (SELECT concat_ws(chr(9), '#p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice') AS header)
    SELECT 'header' AS "check", 'part' AS table_name, 'first line' AS rule,
      'Expected: ' || header || chr(10) || 'Actual: ' || replace(header, 'p_name', 'p_title') AS value, CAST(1 AS BIGINT) AS row_count,
      2 * (SELECT count(*) FROM part) AS source_rows, (SELECT max(p_retailprice) FROM part) AS dearest FROM h""",
)
def header_drift(t: Tables) -> DataFrame:
    """One of two part files has another header; the report, beside what the source holds."""
    root, specs = written_headers(t)
    write_tsv(t.part.withColumnRenamed("p_name", "p_title"), specs["part"].path(root), "append")
    report = quality.header_drift(first_lines(t.spark, root, specs.values()), registry_frame(t.spark, specs))
    held = read_source(t.spark, root, specs["part"]).agg(
        F.lit("part").alias("table_name"), F.count("*").alias("source_rows"), F.max(F.col("p_retailprice").cast("double")).alias("dearest")
    )
    return report.join(held, "table_name")


@query("q_physical_lines", "SELECT count(*) AS lines, CAST(0 AS BIGINT) AS misplaced FROM orders")
def physical_lines(t: Tables) -> DataFrame:
    """Lines numbered within their files; sorted files let each number be checked."""
    path = scratch(t.spark, "lines")
    ordered = t.orders.select("o_orderkey").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    ordered.select(F.col("o_orderkey").cast("string")).write.text(path)
    lines = read_numbered_lines(t.spark, path).select("file", "line_number", F.col("value").cast("long").alias("key"))
    # In a sorted file without gaps, key minus line number is one constant.
    spread = lines.groupBy("file").agg(F.count("*").alias("n"), F.max(F.col("key") - F.col("line_number")).alias("hi"), F.min(F.col("key") - F.col("line_number")).alias("lo"))
    return spread.agg(F.sum("n").alias("lines"), F.sum(F.col("hi") - F.col("lo")).alias("misplaced"))


@query("q_log_lines", "SELECT concat_ws(' ', doc_id, lang, translate(text, chr(10) || chr(13), '  ')) AS line FROM documents UNION ALL SELECT NULL")
def log_lines(t: Tables) -> DataFrame:
    """A log as one column; an empty line is a null."""
    path = scratch(t.spark, "log")
    t.documents.select(F.concat_ws(" ", F.col("doc_id").cast("string"), "lang", F.translate("text", "\n\r", "  ")).alias("line")).write.text(path)
    t.spark.range(1).select(F.lit("").alias("line")).write.mode("append").text(path)
    return read_log(t.spark, path)


@query("q_csv_roundtrip", "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Whole texts with quotes, commas and line breaks, exported in order and read back."""
    df = t.documents.select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch(t.spark, "csv")
    export_sorted_csv(df, path)
    return read_csv_export(t.spark, path, df.schema)


@query(
    "q_batch_append",
    "SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value, props FROM events",
)
def batch_append(t: Tables) -> DataFrame:
    """The results of two query texts, which together cover the table, in one export."""
    path = scratch(t.spark, "dump")
    t.events.createOrReplaceTempView("dumped_events")
    paid = "coalesce(event_type IN ('click', 'error'), false)"
    for i, part in enumerate((paid, f"NOT {paid}")):
        text = f"SELECT * FROM dumped_events WHERE {part}"
        dump_query(t.spark, text, path, append=i > 0, delimiter="|", header=True, timestamp_format="yyyy-MM-dd HH:mm:ss")
    return read_csv_export(t.spark, path, t.events.schema, delimiter="|")


@query(
    "q_unsupported_type",
    "SELECT CAST(vec_id AS VARCHAR) AS vec_id, 'WARNING - ARRAY type is not supported' AS embedding, CAST(label AS VARCHAR) AS label FROM embeddings",
)
def unsupported_type(t: Tables) -> DataFrame:
    """Columns that text cannot hold become a warning."""
    path = scratch(t.spark, "warned")
    write_csv(t.embeddings.select("vec_id", "embedding", "label"), path)
    return t.spark.read.option("header", "true").schema("vec_id string, embedding string, label string").csv(path)


@query(
    "q_sql_literals",
    r"""
    SELECT 'select ' || o_orderkey || ',''' || replace(CASE o_orderstatus WHEN 'F' THEN 'it''s ' || o_orderpriority ELSE o_orderpriority END, '''', '''''') || ''','''
      || CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'F' THEN strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') ELSE '' END
      || ''',' || CASE o_orderstatus WHEN 'O' THEN 'binary_double_infinity' WHEN 'F' THEN CAST(o_custkey AS VARCHAR) ELSE 'null' END AS statement
    FROM orders""",
)
def sql_literals(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'F' THEN concat(\"it's \", o_orderpriority) ELSE o_orderpriority END AS note",
        "CASE o_orderstatus WHEN 'O' THEN o_orderdate WHEN 'F' THEN o_orderdate + INTERVAL 90 MINUTES END AS at",
        "CASE o_orderstatus WHEN 'O' THEN DOUBLE('Infinity') WHEN 'F' THEN DOUBLE(o_custkey) END AS amount",
    )
    return row_statements(df)


@query(
    "q_batches",
    """
    SELECT batch, count(*) AS rows, 'insert into nations' || chr(10) || string_agg(statement, ' union all' || chr(10) ORDER BY statement COLLATE "C") || ';' AS script FROM (
      SELECT statement, (row_number() OVER (ORDER BY statement COLLATE "C") - 1) // 75 + 1 AS batch FROM (
        SELECT 'select ' || o_orderkey || ',''' || o_orderpriority || '''' AS statement FROM orders)) GROUP BY batch""",
)
def batches(t: Tables) -> DataFrame:
    """Numbered INSERT statements of 75 rows over the whole table."""
    return insert_batches(t.orders.select("o_orderkey", "o_orderpriority"), "nations")


@query(
    "q_script_roundtrip",
    """
    SELECT doc_id, nullif(text, '') AS text, lang, source, CASE WHEN n_chars % 7 = 0 THEN 'infinity'::DOUBLE ELSE n_chars / 8 END AS size,
      CASE WHEN n_chars % 5 > 0 THEN TIMESTAMP '2000-02-28' + INTERVAL (n_chars) SECOND END AS at FROM documents""",
)
def script_roundtrip(t: Tables) -> DataFrame:
    """Whole texts with quotes, commas and line breaks, numbers and times, written as INSERT statements and read back."""
    df = t.documents.selectExpr(
        "doc_id", "text", "lang", "source",
        "CASE WHEN n_chars % 7 = 0 THEN DOUBLE('Infinity') ELSE n_chars / 8D END AS size",
        "CASE WHEN n_chars % 5 > 0 THEN TIMESTAMP_NTZ '2000-02-28' + make_dt_interval(0, 0, 0, n_chars) END AS at",
    )
    path = scratch(t.spark, "script")
    write_script(df, "documents", path)
    return read_script(t.spark, path, df.schema)


@query(
    "q_snapshot_roundtrip",
    """
    SELECT 'v10' AS version, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def snapshot_roundtrip(t: Tables) -> DataFrame:
    """Two published versions; readers of the named views see the newer one."""
    root = scratch(t.spark, "snapshot")
    for version in ("v9", "v10"):
        df = t.orders.select(F.lit(version).alias("version"), "*")
        run = new_run()
        write_table(df, root, run, "orders", ["o_orderkey"])
        publish(t.spark, root, version, run, ["orders"])
    register_views(read_snapshot(t.spark, root), "public_")
    return t.spark.sql("SELECT * FROM public_orders")


@query("q_newest_file", "SELECT 'v2' AS newest_version, * FROM orders")
def newest_file(t: Tables) -> DataFrame:
    """Files listed newest first without reading them; then the newest version alone is read."""
    root = scratch(t.spark, "files")
    for version in ("v1", "v2"):
        t.orders.write.parquet(f"{root}/{version}")
    newest = newest_files(t.spark, root).filter(F.col("path").endswith(".parquet")).head()["path"]
    version = newest.split("/")[-2]
    return t.spark.read.parquet(f"{root}/{version}").select(F.lit(version).alias("newest_version"), "*")


@query(
    "q_table_export",
    "SELECT o_orderstatus, count(*) AS launches, min('T' || o_orderkey) AS first_tag FROM orders GROUP BY o_orderstatus",
)
def table_export(t: Tables) -> DataFrame:
    """A built table exported as CSV and read back with its types."""
    root = scratch(t.spark, "export")
    df = write_table(launch(Inputs({"launch": cells.launch(t)})), root, "v1", "launch")
    export_sorted_csv(df, f"{root}/csv")
    back = read_csv_export(t.spark, f"{root}/csv", df.schema)
    return back.groupBy(F.col("l_dest").alias("o_orderstatus")).agg(F.count("*").alias("launches"), F.min("l_launch_tag").alias("first_tag"))
