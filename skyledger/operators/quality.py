"""Checks that return reports.

Every check gives rows (check, table_name, rule, value, row_count) and none when all
is well. Checks aggregate by key before any join, so a key that fills a third
of a table is one row by the time it is shuffled to the other side.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT = "check string, table_name string, rule string, value string, row_count long"

# Hidden name of the row count, so that a key may have any name.
ROWS = "__rows"

# The types an export knows how to write, as Spark names them.
ALLOWED_TYPES = ("string", "timestamp_ntz", "double", "bigint", "int")


class CheckFailed(ValueError):
    """A check found rows; the message shows the first of them."""


def shown(*columns: str) -> Column:
    """Key values as one text, with nulls visible."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def _report(rows: DataFrame, check: str, table: str, rule: str, value: Column, count: Column) -> DataFrame:
    return rows.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        value.alias("value"),
        count.cast("long").alias("row_count"),
    )


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def _all_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row count) for keys held by two or more rows."""
    return df.groupBy(*keys).agg(F.count("*").alias(ROWS)).filter(F.col(ROWS) >= 2)


def primary_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys that repeat, and keys with a null part. One aggregation."""
    bad = df.groupBy(*keys).agg(F.count("*").alias(ROWS)).filter((F.col(ROWS) >= 2) | _any_null(keys))
    return _report(bad, "primary key", table, ", ".join(keys), shown(*keys), F.col(ROWS))


def unique_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys that repeat, nulls being equal; rows with only nulls are exempt."""
    bad = duplicate_keys(df.filter(~_all_null(keys)), keys)
    return _report(bad, "unique key", table, ", ".join(keys), shown(*keys), F.col(ROWS))


def missing_parents(child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """(columns, row count) for child keys that no parent row has.

    A key with a null part is not checked. The distinct keys of each side meet,
    so neither a popular child key nor a repeated parent key weighs on one task.
    """
    used = child.filter(~_any_null(columns)).groupBy(*columns).agg(F.count("*").alias(ROWS))
    known = parent.select(*[F.col(p).alias(f"__parent_{i}") for i, p in enumerate(parent_columns)]).distinct()
    match = [F.col(c) == F.col(f"__parent_{i}") for i, c in enumerate(columns)]
    return used.join(known, reduce(lambda a, b: a & b, match), "left_anti")


def foreign_key(
    child: DataFrame, table: str, columns: list[str], parent: DataFrame, parent_table: str, parent_columns: list[str]
) -> DataFrame:
    bad = missing_parents(child, columns, parent, parent_columns)
    rule = f"{', '.join(columns)} -> {parent_table}({', '.join(parent_columns)})"
    return _report(bad, "foreign key", table, rule, shown(*columns), F.col(ROWS))


def null_safe_key(
    child: DataFrame, table: str, columns: list[str], parent: DataFrame, parent_table: str, parent_columns: list[str]
) -> DataFrame:
    """Like `foreign_key`, but null matches null; only a null first part is skipped."""
    used = child.filter(F.col(columns[0]).isNotNull()).groupBy(*columns).agg(F.count("*").alias(ROWS))
    known = parent.select(*[F.col(p).alias(f"__parent_{i}") for i, p in enumerate(parent_columns)]).distinct()
    match = [F.col(c).eqNullSafe(F.col(f"__parent_{i}")) for i, c in enumerate(columns)]
    bad = used.join(known, reduce(lambda a, b: a & b, match), "left_anti")
    rule = f"{', '.join(columns)} <=> {parent_table}({', '.join(parent_columns)})"
    return _report(bad, "null-safe key", table, rule, shown(*columns), F.col(ROWS))


def not_null(df: DataFrame, table: str, column: str) -> DataFrame:
    bad = df.agg(F.count_if(F.col(column).isNull()).alias(ROWS)).filter(F.col(ROWS) > 0)
    return _report(bad, "not null", table, column, F.lit("NULL"), F.col(ROWS))


def parent_in_domains(df: DataFrame, table: str, column: str, domains: list[tuple[DataFrame, str]]) -> DataFrame:
    """Values that none of several key columns holds."""
    keys = reduce(DataFrame.unionByName, [d.select(F.col(c).alias("__key")) for d, c in domains])
    bad = missing_parents(df, [column], keys, ["__key"])
    return _report(bad, "parent in domains", table, column, shown(column), F.col(ROWS))


def one_parent_by_name(df: DataFrame, table: str, name: str, parent_name: str) -> DataFrame:
    """Parent names held by no row, or by more than one, of the same table.

    Names are counted on both sides first; the children of one popular parent
    are a single row in the join.
    """
    used = df.groupBy(F.col(parent_name).alias("__wanted")).agg(F.count("*").alias("children"))
    held = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("__held")).agg(F.count("*").alias("matches"))
    joined = used.join(held, F.col("__wanted") == F.col("__held"), "left")
    bad = joined.withColumn("matches", F.coalesce("matches", F.lit(0))).filter("matches <> 1")
    value = F.concat(shown("__wanted"), F.when(F.col("matches") == 0, ": no match").otherwise(": several matches"))
    return _report(bad, "one parent", table, f"{parent_name} -> {name}", value, F.col("children"))


def reconciled(master: DataFrame, loaded: Column, detail: DataFrame, table: str, rule: str) -> DataFrame:
    """All detail rows must have reached the master: two counts side by side."""
    got = master.agg(F.count_if(loaded).alias("got")).withColumn("staged", F.lit(0))
    staged = detail.agg(F.count("*").alias("staged")).withColumn("got", F.lit(0))
    both = got.unionByName(staged).agg(F.sum("got").alias("got"), F.sum("staged").alias("staged"))
    value = F.concat(F.lit("loaded "), F.col("got").cast("string"), F.lit(", staged "), F.col("staged").cast("string"))
    return _report(both.filter("got <> staged"), "reconciliation", table, rule, value, F.col("staged") - F.col("got"))


def row_floor(df: DataFrame, table: str, floor: int) -> DataFrame:
    bad = df.agg(F.count("*").alias(ROWS)).filter(F.col(ROWS) < floor)
    value = F.concat(F.lit(f"at least {floor} expected, "), F.col(ROWS).cast("string"), F.lit(" found"))
    return _report(bad, "row floor", table, "count", value, F.col(ROWS))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables in one job."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def header_drift(actual: DataFrame, registry: DataFrame) -> DataFrame:
    """First lines that differ from the registry's header. Both inputs have one row per source."""
    bad = registry.join(actual, "source", "left").filter(~F.col("first_line").eqNullSafe(F.col("header")))
    value = F.concat(
        F.lit("Expected: "), F.col("header"), F.lit("\nActual: "), F.coalesce(F.col("first_line"), F.lit("NULL"))
    )
    return bad.select(
        F.lit("header").alias("check"),
        F.col("source").alias("table_name"),
        F.lit("first line").alias("rule"),
        value.alias("value"),
        F.lit(1).cast("long").alias("row_count"),
    )


def column_types(frames: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """(table_name, position, column_name, data_type, is_allowed): schemas as rows, no data read."""
    rows = [
        (table, i, name, kind, kind in ALLOWED_TYPES)
        for table, df in frames.items()
        for i, (name, kind) in enumerate(df.dtypes, 1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, is_allowed boolean"
    )


def allowed_types(df: DataFrame, table: str) -> DataFrame:
    bad = column_types({table: df}, df.sparkSession).filter("NOT is_allowed")
    value = F.concat(F.col("column_name"), F.lit("("), F.col("data_type"), F.lit(")"))
    return _report(bad, "column type", table, "allowed types", value, F.lit(0))


def width_profile(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, max_bytes) of every string column, in one pass."""
    names = [name for name, kind in df.dtypes if kind == "string"]
    widths = df.agg(*[F.max(F.octet_length(F.col(c))).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("max_bytes")) for c in names])
    return widths.select(F.lit(table).alias("table_name"), F.inline(pairs))


def value_origins(staged: DataFrame, tag: str, column: str, value: str) -> DataFrame:
    """Staging rows with a given raw value, and the source they came from."""
    return staged.filter(F.col(column) == value)


def union_reports(reports: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def require_none(report: DataFrame) -> None:
    """Raise with the first rows of a report, if it has any."""
    rows = report.take(20)
    if rows:
        lines = [
            f"{r['check']} {r['table_name']} [{r['rule']}]: {r['value']} ({r['row_count']} rows)"
            + (f" first at {r['file']}:{r['line']}" if "line" in r and r["line"] is not None else "")
            for r in rows
        ]
        raise CheckFailed("\n".join(lines))
