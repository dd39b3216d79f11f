"""The common shape of a table recipe: rename and clean, correct, parse."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.dates import bad_dates, precision_sql, start_sql, unread_date_sql, with_date_parts, with_vague_dates
from skyledger.functions.lists import list_items
from skyledger.functions.numbers import (
    decorated_double_sql,
    decorated_number_sql,
    is_bad_double,
    is_bad_number,
    unread_double_sql,
    unread_number_sql,
)
from skyledger.functions.text import NULL_MARK, clean, clean_sql
from skyledger.operators.corrections import Fix, correct


#: Hidden columns that rows of a refresh carry until they are published: where a row was
#: read (a number unique in its layout), and its cells that could not be read.
AT, BAD = "__at", "__bad"


def visible(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (AT, BAD)]


def hidden(df: DataFrame) -> list[str]:
    return [c for c in (AT, BAD) if c in df.columns]


@dataclass(frozen=True)
class Inputs:
    """Staging tables by layout, tables already built, and the parsing mode."""

    staged: dict[str, DataFrame]
    built: dict[str, DataFrame] = field(default_factory=dict)
    strict: bool = True

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.staged.values())).sparkSession


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    table: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    build: Callable[[Inputs], DataFrame]
    sort: tuple[str, ...]
    primary: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    needs: tuple[str, ...] = ()


def column_name(prefix: str, source: str, rename: dict[str, str]) -> str:
    """Table prefix plus the source name in lower case, unless renamed."""
    lower = source.lower()
    return rename.get(source, lower if lower.startswith(prefix) else prefix + lower)


def cleaned(staged: DataFrame, prefix: str, columns: Iterable[str], rename: dict[str, str] | None = None) -> DataFrame:
    rename = rename or {}
    return staged.selectExpr(*[f"{clean_sql(c)} AS `{column_name(prefix, c, rename)}`" for c in columns], *hidden(staged))


def typed(
    df: DataFrame,
    numbers: Iterable[str] = (),
    doubles: Iterable[str] = (),
    dates: Iterable[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Parse columns in place; each date gains a ``_precision`` column after it.

    Strict parsing raises an error that names the first cell it cannot read. Otherwise
    such a cell is null, and the hidden column BAD lists (column, value, reason) of all
    of a row's; the reason comes from the parse that gave the value.
    """
    if not strict:
        return _lenient(df, list(numbers), list(doubles), list(dates))
    values = {c: decorated_number_sql(c, strict) for c in numbers} | {c: decorated_double_sql(c, strict) for c in doubles}
    if values:
        df = df.selectExpr(*[f"{values.get(c, f'`{c}`')} AS `{c}`" for c in df.columns])
    return with_vague_dates(df, {c: (c, f"{c}_precision") for c in dates}, strict)


def bad_cell(column: str, reason: str) -> str:
    """SQL of one entry of BAD; null without a reason."""
    return f"CASE WHEN ({reason}) IS NOT NULL THEN named_struct('column', '{column}', 'value', `{column}`, 'reason', {reason}) END"


def with_bad_cells(df: DataFrame, cells: list[str]) -> str:
    """SQL of BAD: what it holds already, and more cells."""
    more = f"array_compact(array({', '.join(cells)}))"
    return f"concat(`{BAD}`, {more})" if BAD in df.columns else more


def _lenient(df: DataFrame, numbers: list[str], doubles: list[str], dates: list[str]) -> DataFrame:
    parsed = {c: decorated_number_sql(c, False) for c in numbers} | {c: decorated_double_sql(c, False) for c in doubles}
    if not parsed and not dates:
        return df
    rows = df.selectExpr("*", *[f"{sql} AS `__value_{c}`" for c, sql in parsed.items()])
    rows = with_date_parts(rows, dates) if dates else rows
    reasons = {c: unread_number_sql(c, f"`__value_{c}`") for c in numbers} | {c: unread_double_sql(c, f"`__value_{c}`") for c in doubles}
    reasons |= {c: unread_date_sql(c) for c in dates}
    out: list[str] = []
    for c in df.columns:
        if c in parsed:
            out.append(f"`__value_{c}` AS `{c}`")
        elif c in dates:
            out += [f"{start_sql(c)} AS `{c}`", f"{precision_sql(c)} AS `{c}_precision`"]
        elif c != BAD:
            out.append(f"`{c}`")
    bad = with_bad_cells(df, [bad_cell(c, reason) for c, reason in reasons.items()])
    return rows.selectExpr(*out, f"{bad} AS `{BAD}`")


def unreadable_cells(
    df: DataFrame,
    keys: list[str],
    numbers: Iterable[str] = (),
    doubles: Iterable[str] = (),
    dates: Iterable[str] = (),
) -> DataFrame:
    """(keys, column, value) for every cell that strict parsing would refuse."""
    def cell(name: str, is_bad: Column) -> Column:
        return F.when(is_bad, F.struct(F.lit(name).alias("column"), F.col(name).alias("value")))

    cells = [cell(c, is_bad_number(c)) for c in numbers] + [cell(c, is_bad_double(c)) for c in doubles]
    reports = []
    if cells:
        reports.append(df.select(*keys, F.inline(F.array_compact(F.array(*cells)))))
    if dates:
        reports.append(bad_dates(df, keys, list(dates)))
    first, *rest = reports
    for report in rest:
        first = first.unionByName(report)
    return first


def entity(
    staged: DataFrame,
    prefix: str,
    columns: Iterable[str],
    rename: dict[str, str] | None = None,
    fixes: Iterable[Fix] = (),
    numbers: Iterable[str] = (),
    doubles: Iterable[str] = (),
    dates: Iterable[str] = (),
    strict: bool = True,
) -> DataFrame:
    """A whole table from one staging table. Parsed columns are given by source name."""
    rename = rename or {}

    def names(sources: Iterable[str]) -> list[str]:
        return [column_name(prefix, c, rename) for c in sources]

    df = correct(cleaned(staged, prefix, columns, rename), fixes)
    return typed(df, names(numbers), names(doubles), names(dates), strict)


def bridge(
    staged: DataFrame,
    keys: dict[str, str],
    cell: str,
    item: str,
    prepare: Callable[[Column], Column] = lambda c: c,
    tidy: Callable[[Column], Column] = lambda c: c,
    delimiters: str = "/",
) -> DataFrame:
    """One row per item of a list cell; `keys` maps output to staging columns.

    The null mark gives no rows; that filter reaches the scan. The cell is
    prepared, split and trimmed, then each item is tidied.
    """
    kinds = dict(staged.dtypes)
    key = {name: clean(F.col(c)) if kinds[c] == "string" else F.col(c) for name, c in keys.items()}
    rows = staged.filter(F.col(cell) != NULL_MARK).select(
        *[value.alias(name) for name, value in key.items()],
        F.explode(list_items(prepare(F.col(cell)), delimiters)).alias("__item"),
        *hidden(staged),
    )
    return rows.select(*keys, tidy(F.trim("__item")).alias(item), *hidden(staged))


def token_map(values: dict[str, str | None], then: Callable[[Column], Column] = lambda c: c) -> Callable[[Column], Column]:
    """Whole-item corrections after another tidy step."""
    def tidy(c: Column) -> Column:
        value = then(c)
        chain = None
        for old, new in values.items():
            chain = (F if chain is None else chain).when(value == old, F.lit(new))
        return chain.otherwise(value)

    return tidy
