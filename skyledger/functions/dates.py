"""Imprecise dates: text such as ``2016 Jun  8.98?`` to a timestamp and a precision word.

The grammar is SQL text over named columns, in steps that each feed the next.
DataFrames run the steps as stacked projections, so each is evaluated once per
value and stays in generated code; SQL users get the same text as functions.

Labels, not instants: years before 1 are negative labels (``-0146``), as the
catalogs count them, and there is no year 0. Spark's calendar is proleptic
Gregorian, so labels before 1582 are kept but day differences across them are not.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The month names of the catalogs.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Precision words from widest to narrowest, certain and uncertain.
# Two shapes give an Hour: ``23h`` and a tenth of a day.
CERTAIN = (
    "Millenium", "Century", "Decade", "Year", "Quarter", "Month", "Day",
    "Hour", "Hour", "Centiday", "Minute", "Second",
)
UNCERTAIN = (
    "Millenia", "Centuries", "Decades", "Years", "Quarters", "Months", "Days",
    "Hours", "Hours", "Centidays", "Minutes", "Seconds",
)

# Kinds are positions in those lists; 0 is text outside the grammar.
MILLENIUM, CENTURY, DECADE, YEAR, QUARTER, MONTH, DAY, HOUR, TENTH, CENTIDAY, MINUTE, SECOND = range(1, 13)
_KIND_BY_LENGTH = {4: YEAR, 8: MONTH, 10: DAY, 11: DAY, 13: TENTH, 14: CENTIDAY, 16: MINUTE, 19: SECOND}

_MONTH = "|".join(MONTHS)
_LENGTHS = ", ".join(str(_KIND_BY_LENGTH.get(n, 0)) for n in range(1, 20))

# A year alone or with a month, a day, and an hour, a part of the day, or a time.
_CALENDAR = (
    f"^(?!0000)[0-9]{{4}}( (?i:{_MONTH})("
    " [ 0-9]?[0-9]( ([01]?[0-9]|2[0-3])h)?"
    r"| [ 0-9][0-9]([.][0-9]{1,2}| ([01][0-9]|2[0-3])[0-5][0-9](:[0-5][0-9])?)"
    ")?)?$"
)
# Counted periods whose first year lies between 1 and 9999.
_COUNTED = "^0*(([2-9]|10)M|([2-9]|[1-9][0-9]|100)C|[1-9][0-9]{0,3}s)$"

# The era, and surplus spaces before a two-digit or a one-digit day.
_NOISE = "^BC |(?<=[A-Za-z]) {1,2}(?= [0-9]{2})|(?<=[A-Za-z]) (?= {2}[0-9])"


def _body(s: str) -> str:
    """The text without doubt mark and noise, its year padded to four digits.

    Few cells have noise or a short year; the others skip the expressions for them.
    """
    certain = f"CASE WHEN {s} LIKE '%?' THEN rtrim(left({s}, char_length({s}) - 1)) ELSE {s} END"
    return f"""
    CASE WHEN substr({s}, 4, 1) IN ('', ' ', '?') OR {s} LIKE 'BC %'
        OR ({s} LIKE '%  %' AND ({s} LIKE '%   %' OR {s} RLIKE '  [0-9][0-9]'))
      THEN regexp_replace(regexp_replace({certain}, '{_NOISE}', ''), '^([0-9]{{3}})( |$)', '0$1$2')
      ELSE {certain} END"""


def _kind(s: str, body: str) -> str:
    """Position of the precision word; null where there is no date."""
    return f"""
    CASE WHEN {body} IS NULL OR {body} IN ('', '-', '*') THEN NULL
      WHEN {s} LIKE 'BC %' AND left({body}, 4) > '4712' THEN 0
      WHEN {body} RLIKE '{_CALENDAR}' THEN
        CASE WHEN {body} LIKE '%h' THEN {HOUR} ELSE element_at(array({_LENGTHS}), char_length({body})) END
      WHEN {body} RLIKE '^(?!0000)[0-9]{{4}} ?Q[1-4]$' THEN {QUARTER}
      WHEN {body} RLIKE '{_COUNTED}' THEN locate(right({body}, 1), 'MCs')
      ELSE 0 END"""


def _start(s: str, body: str, kind: str) -> str:
    """First moment of the period; null when the parts make no date.

    The kind vouches for the shape, so parts stand at fixed places.
    """
    def number(text: str) -> str:
        return f"CAST({text} AS INT)"

    count = number(f"left({body}, char_length({body}) - 1)")
    return f"""
    CASE WHEN {kind} > 0 THEN
      try_make_timestamp_ntz(
        CASE {kind} WHEN {MILLENIUM} THEN {count} * 1000 - 1000 WHEN {CENTURY} THEN {count} * 100 - 100
          WHEN {DECADE} THEN {count} ELSE {number(f"left({body}, 4)")} END * CASE WHEN {s} LIKE 'BC %' THEN -1 ELSE 1 END,
        CASE WHEN {kind} >= {MONTH} THEN (locate(lower(substr({body}, 6, 3)), '{"".join(MONTHS).lower()}') + 2) div 3
          WHEN {kind} = {QUARTER} THEN {number(f"right({body}, 1)")} * 3 - 2 ELSE 1 END,
        CASE WHEN {kind} >= {DAY} THEN {number(f"substr({body}, 10, 2)")} ELSE 1 END,
        CASE WHEN {kind} >= {MINUTE} THEN {number(f"substr({body}, 13, 2)")}
          WHEN {kind} = {HOUR} THEN {number(f"rtrim('h', substring_index({body}, ' ', -1))")} ELSE 0 END,
        CASE WHEN {kind} >= {MINUTE} THEN {number(f"substr({body}, 15, 2)")} ELSE 0 END,
        CASE WHEN {kind} = {SECOND} THEN {number(f"substr({body}, 18, 2)")} ELSE 0 END)
      + CASE {kind} WHEN {TENTH} THEN {number(f"right({body}, 1)")} * 8640
          WHEN {CENTIDAY} THEN {number(f"right({body}, 2)")} * 864 ELSE 0 END * INTERVAL '1' SECOND
    END"""


def _precision(s: str, kind: str) -> str:
    def words(names: tuple[str, ...]) -> str:
        return "array(" + ", ".join(f"'{name}'" for name in names) + ")"

    return f"""CASE WHEN {kind} > 0 THEN
      element_at(CASE WHEN {s} LIKE '%?' THEN {words(UNCERTAIN)} ELSE {words(CERTAIN)} END, {kind}) END"""


def _staged(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the hidden body and kind; the second projection reads the first."""
    df = df.selectExpr("*", *[f"{_body(f'`{c}`')} AS `__body_{c}`" for c in columns])
    return df.selectExpr("*", *[f"{_kind(f'`{c}`', f'`__body_{c}`')} AS `__kind_{c}`" for c in columns])


def _start_of(c: str) -> str:
    return _start(f"`{c}`", f"`__body_{c}`", f"`__kind_{c}`")


def _precision_of(c: str) -> str:
    return _precision(f"`{c}`", f"`__kind_{c}`")


def _fail(s: str) -> str:
    return f"CAST(raise_error(concat('Unreadable date: ', {s})) AS TIMESTAMP_NTZ)"


def with_vague_dates(df: DataFrame, columns: Mapping[str, tuple[str, str]], strict: bool = True) -> DataFrame:
    """Replace each text column by a timestamp and a precision column.

    `columns` maps a text column to its (date, precision) names. Text outside the
    grammar raises an error naming it; with ``strict=False`` both values are null.
    """
    if not columns:
        return df
    staged = _staged(df, list(columns))
    if not strict:
        staged = staged.selectExpr("*", *[f"{_start_of(c)} AS `__start_{c}`" for c in columns])
    out: list[str] = []
    for c in df.columns:
        if c not in columns:
            out.append(f"`{c}`")
            continue
        if strict:
            start = f"CASE WHEN `__kind_{c}` IS NOT NULL THEN coalesce({_start_of(c)}, {_fail(f'`{c}`')}) END"
            word = _precision_of(c)
        else:
            start = f"`__start_{c}`"
            word = f"CASE WHEN {start} IS NOT NULL THEN {_precision_of(c)} END"
        date, precision = columns[c]
        out += [f"{start} AS `{date}`", f"{word} AS `{precision}`"]
    return staged.selectExpr(*out)


def with_date_parts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the hidden kind and start of each text column, for the three functions below."""
    return _staged(df, columns).selectExpr("*", *[f"{_start_of(c)} AS `__start_{c}`" for c in columns])


def start_sql(c: str) -> str:
    return f"`__start_{c}`"


def precision_sql(c: str) -> str:
    return f"CASE WHEN `__start_{c}` IS NOT NULL THEN {_precision_of(c)} END"


def unread_date_sql(c: str) -> str:
    """Why a cell gives no date; null where it gives one or holds none."""
    return f"CASE WHEN `__kind_{c}` IS NOT NULL AND `__start_{c}` IS NULL THEN CASE WHEN `__kind_{c}` = 0 THEN 'not a date' ELSE 'no such day' END END"


def bad_dates(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows (keys, column, value) for every unreadable date, in one pass."""
    def cell(c: str) -> Column:
        is_bad = F.expr(f"`__kind_{c}` IS NOT NULL AND {_start_of(c)} IS NULL")
        return F.when(is_bad, F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")))

    staged = _staged(df, columns)
    return staged.select(*keys, F.inline(F.array_compact(F.array(*[cell(c) for c in columns]))))


def sql_definitions() -> list[str]:
    """The same steps as session functions; each call hands its result to the next."""
    result = "STRUCT<start: TIMESTAMP_NTZ, word: STRING>"
    start = f"CASE WHEN kind IS NOT NULL THEN coalesce({_start('s', 'body', 'kind')}, {_fail('s')}) END"
    steps = {
        "vague_date_of_kind(s STRING, body STRING, kind INT)": f"named_struct('start', {start}, 'word', {_precision('s', 'kind')})",
        "vague_date_of_body(s STRING, body STRING)": f"vague_date_of_kind(s, body, {_kind('s', 'body')})",
        "vague_date(s STRING)": f"vague_date_of_body(s, {_body('s')})",
    }
    return [f"CREATE OR REPLACE TEMPORARY FUNCTION {name} RETURNS {result} RETURN {text}" for name, text in steps.items()] + [
        "CREATE OR REPLACE TEMPORARY FUNCTION vague_to_date(s STRING) RETURNS TIMESTAMP_NTZ RETURN vague_date(s).start",
        "CREATE OR REPLACE TEMPORARY FUNCTION vague_to_precision(s STRING) RETURNS STRING RETURN vague_date(s).word",
    ]
