"""Numbers with decorations: null mark, ``?``, ``M`` (millions), ``yr`` (years).

Functions take a column name and return a Column. The SQL text is shared with
the session functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DAYS_PER_YEAR = "365.26"
INFINITY_MARK = "Inf"

# A plain decimal or exponent number. The exponent stays in the range of a
# 40-digit decimal, so no finite text can become an infinity.
_PLAIN = " *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?(1[01][0-9]|12[0-5]|[0-9]{1,2}))? *"


def _undoubted(s: str) -> str:
    return f"replace({s}, '?', '')"


def _has_no_number(s: str) -> str:
    return f"({s} IS NULL OR {s} = '-' OR {_undoubted(s)} IN ('', 'M', 'yr', 'yrM'))"


def _has_no_double(s: str) -> str:
    return f"({s} IS NULL OR {s} = '-' OR {_undoubted(s)} = '')"


def number_sql(s: str, otherwise: str = "NULL") -> str:
    """Plain numbers first, the common case; ``M`` wins over ``yr``. Numbers of few
    digits multiply with their unit as decimals, which keeps values such as 1.1M
    exact and cuts nothing; all others multiply as doubles."""
    text = _undoubted(s)
    unit = f"CASE WHEN {text} LIKE '%M' THEN 1000000 ELSE {DAYS_PER_YEAR} END"
    digits = f"trim(rtrim('yrM', {text}))"
    return f"""
    CASE WHEN {text} RLIKE '^{_PLAIN}$' THEN CAST({text} AS DOUBLE)
      WHEN {_has_no_number(s)} THEN NULL
      WHEN {text} RLIKE '^ *[+-]?[0-9]{{1,15}}([.][0-9]{{0,4}})? *(yr)?M?$' THEN CAST(CAST({digits} AS DECIMAL(19, 4)) * {unit} AS DOUBLE)
      WHEN {text} RLIKE '^{_PLAIN}(yr)?M?$' THEN CAST({digits} AS DOUBLE) * {unit}
      ELSE {otherwise} END"""


def double_sql(s: str, otherwise: str = "NULL") -> str:
    """Exactly ``Inf`` is infinity; no other words and no unit suffixes."""
    text = _undoubted(s)
    return f"""
    CASE WHEN {text} RLIKE '^{_PLAIN}$' THEN CAST({text} AS DOUBLE)
      WHEN {_has_no_double(s)} THEN NULL
      WHEN {text} = '{INFINITY_MARK}' THEN CAST('Infinity' AS DOUBLE)
      ELSE {otherwise} END"""


def fail_sql(s: str, wanted: str) -> str:
    return f"CAST(raise_error(concat('Not a {wanted}: ', {s})) AS DOUBLE)"


def decorated_number_sql(name: str, strict: bool = True) -> str:
    s = f"`{name}`"
    return number_sql(s, fail_sql(s, "number") if strict else "NULL")


def decorated_double_sql(name: str, strict: bool = True) -> str:
    s = f"`{name}`"
    return double_sql(s, fail_sql(s, "number or infinity") if strict else "NULL")


def unread_number_sql(name: str, value: str) -> str:
    """Why a cell has no number, from its text and the value parsed before: no pattern is tried again."""
    return f"CASE WHEN {value} IS NULL AND NOT {_has_no_number(f'`{name}`')} THEN 'not a number' END"


def unread_double_sql(name: str, value: str) -> str:
    return f"CASE WHEN {value} IS NULL AND NOT {_has_no_double(f'`{name}`')} THEN 'not a number or infinity' END"


def decorated_number(name: str, strict: bool = True) -> Column:
    """Double for a decorated number; bad text raises, or is null if not strict."""
    return F.expr(decorated_number_sql(name, strict))


def decorated_double(name: str, strict: bool = True) -> Column:
    """Double that may be infinite."""
    return F.expr(decorated_double_sql(name, strict))


def is_bad_number(name: str) -> Column:
    s = f"`{name}`"
    return F.expr(f"NOT {_has_no_number(s)} AND NOT {_undoubted(s)} RLIKE '^{_PLAIN}(yr)?M?$'")


def is_bad_double(name: str) -> Column:
    s = f"`{name}`"
    return F.expr(
        f"NOT {_has_no_double(s)} AND {_undoubted(s)} <> '{INFINITY_MARK}' AND NOT {_undoubted(s)} RLIKE '^{_PLAIN}$'"
    )
