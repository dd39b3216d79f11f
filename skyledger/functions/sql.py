"""Session functions, so that SQL users call the parsers by name.

    register_functions(spark)
    spark.sql("SELECT vague_to_date(t_start), decorated_to_number(mass) FROM raw")
    spark.sql("SELECT code, item FROM raw, LATERAL list_items(parents, '/')")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from skyledger.functions.codes import ORBITAL_CODES, SUBORBITAL_CODES
from skyledger.functions.dates import sql_definitions
from skyledger.functions.numbers import double_sql, fail_sql, number_sql
from skyledger.functions.text import clean_sql


def _letters(codes: tuple[str, ...]) -> str:
    return ", ".join(f"'{code}'" for code in codes)


def definitions() -> list[str]:
    def scalar(name: str, returns: str, body: str, params: str = "s STRING") -> str:
        return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}"

    split = r"array_remove(split(s, concat('[\\Q', delimiters, '\\E]')), '')"
    return sql_definitions() + [
        scalar("clean_text", "STRING", clean_sql("s")),
        scalar("decorated_to_number", "DOUBLE", number_sql("s", fail_sql("s", "number"))),
        scalar("decorated_to_double", "DOUBLE", double_sql("s", fail_sql("s", "number or infinity"))),
        scalar(
            "is_orbital",
            "INT",
            f"""CASE WHEN left(s, 1) IN ({_letters(ORBITAL_CODES)}) THEN 1
              WHEN left(s, 1) IN ({_letters(SUBORBITAL_CODES)}) THEN 0
              ELSE CAST(raise_error(concat('Launch code is neither orbital nor suborbital: ', coalesce(s, 'NULL'))) AS INT) END""",
        ),
        scalar("list_to_array", "ARRAY<STRING>", split, "s STRING, delimiters STRING"),
        scalar("list_items", "TABLE(item STRING)", f"SELECT explode({split})", "s STRING, delimiters STRING"),
    ]


def register_functions(spark: SparkSession) -> None:
    for statement in definitions():
        spark.sql(statement)
