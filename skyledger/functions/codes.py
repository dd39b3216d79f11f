"""Position codes and the launch-code predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.text import after_last, before_first, before_last, clean, piece

# First letters of launch codes.
ORBITAL_CODES = ("D", "O", "X")
SUBORBITAL_CODES = ("A", "H", "M", "R", "S", "T", "Y", "!")


def is_orbital(code: Column, strict: bool = True) -> Column:
    """1 or 0 by the first letter; any other letter, or null, is an error.

    With ``strict=False`` an unknown code gives null instead.
    """
    letter = F.substring(code, 1, 1)
    known = F.when(letter.isin(*ORBITAL_CODES), 1).when(letter.isin(*SUBORBITAL_CODES), 0)
    if not strict:
        return known
    message = F.concat(F.lit("Launch code is neither orbital nor suborbital: "), F.coalesce(code, F.lit("NULL")))
    return known.otherwise(F.raise_error(message).cast("int"))


def code_positions(code: Column, names: list[str]) -> list[Column]:
    """One cleaned one-character column per position of a code."""
    return [clean(F.substring(code, i, 1)).alias(name) for i, name in enumerate(names, 1)]


def launch_code_parts(code: Column) -> dict[str, Column]:
    """Category letter, status letter, and the rest (a success fraction)."""
    return {
        "category": F.when(code != "-S", piece(code, 1, 1)),
        "status": piece(code, 2, 1),
        "success_fraction": piece(code, 3),
    }


def group_parts(group: Column, orbital: Column) -> dict[str, Column]:
    """Meaning of the slash-separated group cell, by kind of launch.

    Suborbital: agencies, then the investigators after the last slash.
    Orbital: the service type first, customer types after the last slash.
    """
    return {
        "agencies": F.when(orbital == 0, before_last(group, "/")),
        "investigators": F.when(orbital == 0, after_last(group, "/")),
        "service_type": F.when(orbital == 1, before_first(group, "/")),
        "customer_types": F.when((orbital == 1) & group.contains("/"), after_last(group, "/")),
    }
