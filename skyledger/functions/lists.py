"""List cells: ``A/B//C`` holds the items A, B and C."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_items(c: Column, delimiters: str = "/") -> Column:
    """Split on any of the delimiter characters and drop empty items."""
    return F.array_remove(F.split(c, f"[\\Q{delimiters}\\E]"), "")


def explode_list(df: DataFrame, column: str, item: str, delimiters: str = "/") -> DataFrame:
    """One row per list item; rows whose list is null or empty vanish.

    No shuffle: the fan-out happens inside the scan stage.
    """
    return df.withColumn(item, F.explode(list_items(F.col(column), delimiters)))
