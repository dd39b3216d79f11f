"""Lookup joins: details, surrogate keys, membership and routing.

A lookup is first reduced to one row per key and then rebalanced, all within the
plan: nothing runs before the caller's action. The join has a shuffle of its own on
each side, so adaptive execution knows the lookup's size, broadcasts a small one,
and with a large one splits a skewed partition of the other side, which it does not
do when an aggregation sits between the shuffle and the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rebalanced(lookup: DataFrame) -> DataFrame:
    """An aggregated lookup in even partitions, see the note on lookups above."""
    return lookup.hint("rebalance")


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of same-layout tables with a constant column naming each."""
    tagged = [df.select(F.lit(name).alias(tag), "*") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def distinct_union(*frames: DataFrame) -> DataFrame:
    """Union without repeated rows; repeats collapse before the shuffle."""
    return reduce(DataFrame.unionByName, frames).distinct()


def left_detail(df: DataFrame, detail: DataFrame, key: str, detail_key: str) -> DataFrame:
    """Left join that keeps the key once. `detail` should be a table, or
    an aggregation made `rebalanced` if a key of `df` may be hot."""
    return df.join(detail, F.col(key) == F.col(detail_key), "left").drop(detail_key)


def with_surrogate(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, surrogate: str, name: str) -> DataFrame:
    """Left join to a surrogate id by a name that should be unique.

    The lookup is first reduced to one row per name, so a repeated name cannot
    multiply rows; `repeated_names` reports those names.
    """
    one = rebalanced(lookup.groupBy(F.col(lookup_key).alias("__name")).agg(F.min(surrogate).alias(name)))
    return df.join(one, F.col(key) == F.col("__name"), "left").drop("__name")


def repeated_names(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """(name, matches, row_count): names that match more than one lookup row.

    Both sides are counted before they meet, so no pair of rows is formed.
    """
    used = df.groupBy(F.col(key).alias("name")).agg(F.count("*").alias("row_count"))
    many = lookup.groupBy(F.col(lookup_key).alias("name")).agg(F.count("*").alias("matches")).filter("matches > 1")
    return used.join(many, "name").select("name", "matches", "row_count")


def with_membership(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, flag: str) -> DataFrame:
    """Add whether the key exists in the lookup; never multiplies rows."""
    known = rebalanced(lookup.select(F.col(lookup_key).alias("__known")).distinct())
    joined = df.join(known, F.col(key) == F.col("__known"), "left")
    return joined.withColumn(flag, F.col("__known").isNotNull()).drop("__known")


def with_key_count(df: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Rows per key beside each row, as a window count would give; nulls are equal.

    The counts are aggregated and joined back, so a key that fills a third of
    the table is never one window in one task. Only keys counted above one travel.
    """
    names = [f"__key_{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count("*").alias(count))
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    repeated = rebalanced(counts.filter(F.col(count) > 1))
    joined = df.join(repeated, reduce(lambda a, b: a & b, match), "left").drop(*names)
    return joined.withColumn(count, F.coalesce(count, F.lit(1).cast("long")))


def route(value: Column, matched: Column, hit: str, miss: str) -> list[Column]:
    """Put a value into one of two columns."""
    return [F.when(matched, value).alias(hit), F.when(~matched, value).alias(miss)]


def full_outer_values(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> DataFrame:
    """Distinct values of two columns side by side, null where one side lacks it."""
    a = left.select(left_column).distinct()
    b = right.select(right_column).distinct()
    return a.join(b, F.col(left_column) == F.col(right_column), "full")
