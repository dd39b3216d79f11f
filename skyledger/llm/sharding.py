"""Contiguous shards of near-equal bytes, from prefix sums of per-partition totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import written


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text and one for its separator; a null text has none but the separator."""
    return (F.coalesce(F.octet_length(column), F.lit(0)) + 1).cast("long")


def shard_by_bytes(rows: DataFrame, size: Column, shards: int, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``rows`` packed as struct ``row``, with ``size``, ``start``, ``shard`` and ``slot``.

    Rows lie in the total order of ``order`` (nulls first, rows with equal keys in the
    order of the input) and are cut at equal shares of all bytes: a row belongs to the
    shard in which its first byte falls, so that shards differ by less than two rows'
    bytes. ``start`` is a row's byte offset in the whole, ``slot`` its place in its
    shard, from 0 without gaps. Sizes must be positive. A shard stays empty only where
    one row is larger than a share. Equal texts are not held together: a group of
    copies can be larger than a shard. An empty table gives no rows.

    Only the given columns move: pass keys, not texts, to plan shards. The order is cut
    into ranges, ranges are summed, and the one row per range is all that any single
    task sees of the whole; a hot order key is split by the rows' input position.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    keys = [F.col(f"row.{name}").alias(f"key{i}") for i, name in enumerate(order)]
    lean = rows.select(F.struct("*").alias("row"), size.cast("long").alias("size"), F.monotonically_increasing_id().alias("at"))
    lean = written(lean.select("row", "size", "at", *keys), "shard-rows")
    names = [f"key{i}" for i in range(len(order))] + ["at"]
    ranges = written(lean.repartitionByRange(*names).withColumn("part", F.spark_partition_id()), "shard-ranges")

    totals = ranges.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(everything).alias("all_bytes"),
    )
    within = Window.partitionBy("part").orderBy(*names)
    placed = (
        ranges.withColumn("to_here", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(offsets), "part")  # one row per range
        .withColumn("start", F.col("bytes_before") + F.col("to_here") - F.col("size"))
        .withColumn("shard", F.expr(f"int(start * {int(shards)}L div all_bytes)"))
        .withColumn("place", F.col("rows_before") + F.col("nth") - 1)
        .select("row", "size", "start", "shard", "place")
    )
    placed = written(placed, "shard-placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return placed.join(F.broadcast(first), "shard").select(  # one row per shard
        "row", "size", "start", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )


def write_shards(docs: DataFrame, shards: int, path: str, order: Sequence[str] = ("doc_id",)) -> None:
    """Write whole rows below ``path``, one folder ``shard=N`` each, with ``start`` and ``slot`` to sort by.

    Extra columns travel inside ``row``, so no name of theirs can clash.
    """
    shard_by_bytes(docs, text_bytes(), shards, order).write.partitionBy("shard").parquet(path)
