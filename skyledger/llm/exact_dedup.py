"""Exact duplicates by salted combining of digests with full comparison of contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import text_of, without_blanks, written


def normal_text(column: str = "text") -> Column:
    """The text without white space; null as empty. Texts are equal when these are."""
    return without_blanks(text_of(column))


def _digest(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def groups_of_copies(docs: DataFrame, salts: int = 16) -> DataFrame:
    """One row per distinct content: digest, body, best (the row that stays) and n.

    Three stages, each keyed by the digest *and* the whole content, so that texts are
    merged only after full comparison: Spark's map-side aggregation deduplicates within
    a task; a task's winners then meet under (digest, salt), where the salt is the
    task's number, so that a group held by every task spreads over ``salts`` reducers;
    the salt winners, at most ``salts`` a group, meet under the digest.
    """
    body = normal_text()
    best = F.struct(
        (-F.char_length(text_of())).alias("shorter"), F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("doc_id")
    )
    rows = docs.select(
        _digest(body).alias("digest"), body.alias("body"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"), best.alias("best")
    )
    salted = rows.groupBy("digest", "salt", "body").agg(F.min("best").alias("best"), F.count("*").alias("n"))
    return salted.groupBy("digest", "body").agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def exact_duplicates(docs: DataFrame, salts: int = 16) -> DataFrame:
    """A row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows whose texts are equal without white space, the one with the most code points
    in its original text stays, then the smallest doc_id (null ids last). Null texts
    count as empty, and all empty texts are one group. Rows that repeat id, content and
    length cannot be told apart; one of them is marked kept. Other columns are ignored.

    ``docs`` is read twice: once for contents, once for the rows to be labelled, which
    carry digests and no text. A group that fills a third of the table is one row in
    the joined table; the labelled side of that join is split by adaptive execution.
    """
    groups = written(
        groups_of_copies(docs, salts).select("digest", F.md5("body").alias("second"), F.col("best.doc_id").alias("keep_id"), F.col("best.shorter").alias("shorter"), "n"),
        "copies",
    )
    body = normal_text()
    # the second digest tells apart contents that full comparison has found to share the first
    rows = docs.select("doc_id", _digest(body).alias("digest"), F.md5(body).alias("second"), (-F.char_length(text_of())).alias("length"))
    rows = rows.groupBy("doc_id", "digest", "second", "length").agg(F.count("*").alias("times"))
    rows = rows.join(groups, ["digest", "second"]).withColumn("nth", F.explode(F.expr("sequence(1L, times)")))
    return rows.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("shorter")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, whole, one per distinct content, by the rule of ``exact_duplicates``.

    The winners, without texts, are joined with the rows on id, digest and length: a
    group of copies is spread by its ids. Columns of any name pass through; of rows that
    repeat id, content and length, the one with the least hash of all its columns stays, so
    that reruns agree.
    """
    best = groups_of_copies(docs, salts).select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.shorter")).alias("length"))
    best = written(best, "winners")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), _digest(normal_text()).alias("digest"), F.char_length(text_of()).alias("length"))
    keys = ["nameless", "named", "digest", "length"]
    rows = rows.withColumn("nameless", F.col("id").isNull()).withColumn("named", F.coalesce(F.col("id"), F.lit(0))).drop("id")
    best = best.withColumn("nameless", F.col("keep_id").isNull()).withColumn("named", F.coalesce(F.col("keep_id"), F.lit(0))).drop("keep_id")
    # maps have no hash of their own
    whole = F.to_json("row") if "map<" in rows.schema["row"].dataType.simpleString() else F.col("row")
    return rows.join(best, keys).groupBy(*keys).agg(F.min_by("row", F.xxhash64(whole)).alias("row")).select("row.*")
