"""A corpus pipeline of operators from ``skyledger.llm``: STAGES, run() and its checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, common, exact_dedup, jaccard, mixing, quality, queries

#: No SQL expresses the later stages; tests/llm holds them against brute-force versions.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the rules reject go.

    Null, empty and very short texts are rejected. Rows that repeat are judged each; extra
    columns travel in a struct, so that names cannot clash.
    """
    return quality.judged(docs).where("kept").select("row.*")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: one document of each group of equal texts stays."""
    return exact_dedup.keep_one(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of near copies the document with the smallest id stays.

    Near copies share five-word shingles to 80 percent at least. Documents without an id
    cannot be named and stay.
    """
    common.ship(spark)
    groups = jaccard.jaccard_components(docs, jaccard.Jaccard(percent=80, width=5))
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")) | F.col("doc_id").isNull())
    stay = stay.select(F.col("doc_id").alias("stays")).distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["stays"]), "left_semi")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document as often as its source's target asks for.

    Null and empty texts have no words and get no copy. A null source is a source. Rows
    that repeat an id are documents of their own.
    """
    common.ship(spark)
    return mixing.copied(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word BPE: the token ids of every document, and digests of the ids and of what they decode to.

    Null and empty texts have no ids. Rows that repeat, as copies of the mix do, are each encoded.
    Of the columns of documents, doc_id, lang and source stay; the text is what the ids decode to.
    """
    common.ship(spark)
    codes = bpe.tokenized(docs, queries.WORD_BPE, carry=("doc_id", "lang", "source"))
    return codes.select("row.*", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", dissimilar_documents),
    ("mixing sources to target weights", mixed_documents),
    ("BPE encoding and decoding", encoded_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again by the next."""
    common.ship(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.written(docs, f"pipeline-{i}")
    return docs
