"""The numbered operators as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, exact_dedup, html_text, jaccard, licenses, maxent, mixing, quality, ranked_search, sharding, toxicity, url_filter, whitening
from skyledger.llm.common import ship

#: The tokenizer of op5 and of the pipeline.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: The rules of op2, longest first where several fit.
URL_RULES = (
    url_filter.UrlRule("allow", "com"),
    url_filter.UrlRule("block", "example.com", "/en/"),
    url_filter.UrlRule("allow", "www.example.com", "/en/"),
    url_filter.UrlRule("block", "net", "/es/"),
    url_filter.UrlRule("block", "net", "/fr/"),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, oracle: str | None = None):
    """Register a function of one given table."""

    def register(build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


@query("op1_license_scan", "documents")
def op1(documents: DataFrame) -> DataFrame:
    """The license notices of every document: all in order, and the one with the most words in common.

    Of notices with as many, the one with the greater coverage, then the first in the text.
    """
    rows = licenses.scanned(documents.select("doc_id", "text"), carry=("doc_id",))
    best = F.expr("array_max(transform(found, x -> named_struct('words', x.matched, 'c', x.coverage, 'early', -x.first_word, 'name', x.license)))")
    return rows.select(
        "row.doc_id",
        best["name"].alias("license"),
        F.coalesce(best["c"], F.lit(0.0)).alias("coverage"),
        F.size("found").cast("long").alias("n_notices"),
        F.expr("array_join(transform(found, x -> x.license), '; ')").alias("notices"),
    )


@query(
    "op2_url_filter",
    "pages",
    """
    WITH a AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), u AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM a
    ), r AS (
      SELECT *, '.' || host AS dotted FROM u
    ), m AS (
      SELECT page_id, host, path, CASE
        WHEN ends_with(dotted, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN ends_with(dotted, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN ends_with(dotted, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN ends_with(dotted, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
      FROM r
    )
    SELECT *, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM m
    """,
)
def op2(pages: DataFrame) -> DataFrame:
    """The verdict on every page's url."""
    found = url_filter.filtered(pages.select("page_id", "url"), URL_RULES)
    return found.select("row.page_id", "host", "path", "rule", "verdict")


@query("op3_byte_shards", "documents")
def op3(documents: DataFrame) -> DataFrame:
    """All documents in 8 shards of near-equal bytes."""
    rows = documents.select("doc_id", sharding.text_bytes().alias("bytes"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("crc"))
    return sharding.shard_by_bytes(rows, F.col("bytes"), 8).select(
        "row.doc_id", "size", F.col("row.crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op4_main_text", "pages")
def op4(pages: DataFrame) -> DataFrame:
    """The main text of every page."""
    return html_text.extracted(pages)


@query("op5_word_bpe", "documents")
def op5(documents: DataFrame) -> DataFrame:
    """Token ids of every whole text, and what they decode to, as digests."""
    codes = bpe.encoded(documents.select("doc_id", "text"), WORD_BPE, carry=("doc_id",))
    return codes.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op6_jaccard_join", "documents")
def op6(documents: DataFrame) -> DataFrame:
    """The component of every document under links of at least 85 percent."""
    return jaccard.jaccard_components(documents.select("doc_id", "text"), jaccard.Jaccard(percent=85, width=4))


@query("op7_balanced_mix", "documents")
def op7(documents: DataFrame) -> DataFrame:
    """How many words of each document the mix takes."""
    rows = mixing.mixed(documents.select("doc_id", "source", "text"), carry=("doc_id",))
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op8_maxent_lm", "documents")
def op8(documents: DataFrame) -> DataFrame:
    """Log-probabilities of every whole text under the unigram base and the model."""
    return maxent.scored(documents.select("doc_id", "text"))


@query(
    "op9_adaptive_quality",
    "documents",
    """
    WITH d AS (
      SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), places AS (
      SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM d WHERE len(w) >= 5
    ), found AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i + 1:i + 5]) AS times FROM places
    ), covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(5)) AS k FROM found WHERE times > 1) GROUP BY doc_id
    ), m AS (
      SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN covered USING (doc_id)
    ), b AS (
      SELECT * EXCLUDE (lines), CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        {'symbol_rate': 1000 * n_symbols // greatest(word_chars, 1),
         'dup_line_rate': 1000 * (len(lines) - len(list_distinct(lines))) // greatest(len(lines), 1),
         'word_length': 100 * word_chars // greatest(n_words, 1)} AS rates
      FROM m
    ), v AS (
      SELECT doc_id, lang, source, n_words, unnest(['symbol_rate', 'dup_line_rate', 'word_length']) AS rule,
        unnest([rates.symbol_rate, rates.dup_line_rate, rates.word_length]) AS value
      FROM b
    ), s AS (
      SELECT lang, source, rule, (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) AS bucket
      FROM v WHERE n_words > 0
    ), g AS (
      SELECT lang, source, rule, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM s GROUP BY ALL
    ), l AS (
      SELECT lang, rule, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM s GROUP BY ALL
    ), a AS (
      SELECT rule, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM s GROUP BY ALL
    ), cuts AS (
      SELECT g.lang, g.source, g.rule,
        CASE WHEN g.n >= 30 THEN g.q1 WHEN l.n >= 30 THEN l.q1 ELSE a.q1 END AS q1,
        CASE WHEN g.n >= 30 THEN g.q3 WHEN l.n >= 30 THEN l.q3 ELSE a.q3 END AS q3,
        CASE g.rule WHEN 'symbol_rate' THEN 40 WHEN 'dup_line_rate' THEN 350 ELSE 300 END AS slack
      FROM g JOIN l ON g.rule = l.rule AND g.lang IS NOT DISTINCT FROM l.lang JOIN a ON g.rule = a.rule
    ), odd AS (
      SELECT v.doc_id, bool_or(value > q3 + 3 * (q3 - q1) + slack OR v.rule = 'word_length' AND value < q1 - 3 * (q3 - q1) - slack) AS out
      FROM v JOIN cuts c ON v.rule = c.rule AND v.lang IS NOT DISTINCT FROM c.lang AND v.source IS NOT DISTINCT FROM c.source
      GROUP BY v.doc_id
    )
    SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(out, true) AS kept
    FROM b LEFT JOIN odd USING (doc_id)
    """,
)
def op9(documents: DataFrame) -> DataFrame:
    """Counts and verdicts of all documents."""
    lean = documents.select("doc_id", "lang", "source", "text")
    return quality.judged(lean).select("row.doc_id", *quality.BASE[:5], "base_failed", "kept")


@query(
    "op10_exact_dedup",
    "documents",
    """
    WITH n AS (
      SELECT doc_id, length(coalesce(text, '')) AS len, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body FROM documents
    ), k AS (
      SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY len DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM n
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k
    """,
)
def op10(documents: DataFrame) -> DataFrame:
    """Every document with the one of its copies that stays."""
    return exact_dedup.exact_duplicates(documents)


def op11(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """How likely every whole text is marked toxic."""
    rows = toxicity.scored(documents.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return rows.select("doc_id", "held_out", "score", "predicted", "n_hits", "n_misspelled", "n_quoted")


def _op11(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return op11(*(spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet") for table in ("documents", "labels")))


QUERIES["op11_toxicity"] = _op11


@query("op12_whitening", "embeddings")
def op12(embeddings: DataFrame) -> DataFrame:
    """Whitened components of every whole vector."""
    rows = whitening.whitened(embeddings.select("vec_id", "embedding"))
    return rows.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return ranked_search.ranked(documents, benchmark, 20)


def _op13(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return op13(*(spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet") for table in ("documents", "benchmark")))


QUERIES["op13_ranked_search"] = _op13
ORACLES["op13_ranked_search"] = """
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
    ), s AS (
      SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS big_n, CAST(sum(len(t)) AS BIGINT) AS big_l FROM d
    ), i AS (
      SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
    ), q AS (
      SELECT item_id, term, count(*) AS c FROM i GROUP BY ALL
    ), p AS (
      SELECT doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d
    ), f AS (
      SELECT doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL
    ), w AS (
      SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term) CROSS JOIN s
    ), r AS (
      SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN f USING (term) CROSS JOIN s GROUP BY item_id, doc_id
    ), o AS (
      SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0
    )
    SELECT * FROM o WHERE rank <= 20
    """
