"""Quality rules whose cutoffs come from mergeable quantile sketches per language and source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import text_of, without_blanks, words_of, written

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A whole-number measure and how far outside its group's quartiles it may lie.

    Cutoffs are quartile -/+ ``reach`` * (upper - lower quartile) -/+ ``slack``; the
    slack keeps a group whose documents all agree from refusing the first that differs.
    """

    name: str
    measure: str
    slack: int
    low: bool = False
    reach: int = 3


RULES = (
    Rule("symbol_rate", "1000L * n_symbols div greatest(word_chars, 1L)", slack=40),
    Rule("dup_line_rate", "1000L * n_dup_lines div greatest(n_lines, 1L)", slack=350),
    Rule("word_length", "100L * word_chars div greatest(n_words, 1L)", slack=300, low=True),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` packed as struct ``row``, with lang, source and the base counts as longs.

    Null and empty texts have no words; a text without words has zero everywhere.
    Windows of five words are compared by hash first; only texts in which two hashes
    agree compare the windows themselves, so counts are exact.
    """
    text = text_of()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        text.alias("body"), words_of(text).alias("words"),
    )
    rows = rows.select(
        "row", "lang", "source", "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(without_blanks(F.col("body"))).cast("long").alias("word_chars"),
        (F.char_length("body") - F.char_length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.expr(
            "CASE WHEN size(words) < 5 THEN array() ELSE transform(sequence(0, size(words) - 5),"
            " i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])) END"
        ).alias("hashes"),
    )
    rows = rows.select(
        "row", "lang", "source", "words", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN array() ELSE sort_array(transform(sequence(0, size(words) - 5),"
            " i -> named_struct('window', concat_ws(' ', slice(words, i + 1, 5)), 'at', i))) END"
        ).alias("windows"),
    )
    rows = rows.withColumn(
        "starts",
        F.expr(
            "CASE WHEN size(windows) = 0 THEN array() ELSE sort_array(transform(filter(windows, (w, i) ->"
            " (i > 0 AND windows[greatest(i - 1, 0)].window = w.window) OR"
            " (i < size(windows) - 1 AND windows[least(i + 1, size(windows) - 1)].window = w.window)), w -> w.at)) END"
        ),
    )
    # words covered by repeated windows: each window adds what the next one leaves
    repeats = F.expr(
        "aggregate(transform(starts, (s, i) -> CASE WHEN i = size(starts) - 1 THEN 5"
        " ELSE least(5, starts[least(i + 1, size(starts) - 1)] - s) END), 0L, (a, b) -> a + b)"
    )
    return rows.select("row", "lang", "source", *BASE[:4], repeats.alias("n_repeat_words"), "n_lines")


def bucket_of(value: str) -> str:
    """The lower end of a value's sketch bucket: exact below 64, then the top six binary digits.

    Buckets are the same for every group and size, so sketches merge by adding counts,
    in any order with the same result, and hold a few hundred buckets at most.
    """
    return f"shiftleft(shiftright({value}, greatest(length(bin({value})) - 6, 0)), greatest(length(bin({value})) - 6, 0))"


def sketches(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per bucket of every rule for each (lang, source), each lang, and all rows together.

    Rows without words say nothing about their group and are left out.
    """
    pairs = ", ".join(f"'{rule.name}', {rule.measure}" for rule in rules)
    values = rows.where("n_words > 0").selectExpr("lang", "source", f"stack({len(rules)}, {pairs}) AS (rule, value)")
    cells = values.groupBy("lang", "source", "rule", F.expr(bucket_of("value")).alias("bucket")).agg(F.count("*").alias("n"))
    cells = written(cells, "sketch")
    by_lang = cells.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("n"))
    overall = cells.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    return (
        cells.withColumn("level", F.lit(0))
        .unionByName(by_lang.withColumn("level", F.lit(1)), allowMissingColumns=True)
        .unionByName(overall.withColumn("level", F.lit(2)), allowMissingColumns=True)
    )


def thresholds(rows: DataFrame, rules: tuple[Rule, ...] = RULES, least_rows: int = 30) -> DataFrame:
    """One row per (lang, source): a low and a high cutoff for each rule.

    A group with fewer than ``least_rows`` documents takes its language's sketch, and a
    small language that of all documents.
    """
    group = ["level", "lang", "source", "rule"]
    cells = sketches(rows, rules)
    upto = Window.partitionBy(*group).orderBy("bucket")
    cells = cells.withColumn("below", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    quartiles = cells.groupBy(*group).agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("below") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("below") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"),
    )
    quartiles = written(quartiles, "quartiles")
    g, lang, every = (quartiles.where(F.col("level") == i).alias(f"l{i}") for i in range(3))
    same_lang = (F.col("l0.rule") == F.col("l1.rule")) & F.col("l0.lang").eqNullSafe(F.col("l1.lang"))
    joined = g.join(lang, same_lang).join(every, F.col("l0.rule") == F.col("l2.rule"))

    def pick(name: str) -> Column:
        return F.when(F.col("l0.total") >= least_rows, F.col(f"l0.{name}")).when(F.col("l1.total") >= least_rows, F.col(f"l1.{name}")).otherwise(F.col(f"l2.{name}"))

    picked = joined.select(F.col("l0.lang").alias("lang"), F.col("l0.source").alias("source"), F.col("l0.rule").alias("rule"), pick("q1").alias("q1"), pick("q3").alias("q3"))
    cuts = []
    for rule in rules:
        mine, reach = F.col("rule") == rule.name, rule.reach * (F.col("q3") - F.col("q1")) + rule.slack
        cuts.append(F.max(F.when(mine, F.col("q3") + reach)).alias(f"{rule.name}_high"))
        if rule.low:
            cuts.append(F.max(F.when(mine, F.col("q1") - reach)).alias(f"{rule.name}_low"))
    return picked.groupBy("lang", "source").agg(*cuts)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, least_rows: int = 30) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with its counts, base_failed and kept.

    base_failed: under 10 words, or more than a fifth of the words in repeated windows.
    kept: not base_failed, and no rule's measure outside its group's cutoffs. Null lang
    and null source are groups like any other. Whatever columns are given travel along
    in ``row``; the counts are computed once and written, then joined with the cutoffs.
    """
    rows = written(measured(docs), "measured")
    cuts = written(thresholds(rows, rules, least_rows), "cutoffs")
    same = rows["lang"].eqNullSafe(cuts["lang"]) & rows["source"].eqNullSafe(cuts["source"])
    fits = F.lit(True)
    for rule in rules:
        value = F.expr(rule.measure)
        fits = fits & (value <= F.col(f"{rule.name}_high"))
        if rule.low:
            fits = fits & (value >= F.col(f"{rule.name}_low"))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    # a group whose documents have no words has no cutoffs: its rows fail the base rules
    return rows.join(cuts, same, "left").select(
        "row", *BASE[:5], failed.alias("base_failed"), (~failed & F.coalesce(fits, F.lit(False))).alias("kept")
    )
