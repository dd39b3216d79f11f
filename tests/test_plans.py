"""Plans that must hold at scale: what is scanned, shuffled, broadcast and split."""

import re

import pytest
from pyspark.sql import functions as F

from skyledger.functions.lists import explode_list
from skyledger.operators.corrections import correct_from_table
from skyledger.operators.keys import KeyRule, key_report
from skyledger.operators.lookups import left_detail, rebalanced, with_key_count, with_membership, with_surrogate
from skyledger.operators.numbering import with_row_numbers
from skyledger.operators.quality import foreign_key, primary_key
from skyledger.plans.shape import Inputs, bridge
from skyledger.plans.tables import organization, satellite_owner_org
from skyledger.session import tune
from skyledger.sinks.csv_files import export_sorted_csv
from skyledger.sinks.snapshots import clustered
from skyledger.sinks.sql_script import insert_batches
from skyledger.sources.registry import LAYOUTS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("staged"))
    spark.range(100).selectExpr(
        "CASE id % 2 WHEN 0 THEN 'satcat' ELSE 'ecat' END AS s_catalog", *[f"'x' AS `{c}`" for c in LAYOUTS["object"].split()]
    ).write.parquet(folder + "/object")
    spark.range(100).selectExpr(*[f"'1' AS `{c}`" for c in LAYOUTS["orgs"].split()]).write.parquet(folder + "/orgs")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("object", "orgs")}


def test_bridge_reads_two_columns_and_filters_in_the_scan(staged):
    text = plan(satellite_owner_org(Inputs(staged)))
    assert "EqualTo(s_catalog,satcat)" in text and "Not(EqualTo(Owner,-))" in text
    assert "ReadSchema: struct<s_catalog:string,JCAT:string,Owner:string>" in text
    assert "Exchange" not in text


def test_recipe_prunes_unread_columns(staged):
    text = plan(organization(Inputs(staged)).select("o_code", "o_tstart"))
    assert "ReadSchema: struct<Code:string,TStart:string>" in text and "Exchange" not in text


def test_explode_needs_no_shuffle(spark, staged):
    assert "Exchange" not in plan(explode_list(staged["object"], "Owner", "item"))


def test_keys_aggregate_before_they_move(spark, staged):
    """Both checks shuffle partial counts, never rows."""
    for report in (
        primary_key(staged["orgs"], "orgs", ["Code"]),
        foreign_key(staged["object"], "object", ["State"], staged["orgs"], "orgs", ["Code"]),
    ):
        text = plan(report)
        for part in text.split("Exchange hashpartitioning")[1:]:
            assert "HashAggregate" in part.split("\n")[1]


@pytest.fixture
def small_limits(spark):
    """Thresholds that make a few thousand rows count as large and skewed."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key in limits:
        spark.conf.unset(key)


def lookups(rows, lookup):
    """Every lookup join of rows (id, name) with a table (label, key)."""
    rules = lookup.select("label", F.col("key").cast("string").alias("right"), F.lit(1).alias("place"))
    return (
        with_surrogate(rows, lookup, "name", "label", "key", "k"),
        with_membership(rows, lookup, "name", "label", "known"),
        with_key_count(rows, ["name"], "n"),
        correct_from_table(rows, rules, "name", "label", "right", "place"),
        left_detail(rows, rebalanced(lookup.groupBy("label").agg(F.max("key").alias("key"))), "name", "label"),
    )


@pytest.mark.parametrize("hot", ["'hot'", "NULL"])
def test_hot_key_is_split(spark, tmp_path, small_limits, hot):
    """A key with a third of all rows, or no key at all, is read by several tasks in each lookup join."""
    rows = spark.range(0, 60000, 1, 8).selectExpr("id", f"CASE WHEN id % 3 = 0 THEN {hot} ELSE concat('k', id - id % 3) END AS name")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    lookup = rows.select(F.col("name").alias("label"), F.col("id").alias("key"))
    for joined in lookups(rows, lookup):
        assert len(joined.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in plan(joined), plan(joined)


def test_a_lookup_is_broadcast_by_its_measured_size(spark, tmp_path):
    """Two columns of a wide catalog that has little else hold far more than their share of its files."""
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    blank = [f"CAST(NULL AS STRING) AS blank_{i}" for i in range(30)]
    spark.range(0, 200_000, 1, 4).selectExpr("md5(CAST(id AS STRING)) AS label", "md5(CAST(-id AS STRING)) AS key", *blank).write.parquet(str(tmp_path / "wide"))
    spark.range(10).selectExpr("md5(CAST(id AS STRING)) AS name").write.parquet(str(tmp_path / "rows"))
    wide, rows = spark.read.parquet(str(tmp_path / "wide")), spark.read.parquet(str(tmp_path / "rows"))
    try:
        tune(spark)
        for lookup, broadcasts in ((wide.select("label", "key"), 0), (wide.where("label < '01'").select("label", "key"), 1)):
            joined = left_detail(rows, rebalanced(lookup.distinct()), "name", "label")
            assert len(joined.collect()) == 10
            final = plan(joined).split("== Initial Plan ==")[0]
            assert final.count("BroadcastHashJoin") == broadcasts, final
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_lookups_run_nothing_before_the_action(spark, tmp_path):
    spark.range(100).selectExpr("id", "concat('k', id % 7) AS name").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    spark.sparkContext.setJobGroup("lookups", "lookups")
    try:
        lookups(rows, rows.select(F.col("name").alias("label"), F.col("id").alias("key")))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookups")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_export_spreads_a_hot_sort_key(spark, tmp_path):
    """One value fills a third of the rows, yet no file holds it alone."""
    spark.range(0, 30000, 1, 4).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE lpad(id, 8, '0') END AS a", "'same' AS b").write.parquet(
        str(tmp_path / "t")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_sorted_csv(spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.option("header", "true").csv(str(tmp_path / "c")).filter("a = 'hot'").groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(r["count"] for r in files) == 10000
    assert max(r["count"] for r in files) < 6000


def test_ranges_are_dealt_by_the_first_characters_of_texts(spark, tmp_path):
    """Spark brings a sample of range keys to the driver: whole texts would be a small table whole."""
    long = "concat(repeat(chr(97 + CAST(id % 3 AS INT)), 250 + CAST(id % 11 AS INT)), 'é', CASE WHEN id % 7 > 0 THEN lpad(id % 50, 400, 'x') END)"
    spark.range(0, 3000, 1, 4).selectExpr(f"{long} AS t", "id % 2 AS n", "CASE WHEN id % 5 = 0 THEN repeat('z', 300) ELSE CAST(id AS STRING) END AS u").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    order = ["t", "n", "u"]
    cut = clustered(df, order)
    ranges = next(line for line in plan(cut).splitlines() if "Exchange rangepartitioning" in line)
    assert not re.search(r"\b[tu]#", re.sub(r"substring\([tu]#\d+, 1, 256\)|length\([tu]#\d+\)", "", ranges)), ranges
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = [tuple(r) for r in cut.collect()]
        numbered = with_row_numbers(df, order)
        assert cut.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    key = lambda r: [(v is not None, v.encode() if isinstance(v, str) else v) for v in r]
    assert found == sorted((tuple(r) for r in df.collect()), key=key)
    assert [tuple(r)[:3] for r in numbered.orderBy("row_number").collect()] == found


def test_key_report_filters_on_few_columns(spark):
    """A filter on the sum of all counts takes the optimizer long, and much of the driver's memory."""
    rules = [KeyRule("held", "p", ("k",), "p(k)"), *[KeyRule("foreign key", "c", (f"k{i}",), "p(k)", f"k{i} -> p(k)") for i in range(12)]]
    child = spark.range(3).selectExpr(*[f"CAST(id + {i} AS STRING) AS k{i}" for i in range(12)])
    report = key_report({"p": spark.range(12).selectExpr("CAST(id AS STRING) AS k"), "c": child}, rules)
    optimized = report._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"_aggregateexpression#\d+L? \+ ", optimized), optimized
    assert sorted((r["rule"], r["value"]) for r in report.collect()) == [("k10 -> p(k)", "12"), ("k11 -> p(k)", "12"), ("k11 -> p(k)", "13")]


def test_list_items_stay_in_generated_code(spark, staged):
    df = bridge(staged["orgs"], {"k": "Code"}, "Parent", "item")
    assert re.search(r"\*\(\d+\) Generate", plan(df)), plan(df)


def test_statements_are_batched_and_put_in_order_by_one_shuffle(spark):
    scripts = insert_batches(spark.range(1000).select("id"), "t", in_order=True)
    above = plan(scripts.sortWithinPartitions("batch")).split("BroadcastHashJoin")[0]  # below it rows get their numbers
    assert above.count("Exchange") == above.count("Exchange rangepartitioning") == 1, above
    assert [r["batch"] for r in scripts.sortWithinPartitions("batch").collect()] == list(range(1, 15))
