"""Readers and writers, down to the text they produce."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ledger_queries.exchange import write_tsv
from skyledger.sinks import snapshots
from skyledger.sinks.csv_files import dump_query, export_sorted_csv, read_csv_export, write_csv
from skyledger.sinks.sql_script import insert_batches, row_statements, write_script
from skyledger.sources.registry import LAYOUTS, SOURCES, SourceSpec, registry_frame
from skyledger.sources.text_files import first_lines, header_columns, newest_files, read_log, read_numbered_source, read_source, read_sources

SPEC = SourceSpec("mini", ("Code", "Name", "Parent"), 1)


def text_of(path):
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    return "".join(open(p, encoding="utf-8", newline="").read() for p in parts)


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_registry():
    assert len(SOURCES) == 32 and len(LAYOUTS) == 16
    assert SOURCES["satcat"].path("/data/") == "/data/cat/satcat.tsv"
    assert SOURCES["family"].header == "#Family"
    assert SOURCES["launch"].min_rows == 73426 and SOURCES["ptmpcat"].min_rows == 1


def test_registry_frame(spark):
    assert registry_frame(spark).count() == 32


def test_staging_quirks(spark, tmp_path):
    root = write(
        tmp_path, "mini.tsv", '#Code\tName\tParent\n# comment\nA\tsay "hi\t-\nB\n\tno code\t-\nC\té\t#x\n#late comment\nD\t\tP/Q\n'
    )
    rows = sorted(tuple(r) for r in read_source(spark, root, SPEC).collect())
    assert rows == [("A", 'say "hi', "-"), ("B", None, None), ("C", "é", "#x"), ("D", None, "P/Q")]
    numbered = sorted(tuple(r) for r in read_numbered_source(spark, root, SPEC).collect())
    assert numbered == [(3, "A", 'say "hi', "-"), (4, "B", None, None), (6, "C", "é", "#x"), (8, "D", None, "P/Q")]


def test_shared_layout_is_one_tagged_scan(spark, tmp_path):
    for name in ("one", "two"):
        write(tmp_path, f"{name}.tsv", f"#Code\tName\tParent\n{name}\tx\t-\n")
    specs = [SourceSpec(name, SPEC.columns, 1) for name in ("one", "two")]
    df = read_sources(spark, str(tmp_path), specs, "tag")
    assert sorted((r["tag"], r["Code"]) for r in df.collect()) == [("one", "one"), ("two", "two")]
    with pytest.raises(ValueError, match="share a layout"):
        read_sources(spark, str(tmp_path), [SPEC, SourceSpec("two", ("Code",), 1)], "tag")


def test_headers(spark, tmp_path):
    root = write(tmp_path, "mini.tsv", SPEC.header + "\nA\tB\tC\n")
    lines = first_lines(spark, root, [SPEC])
    assert lines.head()["first_line"] == SPEC.header
    got = [tuple(r) for r in header_columns(lines, "source", "first_line").orderBy("position").collect()]
    assert got == [("mini", 1, "col001", "Code"), ("mini", 2, "col002", "Name"), ("mini", 3, "col003", "Parent")]


def test_log_and_listing(spark, tmp_path):
    write(tmp_path, "a.log", "first\n\nlast\n")
    write(tmp_path, "b.log", "x\n")
    os.utime(tmp_path / "a.log", (1_000_000_000, 1_000_000_000))
    assert [r["line"] for r in read_log(spark, str(tmp_path / "a.log")).collect()] == ["first", None, "last"]
    assert [os.path.basename(r["path"]) for r in newest_files(spark, str(tmp_path)).collect()] == ["b.log", "a.log"]


VALUES = ["plain", 'a"b', "a,b", "line\nbreak", "cr\rx", " padded ", "#mark", "\\back", None, "", "é"]


def test_csv_text(spark, tmp_path):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, s string").coalesce(1)
    write_csv(df, str(tmp_path / "c"))
    assert text_of(tmp_path / "c") == (
        'i,s\n0,plain\n1,"a""b"\n2,"a,b"\n3,"line\nbreak"\n4,"cr\rx"\n5, padded \n6,#mark\n7,\\back\n8,\n9,\n10,é\n'
    )


def test_csv_back(spark, tmp_path):
    texts = [v for v in VALUES if v and "\r" not in v]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, s string")
    export_sorted_csv(df, str(tmp_path / "c"))
    back = read_csv_export(spark, str(tmp_path / "c"), df.schema)
    assert [r["s"] for r in back.orderBy("i").collect()] == texts


def test_export_is_sorted_and_keeps_the_era(spark, tmp_path):
    df = spark.sql(
        "SELECT id % 3 AS a, CAST(100 - id AS STRING) AS b, make_timestamp_ntz(-146, 6, 28, 1, 2, 3) AS t, 1.5D AS d FROM range(100)"
    )
    export_sorted_csv(df, str(tmp_path / "c"))
    lines = [line for line in text_of(tmp_path / "c").splitlines() if not line.startswith("a,b")]
    assert len(lines) == 100 and all(",-0146-06-28 01:02:03,1.5" in line for line in lines)
    keys = [(int(line.split(",")[0]), line.split(",")[1]) for line in lines]
    assert keys == sorted(keys)


def test_dump_query(spark, tmp_path):
    spark.sql("SELECT 1 AS n, TIMESTAMP_NTZ'2020-03-01 04:05:06' AS t, binary('x') AS b").createOrReplaceTempView("dumped")
    path = str(tmp_path / "d")
    dump_query(spark, "SELECT * FROM dumped", path, delimiter="|")
    dump_query(spark, "SELECT * FROM dumped", path, append=True, delimiter="|")
    assert text_of(path) == "1|01-Mar-2020 04:05:06|WARNING - BINARY type is not supported\n" * 2


def test_literals(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('it''s', TIMESTAMP_NTZ'2020-01-02 00:00:00', 5D, 1L), (NULL, TIMESTAMP_NTZ'2020-01-02 03:04:05', DOUBLE('Infinity'), NULL),"
        " ('x', make_timestamp_ntz(-146, 6, 28, 0, 0, 0), 0.5D, 2L), ('y', NULL, NULL, 3L) t(s, d, n, i)"
    )
    assert [r[0] for r in row_statements(df).collect()] == [
        "select 'it''s','2020-01-02',5,1",
        "select '','2020-01-02 03:04:05',binary_double_infinity,null",
        "select 'x','-0146-06-28',0.5,2",
        "select 'y','',null,3",
    ]


def test_batches(spark, tmp_path):
    spark.range(160).selectExpr("lpad(id, 3, '0') AS k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    batches = insert_batches(df, "t").orderBy("batch").collect()
    assert [(r["batch"], r["rows"]) for r in batches] == [(1, 75), (2, 75), (3, 10)]
    assert batches[2]["script"].startswith("insert into t\nselect '150' union all\nselect '151'")
    assert batches[2]["script"].endswith("select '159';")
    write_script(df, "t", str(tmp_path / "s"), suffix=" from dual")
    text = text_of(tmp_path / "s")
    assert text.count("insert into t") == 3 and text.count(" from dual union all\n") == 157 and text.count(" from dual;\n") == 3


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snap")
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    snapshots.write_table(df, root, "a", "t", ["k"])
    snapshots.publish(spark, root, "2020", "a", ["t"])
    snapshots.write_table(df.limit(3), root, "b", "t")
    assert snapshots.read_snapshot(spark, root)["t"].count() == 10, "an unpublished version stays unseen"
    snapshots.publish(spark, root, "2021", "b", ["t"])
    assert snapshots.current_version(spark, root) == ("2021", ["t"])
    tables = snapshots.read_snapshot(spark, root)
    snapshots.register_views(tables, "public_")
    assert spark.table("public_t").count() == 3


def test_install_refuses_existing_tables(spark):
    tables = {"installed_b": spark.range(1), "installed_a": spark.range(2)}
    snapshots.drop_tables(spark, list(tables))
    try:
        snapshots.install(spark, tables)
        with pytest.raises(ValueError, match="already exist: installed_a,installed_b"):
            snapshots.install(spark, tables)
    finally:
        snapshots.drop_tables(spark, list(tables))
    assert snapshots.existing_tables(spark, tables) == []


def test_part_files_are_checked_and_numbered_through(spark, tmp_path):
    """Each part file's header counts, and line numbers go on from file to file."""
    folder = tmp_path / SPEC.folder / SPEC.file_name
    folder.mkdir(parents=True)
    cells = "\t".join("x" for _ in SPEC.columns)
    (folder / "part-0.txt").write_text(f"{SPEC.header}\n{cells}\n{cells}\n")
    (folder / "part-1.txt").write_text(f"#other\n{cells}\n")
    lines = {r["first_line"]: r["files"] for r in first_lines(spark, str(tmp_path), [SPEC]).collect()}
    assert lines == {SPEC.header: 1, "#other": 1}
    assert sorted(r[0] for r in read_numbered_source(spark, str(tmp_path), SPEC).collect()) == [2, 3, 5]


def test_folders_are_written_side_by_side(spark, tmp_path):
    """Rows of several catalogs in turn: compressed part files, no setting left behind, every row in its own."""
    limit = "spark.sql.maxConcurrentOutputFileWriters"
    before, root = spark.conf.get(limit), str(tmp_path / "catalogs")
    rows = spark.range(0, 3000, 1, 2).selectExpr("CAST(id AS STRING) AS A", "'-' AS B", "concat(id % 11, '.tsv') AS file")
    write_tsv(rows, root, folders_by="file", compression="gzip")
    assert spark.conf.get(limit) == before
    names = [p.name for p in (tmp_path / "catalogs").rglob("part-*")]
    assert len(names) == 22 and all(name.endswith(".gz") for name in names)
    back = read_sources(spark, root, [SourceSpec(f"file={i}", ("A", "B"), 1) for i in range(11)], "s_catalog")
    assert back.count() == 3000 and back.where("concat('file=', CAST(A AS LONG) % 11) <> s_catalog").count() == 0
