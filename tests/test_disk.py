"""What a run leaves on disk: scratch tables go with the run, text may be compressed."""

import glob
import os

import pytest
from catalog_files import small_registry, write_catalogs

from ledger_queries.exchange import write_tsv
from skyledger.plans.export import export_set, read_script_set
from skyledger.plans.pipeline import refresh
from skyledger.session import materialised, passing_scratch, scratch, shared_dir, side_by_side
from skyledger.sources.text_files import read_source


def held(spark):
    return set(glob.glob(shared_dir(spark).removeprefix("file://").rstrip("/") + "/skyledger/*"))


def test_passing_scratch(spark):
    before, kept = held(spark), scratch(spark, "kept")
    with passing_scratch(spark):
        side_by_side(spark, [lambda: materialised(spark.range(5), "inner") for _ in range(3)])
        assert len(held(spark) - before) == 3
        with passing_scratch(spark):
            materialised(spark.range(5), "innermost")
        spark.range(7).write.parquet(kept)
    assert {os.path.basename(p).split("-")[0] for p in held(spark) - before} == {"kept"}
    with pytest.raises(ZeroDivisionError), passing_scratch(spark):
        materialised(spark.range(5), "failed")
        raise ZeroDivisionError
    assert len(held(spark) - before) == 1 and spark.read.parquet(kept).count() == 7


def test_refresh_and_export_leave_their_results_only(spark, tmp_path):
    before = held(spark)
    root, out = write_catalogs(str(tmp_path / "in")), str(tmp_path / "out")
    built = refresh(spark, root, out, "v1", small_registry(), tables=("organization", "organization_type", "engine"), enforce=False)
    assert held(spark) == before
    assert min(df.count() for df in built.values()) > 0
    export_set(built, str(tmp_path / "plain"))
    export_set(built, str(tmp_path / "set"), "gzip")
    assert held(spark) == before
    for folder, suffix in (("plain", ""), ("set", ".gz")):
        for kind, ending in (("csv", ".csv"), ("script", ".txt")):
            files = glob.glob(f"{tmp_path}/{folder}/{kind}/*/**/part-*", recursive=True)
            assert files and all(f.endswith(ending + suffix) for f in files if "/create/" not in f)
        back = read_script_set(spark, str(tmp_path / folder), {name: df.schema for name, df in built.items()})
        assert all(back[name].exceptAll(df).isEmpty() and df.exceptAll(back[name]).isEmpty() for name, df in built.items())
    assert {os.path.basename(p).split("-")[0] for p in held(spark) - before} == {"scripts"}


def test_compressed_catalogs_read_alike(spark, tmp_path):
    spec = small_registry()["refs"]
    rows = spark.range(300).selectExpr("concat('c', id) AS Cite", "concat('text ', id, ' \"x\"') AS Reference")
    for name, compression in (("a", "none"), ("b", "gzip")):
        write_tsv(rows.repartition(3), spec.path(str(tmp_path / name)), compression=compression)
    plain, packed = (read_source(spark, str(tmp_path / name), spec) for name in ("a", "b"))
    assert plain.count() == 300 and packed.exceptAll(plain).isEmpty()
