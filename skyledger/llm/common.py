"""What the operators share: words, text defaults, the shared folder and shipped code."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import freeing_shuffles

#: White space as every operator here means it; words are runs of anything else.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def words_of(text: Column) -> Column:
    """Words in order. One blank character splits faster than a pattern."""
    spaced = F.translate(text, BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local master (one machine, one process) gets a folder of its
    own; any other master is refused, because executors would not see the files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return "file://" + _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: computed once, lineage cut."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    with freeing_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per Spark application, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(ship, "done", None) == context.applicationId:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "skyledger_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    ship.done = context.applicationId
