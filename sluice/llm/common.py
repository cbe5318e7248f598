"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path

#: Java regex class of the ASCII white space that separates words (UTF-8 safe).
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Columns of ``documents`` that operators read.
OPERATOR_COLUMNS = ("doc_id", "text", "source", "lang")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts lineage and fixes row contents (generated ids, hashes), so executors
    lost later only cost a re-read of shared files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shielded(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` applied to the documents while columns that operators do not read bear
    neutral names, so that none of them can clash with what an operator adds; ``step``
    keeps all columns it is given, and the result has those of ``docs`` alone."""
    names = {c: c if c in OPERATOR_COLUMNS else f"column {i}" for i, c in enumerate(docs.columns)}
    out = step(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return out.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])


def ship(spark: SparkSession) -> None:
    """Give Python workers this package: Spark serves it from the driver, once per
    application, so tasks need no installation on the executors."""
    sc = spark.sparkContext
    if getattr(sc, "_sluice_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    # Spark's file server reads the archive for as long as the application runs.
    folder = tempfile.mkdtemp(prefix="sluice-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/sluice.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"sluice/{source.relative_to(root)}")
    sc.addPyFile(path)
    sc._sluice_shipped = True


def is_empty(df: DataFrame) -> bool:
    """Whether a (staged) DataFrame has no rows; one short job."""
    return not df.limit(1).count()
