"""Given tables, intermediate tables in the shared folder, and the fold that models may not learn from."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.session import configure

FOLDS = 5


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset: a temporary folder if Spark runs in one process, else a folder of the warehouse, which is shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        named = tempfile.mkdtemp(prefix="sievework-") if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_sievework"
        spark.conf.set("spark.checkpoint.dir", named) if local else None
    return named


_SCRATCH: list[str] = []  # folders of the operators that are at work, innermost last


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it: cuts lineage, survives executors, and is computed once."""
    return _written(df, name, _SCRATCH[-1] if _SCRATCH else shared_folder(df.sparkSession))


def _written(df: DataFrame, name: str, folder: str) -> DataFrame:
    path = f"{folder}/sievework-{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored within are deleted at the end, but for those stored by the function that this gives."""
    folder = f"{shared_folder(spark)}/sievework-{uuid.uuid4().hex}-scratch"
    outer = _SCRATCH[-1] if _SCRATCH else shared_folder(spark)
    _SCRATCH.append(folder)
    try:
        yield lambda df, name: _written(df, name, outer)
    finally:
        _SCRATCH.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
