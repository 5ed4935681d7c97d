"""What several operators need: the documents' columns, stored tables, corpus size."""

from __future__ import annotations

import gc
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Only the id and the text: other columns, whatever their names, stay out of the work."""
    return docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col("text").cast("string").alias("text"))


#: Paths stored inside the ``temporary`` blocks that are open, innermost last.
_OPEN: list[list[str]] = []


def stored(df: DataFrame, purpose: str, lasting: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: later readers prune columns, and a lost
    executor costs its running tasks only.  A ``lasting`` table outlives the innermost ``temporary`` block."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    around = _OPEN[:-1] if lasting else _OPEN
    if around:
        around[-1].append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def erase(spark: SparkSession, *paths: str) -> None:
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Shuffle files, broadcast tables and what the driver holds of finished queries stay until its
    garbage happens to be collected; jobs of many short queries have that done between their rounds."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def temporary(spark: SparkSession):
    """Tables stored inside the block go when it is left; its result must be stored as ``lasting``."""
    own: list[str] = []
    _OPEN.append(own)
    try:
        yield
    finally:
        _OPEN.remove(own)
        erase(spark, *own)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts; sizes partitions."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
