"""What the training-data operators share: words, batches of Python work, tables written on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import scratch_path, ship_package

#: A word is a run of characters other than ASCII white space. `bytes.split()` splits the same way.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = "1000"
BATCH_BYTES = str(16 << 20)


def prepare(spark: SparkSession) -> None:
    """Make ready for Python work: the package on all workers, and small batches, since one document may be long."""
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame into the shared scratch folder and read it back, so that no later step computes it again."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of an id written as text, modulo a number; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def empty_if_null(texts) -> list[str]:
    return [text if text is not None else "" for text in texts.to_pylist()]
