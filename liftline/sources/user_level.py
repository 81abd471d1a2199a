"""User-level tables laid out by signup day, so that a date filter reads the folders of those days only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DAY = "signup_date"
#: A day is written by so many tasks, in files of so many rows at most.
SPREAD, ROWS_PER_FILE = 8, 5_000_000


def write_user_level(df: DataFrame, path: str, spread: int = SPREAD) -> None:
    """A table with ``signup_date``; a day that holds a large share of the users is spread over several tasks and files."""
    dealt = df.repartition(DAY, F.pmod(F.xxhash64("user_id"), F.lit(spread)))
    dealt.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(DAY).parquet(path)


def read_user_level(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The stored table; ``columns`` gives their order back, the day included."""
    df = spark.read.parquet(path).withColumn(DAY, F.col(DAY).cast("date"))
    return df.select(*columns) if columns else df
