"""Reading warehouse tables and writing result tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from liftline.schemas import TABLES, TableSpec


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # Header names are checked against the schema, quotes inside quoted JSON are doubled, and a
        # row that does not parse fails the job instead of turning into NULLs.
        reader = reader.options(header=True, enforceSchema=False, quote='"', escape='"', mode="FAILFAST")
    return reader.format(fmt).load(path)


def _with_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    for name in spec.optional:
        now = F.localtimestamp()
        df = df.withColumn(name, F.coalesce(F.col(name), now) if name in df.columns else now)
    return df.select(*spec.schema.fieldNames())


def table_path(root: str, name: str, fmt: str) -> str:
    return f"{root.rstrip('/')}/{name}.{fmt}"


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One warehouse table with its declared schema; never inferred."""
    spec = TABLES[name]
    schema = spec.schema
    if fmt == "csv" and spec.optional:
        # a file may or may not carry the columns that have defaults; its header line tells
        there = spark.read.option("header", True).csv(table_path(root, name, fmt)).columns
        schema = T.StructType([f for f in schema.fields if f.name not in spec.optional or f.name in there])
    return _with_defaults(_read(spark, table_path(root, name, fmt), fmt, schema), spec)


def missing_inputs(spark: SparkSession, root: str, names: Iterable[str], fmt: str = "parquet") -> list[str]:
    """Names whose files are not there, all of them at once. Only paths are looked up."""
    missing = []
    for name in names:
        try:
            _read(spark, table_path(root, name, fmt), fmt, TABLES[name].schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    return missing


def read_tables(
    spark: SparkSession, root: str, names: Iterable[str] | None = None, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Several tables, or one error that lists every missing one."""
    wanted = list(names or TABLES)
    missing = missing_inputs(spark, root, wanted, fmt)
    if missing:
        raise FileNotFoundError(f"missing inputs under {root}: {', '.join(missing)}")
    return {name: read_table(spark, root, name, fmt) for name in wanted}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Overwrite a result table. ``single_file`` is for summaries of a few rows only."""
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if fmt == "csv":
        # The default timestamp format stops at milliseconds.
        writer = writer.options(
            header=True, quote='"', escape='"', timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS"
        )
    writer.format(fmt).save(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out
