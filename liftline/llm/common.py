"""What the operators of this package share: column access, input frames and cut lineage."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from liftline.session import scratch_path


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text of each row, a NULL text as the empty one; other columns cannot clash."""
    return docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored once in the shared scratch folder and read back, so that lost executors cost a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it holds at most ``rows`` rows, else as it is: the join then shuffles.

    ``df`` should be cheap to count (a stored frame). Nothing beyond the limit is cut.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_shipped: set[str] = set()


#: Rows of a batch between Spark and Python: these are texts and vectors, and a batch is held on both sides.
BATCH, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that its functions can be loaded there. A session that has not chosen the
    rows of its Arrow batches gets ``ROWS``."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = os.path.realpath(tempfile.mkdtemp(prefix="liftline-package-"))
        built = Path(folder, "content", package.name)
        shutil.copytree(package, built, ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", built.parent))
        _shipped.add(app)


#: Bytes of rows that a function gets at once, whatever the rows in a batch; a row larger than that comes alone.
FRAME_BYTES = 8 << 20


def pieces(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in halves, and halves of those, until each is small enough."""
    if batch.num_rows <= 1 or batch.nbytes <= limit:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half), limit)
        yield from pieces(batch.slice(half), limit)


def give_back() -> None:
    """Return freed memory to the system: a worker stays alive for later tasks, and would hold the most it ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_frames(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """A function from frames to frames over each partition, with the package at hand on the executors. Frames are bounded in bytes,
    not in rows: a worker's memory does not depend on how long texts are."""
    ship_package(df.sparkSession)
    declared = schema if isinstance(schema, StructType) else DataType.fromDDL(schema)
    wanted = to_arrow_schema(StructType([StructField(f.name, f.dataType) for f in declared]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = (piece.to_pandas() for batch in batches if batch.num_rows for piece in pieces(batch, FRAME_BYTES))
        for frame in function(frames):
            if len(frame):
                yield pa.RecordBatch.from_pandas(frame, schema=wanted, preserve_index=False)
        give_back()

    return df.mapInArrow(each, schema)


def map_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with the package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
