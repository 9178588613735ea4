"""Small helpers the text operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.workspace import shared_folder

#: Text handled at once inside a task; larger single texts are handled alone.
SLICE_BYTES = 2 << 20


def column(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), whatever other columns there are."""
    return docs.select(column(id_col).alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the driver and all executors share."""
    return f"{shared_folder(spark)}/ordermill-{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application; a worker keeps it from task to task."""
    context = spark.sparkContext
    if getattr(context, "_ordermill_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(dir=context._temp_dir)  # the driver's own, until it ends; executors get the file from Spark
    tree = shutil.copytree(package, f"{folder}/tree/{os.path.basename(package)}", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/ordermill_package", "zip", os.path.dirname(tree)))
    context._ordermill_shipped = True


def arrow_map(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` stored once as Parquet in the shared folder and read again: cuts the lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def byte_lengths(array: pa.Array) -> np.ndarray:
    return pc.binary_length(array).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], field: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``size`` bytes of ``field``; no row is split."""
    for batch in batches:
        lengths = np.cumsum(byte_lengths(batch.column(field)))
        at = 0
        while at < batch.num_rows:
            before = lengths[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(lengths, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text array without nulls, and where each text starts (one more entry: the end)."""
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    data = array.buffers()[2]
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values[offsets[0]:offsets[-1]], offsets - offsets[0]


def squeezed(values: np.ndarray, level: int = 3) -> bytes:
    return pa.Codec("zstd", compression_level=level).compress(values.tobytes(), asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    """The ``n`` bytes that ``squeezed`` was given."""
    return np.frombuffer(pa.Codec("zstd").decompress(data, decompressed_size=n, asbytes=True) if n else b"", np.uint8)
