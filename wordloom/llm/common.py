"""What the operators share: tables in the session's shared folder, and Arrow helpers."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 32 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of ``rows`` and of ``BATCH_BYTES`` at most, and see
    that Python workers find this package; a job calls this once."""
    spark.conf.set(ARROW_ROWS, str(rows))
    spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    context = spark.sparkContext
    name = f"wordloom-{context.applicationId}.zip"
    if not any(path.endswith(name) for path in context.listFiles):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="llm-")) / name
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset,
    a local session takes a temporary folder, and a cluster refuses."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        folder = f"file://{tempfile.mkdtemp(prefix='llm-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one, deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows does not repeat what
    came before, also when executors are lost."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def best(rows: DataFrame, by: list[str], order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each group with their ``rank``, in slices first: a hot group
    never meets in one task, and a slice keeps all rows that could be among the first."""
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = F.xxhash64(*rows.columns)
    for slices in (slots, max(1, math.isqrt(slots))):
        window = Window.partitionBy(*by, F.pmod(whole, F.lit(slices))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)
    window = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote, once what follows from it is stored itself, and let Spark
    delete the shuffle files of plans that nothing refers to: it does so when the driver's JVM
    collects its garbage, which on a quiet driver may be long after."""
    files = df.inputFiles()
    if files:
        delete(df.sparkSession, files[0].rsplit("/", 1)[0])


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    spark._jvm.System.gc()


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def table(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    """A batch of the given schema; values are arrays or lists by column name."""
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False)
        for f in schema
        for c in [columns[f.name]]
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def slices(total: int, size: int) -> Iterator[tuple[int, int]]:
    for start in range(0, total, size):
        yield start, min(total, start + size)


def runs(keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values: starts, and the length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
