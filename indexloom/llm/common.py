"""Helpers the operators share: word rule, stored steps, work on text in bounded pieces."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHECKPOINT = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    root = spark.conf.get(CHECKPOINT, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="indexloom-llm-")
        spark.conf.set(CHECKPOINT, root)
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove scratch files of this job whose rows were all written on to another table: nothing reads them again."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with this package's code sent to the workers first."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).parents[1]
        code = Path(tempfile.mkdtemp(prefix="indexloom-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(code, "w") as archive:
            for source in package.rglob("*.py"):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(code))
        _SHIPPED.add(context.applicationId)
    return df.mapInArrow(run, schema)


def widened(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` and the fields of ``ddl``; all may be null."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in (*df.schema.fields, *T.StructType.fromDDL(ddl).fields)])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether crc32 of the id as text falls in fold 0 (a null id: never)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Rows go to Python in batches of about ``limit`` bytes, unless the session has a setting of its own.

    Spark's default of 64 MB is held several times at once: by the JVM that fills it, by the worker and by its results.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, str(limit))


def text_parts(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Runs of whole rows with about ``limit`` bytes of text, as they are, and their texts with nulls as empty; a longer text is alone."""
    for batch in batches:
        text = pc.fill_null(batch.column(column).cast(pa.string()), "")
        ends = pc.cumulative_sum(pc.cast(pc.binary_length(text), pa.int64())).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(base + limit, "right")))
            yield batch.slice(start, stop - start), text.slice(start, stop - start)
            start = stop


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """``text_parts`` with the texts in place of the column: nulls become empty."""
    for part, text in text_parts(batches, column, limit):
        yield part.set_column(part.schema.get_field_index(column), pa.field(column, pa.string()), text)


def text_bytes(text: pa.StringArray):
    """The bytes of all texts in a row and, as numpy, where each starts (one more than texts)."""
    import numpy as np

    _, offsets, data = text.buffers()
    bounds = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]
