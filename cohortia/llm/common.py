"""Helpers that the text operators share: staging, folds, Arrow scans."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BATCH = "512"  # rows of an Arrow batch of texts, where the session has Spark's default
SLICE = 256  # rows of an Arrow batch that are Python objects at one time


_own_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none, as in tests on one machine, a folder is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="llm-shared-")
    return _own_roots[app]


def stage(df: DataFrame) -> DataFrame:
    """Write rows as Parquet to the shared folder and read them back.

    Cuts the lineage: what was computed once survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    On a cluster it is installed on every node; there the path is one more that is empty.
    Texts are long: batches of Spark's default number of rows would hold too much memory.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        paths = [path for path in paths if path] + [ROOT]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(paths)


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts


def held_out(key: Column, parts: int) -> Column:
    """Whether a row is kept from learning: its remainder is 0."""
    return remainder(key, parts) == 0


def scan(
    df: DataFrame,
    each: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]],
    schema: str,
) -> DataFrame:
    """Run ``each`` over a partition as column lists, a bounded slice at a time.

    ``each`` gets an iterator of slices and yields slices of the output columns.
    """
    importable(df.sparkSession)
    out_schema = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[dict[str, list]]:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    yield batch.slice(at, SLICE).to_pydict()

        for out in each(slices()):
            yield pa.RecordBatch.from_pydict(out, schema=out_schema)
        pa.default_memory_pool().release_unused()  # workers live on, their tasks' memory not

    return df.mapInArrow(run, schema)


def arrays(
    df: DataFrame,
    each: Callable[[Iterator[dict[str, np.ndarray]]], Iterable[dict[str, list]]],
    schema: str,
) -> DataFrame:
    """As ``scan``, for columns without nulls: a batch at a time, as arrays."""
    importable(df.sparkSession)
    out_schema = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (
            {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            for batch in batches
        )
        for out in each(columns):
            yield pa.RecordBatch.from_pydict(out, schema=out_schema)

    return df.mapInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def parts_for(spark: SparkSession, least: int = 1) -> int:
    """Partitions of an explicit shuffle: what the session is set to."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0, compressed."""
    values = np.asarray(values, np.int64)
    most = int(values.max()) if len(values) else 0
    size = next(s for s in (1, 2, 4, 8) if most < 1 << (8 * s - (s == 8)))
    planes = values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(f"<u{size}").ravel().astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def zipped(text: str) -> bytes:
    """A text, compressed for a shuffle."""
    return zstandard.ZstdCompressor(level=1).compress(text.encode("utf-8", "replace"))


def unzipped(data: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(data).decode("utf-8")
