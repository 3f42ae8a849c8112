"""Arrow plumbing shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: An Arrow batch is worked on in slices of at most so many text bytes, one row at least.
SLICE_BYTES = 8 << 20
#: Bytes of an Arrow batch: the JVM and the worker each hold one or two of a task's.
BATCH_BYTES = 8 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def limit_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """The session sends Arrow batches of at most so many bytes from now on, or of less where so set."""
    now = spark.conf.get(_BATCH_BYTES)  # as Spark writes it: 256MB, 8388608b, 64k
    if not (now.rstrip("b").isdigit() and 0 < int(now.rstrip("b")) <= most):
        spark.conf.set(_BATCH_BYTES, str(most))


def small_batches(df: DataFrame) -> DataFrame:
    """The same frame, in batches of at most BATCH_BYTES."""
    limit_batches(df.sparkSession)
    return df


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column


def slices(batch: pa.RecordBatch, text_col: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by the bytes of its texts, so that a run of long texts doesn't pile up."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(text_column(batch, text_col)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size + 1
    if start < len(sizes):
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    return [t or "" for t in text_column(batch, name).to_pylist()]


def bytes_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [t or b"" for t in text_column(batch, name).cast(pa.large_binary()).to_pylist()]


def per_text(
    text_col: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], most: int = SLICE_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that applies `work` to byte-balanced slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, most):
                yield work(part)

    return run
