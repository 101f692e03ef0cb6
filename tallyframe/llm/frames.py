"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import settled, stage

#: Texts are handed to numpy code in batches of about this many characters.
BATCH_CHARS = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_texts(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so that further columns of the input can't clash; null is empty."""
    return frame.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def text_batches(
    batches: Iterator[pa.RecordBatch], chars: int = BATCH_CHARS
) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of at most about ``chars`` characters; a longer text comes alone."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            if texts and size + len(text) > chars:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts
    release_memory()


def row_by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dictionaries, one at a time, for tables with large cells."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
    release_memory()


def release_memory() -> None:
    """Give freed memory back at the end of a task: a worker process serves many tasks, and what
    one of them held would otherwise stay with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in some C libraries
    if trim is not None:
        trim(0)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or the first variation of it that no column of the frame has in any case."""
    taken = {column.lower() for column in frame.columns}
    found, k = name, 0
    while found.lower() in taken:
        found, k = f"{name}_{k}", k + 1
    return found


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """One record batch with the columns of ``schema`` in order."""
    arrays = [pa.array(columns[field.name], field.type) for field in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


__all__ = [
    "BATCH_CHARS", "arrow_rows", "free_name", "release_memory", "row_by_row", "settled", "stage", "table", "text_batches",
    "whole_texts",
]
