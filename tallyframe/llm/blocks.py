"""Blocks of documents, and the exchange of fingerprints between them.

Duplicate search over all texts works on blocks: runs of whole documents of about
``BLOCK_BYTES``, written once to the shared folder, so that a block keeps its number and its
content however often an executor is lost. A block sends the fingerprints of its own distinct
strings, sorted, to buckets by fingerprint, one binary row for each bucket; a bucket answers
each block with one bit per fingerprint. A string that occurs in a third of all documents thus
reaches its bucket one time per block, and nothing is ever grouped by document.

The number of buckets grows with the size of the texts, so a bucket's share stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_rows, stage, text_batches

BLOCK_BYTES = 5_000_000
BUCKET_BYTES = 64_000_000
NO_ID = np.iinfo(np.int64).min

BLOCKS = pa.schema([
    ("block", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()),
    ("sizes", pa.binary()), ("body", pa.binary()),
])
BLOCKS_DDL = "block long, n_bytes long, ids binary, rows binary, sizes binary, body binary"

KEYS = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("notes", pa.binary()),
])
KEYS_DDL = "bucket int, block long, keys binary, notes binary"
ANSWERS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())])
ANSWERS_DDL = "block long, bucket int, answer binary"


def packed(array: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 1)


def unpacked(body: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(body), kind)


@dataclass
class Block:
    """Documents in ascending order of id, their UTF-8 texts with a line feed after each."""

    number: int
    ids: np.ndarray
    rows: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        return cls(
            row["block"], unpacked(row["ids"], "<i8"), unpacked(row["rows"], "<i8"),
            unpacked(row["sizes"], "<i8"), unpacked(row["body"], "u1"),
        )

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes + 1) - self.sizes - 1

    def text(self, i: int, start: int) -> np.ndarray:
        return self.data[start:start + self.sizes[i]]


def text_blocks(
    docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None
) -> DataFrame:
    """The documents as staged blocks; a null id comes before all others.

    ``row_col`` names a column of row numbers to carry along, if there is one.
    """

    def build(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for ids, texts in text_batches(batches, BLOCK_BYTES):
            doc_ids, row_ids = zip(*(tuple(pair.values()) for pair in ids))
            rows = np.array(row_ids, np.int64)
            numbers = np.array([NO_ID if i is None else i for i in doc_ids], np.int64)
            order = np.argsort(numbers, kind="stable")
            bodies = [texts[i].encode("utf-8") for i in order]
            sizes = np.array([len(body) for body in bodies], np.int64)
            yield arrow_rows(
                BLOCKS, block=[part << 32 | seq], n_bytes=[int(sizes.sum())],
                ids=[packed(numbers[order])], rows=[packed(rows[order])], sizes=[packed(sizes)],
                body=[zstandard.compress(b"\n".join([*bodies, b""]), 1)],
            )
            seq += 1

    named = docs.select(
        F.struct(
            F.col(id_col).cast("bigint").alias("doc_id"),
            (F.col(row_col) if row_col else F.lit(0)).cast("bigint").alias("row"),
        ).alias("ids"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = named.mapInArrow(build, BLOCKS_DDL)
    return stage(rows, "text-blocks")


def bucket_count(blocks: DataFrame) -> int:
    """At least the session's shuffle partitions, more for more text."""
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    least = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-total // BUCKET_BYTES))


def bucketed(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper 24 bits, 40 bits of the 64-bit fingerprint below."""
    low = keys & np.uint64((1 << 40) - 1)
    return ((keys >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40) | low


def bucket_bounds(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, and where each begins (with the end at last)."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    bucket = (sorted_keys >> np.uint64(40)).astype(np.int64)
    begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    return bucket[begins], np.r_[begins, len(bucket)]


def five_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view("u1").reshape(-1, 8)[:, :5]).tobytes()


def from_five_bytes(body: bytes) -> np.ndarray:
    wide = np.zeros((len(body) // 5, 8), "u1")
    wide[:, :5] = np.frombuffer(body, "u1").reshape(-1, 5)
    return wide.reshape(-1).view("<u8")


def key_rows(number: int, keys: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
    """One row per bucket of a block's sorted distinct keys; ``many``: repeated in the block."""
    which, bounds = bucket_bounds(keys)
    pieces = list(zip(bounds[:-1], bounds[1:]))
    return arrow_rows(
        KEYS, bucket=which, block=[number] * len(which),
        keys=[five_bytes(keys[a:b]) for a, b in pieces],
        notes=[np.packbits(many[a:b]).tobytes() for a, b in pieces],
    )


def answer_repeats(rows: pa.Table) -> pa.Table:
    """For each key of each block: is it repeated, in its block or in another one?"""
    parts = [from_five_bytes(body) for body in rows["keys"].to_pylist()]
    sizes = [len(part) for part in parts]
    keys = np.concatenate(parts)
    many = np.concatenate([
        np.unpackbits(np.frombuffer(note, "u1"), count=size)
        for note, size in zip(rows["notes"].to_pylist(), sizes)
    ]).astype(bool)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.r_[False, same] | np.r_[same, False]
    repeated = many.copy()
    repeated[order] |= twice
    ends = np.cumsum(sizes)
    return pa.Table.from_batches([arrow_rows(
        ANSWERS, block=rows["block"], bucket=rows["bucket"],
        answer=[np.packbits(part).tobytes() for part in np.split(repeated, ends[:-1])],
    )]) if len(sizes) else pa.Table.from_batches([], schema=ANSWERS)


def exchange(rows: DataFrame, answer: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """(block, answers): what the buckets say to each block, one entry per bucket."""
    answers = rows.groupBy("bucket").applyInArrow(answer, ANSWERS_DDL)
    return answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))


def answered_bits(answers: list[dict] | None, keys: np.ndarray) -> np.ndarray:
    """One boolean per sorted distinct key of a block, from the bits of its buckets."""
    found = np.zeros(len(keys), bool)
    which, bounds = bucket_bounds(keys)
    by_bucket = {item["bucket"]: item["answer"] for item in answers or ()}
    for bucket, a, b in zip(which.tolist(), bounds[:-1], bounds[1:]):
        bits = np.frombuffer(by_bucket[bucket], "u1")
        found[a:b] = np.unpackbits(bits, count=b - a).astype(bool)
    return found


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    return blocks.join(answers.hint("shuffle_hash"), "block", "left")


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit fingerprints."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x81DADEF4BC2DD44D)
    values ^= values >> np.uint64(33)
    return values


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values."""
    span, result = 1, values
    while span < width:
        step = min(span, width - span)
        result = pick(result[:len(result) - step], result[step:])
        span += step
    return result
