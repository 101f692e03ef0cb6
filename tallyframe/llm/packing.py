"""Packing of documents into fixed-size sequences by cutting-stock column generation.

Every document is encoded; full sequences are cut off its front, and what remains is one
piece. The lengths of the remaining pieces, in classes of ``grain`` tokens, form a
histogram of at most ``capacity / grain`` entries, which is all that reaches the driver.
There a linear program over patterns (how many pieces of each class share a sequence) is
solved by column generation: a revised simplex gives each class a price, a knapsack dynamic
program finds the pattern worth most at these prices, until none is worth more than a
sequence. Pattern uses are rounded down; pieces left over, a few per pattern, are packed
by the same knapsack program, greedily, the largest classes first in value.

Pieces are then ranked within their class, and the rank says which use of which pattern a
piece belongs to. Ranks come from counts per (class, part) and row numbers in (class, part),
so a class that holds most pieces is still ranked in parts.

Defined results: a null text is empty and yields the end id alone; repeated rows are all
packed; an empty table gives no sequence. A sequence that is not full is padded to the
capacity, unless its length is a power of two.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import arrow_rows, stage, text_batches, whole_texts
from .pieces import crc32, encoder

CAPACITY = 4096
GRAIN = 8
#: The program is left when its value is within this share of the optimum.
GAP = 5e-4
ROUNDING = 1e-9

PIECES = pa.schema([
    ("part", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
])
PIECES_DDL = (
    "part int, doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"
)


def best_pattern(
    sizes: np.ndarray, values: np.ndarray, room: int, most: np.ndarray | None = None
) -> np.ndarray:
    """Counts per class of the most valuable content of ``room`` units.

    Without ``most`` the knapsack is unbounded and solved by dynamic programming over the
    room. With it, a class of which the program asks too much is taken as far as it goes and
    the program is run again for the room that is left.
    """
    counts = np.zeros(len(sizes), np.int64)
    left = np.full(len(sizes), room + 1) if most is None else most.copy()
    while room > 0:
        usable = np.flatnonzero((left > 0) & (sizes <= room) & (values > 0))
        if not len(usable):
            break
        some, worth = sizes[usable], values[usable]
        order = np.argsort(some, kind="stable")
        some, worth, usable = some[order], worth[order], usable[order]
        best = np.zeros(room + 1)
        last = np.full(room + 1, -1)
        fits = np.searchsorted(some, np.arange(room + 1), "right")
        for unit in range(int(some[0]), room + 1):
            sums = best[unit - some[:fits[unit]]] + worth[:fits[unit]]
            top = int(sums.argmax())
            if sums[top] > best[unit - 1]:
                best[unit], last[unit] = sums[top], top
            else:
                best[unit] = best[unit - 1]
        wanted: Counter = Counter()
        unit = room
        while unit > 0:
            if last[unit] < 0:
                unit -= 1
                continue
            wanted[int(last[unit])] += 1
            unit -= int(some[last[unit]])
        short = False
        for place, count in wanted.items():
            index = usable[place]
            taken = min(count, int(left[index]))
            short |= taken < count
            counts[index] += taken
            left[index] -= taken
            room -= taken * int(sizes[index])
        if not short:
            break
    return counts


def solve(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used in an optimum of the linear program."""
    m = len(sizes)
    if not m:
        return []
    patterns = np.diag(room // sizes).astype(float)  # a column per basic pattern
    inverse = np.diag(1.0 / np.diag(patterns))
    uses = inverse @ demand
    for step in range(1, 50 * m + 100):
        prices = inverse.sum(axis=0)
        entering = best_pattern(sizes, prices, room).astype(float)
        if prices @ entering <= 1 + GAP:
            break
        direction = inverse @ entering
        positive = direction > 1e-9
        ratios = np.where(positive, uses / np.where(positive, direction, 1), np.inf)
        leaving = int(ratios.argmin())
        amount = ratios[leaving]
        uses = uses - amount * direction
        uses[leaving] = amount
        patterns[:, leaving] = entering
        row = inverse[leaving] / direction[leaving]
        inverse = inverse - np.outer(direction, row)
        inverse[leaving] = row
        if step % 200 == 0:
            inverse = np.linalg.inv(patterns)
            uses = inverse @ demand
    return [(patterns[:, j].astype(np.int64), max(0.0, float(uses[j]))) for j in range(m)]


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, number of sequences) so that every piece of the histogram has a place.

    A pattern maps a class to the number of its pieces in one sequence.
    """
    sizes = np.array(sorted(histogram), np.int64)
    rest = np.array([histogram[size] for size in sizes], np.int64)
    chosen: list[tuple[np.ndarray, int]] = []
    for pattern, use in sorted(solve(sizes, rest.astype(float), room), key=lambda x: -x[1]):
        fits = [int(rest[i] // pattern[i]) for i in np.flatnonzero(pattern)]
        times = min([int(use + ROUNDING), *fits]) if fits else 0
        if times:
            chosen.append((pattern, times))
            rest = rest - pattern * times
    while rest.any():
        # a little more for large classes, which are harder to place later
        pattern = best_pattern(sizes, sizes * (1 + sizes / (8 * room)), room, rest)
        times = min(int(rest[i] // pattern[i]) for i in np.flatnonzero(pattern))
        chosen.append((pattern, times))
        rest = rest - pattern * times
    return [
        ({int(sizes[i]): int(pattern[i]) for i in np.flatnonzero(pattern)}, times)
        for pattern, times in chosen
    ]


def rank_ranges(patterns: list[tuple[dict[int, int], int]]) -> list[tuple]:
    """(class, first rank, rank after, pieces in a sequence, first sequence) per use."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in patterns:
        for size, count in pattern.items():
            first = taken[size]
            taken[size] += count * times
            rows.append((size, first, taken[size], count, sequence))
        sequence += times
    return rows


def encoded_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str, text_col: str
) -> DataFrame:
    """Pieces of all documents: full sequences first, then what remains."""

    def encode(batches):
        coder = encoder(vocabulary, False)
        part, row = TaskContext.get().partitionId(), 0
        for ids, texts in text_batches(batches):
            out = {name: [] for name in PIECES.names}
            for doc_id, found in zip(ids, coder.encode_all(texts)):
                tokens = np.append(found, np.uint32(end_id))
                for start in range(0, len(tokens), capacity):
                    piece = tokens[start:start + capacity]
                    values = (part, doc_id, row, start, len(piece), crc32(piece), len(tokens))
                    for name, value in zip(PIECES.names, values):
                        out[name].append(value)
                row += 1
            yield arrow_rows(PIECES, **out)

    return whole_texts(docs, id_col, text_col).mapInArrow(encode, PIECES_DDL)


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY,
    grain: int = GRAIN, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: its place in its document and in its sequence."""
    spark = docs.sparkSession
    pieces = stage(
        encoded_pieces(docs, vocabulary, end_id, capacity, id_col, text_col), "token-pieces"
    ).withColumn("size", F.ceil(F.col("length") / grain).cast("int"))
    counts = pieces.groupBy("size").count().collect()  # at most capacity / grain rows
    room = capacity // grain
    ranges = rank_ranges(plan({row["size"]: row["count"] for row in counts}, room))
    table = spark.createDataFrame(
        ranges, "size int, first_rank long, end_rank long, pieces long, first_sequence long"
    )

    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = pieces.groupBy("size", "part").count().select(
        "size", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("part_rank")
    )
    in_part = Window.partitionBy("size", "part").orderBy("row", "start")
    ranked = pieces.withColumn("number", F.row_number().over(in_part) - 1).join(
        parts, ["size", "part"]
    ).withColumn("rank", F.col("part_rank") + F.col("number"))

    # the ranges are at most capacity / grain patterns of as many classes
    placed = ranked.join(F.broadcast(table), "size").where(
        (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    )
    local = F.col("rank") - F.col("first_rank")
    placed = placed.withColumns({
        "sequence_id": F.col("first_sequence") + F.expr("(rank - first_rank) div pieces"),
        "slot": local % F.col("pieces"),
    })
    in_sequence = Window.partitionBy("sequence_id").orderBy("size", "slot")
    before = in_sequence.rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )
