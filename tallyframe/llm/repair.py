"""Token-id shards compressed by a Re-Pair grammar, with random access.

Documents are put in ascending order of doc_id (ties by a hash of the text) by a range
shuffle, encoded, and cut into shards of about ``shard_tokens`` ids. In each shard, frequent
pairs of neighbouring symbols are replaced by nonterminals, over and over; many pairs are
replaced in one round, and where two of them overlap the more frequent one wins. No pair
crosses the end of a document. Rounds end when no pair occurs ``least_count`` times, or when
a round would replace less than ``least_gain`` of the symbols: a passage that makes up less of
a shard stays as it is. Both cost compression only, and decoding is exact with any. A shard holds its rules, the length that each rule expands to,
the remaining symbols, and per document its id and how many symbols it has, so that any
range of ids is decoded from the symbols that cover it.

Shard file, little-endian: magic ``RPG2``; then for each of the arrays in ``FIELDS`` its
item type (2 bytes), count (8 bytes) and items. ``low`` holds the lower 16 bits of the symbols;
for each bit above them that the largest symbol has, ``high`` holds one bit a symbol, eight to a
byte, so that a symbol takes as many bits as the grammar needs. Shard files are the binary cells of a Parquet
table, one row each, which is how Spark writes and reads them on any store.

Defined results: a null text is empty and yields the end id alone; a null doc_id sorts first
and comes back as null; repeated rows are all written; an empty table makes no shard.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import arrow_rows, row_by_row, text_batches, whole_texts
from .pieces import crc32, encoder, ragged_positions

MAGIC = b"RPG2"
FIELDS = ("base", "doc_ids", "doc_valid", "doc_symbols", "left", "right", "rule_lengths", "low", "high")

SHARD_TOKENS = 2_000_000
RULES_A_ROUND = 4096
LEAST_COUNT = 24
LEAST_GAIN = 0.04

SHARDS = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
    ("n_symbols", pa.int64()), ("n_rules", pa.int64()), ("body", pa.binary()),
])
DECODED = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()),
    ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
])


def ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{field.name} {names[field.type]}" for field in schema)


@dataclass
class Shard:
    """A grammar-compressed run of documents."""

    base: int
    doc_ids: np.ndarray
    doc_valid: np.ndarray
    doc_symbols: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rule_lengths: np.ndarray
    symbols: np.ndarray

    def to_bytes(self) -> bytes:
        parts = {
            "base": np.array([self.base], "<u4"), "doc_ids": self.doc_ids.astype("<i8"),
            "doc_valid": self.doc_valid.astype("u1"), "doc_symbols": self.doc_symbols.astype("<u4"),
            "left": self.left.astype("<u4"), "right": self.right.astype("<u4"),
            "rule_lengths": self.rule_lengths.astype("<u4"),
            "low": (self.symbols & 0xFFFF).astype("<u2"),
            "high": np.packbits(self._planes(), axis=1).ravel(),
        }
        out = [MAGIC]
        for name in FIELDS:
            array = parts[name]
            out += [array.dtype.str[1:].encode(), struct.pack("<Q", len(array)), array.tobytes()]
        return b"".join(out)

    def _planes(self) -> np.ndarray:
        """The bits above 16, a row for each."""
        count = max(0, int(self.symbols.max(initial=0)).bit_length() - 16)
        return np.array([self.symbols >> 16 + k & 1 for k in range(count)], np.uint8).reshape(
            count, len(self.symbols)
        )

    @classmethod
    def from_bytes(cls, body: bytes) -> Shard:
        if body[:4] != MAGIC:
            raise ValueError("not a token shard")
        at, parts = 4, {}
        for name in FIELDS:
            kind = np.dtype("<" + body[at:at + 2].decode())
            (count,) = struct.unpack_from("<Q", body, at + 2)
            parts[name] = np.frombuffer(body, kind, count, at + 10)
            at += 10 + count * kind.itemsize
        symbols, high = parts.pop("low").astype(np.int64), parts.pop("high")
        row = -(-len(symbols) // 8)
        for k in range(len(high) // row if row else 0):
            bits = np.unpackbits(high[k * row:(k + 1) * row], count=len(symbols))
            symbols |= bits.astype(np.int64) << 16 + k
        return cls(base=int(parts.pop("base")[0]), symbols=symbols, **parts)

    def _lengths(self, symbols: np.ndarray) -> np.ndarray:
        lengths = np.ones(len(symbols), np.int64)
        rules = symbols >= self.base
        lengths[rules] = self.rule_lengths[symbols[rules] - self.base]
        return lengths

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that the symbols stand for."""
        if not hasattr(self, "_flat"):
            flat = np.arange(self.base, self.base + len(self.left), dtype=np.int64)
            while (rules := flat >= self.base).any():
                sizes = 1 + rules.astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                wider = np.repeat(flat, sizes)
                inner = flat[rules] - self.base
                wider[starts[rules]] = self.left[inner]
                wider[starts[rules] + 1] = self.right[inner]
                flat = wider
            self._flat = flat
            self._starts = np.cumsum(self.rule_lengths, dtype=np.int64) - self.rule_lengths
        lengths = self._lengths(symbols)
        rules = symbols >= self.base
        starts = np.arange(len(symbols)) + len(self._flat)
        starts[rules] = self._starts[symbols[rules] - self.base]
        pool = np.concatenate([self._flat, symbols])
        return pool[ragged_positions(starts, lengths)].astype(np.uint32)

    def documents(self):
        """(doc_id or None, ids) of each document, in order."""
        bounds = np.r_[0, np.cumsum(self.doc_symbols, dtype=np.int64)]
        lengths = np.r_[0, np.cumsum(self._lengths(self.symbols))]
        ids = self.expand(self.symbols)
        for i, (doc_id, valid) in enumerate(zip(self.doc_ids.tolist(), self.doc_valid)):
            yield doc_id if valid else None, ids[lengths[bounds[i]]:lengths[bounds[i + 1]]]

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start``, expanding only the symbols that cover them."""
        ends = np.cumsum(self._lengths(self.symbols))
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(ends, start + count, "left")) + 1
        skipped = int(ends[first - 1]) if first else 0
        return self.expand(self.symbols[first:last])[start - skipped:start - skipped + count]


def compress(
    doc_ids: list, parts: list[np.ndarray], base: int,
    least_count: int = LEAST_COUNT, least_gain: float = LEAST_GAIN,
) -> Shard:
    """Build the grammar of the documents' ids; ``base`` is above every id.

    With ``least_gain`` 0 it goes on until no pair occurs ``least_count`` times.
    """
    sizes = np.array([len(part) for part in parts], np.int64)
    symbols = np.concatenate(parts).astype(np.int64)
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(sizes) - 1] = True
    lefts, rights, lengths = [], [], [np.ones(base, np.int64)]
    known = np.ones(base, np.int64)
    top = base
    while len(symbols) > 1:
        keys = symbols[:-1] << 32 | symbols[1:]
        keys[last[:-1]] = -1
        pairs, counts = run_lengths(np.sort(keys))
        frequent = np.flatnonzero((counts >= least_count) & (pairs >= 0))
        if not len(frequent):
            break
        chosen = frequent[np.argsort(-counts[frequent], kind="stable")[:RULES_A_ROUND]]
        at, rule = places_of(keys, pairs[chosen])
        if not len(at) or len(at) < least_gain * len(symbols):
            break
        used = np.unique(rule)
        number = np.zeros(len(chosen), np.int64)
        number[used] = top + np.arange(len(used))
        left, right = pairs[chosen[used]] >> 32, pairs[chosen[used]] & 0xFFFFFFFF
        lefts.append(left)
        rights.append(right)
        known = np.concatenate([known, known[left] + known[right]])
        top += len(used)
        symbols[at] = number[rule]
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
    none = np.zeros(0, np.int64)
    return Shard(
        base=base,
        doc_ids=np.array([0 if i is None else i for i in doc_ids], np.int64),
        doc_valid=np.array([i is not None for i in doc_ids], bool),
        doc_symbols=np.diff(np.flatnonzero(last), prepend=-1),
        left=np.concatenate([none, *lefts]), right=np.concatenate([none, *rights]),
        rule_lengths=known[base:], symbols=symbols,
    )


def run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    begins = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[begins], np.diff(np.r_[begins, len(values)])


def places_of(keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions to replace, none overlapping another, and the rank of the pair at each.

    ``pairs`` come by falling frequency. A position is taken if its pair ranks before the one
    at its left and not behind the one at its right.
    """
    bits = 18
    factor = np.int64(0x9E3779B97F4A7C15 - (1 << 64))

    def slot(values: np.ndarray) -> np.ndarray:
        return ((values * factor) >> np.int64(64 - bits)) & ((1 << bits) - 1)

    slots = np.full(1 << bits, 0, np.int64)
    order = np.arange(len(pairs))[::-1]
    slots[slot(pairs[order])] = order  # of pairs that share a slot, the most frequent stays
    rank = slots[slot(keys)]
    none = len(pairs)
    rank = np.where(pairs[rank] == keys, rank, none)
    before = np.r_[none + 1, rank[:-1]]
    after = np.r_[rank[1:], none + 1]
    at = np.flatnonzero((rank < none) & (rank < before) & (rank <= after))
    return at, rank[at]


def token_shards(
    docs: DataFrame, vocabulary: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
    least_count: int = LEAST_COUNT, least_gain: float = LEAST_GAIN,
) -> DataFrame:
    """Shards of the encoded documents, ``part`` and ``seq`` in ascending doc_id order."""
    ordered = whole_texts(docs, id_col, text_col).repartitionByRange(
        "doc_id", F.xxhash64("text")
    ).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def encode(batches):
        coder = encoder(vocabulary, True)
        base = max(len(coder.weights), end_id + 1)
        part, seq = TaskContext.get().partitionId(), 0
        held_ids, held, size = [], [], 0

        def full():
            shard = compress(held_ids, held, base, least_count, least_gain)
            return arrow_rows(
                SHARDS, part=[part], seq=[seq], n_docs=[len(held)], n_tokens=[size],
                n_symbols=[len(shard.symbols)], n_rules=[len(shard.left)],
                body=[shard.to_bytes()],
            )

        for ids, texts in text_batches(batches):
            for doc_id, found in zip(ids, coder.encode_all(texts)):
                held_ids.append(doc_id)
                held.append(np.append(found, np.uint32(end_id)))
                size += len(found) + 1
                if size >= shard_tokens:
                    yield full()
                    held_ids, held, size, seq = [], [], 0, seq + 1
        if held:
            yield full()

    return ordered.mapInArrow(encode, ddl(SHARDS))


def decoded_documents(shards: DataFrame) -> DataFrame:
    """Every document of the shards, decoded: its id, place, token count and crc32.

    Where a shard starts follows from the token counts of the parts before it (one small
    row a part) and of the shards before it in its part; shard bodies are not shuffled.
    """
    def decode(batches):
        for row in row_by_row(batches):
            found = list(Shard.from_bytes(row["body"]).documents())
            sizes = np.array([len(ids) for _, ids in found], np.int64)
            yield arrow_rows(
                DECODED, part=[row["part"]] * len(found), seq=[row["seq"]] * len(found),
                doc_id=[doc_id for doc_id, _ in found], before=np.cumsum(sizes) - sizes,
                n_tokens=sizes, ids_crc32=[crc32(ids) for _, ids in found],
            )

    sizes = shards.select("part", "seq", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total")).select(
        "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("part_start")
    )
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select(
        "part", "seq",
        (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))).alias("shard_start"),
    )
    rows = shards.select("part", "seq", "body").mapInArrow(decode, ddl(DECODED))
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
