"""Removal of repeated word windows, found by level-wise doubling of their length.

A window of ``window`` words can only be repeated if every shorter run of words inside it is.
So the search starts with short runs and doubles: at each length below ``window`` a window that
is still a candidate names the run inside it with the smallest fingerprint (the same choice in
every copy of the window), and stays a candidate only if that run is repeated somewhere. At the
full length the fingerprint of the whole window, of 96 bits and more, is compared. The
search stops early when no candidate survives.

Texts stay in their blocks; fingerprints travel, one time per block and distinct run.

Defined results: a null text has no words; windows never cross documents; the first window by
(doc_id, start) stays and all later ones go; of repeated doc_ids the row in the earlier block,
or earlier in its block, counts as the first; a text of fewer words than the window is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import (
    ANSWERS, KEYS, KEYS_DDL, NO_ID, Block, answer_repeats, answered_bits, bucket_bounds,
    bucket_count, bucketed, exchange, key_rows, mix, packed, sliding, text_blocks, unpacked,
    with_answers,
)
from .frames import arrow_rows, row_by_row, stage

KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("text", pa.string()),
])
KEPT_DDL = "doc_id long, n_words long, n_removed long, text string"
SURVIVORS = pa.schema([("block", pa.int64()), ("alive", pa.int64()), ("bits", pa.binary())])
SURVIVORS_DDL = "block long, alive long, bits binary"

# Fixed value: the bytes between words.
SPACE_BYTES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD1B54A32D192ED03)


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _FACTOR)


BYTE_VALUES = byte_values()


def words_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte, fingerprint and document of each word of a block."""
    space = SPACE_BYTES[block.data]
    edges = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    factor = np.full(len(block.data), _FACTOR)
    powers = np.cumprod(factor, dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(BYTE_VALUES[block.data] * powers, dtype=np.uint64)]
    inverse = pow(int(_FACTOR), -1, 1 << 64)
    shrink = np.cumprod(np.full(len(block.data), np.uint64(inverse)), dtype=np.uint64)
    prints = mix((sums[ends] - sums[starts]) * shrink[starts])
    docs = np.searchsorted(block.starts, starts, "right") - 1
    return starts, ends, prints, docs


def run_prints(prints: np.ndarray, length: int, factor: np.uint64 = _FACTOR) -> np.ndarray:
    """Fingerprint of each run of ``length`` consecutive words."""
    count = max(0, len(prints) - length + 1)
    found = np.zeros(count, np.uint64)
    for k in range(length):
        found = found * factor + prints[k:k + count]
    return mix(found)


def whole_windows(docs: np.ndarray, window: int) -> np.ndarray:
    """Which windows lie in one document."""
    count = max(0, len(docs) - window + 1)
    return docs[:count] == docs[window - 1:window - 1 + count]


def _alive(row: dict, inside: np.ndarray) -> np.ndarray:
    if row.get("bits") is None:
        return np.flatnonzero(inside)
    return np.flatnonzero(np.unpackbits(unpacked(row["bits"], "u1"), count=len(inside)))


def send_level(length: int, window: int, buckets: int):
    def send(batches):
        for row in row_by_row(batches):
            _, _, prints, docs = words_of(Block.of(row))
            inside = whole_windows(docs, window)
            alive = _alive(row, inside)
            if not len(alive):
                continue
            least = sliding(run_prints(prints, length), window - length + 1, np.minimum)[alive]
            keys = bucketed(mix(least), buckets)
            found, first = np.unique(keys, return_index=True)
            # windows next to each other share their run; only another place is a repeat
            where = run_places(prints, alive, length, window)
            many = repeats_inside(keys, where, found)
            yield key_rows(row["block"], found, many)

    return send


def run_places(prints, alive, length, window) -> np.ndarray:
    """Word at which the run of least fingerprint of each live window begins (the first)."""
    runs = run_prints(prints, length)
    width = window - length + 1
    least = sliding(runs, width, np.minimum)[alive]
    places = np.full(len(alive), -1)
    for k in range(width - 1, -1, -1):
        hit = runs[alive + k] == least
        places[hit] = alive[hit] + k
    return places


def repeats_inside(keys: np.ndarray, places: np.ndarray, found: np.ndarray) -> np.ndarray:
    """For each distinct key: does it stand for runs at two places or more?"""
    index = np.searchsorted(found, keys)
    low = np.full(len(found), np.iinfo(np.int64).max)
    high = np.full(len(found), -1)
    np.minimum.at(low, index, places)
    np.maximum.at(high, index, places)
    return low < high


def keep_level(length: int, window: int, buckets: int):
    def keep(batches):
        for row in row_by_row(batches):
            _, _, prints, docs = words_of(Block.of(row))
            inside = whole_windows(docs, window)
            alive = _alive(row, inside)
            bits = np.zeros(len(inside), bool)
            if len(alive):
                least = sliding(run_prints(prints, length), window - length + 1, np.minimum)[alive]
                keys = bucketed(mix(least), buckets)
                found = np.unique(keys)
                repeated = answered_bits(row["answers"], found)
                bits[alive] = repeated[np.searchsorted(found, keys)]
            yield arrow_rows(
                SURVIVORS, block=[row["block"]], alive=[int(bits.sum())],
                bits=[packed(np.packbits(bits))],
            )

    return keep


def full_keys(prints: np.ndarray, alive: np.ndarray, window: int, buckets: int):
    """Sorted distinct whole-window keys: bucketed part, 64 more bits, first place, and index."""
    low = bucketed(run_prints(prints, window)[alive], buckets)
    more = run_prints(prints, window, _SECOND)[alive]
    order = np.lexsort((alive, more, low))
    low, more, place = low[order], more[order], alive[order]
    new = np.r_[True, (low[1:] != low[:-1]) | (more[1:] != more[:-1])][:len(low)]
    group = np.cumsum(new) - 1
    return low[new], more[new], place[new], place, group


def send_full(window: int, buckets: int):
    def send(batches):
        for row in row_by_row(batches):
            block = Block.of(row)
            _, _, prints, docs = words_of(block)
            alive = _alive(row, whole_windows(docs, window))
            if not len(alive):
                continue
            low, more, first, _, _ = full_keys(prints, alive, window, buckets)
            ids = block.ids[docs[first]]
            which, bounds = bucket_bounds(low)
            cuts = list(zip(bounds[:-1], bounds[1:]))
            yield arrow_rows(
                KEYS, bucket=which, block=[row["block"]] * len(which),
                keys=[low[a:b].astype("<u8").tobytes() + more[a:b].astype("<u8").tobytes()
                      for a, b in cuts],
                notes=[packed(ids[a:b].astype("<i8")) for a, b in cuts],
            )

    return send


def answer_first(rows: pa.Table) -> pa.Table:
    """For each key of each block: does the block hold its first place of all?"""
    blocks = rows["block"].to_pylist()
    parts = [np.frombuffer(body, "<u8").reshape(2, -1) for body in rows["keys"].to_pylist()]
    sizes = [part.shape[1] for part in parts]
    low, more = np.concatenate(parts, axis=1)
    ids = np.concatenate([unpacked(note, "<i8") for note in rows["notes"].to_pylist()])
    block = np.repeat(np.array(blocks, np.int64), sizes)
    order = np.lexsort((block, ids, more, low))
    same = (low[order][1:] == low[order][:-1]) & (more[order][1:] == more[order][:-1])
    first = np.zeros(len(low), bool)
    first[order] = np.r_[True, ~same]
    return pa.Table.from_batches([arrow_rows(
        ANSWERS, block=blocks, bucket=rows["bucket"],
        answer=[np.packbits(part).tobytes() for part in np.split(first, np.cumsum(sizes)[:-1])],
    )])


def remove_later(window: int, buckets: int):
    def remove(batches):
        for row in row_by_row(batches):
            block = Block.of(row)
            starts, ends, prints, docs = words_of(block)
            inside = whole_windows(docs, window)
            alive = _alive(row, inside)
            change = np.zeros(len(docs) + 1, np.int64)
            if len(alive):
                low, _, first, place, group = full_keys(prints, alive, window, buckets)
                stays = answered_bits(row["answers"], low)
                gone = place[~(stays[group] & (place == first[group]))]
                np.add.at(change, gone, 1)
                np.add.at(change, gone + window, -1)
            kept = np.cumsum(change[:-1]) == 0
            yield kept_rows(block, starts, ends, docs, kept)

    return remove


def kept_rows(block: Block, starts, ends, docs, kept) -> pa.RecordBatch:
    """Documents of a block with their kept words joined by one space."""
    count = len(block.ids)
    total = np.bincount(docs, minlength=count)
    left = np.bincount(docs[kept], minlength=count)
    sizes = ends - starts
    body = block.data
    bounds = np.r_[0, np.cumsum(total)]
    raw = body.tobytes()
    texts = []
    for i in range(count):
        a, b = bounds[i], bounds[i + 1]
        chosen = np.flatnonzero(kept[a:b]) + a
        texts.append(b" ".join(
            [raw[s:e] for s, e in zip(starts[chosen].tolist(), ends[chosen].tolist())]
        ).decode("utf-8"))
    return arrow_rows(
        KEPT, doc_id=[None if i == NO_ID else i for i in block.ids.tolist()], n_words=total,
        n_removed=total - left, text=texts,
    )


def remove_repeated_windows(
    docs: DataFrame, window: int = 20, shortest: int = 10,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: its text without later copies of repeated windows, and word counts."""
    lengths = [window]
    while lengths[0] // 2 >= shortest:
        lengths.insert(0, lengths[0] // 2)
    blocks = text_blocks(docs, id_col, text_col)
    buckets = bucket_count(blocks)
    state = blocks
    for length in lengths[:-1]:
        sent = state.mapInArrow(send_level(length, window, buckets), KEYS_DDL)
        answered = with_answers(state, exchange(sent, answer_repeats))
        alive = stage(
            answered.mapInArrow(keep_level(length, window, buckets), SURVIVORS_DDL), "survivors"
        )
        state = blocks.join(alive.hint("shuffle_hash"), "block", "left")
        if not alive.agg(F.sum("alive")).first()[0]:
            break
    sent = state.mapInArrow(send_full(window, buckets), KEYS_DDL)
    answered = with_answers(state, exchange(sent, answer_first))
    return answered.mapInArrow(remove_later(window, buckets), KEPT_DDL)
