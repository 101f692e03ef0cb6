"""Removal of repeated byte strings by a prefix-aware distributed merge of suffix runs.

A byte of a document goes if a string of ``span`` bytes that covers it also starts in a
document with a smaller id. Every such string holds ``span - core + 1`` runs of ``core`` bytes;
the run of least fingerprint is its anchor, the same one in all its copies. So only suffixes
that start at anchors are sorted, and each stands for all windows around its anchor:

1. blocks exchange fingerprints of their anchors; only repeated ones go on;
2. each block sorts the suffixes at these anchors, together with the bytes before them that its
   windows need and the set of window offsets, collapses equal ones to one entry (with the
   smallest document), and sends them front-coded: each entry is the length of the prefix it
   shares with the one before, and the rest. A bucket gets the entries of its anchors;
3. a bucket merges its runs with a loser tree that keeps, for each run, the prefix its head
   shares with the last winner, and compares bytes beyond that prefix only. The shared prefixes
   that come out are the LCP array, from which windows are grouped: equal suffix to the right
   byte by byte, equal bytes to the left by a 64-bit fingerprint. One bit per window offset
   goes back: does this window start in a smaller document?
4. each block marks its bytes.

A passage that a third of all documents share reaches a bucket one time per block.

Defined results: a null text is empty; null ids count as one id that is smaller than all others;
equal ids are not smaller than each other, so repeated rows keep each other's bytes; texts
shorter than the span lose nothing; matches never cross documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import (
    ANSWERS, KEYS_DDL, NO_ID, Block, answer_repeats, answered_bits, bucket_bounds, bucket_count,
    bucketed, exchange, key_rows, mix, packed, sliding, text_blocks, unpacked, with_answers,
)
from .doubling import BYTE_VALUES
from .frames import arrow_rows, row_by_row, stage
from .pieces import ragged_positions

SPAN = 50
CORE = 24
SLICE = 400_000

KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("n_spans", pa.int64()), ("kept", pa.binary()), ("row", pa.int64()),
])
KEPT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, row long"
RUNS = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("shared", pa.binary()), ("rest", pa.binary()),
    ("ids", pa.binary()),
])
RUNS_DDL = "bucket int, block long, shared binary, rest binary, ids binary"

_FACTOR = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def gram_prints(data: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint (never 0) of the ``size`` bytes from each position, by doubling."""
    power, span, square, found, done = BYTE_VALUES[data], 1, _FACTOR, None, 0
    while True:
        if size & span:
            found = power if found is None else (
                found[:len(data) - done - span + 1] * np.uint64(square) + power[done:]
            )
            done += span
        if done == size:
            return mix(found) | np.uint64(1)
        power = power[:-span] * np.uint64(square) + power[span:]
        span, square = span * 2, square * square & _WORD


def slices(block: Block):
    """(first byte, sizes) of runs of documents of about SLICE bytes."""
    first = 0
    for i, start in enumerate(block.starts.tolist()):
        end = start + int(block.sizes[i]) + 1
        if end - int(block.starts[first]) >= SLICE or i == len(block.sizes) - 1:
            yield int(block.starts[first]), block.sizes[first:i + 1]
            first = i + 1


def anchors(block: Block, span: int, core: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, their fingerprints, and a bit per offset of the windows they stand for.

    Bit d means that the window starting d bytes before the anchor has it as its anchor.
    """
    offsets = span - core + 1
    places, prints, masks = [], [], []
    for first, sizes in slices(block):
        data = block.data[first:first + int(sizes.sum()) + len(sizes)]
        if len(data) < span:
            continue
        grams = gram_prints(data, core)
        least = sliding(grams, offsets, np.minimum)
        begins = np.cumsum(sizes + 1) - sizes - 1
        fits = sizes >= span
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, begins[fits], 1)
        np.add.at(inside, begins[fits] + sizes[fits] - span + 1, -1)
        inside = np.cumsum(inside, dtype=np.int8)[:len(least)].astype(bool)
        least[~inside] = 0
        padded = np.concatenate([
            np.zeros(offsets - 1, np.uint64), least,
            np.zeros(len(grams) - len(least), np.uint64),
        ])
        top = sliding(padded, offsets, np.maximum)
        at = np.flatnonzero(grams == top)
        own = grams[at]
        mask = np.zeros(len(at), np.uint32)
        for d in range(offsets):
            mask |= (padded[at + offsets - 1 - d] == own).astype(np.uint32) << np.uint32(d)
        places.append(at + first)
        prints.append(own)
        masks.append(mask)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    return np.concatenate(places), np.concatenate(prints), np.concatenate(masks)


def doc_of(block: Block, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(block.starts, at, "right") - 1


def send_anchors(span: int, core: int, buckets: int):
    def send(batches):
        for row in row_by_row(batches):
            block = Block.of(row)
            at, prints, _ = anchors(block, span, core)
            if not len(at):
                continue
            keys = bucketed(prints, buckets)
            order = np.argsort(keys, kind="stable")
            keys, docs = keys[order], doc_of(block, at)[order]
            begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            low = np.minimum.reduceat(docs, begins)
            high = np.maximum.reduceat(docs, begins)
            yield key_rows(row["block"], keys[begins], low < high)

    return send


class SuffixRun:
    """Sorted, collapsed suffix entries of a block, and the places each entry stands for."""

    def __init__(self, block: Block, answers: list[dict] | None, span: int, core: int, buckets: int):
        self.at, prints, self.masks = anchors(block, span, core)
        keys = bucketed(prints, buckets)
        if len(keys):
            known = np.unique(keys)
            live = answered_bits(answers, known)[np.searchsorted(known, keys)]
            self.at, keys, self.masks = self.at[live], keys[live], self.masks[live]
        before, count = span - core, len(self.at)
        self.width = span + before + 4
        self.ids = block.ids[doc_of(block, self.at)] if count else np.zeros(0, np.int64)
        if not count:
            self.entry = np.zeros(0, np.int64)
            return
        nothing = np.zeros(span, np.uint8)
        data = np.concatenate([nothing, block.data, nothing])
        rows = np.zeros((count, -(-self.width // 8) * 8), np.uint8)
        base = self.at + span
        bits = np.unpackbits(self.masks.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        reach = 31 - np.argmax(bits[:, ::-1], axis=1)  # bytes needed before the anchor
        need = span - np.argmax(bits, axis=1)  # and from it on
        for k in range(span):
            rows[:, k] = np.where(k < need, data[base + k], 0)
        for k in range(before):
            rows[:, span + k] = np.where(k < reach, data[base - 1 - k], 0)
        rows[:, span + before:self.width] = self.masks.astype(">u4").view(np.uint8).reshape(-1, 4)
        words = rows.view(">u8").astype(np.uint64)
        bucket = keys >> np.uint64(40)
        order = np.lexsort([self.ids, *words.T[::-1], bucket])
        rows, bucket = rows[order][:, :self.width], bucket[order]
        differ = rows[1:] != rows[:-1]
        new = np.r_[True, differ.any(axis=1) | (bucket[1:] != bucket[:-1])]
        self.entry = np.empty(count, np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.rows, self.bucket = rows[new], bucket[new]
        self.least = self.ids[order][new]

    def send(self, number: int) -> pa.RecordBatch:
        rows, width = self.rows, self.width
        shared = np.zeros(len(rows), np.int64)
        shared[1:] = np.argmax(rows[1:] != rows[:-1], axis=1)
        which, bounds = bucket_bounds(self.bucket << np.uint64(40))
        shared[bounds[:-1]] = 0
        flat = rows.reshape(-1)
        starts = np.arange(len(rows)) * width + shared
        out = {name: [] for name in RUNS.names}
        for bucket, a, b in zip(which.tolist(), bounds[:-1], bounds[1:]):
            rest = flat[ragged_positions(starts[a:b], width - shared[a:b])]
            out["bucket"].append(bucket)
            out["block"].append(number)
            out["shared"].append(packed(shared[a:b].astype("u1")))
            out["rest"].append(packed(rest))
            out["ids"].append(packed(self.least[a:b].astype("<i8")))
        return arrow_rows(RUNS, **out)


def send_runs(span: int, core: int, buckets: int):
    def send(batches):
        for row in row_by_row(batches):
            run = SuffixRun(Block.of(row), row["answers"], span, core, buckets)
            if len(run.entry):
                yield run.send(row["block"])

    return send


def entries(shared: bytes, rest: bytes, width: int):
    """(shared prefix, entry) of a front-coded run, one after another."""
    before, at = b"", 0
    for same in shared:
        end = at + width - same
        before = before[:same] + rest[at:end]
        at = end
        yield same, before


def merged(runs: list[tuple[bytes, bytes]], width: int) -> tuple[list[int], list[int], list[bytes]]:
    """Merge front-coded runs: the run of each entry, its LCP with the one before, and itself.

    ``known[r]`` is the prefix that the head of run r shares with the last entry put out. A
    longer one means a smaller head; only heads with equal ``known`` compare bytes beyond it.
    """
    count = len(runs)
    sources = [entries(shared, rest, width) for shared, rest in runs]
    heads: list[bytes] = [b""] * count
    known = [-1] * count
    for r, source in enumerate(sources):
        first = next(source, None)
        if first is not None:
            known[r], heads[r] = 0, first[1]
    from_bytes = int.from_bytes
    losers = [-1] * (2 * count)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        begin = known[a]
        if begin in (-1, width):
            return (a, b)
        one, two = from_bytes(heads[a][begin:]), from_bytes(heads[b][begin:])
        if one == two:
            known[b] = width
            return (a, b)
        same = width - ((one ^ two).bit_length() + 7) // 8
        if one < two:
            known[b] = same
            return (a, b)
        known[a] = same
        return (b, a)

    def build(node: int) -> int:
        if node >= count:
            return node - count
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    out_run, out_lcp, out_entry = [], [], []
    winner = build(1) if count > 1 else 0
    while known[winner] >= 0:
        out_run.append(winner)
        out_lcp.append(known[winner])
        out_entry.append(heads[winner])
        following = next(sources[winner], None)
        if following is None:
            known[winner] = -1
        else:
            known[winner], heads[winner] = following
        node = (winner + count) >> 1
        while node:
            rival = losers[node]
            mine, other = known[winner], known[rival]
            if other > mine:
                losers[node], winner = winner, rival
            elif other == mine and mine >= 0 and mine != width:
                winner, losers[node] = play(winner, rival)
            node >>= 1
    return out_run, out_lcp, out_entry


def answer_smaller(span: int, core: int):
    before = span - core
    width = span + before + 4

    def answer(rows: pa.Table) -> pa.Table:
        """Per entry of each block a bit per offset: its window starts in a smaller document."""
        found = rows.to_pylist()
        runs = [(unpacked(row["shared"], "u1").tobytes(), unpacked(row["rest"], "u1").tobytes())
                for row in found]
        ids = [unpacked(row["ids"], "<i8") for row in found]
        run_of, lcp, entry = merged(runs, width)
        run_of, lcp = np.array(run_of, np.int64), np.array(lcp, np.int64)
        matrix = np.frombuffer(b"".join(entry), np.uint8).reshape(-1, width)
        masks = np.ascontiguousarray(matrix[:, span + before:]).view(">u4")[:, 0].astype(np.uint32)
        # entry t is the next one of its run: the stable order by run lists the runs one by one
        by_run = np.argsort(run_of, kind="stable")
        own = np.empty(len(lcp), np.int64)
        own[by_run] = np.concatenate(ids)
        flags = smaller_windows(matrix, lcp, masks, own, span, core)
        parts = np.split(flags[by_run], np.cumsum([len(part) for part in ids])[:-1])
        return pa.Table.from_batches([arrow_rows(
            ANSWERS, block=rows["block"], bucket=rows["bucket"],
            answer=[packed(part.astype("<u4")) for part in parts],
        )])

    return answer


def smaller_windows(matrix, lcp, masks, own, span: int, core: int) -> np.ndarray:
    """Bits of the offsets at which an equal window has an entry with a smaller id."""
    flags = np.zeros(len(lcp), np.uint32)
    begins = np.flatnonzero(np.r_[True, lcp[1:] < core][:len(lcp)])
    spread = np.diff(np.r_[begins, len(lcp)])
    mixed = np.minimum.reduceat(own, begins) < np.maximum.reduceat(own, begins)
    live = np.flatnonzero(np.repeat(mixed, spread))
    left = np.zeros(len(live), np.uint64)
    for d in range(span - core + 1):
        if d:
            left = left * np.uint64(_FACTOR) + BYTE_VALUES[matrix[live, span + d - 1]]
        usable = np.flatnonzero(masks[live] >> np.uint32(d) & np.uint32(1))
        if not len(usable):
            continue
        right = np.cumsum(lcp < span - d)[live[usable]]
        order = np.lexsort((left[usable], right))
        a, b = right[order], left[usable][order]
        new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        ids = own[live[usable]][order]
        least = np.repeat(np.minimum.reduceat(ids, new), np.diff(np.r_[new, len(ids)]))
        hit = live[usable[order[least < ids]]]
        flags[hit] |= np.uint32(1 << d)
    return flags


def answered_flags(answers: list[dict] | None, run: SuffixRun) -> np.ndarray:
    which, bounds = bucket_bounds(run.bucket << np.uint64(40))
    by_bucket = {item["bucket"]: item["answer"] for item in answers or ()}
    flags = np.zeros(len(run.bucket), np.uint32)
    for bucket, a, b in zip(which.tolist(), bounds[:-1], bounds[1:]):
        flags[a:b] = unpacked(by_bucket[bucket], "<u4")
    return flags


def whole_characters(data: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """The removed bytes of those characters of which all bytes are removed."""
    leads = (data & 0xC0) != 0x80
    number = np.cumsum(leads) - 1
    kept = np.bincount(number, weights=~removed) > 0
    return removed & ~kept[number]


def remove_marked(span: int, core: int, buckets: int, characters: bool):
    def remove(batches):
        for row in row_by_row(batches):
            block = Block.of(row)
            run = SuffixRun(block, row["anchor_answers"], span, core, buckets)
            change = np.zeros(len(block.data) + 1, np.int32)
            if len(run.entry):
                flags = answered_flags(row["answers"], run)[run.entry]
                later = run.ids > run.least[run.entry]
                gone = np.where(later, run.masks, flags & run.masks)
                for d in range(span - core + 1):
                    starts = run.at[(gone >> np.uint32(d) & np.uint32(1)).astype(bool)] - d
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + span, -1)
            removed = np.cumsum(change[:-1]) > 0
            if characters:
                removed = whole_characters(block.data, removed)
            yield marked_rows(block, removed)

    return remove


def marked_rows(block: Block, removed: np.ndarray) -> pa.RecordBatch:
    """Documents of a block without their removed bytes."""
    total = np.r_[0, np.cumsum(removed)]
    edges = np.r_[0, np.cumsum(removed & ~np.r_[False, removed[:-1]])]
    starts, ends = block.starts, block.starts + block.sizes
    kept = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        part = block.data[a:b]
        kept.append((part if total[a] == total[b] else part[~removed[a:b]]).tobytes())
    return arrow_rows(
        KEPT, doc_id=[None if i == NO_ID else i for i in block.ids.tolist()],
        n_bytes=block.sizes, n_removed=total[ends] - total[starts],
        n_spans=edges[ends] - edges[starts], kept=kept, row=block.rows,
    )


def remove_repeated_bytes(
    docs: DataFrame, span: int = SPAN, core: int = CORE,
    id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
    characters: bool = False,
) -> DataFrame:
    """Per document: its remaining bytes, and how many bytes and runs of bytes went.

    With ``characters`` a character goes only as a whole, so that what is left is UTF-8. The
    numbers of ``row_col``, if given, come back as ``row``.
    """
    if not span // 3 <= core <= span or span - core >= 32:
        raise ValueError("core must be at most the span, and more than the span less 32")
    blocks = text_blocks(docs, id_col, text_col, row_col)
    buckets = bucket_count(blocks)
    sent = blocks.mapInArrow(send_anchors(span, core, buckets), KEYS_DDL)
    repeated = stage(exchange(sent, answer_repeats), "repeated-anchors")
    chosen = with_answers(blocks, repeated)
    runs = chosen.mapInArrow(send_runs(span, core, buckets), RUNS_DDL)
    smaller = stage(exchange(runs, answer_smaller(span, core)), "smaller-windows")
    both = chosen.withColumnRenamed("answers", "anchor_answers").join(
        smaller.hint("shuffle_hash"), "block", "left"
    )
    return both.mapInArrow(remove_marked(span, core, buckets, characters), KEPT_DDL)
