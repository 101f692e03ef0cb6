"""Token counts by rank-synchronous merging of arrays.

A text is cut into pieces at changes from non-space to space, the new pieces of a batch
are cut into pre-tokens, and the pre-tokens are held as one ragged array of byte symbols.
In each step every pre-token that still has a mergeable pair replaces all occurrences of
its lowest-ranked pair, all pre-tokens at once; the symbols that survive are its tokens.
Pre-tokens of more than ``LONG`` bytes take far more steps than the others, so they go through
the same steps as linked arrays in which a step touches the occurrences of one rank alone: the
work for a text of a megabyte without a space is in proportion to its merges.
Counts of pieces are kept in a bounded table per worker, so a word is merged one time.

Defined results: a null text counts as empty (no tokens); special strings of the vocabulary
inside a text count as one token each, as the library does by default; repeated rows are
counted each; an empty table gives an empty result. There is no shuffle.
"""

from __future__ import annotations

import json
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import arrow_rows, text_batches, whole_texts
from .pieces import SPACED_WORDS, SPACES, PieceTable

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
    ("over_limit", pa.bool_()),
])

# Fixed value: the pre-token pattern of the byte-level vocabulary.
PRE_TOKEN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{SPACES}\\p{{L}}\\p{{N}}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)

NO_RANK = np.int64(1) << 40

#: Pre-tokens of more bytes than this are merged as linked arrays.
LONG = 512


def byte_letters() -> dict[int, str]:
    """Letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves; the other bytes, in order, for the
    characters from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class RankMerger:
    """Merges byte sequences by the ranks of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.specials = [token["content"] for token in spec["added_tokens"] if token["special"]]
        letters = byte_letters()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged_by_rank = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.merged = self.merged_by_rank[order]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of surviving symbols of each byte string."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        long = np.flatnonzero(sizes > LONG)
        if not len(long):
            return self._short_counts(words, sizes)
        result = np.empty(len(words), np.int64)
        result[long] = self._long_counts([words[k] for k in long.tolist()], sizes[long])
        short = np.flatnonzero(sizes <= LONG)
        result[short] = self._short_counts([words[k] for k in short.tolist()], sizes[short])
        return result

    def _found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs among the merges, and whether they are there."""
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return place, self.keys[place] == keys

    def _short_counts(self, words: list[bytes], sizes: np.ndarray) -> np.ndarray:
        result = sizes.copy()
        owner = np.repeat(np.arange(len(words)), sizes)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        while len(symbols) > 1:
            keys = symbols[:-1] << 32 | symbols[1:]
            place, found = self._found(keys)
            found &= owner[:-1] == owner[1:]
            rank = np.where(found, self.ranks[place], NO_RANK)
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(np.r_[rank, NO_RANK], begins)
            spread = np.repeat(best, np.diff(np.r_[begins, len(owner)]))
            alive = spread < NO_RANK
            if not alive.any():
                break
            chosen = np.r_[rank == spread[:-1], False] & alive
            chosen = every_other(chosen)
            at = np.flatnonzero(chosen)
            symbols[at] = self.merged[place[at]]
            result -= np.bincount(owner[at], minlength=len(words))
            keep = alive
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return result

    def _long_counts(self, words: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """The same by one rank after another, over all words, each word with an end of its own."""
        owner = np.repeat(np.arange(len(words)), sizes + 1)
        ends = np.cumsum(sizes + 1) - 1
        total = len(owner)
        symbols = np.full(total, -1, np.int64)
        inner = np.ones(total, bool)
        inner[ends] = False
        symbols[inner] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, total + 1)
        before = np.arange(-1, total - 1)
        rank_at = np.full(total, NO_RANK)
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def note(at: np.ndarray) -> None:
            """Look up the pairs that begin at these positions, and file them under their ranks."""
            one, two = symbols[at], symbols[np.minimum(after[at], total - 1)]
            place, found = self._found(one << 32 | two)
            found &= (one >= 0) & (two >= 0)
            ranks = np.where(found, self.ranks[place], NO_RANK)
            rank_at[at] = ranks
            at, ranks = at[found], ranks[found]
            by_rank = np.argsort(ranks, kind="stable")
            at, ranks = at[by_rank], ranks[by_rank]
            begins = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]][:len(ranks)])
            for part, rank in zip(np.split(at, begins[1:]), ranks[begins].tolist()):
                if rank not in waiting:
                    waiting[rank] = []
                    heappush(order, rank)
                waiting[rank].append(part)

        note(np.flatnonzero(inner))
        while order:
            rank = heappop(order)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            at = at[rank_at[at] == rank]  # pairs that an earlier merge changed are filed anew
            if not len(at):
                continue
            linked = np.r_[False, after[at[:-1]] == at[1:]]
            index = np.arange(len(at))
            run = np.maximum.accumulate(np.where(linked, 0, index))
            at = at[(index - run) % 2 == 0]
            gone = after[at]
            symbols[at] = self.merged_by_rank[rank]
            symbols[gone] = -1
            rank_at[gone] = NO_RANK
            inner[gone] = False
            after[at] = after[gone]
            before[after[at]] = at
            left = before[at]
            note(np.unique(np.concatenate([at, left[left >= 0]])))
        return np.bincount(owner[inner], minlength=len(words))


def every_other(chosen: np.ndarray) -> np.ndarray:
    """The first, third, ... position of each run of chosen positions."""
    at = np.arange(len(chosen))
    first = chosen & ~np.r_[False, chosen[:-1]]
    run = np.maximum.accumulate(np.where(first, at, -1))
    return chosen & ((at - run) % 2 == 0)


class PieceCounter:
    def __init__(self, path: str):
        import regex

        self.merger = RankMerger(path)
        self.pre_token = regex.compile(PRE_TOKEN)
        self._clear()

    def _clear(self) -> None:
        self.table = PieceTable()
        self.sizes = np.zeros(0, np.int64)

    def _count_fresh(self) -> None:
        fresh, self.table.fresh = self.table.fresh, []
        if not fresh:
            return
        words, owner = [], []
        for index, piece in enumerate(fresh):
            found = self.pre_token.findall(piece)
            words += [word.encode("utf-8") for word in found]
            owner += [index] * len(found)
        sums = np.bincount(np.array(owner), weights=self.merger.counts(words), minlength=len(fresh))
        self.sizes = np.concatenate([self.sizes, sums.astype(np.int64)])

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if len(self.table) > self.table.limit:
            self._clear()
        known, specials = [], []
        for text in texts:
            parts = [text]
            for special in self.merger.specials:
                if special in text:
                    parts = [x for part in parts for x in part.split(special)]
            specials.append(len(parts) - 1)
            known.append(self.table.indices(
                [piece for part in parts for piece in SPACED_WORDS.findall(part)]
            ))
        self._count_fresh()
        return np.array([
            int(self.sizes[index].sum()) + extra for index, extra in zip(known, specials)
        ], np.int64)


@cache
def counter(path: str) -> PieceCounter:
    """The counter of this worker process for a vocabulary file."""
    return PieceCounter(path)


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 1024,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: UTF-8 bytes, tokens, and whether the tokens are more than ``limit``."""

    def count(batches):
        for ids, texts in text_batches(batches):
            tokens = counter(vocabulary).counts(texts)
            sizes = [len(text) if text.isascii() else len(text.encode("utf-8")) for text in texts]
            yield arrow_rows(
                SCHEMA, doc_id=ids, n_bytes=sizes, n_tokens=tokens, over_limit=tokens > limit
            )

    return whole_texts(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
