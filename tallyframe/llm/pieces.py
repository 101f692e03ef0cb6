"""Splitting texts into pieces that a tokenizer encodes independently of each other.

The public BPE tokenizers never match across a change from a non-space to a space
character, so a text is cut there and each distinct piece is encoded one time per worker.
The pieces seen are kept in a table of bounded size that outlives a task; when it is full
it starts anew, which costs time but changes no result.

Special strings inside a text (such as an end-of-text mark) are handled as the library does
by default: a text that holds one is encoded whole.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa

# The characters with the Unicode property White_Space, which is what the
# tokenizers' patterns call a space.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

SPACE_SET = frozenset(re.findall(f"[{SPACES}]", "".join(map(chr, range(0x3001)))))

#: A run of spaces with the word after it, or the spaces at the end of the text.
SPACED_WORDS = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
#: Words alone, for tokenizers that drop white space.
WORDS = re.compile(f"[^{SPACES}]+")

TABLE_LIMIT = 1_100_000

#: Characters of the texts that are looked up together, each distinct piece of them once.
BATCH_CHARS = 4_000_000

# The vocabulary files that the queries use.
BYTE_LEVEL = "byte_bpe_50k.json"
WORD_LEVEL = "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` for each i, one after another."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])


#: Bytes that are a space, bytes that a longer space begins with, and the longer ones as numbers.
_LONG_SPACES = [char.encode() for char in SPACE_SET if ord(char) > 127]
_IS_SPACE = np.isin(np.arange(256), [ord(char) for char in SPACE_SET if ord(char) < 128])
_LEADS = np.isin(np.arange(256), [char[0] for char in _LONG_SPACES])
_LONG_NUMBERS = {
    size: np.array([int.from_bytes(char) for char in _LONG_SPACES if len(char) == size])
    for size in (2, 3)
}


def space_bytes(data: np.ndarray) -> np.ndarray:
    """Whether each byte of UTF-8 ``data`` belongs to a space character."""
    spaces = _IS_SPACE[data]
    leads = np.flatnonzero(_LEADS[data])
    for size, numbers in _LONG_NUMBERS.items():
        leads = leads[leads + size <= len(data)]
        value = np.zeros(len(leads), np.int64)
        for k in range(size):
            value = value << 8 | data[leads + k]
        found = leads[np.isin(value, numbers)]
        for k in range(size):
            spaces[found + k] = True
    return spaces


def spaced_words(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """What ``SPACED_WORDS`` finds in all texts, as one array, and how many pieces each text has.

    A piece begins with its text, and where a space follows another character.
    """
    encoded = [text.encode() for text in texts]
    ends = np.cumsum([len(text) for text in encoded], dtype=np.int64)
    joined = b"".join(encoded)
    data = np.frombuffer(joined, np.uint8)
    spaces = space_bytes(data)
    begins = spaces.copy()
    begins[1:] &= ~spaces[:-1]
    bounds = np.r_[0, ends]
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(begins)
    offsets = np.r_[starts, len(data)].astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined))
    return pieces.dictionary_encode(), np.diff(np.searchsorted(starts, bounds))


class PieceTable(dict):
    """Piece to index; a look-up of an unknown piece enters it."""

    def __missing__(self, piece: str) -> int:
        self[piece] = index = len(self)
        self.fresh.append(piece)
        return index

    def __init__(self, limit: int = TABLE_LIMIT):
        super().__init__()
        self.limit = limit
        self.fresh: list[str] = []

    def indices(self, pieces: list[str] | np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, each distinct piece encoded one time.

    New pieces go to the library many at a time. Where a piece's share of the ids follows
    from their weights (bytes, or ends of words), pieces are simply joined; the others have
    a special string between them, which the library splits off before anything else.
    """

    def __init__(self, path: str, keeps_spaces: bool, limit: int = TABLE_LIMIT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = re.compile("|".join(re.escape(token.content) for token in added.values()))
        self.mark_id = max(added)
        self.mark = added[self.mark_id].content
        self.keeps_spaces = keeps_spaces
        self.pattern = SPACED_WORDS if keeps_spaces else WORDS
        self.weights = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, np.int64)
        for token, index in self.tokenizer.get_vocab().items():
            self.weights[index] = len(token) if keeps_spaces else token.endswith("</w>")
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.table = PieceTable(self.limit)
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def _weight(self, piece: str) -> int:
        """Weight of the piece's ids; 0 if it can't simply be joined with others."""
        if self.keeps_spaces:
            if piece[0] in " \n" and piece[-1] not in SPACE_SET:
                return len(piece) if piece.isascii() else len(piece.encode("utf-8"))
            return 0
        if piece.isalpha() and max(piece) < "\u0250" and "\u0130" not in piece:
            return 1
        stem = piece[:-1]
        if piece[-1] in ".,;:!?" and stem.isalpha() and max(stem) < "\u0250" and "\u0130" not in stem:
            return 2
        return 0

    def _library(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.uint32)

    def _encode_fresh(self) -> None:
        fresh, self.table.fresh = self.table.fresh, []
        if not fresh:
            return
        weights = np.fromiter(map(self._weight, fresh), np.int64, len(fresh))
        lengths = np.zeros(len(fresh), np.int64)
        starts = np.zeros(len(fresh), np.int64)
        flats, total = [self.ids], len(self.ids)
        for simple in (True, False):
            members = np.flatnonzero((weights > 0) == simple)
            for first in range(0, len(members), 1000):
                part = members[first:first + 1000]
                texts = [fresh[i] for i in part]
                if simple:
                    ids = self._library(("" if self.keeps_spaces else " ").join(texts))
                    ends = 1 + np.searchsorted(
                        np.cumsum(self.weights[ids]), np.cumsum(weights[part]), "left"
                    )
                else:
                    marked = self._library(self.mark.join(texts) + self.mark)
                    ends = np.flatnonzero(marked == self.mark_id) - np.arange(len(part))
                    ids = marked[marked != self.mark_id]
                lengths[part] = np.diff(ends, prepend=0)
                starts[part] = total + ends - lengths[part]
                flats.append(ids)
                total += len(ids)
        self.ids = np.concatenate(flats)
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text as unsigned 32-bit integers."""
        return next(iter(self.encode_all([text])))

    def encode_all(self, texts: list[str]):
        """Ids of each text, in order."""
        if not self.keeps_spaces:
            for first in range(0, len(texts), 256):
                yield from self._encode_some(texts[first:first + 256])
            return
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > BATCH_CHARS:
                yield from self._encode_some(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        if held:
            yield from self._encode_some(held)

    def _known(self, texts: list[str]) -> list[np.ndarray]:
        """Indices of the pieces of each text."""
        if not self.keeps_spaces:
            return [self.table.indices(self.pattern.findall(text)) for text in texts]
        pieces, counts = spaced_words(texts)
        distinct = self.table.indices(pieces.dictionary.to_numpy(zero_copy_only=False))
        return np.split(distinct[pieces.indices.to_numpy()], np.cumsum(counts)[:-1])

    def _encode_some(self, texts: list[str]):
        if len(self.table) > self.table.limit:
            self._clear()
        plain = [text for text in texts if not self.special.search(text)]
        known = iter(self._known(plain) if plain else [])
        whole = len(plain) < len(texts)
        self._encode_fresh()
        for text in texts:
            if whole and self.special.search(text):
                yield self._library(text)
            else:
                index = next(known)
                yield self.ids[ragged_positions(self.starts[index], self.lengths[index])]


@cache
def encoder(path: str, keeps_spaces: bool) -> PieceEncoder:
    """The encoder of this worker process for a vocabulary file."""
    return PieceEncoder(path, keeps_spaces)


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()) & 0xFFFFFFFF
