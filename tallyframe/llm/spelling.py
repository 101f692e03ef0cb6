"""Spelling variants of a corpus vocabulary, by Bloom-guided edit neighbourhoods.

The words of all texts are counted once. Two words are near if they differ by exactly one inserted,
deleted or replaced code point; a word's form is its most frequent near word, if that is at least
``ratio`` times as frequent.

Near words are found by probing, not by comparing words with each other. The vocabulary goes into
blocked Bloom filters, one for each word length, of 64-bit blocks. Every word generates its edits
as 64-bit hashes (a hash is a sum over places, so an edit costs one addition) and tests them
against the broadcast filter of the edit's length. Only hits are shuffled, as a few bytes each, to
a join with the vocabulary, and the join is checked letter by letter, so nothing false remains.

A pair is generated once: a deletion from its longer word, a replacement from the word with the
smaller letter there. A broadcast holds at most ``pass_blocks`` blocks; a larger vocabulary is
probed in several passes, each over its own range of blocks, so that the broadcast stays bounded
while the passes grow with the vocabulary. All lengths from 64 on share a filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import arrow_rows, release_memory, stage
from .words import lower_ascii

#: Fixed value: what is left of the letters A-Z, a-z, U+00C0 to U+00FF when A-Z are lower-cased.
NO_LETTERS = r"[^a-zÀ-ÿ]+"

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
SLIP = 31
PASS_BLOCKS = 1 << 21
BITS_PER_WORD = 24
BITS_SET = 5
LAST_CLASS = 64
#: Letters of a batch that are edited at a time.
CELLS = 1 << 16

VOCABULARY = pa.schema([
    ("id", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("length", pa.int32()),
    ("h", pa.int64()),
])
VOCABULARY_DDL = "id long, word string, n long, length int, h long"
HITS = pa.schema([
    ("id", pa.int64()), ("h", pa.int64()), ("place", pa.int32()), ("letter", pa.string()),
])
HITS_DDL = "id long, h long, place int, letter string"


# ---- words -------------------------------------------------------------------------------------


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP,
) -> DataFrame:
    """(word, n): letter runs of whole texts, A-Z lower-cased, counted over the corpus.

    Where ``slip`` divides the crc32 of ``<doc_id>:<run>``, the run loses the code point at that
    crc32 modulo its length. Shorter and rarer results are left out. A null text has no runs; a
    null id reads as empty.
    """
    lowered = lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("owner"),
        F.explode(F.split(lowered, NO_LETTERS)).alias("run"),
    ).where(F.length("run") >= least_length)
    marked = runs.select(
        "run", F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary")).alias("crc")
    )
    at = (F.col("crc") % F.length("run")).cast("int")
    word = F.when(F.col("crc") % slip == 0, _without(F.col("run"), at)).otherwise(F.col("run"))
    return (
        marked.select(word.alias("word")).where(F.length("word") >= least_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
    )


def _without(text: Column, at: Column) -> Column:
    """Text without the code point at a place from 0."""
    return F.concat(F.substring(text, F.lit(1), at), F.substring(text, at + 2, F.length(text)))


# ---- hashes ------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _values(start: int, stop: int) -> np.ndarray:
    """[place, letter]: what a letter adds to the hash of a word at the places start to stop."""
    cells = np.arange(start * 256 + 1, stop * 256 + 1, dtype=np.uint64)
    return _mixed(cells * np.uint64(0x9E3779B97F4A7C15)).reshape(-1, 256)


_short_values = lru_cache(maxsize=128)(lambda stop: _values(0, stop))


def _added(letters: np.ndarray, first: int, shift: int = 0) -> np.ndarray:
    """What each letter of a matrix adds, its first column standing at place ``first - shift``."""
    width = letters.shape[1]
    start = first - shift
    if first == 0 and shift == 0 and width <= 256:
        values = _short_values(width)
    else:
        values = _values(max(start, 0), start + width)
        if start < 0:  # the place before the first is never used
            values = np.vstack([np.zeros((1, 256), np.uint64), values])
    return values[np.arange(width)[None, :], letters]


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, given as a matrix of their code points."""
    total = np.zeros(len(letters), np.uint64)
    step = max(1, CELLS // max(1, len(letters)))
    for first in range(0, letters.shape[1], step):
        total += _added(letters[:, first:first + step], first).sum(axis=1, dtype=np.uint64)
    return total


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, letters) of words of one length, at most about CELLS letters at a time."""
    coded = [word.encode("latin-1") for word in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        step = max(1, CELLS // int(size))
        for k in range(0, len(places), step):
            some = places[k:k + step]
            body = b"".join(coded[i] for i in some)
            yield some, np.frombuffer(body, np.uint8).reshape(len(some), int(size))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(1).to_pylist()
        hashes = np.zeros(len(words), np.uint64)
        lengths = np.zeros(len(words), np.int32)
        for places, letters in _by_length(words):
            hashes[places] = word_hashes(letters)
            lengths[places] = letters.shape[1]
        yield arrow_rows(
            VOCABULARY, id=batch.column(0), word=batch.column(1), n=batch.column(2),
            length=lengths, h=hashes.view(np.int64),
        )
    release_memory()


# ---- filters -----------------------------------------------------------------------------------


def _class(length: Column) -> Column:
    return F.least(length, F.lit(LAST_CLASS))


def _blocks_needed(words: int) -> int:
    return words * BITS_PER_WORD // 64 + 1


def _passes(blocks: dict[int, int], room: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (class, first block, last block + 1) with at most ``room`` blocks in each."""
    taken, left = [], room
    for length, count in sorted(blocks.items()):
        first = 0
        while first < count:
            last = min(count, first + left)
            taken.append((length, first, last))
            left -= last - first
            first = last
            if not left:
                yield taken
                taken, left = [], room
    if taken:
        yield taken


def _filter_rows(vocabulary: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """(class, block, bits): the filters of all classes, as rows of 64-bit blocks."""
    sizes = F.create_map(*[F.lit(x).cast("long") for pair in blocks.items() for x in pair])
    high = F.shiftrightunsigned("h", 32)
    block = F.shiftright(high * sizes[_class(F.col("length")).cast("long")], 32)
    bits = F.lit(0).cast("long")
    for k in range(BITS_SET):
        place = F.shiftright("h", 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return vocabulary.select(
        _class(F.col("length")).alias("class"), block.alias("block"), bits.alias("bits")
    ).groupBy("class", "block").agg(F.bit_or("bits").alias("bits"))


def _loaded(rows: DataFrame, shares: list[tuple[int, int, int]], blocks: dict[int, int]) -> dict:
    """{class: (blocks in all, first block, bits)} of one pass; at most its room of blocks."""
    wanted = F.lit(False)
    for length, first, last in shares:
        wanted |= (F.col("class") == length) & F.col("block").between(first, last - 1)
    found = rows.where(wanted).toArrow()
    classes, places, bits = (found.column(name).to_numpy() for name in ("class", "block", "bits"))
    loaded = {}
    for length, first, last in shares:
        own = classes == length
        body = np.zeros(last - first, np.uint64)
        body[places[own] - first] = bits[own].astype(np.int64).view(np.uint64)
        loaded[length] = (blocks[length], first, body)
    return loaded


def _held(hashes: np.ndarray, share: tuple[int, int, np.ndarray]) -> np.ndarray:
    """Indices of the hashes that a filter may hold."""
    count, first, body = share
    block = ((hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).view(np.int64) - first
    kept = np.arange(len(hashes))
    if first or len(body) < count:
        kept = np.flatnonzero((block >= 0) & (block < len(body)))
        block, hashes = block[kept], hashes[kept]
    bits = body[block]
    one, low = np.uint64(1), np.uint64(63)
    for k in range(BITS_SET):
        ok = (bits >> (hashes >> np.uint64(6 * k) & low)) & one == one
        kept, bits, hashes = kept[ok], bits[ok], hashes[ok]
    return kept


# ---- edits -------------------------------------------------------------------------------------


def _edits(letters: np.ndarray, hashes: np.ndarray, alphabet: bytes, filters: dict) -> Iterator[tuple]:
    """(rows, places, letter, hashes) of the edits of words of one length that a filter may hold."""
    size = letters.shape[1]
    same, shorter = filters.get(min(size, LAST_CLASS)), filters.get(min(size - 1, LAST_CLASS))
    before = np.zeros(len(letters), np.uint64)  # sum of the letters before, at their own places
    after = np.zeros(len(letters), np.uint64)  # sum of the letters from here on, one place earlier
    step = max(1, CELLS // len(letters))
    if shorter is not None:
        for first in range(0, size, step):
            part = letters[:, first:first + step]
            moved = _added(part, first, 1)
            if first == 0:
                moved[:, 0] = 0
            after += moved.sum(axis=1, dtype=np.uint64)
    for first in range(0, size, step):
        part = letters[:, first:first + step]
        own = _added(part, first)
        if shorter is not None:
            moved = _added(part, first, 1)
            if first == 0:
                moved[:, 0] = 0
            left = before[:, None] + np.cumsum(own, axis=1, dtype=np.uint64) - own
            right = after[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
            following = letters[:, first + 1:first + 1 + part.shape[1]]
            last = np.ones(part.shape, bool)  # of equal letters in a row the last one is deleted
            last[:, :following.shape[1]] = part[:, :following.shape[1]] != following
            rows, places = np.nonzero(last)
            found = (left + right)[last]
            kept = _held(found, shorter)
            yield rows[kept], places[kept] + first, "", found[kept]
            before += own.sum(axis=1, dtype=np.uint64)
            after -= moved.sum(axis=1, dtype=np.uint64)
        if same is not None:
            base = hashes[:, None] - own
            values = _short_values(size) if first == 0 and size <= min(step, 256) else _values(
                first, first + part.shape[1]
            )
            for letter in alphabet:
                smaller = part < letter
                found = (base + values[:, letter][None, :])[smaller]
                kept = _held(found, same)
                if len(kept):
                    cells = np.flatnonzero(smaller)[kept]
                    yield cells // part.shape[1], cells % part.shape[1] + first, chr(letter), found[kept]


def _probe(alphabet: bytes, filters) -> Callable:
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = filters.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            words = batch.column(1).to_pylist()
            all_hashes = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            for at, letters in _by_length(words):
                for rows, places, letter, hashes in _edits(letters, all_hashes[at], alphabet, loaded):
                    if len(rows):
                        yield arrow_rows(
                            HITS, id=ids[at[rows]], h=hashes.view(np.int64),
                            place=places.astype(np.int32), letter=[letter] * len(rows),
                        )
        release_memory()

    return probe


def near_pairs(vocabulary: DataFrame, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """(word, n, other, other_n): every unordered pair of near words once.

    ``vocabulary`` is a staged table (id, word, n, length, h).
    """
    spark = vocabulary.sparkSession
    counts = vocabulary.groupBy(_class(F.col("length")).alias("class")).count().collect()
    blocks = {row["class"]: _blocks_needed(row["count"]) for row in counts}
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).distinct()
    alphabet = bytes(sorted(ord(row["c"]) for row in letters.collect() if row["c"]))
    hits = spark.createDataFrame([], HITS_DDL)
    if blocks:
        rows = stage(_filter_rows(vocabulary, blocks), "filters")
        for shares in _passes(blocks, pass_blocks):
            lengths = {length for length, _, _ in shares}
            filters = spark.sparkContext.broadcast(_loaded(rows, shares, blocks))
            probed = vocabulary.where(
                _class(F.col("length")).isin(*lengths) | _class(F.col("length") - 1).isin(*lengths)
            ).select("id", "word", "h").mapInArrow(_probe(alphabet, filters), HITS_DDL)
            hits = hits.union(stage(probed, "hits"))
    own = vocabulary.select("id", "word", "n")
    other = vocabulary.select("h", F.col("word").alias("other"), F.col("n").alias("other_n"))
    edited = F.concat(
        F.substring(F.col("word"), F.lit(1), F.col("place")), F.col("letter"),
        F.substring(F.col("word"), F.col("place") + 2, F.length("word")),
    )
    return hits.join(other, "h").join(own, "id").where(edited == F.col("other")).select(
        "word", "n", "other", "other_n"
    )


# ---- groups ------------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) rows: the last word of each chain.

    The count grows at least ``ratio`` times with each link, so chains are short; each round
    doubles what is followed.
    """
    found = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = found.join(onward, "root", "left")
        if longer.where(F.col("next").isNotNull()).isEmpty():
            return found
        found = stage(longer.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variant_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
    slip: int = SLIP, pass_blocks: int = PASS_BLOCKS,
) -> DataFrame:
    """One row per word of the corpus: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that n is at
    least ``ratio`` times the word's, else null; ``root`` is the end of the chain of forms, the
    word itself if there is none. Repeated rows count each time; an empty table, or one of null
    and empty texts, gives no rows; further columns of ``docs`` are not looked at.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, else chains of forms need not end")
    counted = word_counts(docs, id_col, text_col, least_length, least_count, slip)
    vocabulary = stage(
        counted.select(F.monotonically_increasing_id().alias("id"), "word", "n")
        .mapInArrow(_hashed, VOCABULARY_DDL), "vocabulary",
    )
    pairs = stage(near_pairs(vocabulary, pass_blocks), "near-words")
    both = pairs.select("word", "other", "other_n").union(
        pairs.select(F.col("other"), F.col("word"), F.col("n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"))).alias("best"),
    )
    form_n = -F.col("best.rank")
    judged = stage(
        vocabulary.select("word", "n").join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(form_n >= ratio * F.col("n"), F.col("best.form")).alias("form"),
            F.when(form_n >= ratio * F.col("n"), form_n).alias("form_n"),
        ), "judged-words",
    )
    roots = _roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
