"""Near-duplicates by Order MinHash, verified by banded alignment.

The k-mers of a text are its runs of five words (a shorter text is one k-mer), each labelled
with how many times it came before in the text. A sketch takes the ``size`` k-mers that are
least under one permutation and keeps them in text order, so that it is sensitive to edits and
not only to content. Texts with an equal sketch are candidates.

A short text has too few k-mers for that: four and five k-mers never share a sketch. Short texts
(at most 14 k-mers at similarity 0.8) have exact keys besides: the k-mer sequence and each
sequence that is left when k-mers are taken out, as many as a text of the asked similarity may
lack. Two short texts of that similarity share the key of their longest common subsequence, so
none of these links is left to chance.

The similarity of two texts is that of their labelled k-mer sequences: ``m / (a + b - m)``
with m the length of their longest common subsequence. Labelled k-mers match at most once, so
that is a longest increasing subsequence, within the band of diagonals which an alignment
of the asked similarity can reach. Where nothing is moved or repeated it equals the Jaccard
similarity of the word shingles.

Equal texts are one node, so copies cost nothing further. In a group of candidates every text is
verified against its center, the text that shares the most keys, and what is linked becomes one
component. A group that still spans several components may hide links among its other members, so
every pair of different components in it is decided too, whatever the sizes of the group and of the
table. Pairs of groups of up to ``FULL_GROUP`` texts are listed, each once, and verified. Larger
groups are cut into parts, and a task takes two parts of a group: it counts the common k-mers of all
pairs at once, and aligns those that can reach the asked similarity and are not yet linked. Nothing
but links comes out of it. The work grows with the square of such a group; a task's share does not.

What is left to chance: a pair of the asked similarity shares no sketch with probability ``LOSS`` at
most with the default number and size of sketches; texts too short for that have exact keys.

Defined results: null texts count as empty, and texts without a word are near-duplicates of their
exact copies only; a document without id is its own group and kept; a doc_id that several
rows share is one document with several texts.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache
from itertools import combinations
from math import ceil, comb, inf, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import mix
from .components import connected_components
from .doubling import BYTE_VALUES, run_prints
from .frames import arrow_rows, release_memory, settled, stage, text_batches, whole_texts
from .pieces import ragged_positions

WORDS = 5
SIZE = 5
SKETCHES = 32
SIMILARITY = 0.8
EXACT_KEYS = 128
LOSS = 1e-4
PAIRS_A_TEXT = 1
LEAST_PAIRS = 50_000
FULL_GROUP = 16
PART_TEXTS = 2000
PART_KMERS = 1_000_000
SPREAD_PAIRS = 1 << 20
KEPT_KMERS = 2_000_000
BATCH_KEYS = 500_000

KEYED = pa.schema([
    ("doc_id", pa.int64()), ("keys", pa.list_(pa.int64())), ("gone", pa.list_(pa.int32())),
    ("n_kmers", pa.int32()),
])
VERIFIED = pa.schema([("center", pa.int64()), ("member", pa.int64()), ("similarity", pa.float64())])

# Fixed value: with A-Z lower-cased, the bytes that separate words.
_SEPARATES = np.isin(np.arange(256), [
    *range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80),
])
_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def word_prints(text: str) -> np.ndarray:
    """Fingerprint of each word of a text."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    edges = np.flatnonzero(np.diff(np.r_[True, _SEPARATES[data], True].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = BYTE_VALUES[_LOWER[data]]
    powers = np.cumprod(np.full(len(data), _FACTOR), dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(values * powers, dtype=np.uint64)]
    shrink = np.cumprod(
        np.full(len(data), np.uint64(pow(int(_FACTOR), -1, 1 << 64))), dtype=np.uint64
    )
    return mix((sums[ends] - sums[starts]) * shrink[starts])


def labelled(text: str, words: int = WORDS) -> np.ndarray:
    """Fingerprints of the text's k-mers in order, each told apart by its earlier occurrences."""
    prints = word_prints(text)
    if not len(prints):
        return prints
    grams = run_prints(prints, min(words, len(prints)))
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    at = np.arange(len(grams))
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    count = np.empty(len(grams), np.uint64)
    count[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return np.where(count > 0, mix(grams + count * _FACTOR), grams)


def sketches(kmers: np.ndarray, size: int, count: int, salt: int = 0) -> np.ndarray:
    """``count`` order sketches, as signed 64-bit values that differ between permutations."""
    seeds = mix(np.arange(1 + salt, 1 + salt + count, dtype=np.uint64) * _FACTOR)
    found = np.empty(count, np.uint64)
    step = max(1, 250_000 // max(1, len(kmers)))
    for first in range(0, count, step):
        seed = seeds[first:first + step, None]
        if len(kmers) > size:
            turned = (kmers[None, :] ^ seed) * (seed | _ONE)
            least = np.sort(np.argpartition(turned, size, axis=1)[:, :size], axis=1)
            chosen = kmers[least]
        else:
            chosen = np.repeat(kmers[None, :], len(seed), axis=0)
        value = seed[:, 0].copy()
        for k in range(chosen.shape[1]):
            value = mix(value * _FACTOR + chosen[:, k])
        found[first:first + step] = value
    return found.view(np.int64)


def most_gone(length: int, least: float) -> int:
    """How many of ``length`` k-mers a text of similarity ``least`` may lack."""
    return max(gone for gone in range(length + 1) if (length - gone) / length >= least)


def short_length(least: float, size: int) -> int:
    """Number of k-mers up to which texts have exact keys: as long as these are at most
    EXACT_KEYS, and in any case where a text that is sketched by all its k-mers may be similar."""
    length = 0
    while (length + 1) * least <= size or sum(
        comb(length + 1, gone) for gone in range(most_gone(length + 1, least) + 1)
    ) <= EXACT_KEYS:
        length += 1
    return length


@lru_cache(maxsize=64)
def _left(length: int, gone: int) -> np.ndarray:
    return np.array(list(combinations(range(length), length - gone)), np.int64)


def exact_keys(kmers: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(key, k-mers gone) of each sequence left when as many go as ``least`` allows."""
    keys, gone = [], []
    for count in range(most_gone(len(kmers), least) + 1):
        chosen = kmers[_left(len(kmers), count)]
        value = mix(np.full(len(chosen), chosen.shape[1], np.uint64))
        for k in range(chosen.shape[1]):
            value = mix(value * _FACTOR + chosen[:, k])
        keys.append(value.view(np.int64))
        gone.append(np.full(len(value), count, np.int32))
    return np.concatenate(keys), np.concatenate(gone)


def similarity(one: np.ndarray, two: np.ndarray, least: float) -> float:
    """Aligned similarity of two labelled k-mer sequences; 0 if it is below ``least``."""
    a, b = len(one), len(two)
    if not a or not b or min(a, b) < least * max(a, b):
        return 0.0
    band = (a + b) * (1 - least) / (1 + least) + 1e-9
    _, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    order = np.argsort(i[near])
    matched = j[near][order]
    common = len(matched)
    if common / (a + b - common) < least:
        return 0.0
    if (matched[1:] < matched[:-1]).any():
        tails: list[int] = []
        for place in matched.tolist():
            at = bisect_left(tails, place)
            tails[at:at + 1] = [place]
        common = len(tails)
    found = common / (a + b - common)
    return found if found >= least else 0.0


def common_kmers(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many labelled k-mers each text of ``one`` has in common with each of ``two``.

    K-mers of many texts are counted by products of 0-1 matrices, the others pair by pair.
    """
    rows = [np.repeat(np.arange(len(side)), [len(kmers) for kmers in side]) for side in (one, two)]
    _, place = np.unique(np.concatenate([*one, *two]), return_inverse=True)
    places = place[:len(rows[0])], place[len(rows[0]):]
    often = [np.bincount(side, minlength=int(place.max(initial=-1)) + 1) for side in places]
    pairs = often[0] * often[1]
    dense = pairs * 100 > len(one) * len(two)
    found = np.zeros((len(one), len(two)), np.float32)
    column = np.cumsum(dense) - 1
    for first in range(0, int(dense.sum()), 2048):
        bits = []
        for side, at, number in zip((one, two), places, rows):
            here = dense[at] & (column[at] >= first) & (column[at] < first + 2048)
            matrix = np.zeros((len(side), 2048), np.float32)
            matrix[number[here], column[at[here]] - first] = 1
            bits.append(matrix)
        found += bits[0] @ bits[1].T
    order = np.argsort(places[1], kind="stable")
    begins = np.cumsum(often[1]) - often[1]
    rare = np.flatnonzero(~dense[places[0]] & (pairs[places[0]] > 0))
    spread = np.cumsum(often[1][places[0][rare]])
    flat = found.reshape(-1)
    while len(rare):
        take = max(1, int(np.searchsorted(spread, SPREAD_PAIRS, "right")))
        at = places[0][rare[:take]]
        others = order[ragged_positions(begins[at], often[1][at])]
        cells = np.repeat(rows[0][rare[:take]], often[1][at]) * len(two) + rows[1][others]
        cells, n = np.unique(cells, return_counts=True)
        flat[cells] += n
        rare, spread = rare[take:], spread[take:] - spread[take - 1]
    return found


def part_links(one: tuple, two: tuple | None, least: float) -> tuple[list, list, list]:
    """Links of different components between two parts, or within one, as (ids, components, k-mers):
    as many as it takes to join all that any of the pairs would."""
    (ids, components, kmers), (other_ids, other_components, other_kmers) = one, two or one
    common = common_kmers(kmers, other_kmers).astype(np.float64)
    total = np.add.outer([len(k) for k in kmers], [len(k) for k in other_kmers]) - common
    bound = common / np.maximum(total, 1)
    bound[components[:, None] == other_components[None, :]] = 0
    if two is None:
        bound = np.triu(bound, 1)
    a, b = np.nonzero(bound >= least)
    order = np.argsort(-bound[a, b], kind="stable")
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (above := parent.get(node, node)) != node:
            parent[node] = parent.get(above, above)
            node = above
        return node

    centers, members, found = [], [], []
    for i, j in zip(a[order].tolist(), b[order].tolist()):
        here, there = root(int(components[i])), root(int(other_components[j]))
        if here == there:
            continue
        value = similarity(kmers[i], other_kmers[j], least)
        if value >= least:
            parent[there] = here
            centers.append(int(min(ids[i], other_ids[j])))
            members.append(int(max(ids[i], other_ids[j])))
            found.append(value)
    return centers, members, found


def exact_count(length: int, least: float) -> int:
    """Number of exact keys of a text."""
    return sum(comb(length, gone) for gone in range(most_gone(length, least) + 1))


@lru_cache(maxsize=1 << 16)
def draws(length: int, size: int, least: float) -> float:
    """How many sketches a text needs to share one with any that is similar, but for LOSS.

    Counted for the worst partner of a text: one that lacks all that a similar text may lack.
    """
    common = int(least * length + 1e-9)
    if common < size:
        return inf
    return ceil(-log(LOSS) / (comb(common, size) / comb(length, size)))


@lru_cache(maxsize=256)
def exact_length(size: int, least: float) -> int:
    """Up to this many k-mers, exact keys are fewer than the sketches that would be needed."""
    length = size
    while any(
        exact_count(longer, least) <= draws(longer, size, least) for longer in range(length + 1, length + 6)
    ):
        length += 1
    return length


def later_draws(length: int, size: int, least: float) -> int:
    """Number of sketches of ``size`` k-mers that a text needs beside exact keys of texts up to
    ``exact_length``, by which to choose other sizes; 0 if all its partners have exact keys."""
    bound = exact_length(size, least)
    if length < least * bound:
        return 0
    return int(draws(max(length, bound + 1), size, least))


def keyed_texts(texts: DataFrame, size: int, least: float, count: int) -> DataFrame:
    """(doc_id, keys, gone, n_kmers) of (doc_id, text): ``count`` sketches, and exact keys of short
    texts. ``gone`` is null for a sketch.
    """
    short = short_length(least, size)

    def keyed(batches):
        for ids, bodies in text_batches(batches):
            keys, gone, lengths, done, size_now = [], [], [], 0, 0
            for body in bodies:
                if size_now > BATCH_KEYS:
                    some = slice(done, done + len(keys))
                    yield arrow_rows(KEYED, doc_id=ids[some], keys=keys, gone=gone, n_kmers=lengths)
                    keys, gone, lengths, done, size_now = [], [], [], some.stop, 0
                kmers = labelled(body)
                exact, fewer = np.zeros(0, np.int64), []
                if 0 < len(kmers) <= short:
                    exact, fewer = exact_keys(kmers, least)
                # up to ``size`` k-mers, whatever is similar has exact keys too
                drawn = sketches(kmers, size, count) if len(kmers) > size else exact[:0]
                keys.append(np.r_[drawn, exact])
                gone.append([None] * len(drawn) + list(fewer))
                lengths.append(len(kmers))
                size_now += len(keys[-1])
            yield arrow_rows(KEYED, doc_id=ids[done:], keys=keys, gone=gone, n_kmers=lengths)

    return texts.select("doc_id", "text").mapInArrow(
        keyed, "doc_id long, keys array<long>, gone array<int>, n_kmers int"
    )


def exploded_keys(keyed: DataFrame) -> DataFrame:
    """(doc_id, key, gone, n_kmers), one row per key; n_kmers is null for a sketch."""
    rows = keyed.select("doc_id", "n_kmers", F.explode(F.arrays_zip("keys", "gone")).alias("at"))
    return rows.select(
        "doc_id", F.col("at.keys").alias("key"), F.col("at.gone").alias("gone"),
        F.when(F.col("at.gone").isNotNull(), F.col("n_kmers")).alias("n_kmers"),
    )


class KmerTable(dict):
    """Labelled k-mers of the texts seen last, up to a number of k-mers in all."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held = limit, 0

    def __missing__(self, text: str) -> np.ndarray:
        kmers = labelled(text)
        self.held += len(kmers) + len(text) // 8
        if self.held > self.limit:
            self.clear()
            self.held = len(kmers) + len(text) // 8
        self[text] = kmers
        return kmers


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(center, member, similarity) of candidate pairs; a dominant center is a skewed join key."""
    members = pairs.join(texts.withColumnRenamed("doc_id", "member"), "member")
    both = members.join(
        texts.select(F.col("doc_id").alias("center"), F.col("text").alias("center_text")), "center"
    ).select("center", "member", "text", "center_text")

    def verify(batches):
        kmers = KmerTable(KEPT_KMERS)
        for batch in batches:
            found = [
                similarity(kmers[other.as_py()], kmers[text.as_py()], least)
                for text, other in zip(batch.column(2), batch.column(3))
            ]
            yield arrow_rows(
                VERIFIED, center=batch.column(0), member=batch.column(1), similarity=found
            )

    return both.mapInArrow(verify, "center long, member long, similarity double")


def near_duplicates(
    docs: DataFrame, least: float = SIMILARITY, size: int = SIZE, count: int = SKETCHES,
    id_col: str = "doc_id", text_col: str = "text", pairs_a_text: float = PAIRS_A_TEXT,
    least_pairs: int = LEAST_PAIRS,
) -> DataFrame:
    """Per document row: ``text_id``, the smallest document with an equal text, ``group_id``,
    the smallest document it is linked to by near-duplicates, and whether it stays.

    Groups of any size are decided in full: ``pairs_a_text`` and ``least_pairs``, which once bounded
    the pairs by the size of the table, are accepted and change nothing. The result is a staged
    table; keys, groups and candidate texts are removed when it is written.
    """
    return settled(
        lambda: _groups(docs, least, size, count, id_col, text_col), "near-duplicates"
    )


def _groups(
    docs: DataFrame, least: float, size: int, count: int, id_col: str, text_col: str
) -> DataFrame:
    texts = whole_texts(docs, id_col, text_col)
    keyed = texts.select("doc_id", F.unhex(F.sha2("text", 256)).alias("text_key"))
    same = stage(
        keyed.where(F.col("doc_id").isNotNull()).groupBy("text_key").agg(
            F.min("doc_id").alias("text_id"), F.max("doc_id").alias("last")
        ).where(F.col("text_id") != F.col("last")).drop("last"), "repeated-texts",
    )
    equal = stage(
        keyed.join(same, "text_key", "left").select(
            "doc_id", F.coalesce("text_id", "doc_id").alias("text_id")
        ), "equal-texts",
    )
    nodes = equal.select("text_id").where(F.col("text_id").isNotNull()).distinct()

    named = texts.where(F.col("doc_id").isNotNull())
    first = stage(
        keyed_texts(named, size, least, count).join(
            nodes.withColumnRenamed("text_id", "doc_id"), "doc_id", "left_semi"
        ), "text-keys",
    )
    most = most_gone(short_length(least, size), least)
    groups = stage(shared_keys(exploded_keys(first), most, least), "sketch-groups")
    involved = groups.select("doc_id").distinct()
    bodies = stage(named.join(involved, "doc_id", "left_semi"), "candidate-texts")

    checked = _checked(
        groups.select("center", F.col("doc_id").alias("member")), None, bodies, least
    )
    mixed = _mixed_groups(_placed(groups, _components(checked, least)))
    is_large = F.col("members") > FULL_GROUP
    lengths = first.groupBy("doc_id").agg(F.sum("n_kmers").alias("n_kmers"))
    links = stage(_linked(mixed.where(is_large).join(lengths, "doc_id"), bodies, least), "group-links")
    checked = _checked(_apart(mixed.where(~is_large)), checked, bodies, least).unionByName(links)
    component = _components(checked, least).withColumnRenamed("node", "text_id")
    group = F.coalesce("component", "text_id", "doc_id")
    return equal.join(component, "text_id", "left").select(
        "doc_id", "text_id", group.alias("group_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == group)).alias("kept"),
    )


def _checked(
    pairs: DataFrame, checked: DataFrame | None, bodies: DataFrame, least: float
) -> DataFrame:
    """All verified pairs, with those of ``pairs`` that are new."""
    pairs = pairs.where(F.col("member") != F.col("center")).select("center", "member").distinct()
    if checked is not None:
        pairs = pairs.join(checked, ["center", "member"], "left_anti")
    fresh = verified(pairs, bodies, least).groupBy("center", "member").agg(
        F.max("similarity").alias("similarity")
    )
    fresh = stage(fresh, "verified-pairs")
    return fresh if checked is None else checked.unionByName(fresh)


def _components(checked: DataFrame, least: float) -> DataFrame:
    links = checked.where(F.col("similarity") >= least)
    return connected_components(links, "center", "member")


def _apart(mixed: DataFrame) -> DataFrame:
    """(center, member) pairs of different components in the same group."""
    other = mixed.select(
        "key", F.col("doc_id").alias("center"), F.col("component").alias("center_component")
    )
    return mixed.withColumnRenamed("doc_id", "member").join(other, "key").where(
        (F.col("center") < F.col("member")) & (F.col("component") != F.col("center_component"))
    ).select("center", "member")


def _placed(groups: DataFrame, component: DataFrame) -> DataFrame:
    """(key, doc_id, component, is_center) with the components of all links so far."""
    named = component.withColumnRenamed("node", "doc_id")
    return groups.dropDuplicates(["key", "doc_id"]).join(named, "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component"),
        (F.col("doc_id") == F.col("center")).alias("is_center"),
    )


def _linked(mixed: DataFrame, bodies: DataFrame, least: float) -> DataFrame:
    """(center, member, similarity): links that join the components in each group as all of its
    pairs would.

    A group is cut into parts by hash, as many as its texts and k-mers need, and every two parts
    meet in one task.
    """
    parts = mixed.groupBy("key").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / PART_TEXTS, F.sum("n_kmers") / PART_KMERS
    )).alias("parts"))
    own, other = F.col("part"), F.col("other")
    dealt = mixed.join(parts, "key").withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), "parts")
    ).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).select(
        "key", F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), "part",
        "doc_id", "component",
    )

    def link(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")
        part = rows["part"].to_numpy()
        ids, component = rows["doc_id"].to_numpy(), rows["component"].to_numpy()
        kmers = [labelled(text.as_py()) for text in rows["text"]]
        sides = []
        for name in ("low", "high"):
            at = np.flatnonzero(part == rows[name].to_numpy())
            sides.append((ids[at], component[at], [kmers[i] for i in at]))
        same_part = rows["low"][0] == rows["high"][0]
        center, member, found = part_links(sides[0], None if same_part else sides[1], least)
        release_memory()
        return pa.Table.from_batches([
            arrow_rows(VERIFIED, center=center, member=member, similarity=found)
        ])

    return dealt.join(bodies, "doc_id").groupBy("key", "low", "high").applyInArrow(
        link, "center long, member long, similarity double"
    )


def _mixed_groups(parts: DataFrame) -> DataFrame:
    """(key, doc_id, component, members) of groups with pairs of different components that no
    check has seen. Pairs with a group's center have been checked.
    """
    parts = stage(parts, "group-components")
    per_component = parts.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n"), F.max("is_center").alias("has_center")
    )
    n = F.col("n")
    outside = F.sum(F.when(~F.col("has_center"), n).otherwise(0))
    open_keys = per_component.groupBy("key").agg(
        ((F.pow(F.sum(n), 2) - F.sum(n * n)) / 2 - outside).alias("unseen"),
        F.sum(n).alias("members"),
    ).where(F.col("unseen") > 0)
    open_keys = stage(open_keys.select("key", "members"), "open-groups")
    return parts.join(open_keys, "key").select("key", "doc_id", "component", "members")


def shared_keys(rows: DataFrame, most: int, least: float) -> DataFrame:
    """(doc_id, key, center) of keys that two documents or more have.

    The center of a sketch is the document that shares the most keys, which in a group of copies is
    the one that all others were made from or the nearest to it (ties: the smallest).

    The center of an exact key is the smallest document of those that lack the fewest k-mers in
    it. Who together with the center lacks too many for ``least`` would lack too many with every
    other document of the key, and is left out.
    """
    fewest = [F.min(F.when(F.col("gone") == k, F.col("doc_id"))) for k in range(most + 1)]
    shared = rows.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
        F.coalesce(*fewest).alias("fullest"), F.min("gone").alias("center_gone"),
    ).where(F.col("first") != F.col("last")).drop("first", "last")
    found = stage(rows.join(shared, "key"), "shared-keys")
    degree = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("degree"))
    hubs = found.where(F.col("gone").isNull()).join(degree, "doc_id").groupBy("key").agg(
        F.min(F.struct(-F.col("degree"), "doc_id"))["doc_id"].alias("hub")
    )
    common = F.col("n_kmers") - F.col("gone")
    alike = common / (F.col("n_kmers") + F.col("center_gone")) >= least
    return found.join(hubs, "key", "left").withColumn(
        "center", F.coalesce("hub", "fullest")
    ).where(
        F.col("gone").isNull() | (F.col("doc_id") == F.col("center")) | alike
    ).select("doc_id", "key", "center")
