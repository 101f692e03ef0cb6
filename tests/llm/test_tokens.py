"""Token counts, token shards and packing against the tokenizers library."""

import zlib
from collections import Counter, defaultdict
from time import process_time

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import catalog
from tallyframe.llm.frames import stage
from tallyframe.llm.packing import pack, plan
from tallyframe.llm.pieces import (
    BYTE_LEVEL,
    SPACE_SET,
    SPACED_WORDS,
    WORD_LEVEL,
    PieceEncoder,
    PieceTable,
    encoder,
    spaced_words,
    vocabulary,
)
from tallyframe.llm.repair import Shard, compress, decoded_documents, token_shards
from tallyframe.llm.token_counts import RankMerger, token_counts

from .samples import documents, nothing, texts

tokenizers = pytest.importorskip("tokenizers")
FOLDER = "/root/testdata/sf0.001"


def library(name):
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def rows_of(frame):
    return [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", [BYTE_LEVEL, WORD_LEVEL])
def test_pieces_encode_as_the_library(name):
    encode = library(name)
    coder = PieceEncoder(vocabulary(name), name == BYTE_LEVEL, limit=50)
    alphabet = ["a", "B", " ", "  ", "\n", "'s", "é", "1", "\xa0", "\x1c", "\x85", "!", "İ", "क़", "　", "ﬁ"]
    chance = np.random.default_rng(3)
    bodies = [text or "" for _, text in texts()]
    bodies += ["".join(chance.choice(alphabet, 30)) for _ in range(600)]
    for body, ids in zip(bodies, coder.encode_all(bodies)):
        assert ids.tolist() == encode(body)


def test_spaced_words_are_those_of_the_pattern():
    chance = np.random.default_rng(4)
    alphabet = [*sorted(SPACE_SET), "a", "é", "\u2010", "\u200b", "\u00c2", "\u0a80", "\u3001", "😀", "\0", "\x1c"]
    bodies = ["", " ", "", *["".join(chance.choice(alphabet, n)) for n in range(60) for _ in range(20)], ""]
    for some in (bodies, [""], ["", "a"], ["\u3000"], ["\xa0a\xe2"]):
        found, counts = spaced_words(some)
        wanted = [SPACED_WORDS.findall(body) for body in some]
        assert counts.tolist() == [len(words) for words in wanted]
        assert found.to_pylist() == [word for words in wanted for word in words]


def test_a_batch_looks_up_each_distinct_piece_once(monkeypatch):
    """Each piece of each text was looked up before: 150,000 here."""
    coder, asked = PieceEncoder(vocabulary(BYTE_LEVEL), True), []

    def counted(table, pieces, indices=PieceTable.indices):
        asked.append(len(pieces))
        return indices(table, pieces)

    monkeypatch.setattr(PieceTable, "indices", counted)
    bodies = ["one two one" + " two one two" * 999] * 50
    encoded = list(coder.encode_all(bodies))
    assert sum(asked) == 3
    assert all(ids.tolist() == encoded[0].tolist() for ids in encoded)
    assert encoded[0].tolist() == library(BYTE_LEVEL)(bodies[0])


def test_rank_merging_of_overlapping_pairs():
    encode, merger = library(BYTE_LEVEL), RankMerger(vocabulary(BYTE_LEVEL))
    words = ["a" * n for n in range(1, 40)] + ["abababab", "\t" * 9]
    assert merger.counts([w.encode() for w in words]).tolist() == [len(encode(w)) for w in words]


def test_long_words_merge_as_short_ones(monkeypatch):
    encode, merger = library(BYTE_LEVEL), RankMerger(vocabulary(BYTE_LEVEL))
    chance = np.random.default_rng(8)
    words = ["".join(chance.choice(list(letters), size)) for letters, size in [
        ("ab", 700), ("abcdefghijklmnopqrstuvwxyz", 900), ("aeiourstn", 513), ("a", 1023), ("é", 600), ("xé", 512),
    ] * 3] + ["a", "word", "a" * 512, "a" * 513]
    expected = [len(encode(w)) for w in words]
    encoded = [w.encode() for w in words]
    assert merger.counts(encoded).tolist() == expected
    for bound in (0, 10**6):
        monkeypatch.setattr("tallyframe.llm.token_counts.LONG", bound)
        assert merger.counts(encoded).tolist() == expected
        assert merger.counts([]).tolist() == []


@pytest.mark.parametrize("letters", [
    "etaoinshrdlucmfwypvbgkjqxz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "a",
])
def test_a_word_of_a_megabyte(letters):
    encode, merger = library(BYTE_LEVEL), RankMerger(vocabulary(BYTE_LEVEL))
    word = "".join(np.random.default_rng(9).choice(list(letters), 1_000_000))
    begun = process_time()
    found = merger.counts([word.encode()]).tolist()
    assert process_time() - begun < 30  # far below what a step over the whole word per rank takes
    assert found == [len(encode(word))]


def test_token_counts(spark):
    encode, frame = library(BYTE_LEVEL), documents(spark)
    found = Counter(map(tuple, token_counts(frame, vocabulary(BYTE_LEVEL)).collect()))
    assert found == Counter(
        (i, len((t or "").encode()), len(encode(t)), len(encode(t)) > 1024) for i, t in rows_of(frame)
    )
    assert token_counts(nothing(spark), vocabulary(BYTE_LEVEL)).count() == 0


def test_token_counts_of_the_whole_table(spark):
    encode = library(BYTE_LEVEL)
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for row in rows:
        tokens = len(encode(row["text"]))
        expected.append((row["doc_id"], len((row["text"] or "").encode()), tokens, tokens > 1024))
    found = catalog.op9_token_counts(spark, FOLDER).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=400), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_grammar_round_trip(parts):
    shard = compress([None, *range(1, len(parts))], [np.array(p, np.uint32) for p in parts], 6)
    again = Shard.from_bytes(shard.to_bytes())
    found = list(again.documents())
    assert [ids.tolist() for _, ids in found] == parts and found[0][0] is None
    flat = [i for part in parts for i in part]
    for start in range(0, len(flat), max(1, len(flat) // 7)):
        assert again.ids(start, min(50, len(flat) - start)).tolist() == flat[start:start + 50]


def test_grammar_makes_rules():
    ids = np.tile(np.arange(8, dtype=np.uint32), 500)
    shard = compress([1], [ids], 8)
    assert len(shard.left) and len(shard.symbols) < len(ids) / 4
    assert shard.rule_lengths.max() > 2


def test_grammar_goes_on_as_far_as_asked():
    chance = np.random.default_rng(3)
    passage = np.arange(50_000, 50_010)
    parts = [np.r_[chance.integers(0, 50_000, 500), passage].astype(np.uint32) for _ in range(40)]
    ids = list(range(len(parts)))
    whole = compress(ids, parts, 50_010, least_gain=0)
    assert whole.rule_lengths.max() == len(passage)
    assert [found.tolist() for _, found in whole.documents()] == [part.tolist() for part in parts]
    assert len(compress(ids, parts, 50_010).left) == 0
    assert len(compress(ids, parts, 50_010, least_count=41, least_gain=0).left) == 0


@pytest.mark.parametrize("whole", [True, False])
def test_token_shards(spark, whole):
    encode = library(BYTE_LEVEL)
    if whole:
        frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
        found = catalog.op1_repair_shards(spark, FOLDER)
    else:
        frame = documents(spark, texts())
        found = decoded_documents(stage(token_shards(frame, vocabulary(BYTE_LEVEL), shard_tokens=500), "t"))
    expected, start = [], 0
    for i, text in sorted(rows_of(frame)):
        ids = [*encode(text), 0]
        expected.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, found.collect())) == expected


def test_token_shards_of_repeated_rows_and_none(spark):
    frame = documents(spark)
    found = decoded_documents(stage(token_shards(frame, vocabulary(BYTE_LEVEL)), "t")).collect()
    assert len(found) == frame.count() and {row["doc_id"] for row in found} >= {None, 9}
    empty = stage(token_shards(nothing(spark), vocabulary(BYTE_LEVEL)), "t")
    assert decoded_documents(empty).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), min_size=1, max_size=30))
@settings(max_examples=40, deadline=None)
def test_plan_places_every_piece(histogram):
    placed = Counter()
    sequences = 0
    for pattern, times in plan(histogram, 64):
        assert sum(size * count for size, count in pattern.items()) <= 64
        placed.update({size: count * times for size, count in pattern.items()})
        sequences += times
    assert placed == Counter(histogram)
    least = -(-sum(size * count for size, count in histogram.items()) // 64)
    assert sequences <= 1.7 * least + len(histogram) + 1


@pytest.mark.parametrize("whole", [True, False])
def test_packing(spark, whole):
    encode = library(WORD_LEVEL)
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet") if whole else documents(spark, texts())
    found = catalog.op2_packing(spark, FOLDER) if whole else pack(frame, vocabulary(WORD_LEVEL))
    ids = {i: [*encode(text), 2] for i, text in rows_of(frame)}
    documents_, sequences = defaultdict(list), defaultdict(list)
    for row in found.collect():
        part = ids[row["doc_id"]][row["start"]:row["start"] + row["length"]]
        assert (row["doc_tokens"], row["ids_crc32"]) == (len(ids[row["doc_id"]]), crc(part))
        documents_[row["doc_id"]].append((row["start"], row["length"]))
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for spans, size in [(documents_[i], len(x)) for i, x in ids.items()] + [
        (s, sum(length for _, length in s)) for s in sequences.values()
    ]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == size
    assert all(sum(length for _, length in s) <= 4096 for s in sequences.values())
    if whole:
        assert sum(map(len, ids.values())) > 0.97 * 4096 * len(sequences)


def test_packing_of_repeated_rows_and_none(spark):
    frame = documents(spark)
    found = pack(frame, vocabulary(WORD_LEVEL))
    assert found.where("start = 0").count() == frame.count()
    assert pack(nothing(spark), vocabulary(WORD_LEVEL)).count() == 0


def test_shards_are_smaller_than_their_ids():
    docs = duckdb.sql("SELECT doc_id, coalesce(text, '') FROM '/root/testdata/sf0.01/documents.parquet' ORDER BY doc_id").fetchall()
    coder = encoder(vocabulary(BYTE_LEVEL), True)
    parts = [np.append(ids, np.uint32(0)) for ids in coder.encode_all([text for _, text in docs])]
    shard = compress([i for i, _ in docs], parts, len(coder.weights))
    body = shard.to_bytes()
    count = sum(map(len, parts))
    # raw ids of this vocabulary take 16 bits; symbols, rules and documents are all counted
    assert len(body) < 0.85 * 2 * count
    assert [ids.tolist() for _, ids in Shard.from_bytes(body).documents()] == [ids.tolist() for ids in parts]
    many = Shard(5, np.zeros(1, np.int64), np.ones(1, bool), np.array([9]), np.zeros(0, np.int64),
                 np.zeros(0, np.int64), np.zeros(0, np.int64), np.array([0, 1 << 16, 5, 1 << 17, 3, 2**18 - 1, 7, 8, 9]))
    assert Shard.from_bytes(many.to_bytes()).symbols.tolist() == many.symbols.tolist()
