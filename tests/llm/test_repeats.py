"""Byte, word and near-duplicate removal against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import catalog, order_minhash
from tallyframe.llm.components import connected_components
from tallyframe.llm.doubling import remove_repeated_windows
from tallyframe.llm.order_minhash import (
    exact_keys, exact_length, labelled, later_draws, near_duplicates, short_length, similarity,
    sketches,
)
from tallyframe.llm.suffix_merge import merged, remove_repeated_bytes

from .samples import documents, nothing, prose, texts, words

FOLDER = "/root/testdata/sf0.001"
SPACE = " \t\n\v\f\r"


def space_words(text):
    found, now = [], ""
    for c in (text or "") + " ":
        if c in SPACE:
            if now:
                found.append(now)
            now = ""
        else:
            now += c
    return found


def brute_bytes(rows, span):
    least = {}
    for i, text in rows:
        body = (text or "").encode()
        for k in range(len(body) - span + 1):
            window = body[k:k + span]
            least[window] = min(least.get(window, i), i)
    out = []
    for i, text in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - span + 1):
            if least[body[k:k + span]] < i:
                gone[k:k + span] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(body) else 0
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((i, len(body), int(gone.sum()), spans, kept))
    return sorted(out)


def brute_words(rows, window):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda row: row[0]):
        parts = space_words(text)
        gone = [False] * len(parts)
        for k in range(len(parts) - window + 1):
            key = tuple(parts[k:k + window])
            if key in seen:
                gone[k:k + window] = [True] * window
            seen.add(key)
        kept = " ".join(p for p, g in zip(parts, gone) if not g)
        out.append((i, len(parts), sum(gone), kept))
    return out


def brute_groups(rows, least=0.8):
    shingles = {}
    for i, text in rows:
        parts = words(text)
        grams = [tuple(parts[k:k + 5]) for k in range(max(1, len(parts) - 4))] if parts else []
        shingles[i] = {(gram, grams[:k].count(gram)) for k, gram in enumerate(grams)}
    group, text_of = {i: i for i in shingles}, dict(rows)
    for i in shingles:
        for j in shingles:
            if i < j:
                one, two = shingles[i], shingles[j]
                alike = (text_of[i] or "") == (text_of[j] or "") or (
                    one and two and len(one & two) / len(one | two) >= least
                )
                if alike and group[i] != group[j]:
                    low, high = sorted((group[i], group[j]))
                    group = {x: low if g == high else g for x, g in group.items()}
    return group


def random_rows(seed):
    chance = random.Random(seed)
    parts = [prose(100 + k, 30) for k in range(12)]
    return [
        (3 * i, " ".join(chance.choice(parts)[chance.randint(0, 60):] for _ in range(chance.randint(1, 4))))
        for i in range(40)
    ]


def digest(row):
    return hashlib.sha256(row).hexdigest()


@pytest.mark.parametrize("rows", [texts(), random_rows(1)], ids=["awkward", "random"])
def test_bytes(spark, rows):
    found = remove_repeated_bytes(documents(spark, rows)).drop("row").collect()
    assert sorted((*row[:4], bytes(row[4])) for row in found) == brute_bytes(rows, 50)


def test_bytes_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, catalog.op5_suffix_dedup(spark, FOLDER).collect()))
    assert found == [(*row[:4], digest(row[4])) for row in brute_bytes(rows, 50)]


def test_bytes_of_equal_ids_none_and_characters(spark):
    body = prose(9, 40)
    rows = [(None, body), (5, body), (5, body), (7, "é" + body)]
    found = remove_repeated_bytes(documents(spark, rows)).collect()
    removed = sorted((row["doc_id"] or -1, row["n_removed"]) for row in found)
    size = len(body.encode())
    assert removed == [(-1, 0), (5, size), (5, size), (7, size)]
    alone = remove_repeated_bytes(documents(spark, rows[1:3])).collect()
    assert [row["n_removed"] for row in alone] == [0, 0]
    text = "é" * 60
    cut = remove_repeated_bytes(documents(spark, [(1, "a" + text), (2, "b" + text)]), characters=True)
    assert {row["doc_id"]: bytes(row["kept"]).decode() for row in cut.collect()}[2] == "b"
    assert remove_repeated_bytes(nothing(spark)).count() == 0


@given(st.lists(st.lists(st.binary(min_size=6, max_size=6), max_size=12), min_size=1, max_size=7))
@settings(max_examples=80, deadline=None)
def test_merge_keeps_order_and_prefixes(runs):
    coded = []
    for run in (sorted(r) for r in runs):
        shared, rest, before = [], b"", None
        for entry in run:
            same = 0
            while before is not None and same < 6 and entry[same] == before[same]:
                same += 1
            shared.append(same)
            rest += entry[same:]
            before = entry
        coded.append((bytes(shared), rest))
    run_of, lcp, entries = merged(coded, 6)
    assert entries == sorted(entry for run in runs for entry in run)
    for k in range(1, len(entries)):
        same = next((x for x in range(6) if entries[k][x] != entries[k - 1][x]), 6)
        assert lcp[k] == same
    assert [run_of.count(r) for r in range(len(runs))] == [len(run) for run in runs]


@pytest.mark.parametrize("rows", [texts(), random_rows(2)], ids=["awkward", "random"])
def test_words(spark, rows):
    found = sorted(map(tuple, remove_repeated_windows(documents(spark, rows)).collect()))
    assert found == brute_words(rows, 20)


def test_words_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, catalog.op10_substring_dedup(spark, FOLDER).collect()))
    assert found == [(*row[:3], digest(row[3].encode())) for row in brute_words(rows, 20)]


def test_words_levels_and_none(spark):
    rows = random_rows(3)
    found = sorted(map(tuple, remove_repeated_windows(documents(spark, rows), 12, 3).collect()))
    assert found == brute_words(rows, 12)
    alone = [(1, prose(50, 100)), (2, prose(51, 100))]
    assert {row["n_removed"] for row in remove_repeated_windows(documents(spark, alone)).collect()} == {0}
    assert remove_repeated_windows(nothing(spark)).count() == 0
    body = prose(52, 30)
    again = remove_repeated_windows(documents(spark, [(None, body), (3, body), (3, body)])).collect()
    assert sorted((row["doc_id"] or -1, row["n_removed"]) for row in again) == [(-1, 0), (3, 30), (3, 30)]


def test_near_duplicates(spark):
    rows = [row for row in texts() if row[0] not in (14, 15)]
    base = prose(60, 200).split()
    for k in range(40):  # a large group of near copies of each other
        changed = list(base)
        changed[(k * 5) % 200] = f"edit{k}"
        rows.append((100 + k, " ".join(changed)))
    for k in range(25):  # texts that share a passage only
        rows.append((200 + k, prose(300 + k, 90) + " " + prose(61, 40)))
    found = {row["doc_id"]: row for row in near_duplicates(documents(spark, rows)).collect()}
    assert {i: row["group_id"] for i, row in found.items()} == brute_groups(rows)
    assert all(row["kept"] == (i == row["group_id"]) for i, row in found.items())


def test_near_duplicates_of_short_texts(spark):
    rows = []
    for k, size in enumerate([5, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16] * 6):
        base = prose(700 + k, size + 2).split()
        cuts = [base[1:-1], base[1:], base[:-1], base] if k % 2 else [base, base[1:-1], base[:-1], base[2:]]
        rows += [(10 * k + i, " ".join(cut)) for i, cut in enumerate(cuts)]
    rows += [(5001, prose(900, 5) + " a"), (5002, prose(900, 5) + " b"), (5003, "Solo"), (5004, "solo!")]
    found = {row["doc_id"]: row for row in near_duplicates(documents(spark, rows)).collect()}
    assert {i: row["group_id"] for i, row in found.items()} == brute_groups(rows)


def test_short_texts_of_the_asked_similarity_share_an_exact_key():
    assert short_length(0.8, 5) == 14 and short_length(0.5, 5) >= 10
    for a in range(1, 15):
        for b in range(a, 15):
            for common in range(a + 1):
                one = np.arange(1, a + 1, dtype=np.uint64)
                two = np.r_[np.arange(100, 100 + b - common, dtype=np.uint64), one[a - common:]]
                shared = set(exact_keys(one, 0.8)[0].tolist()) & set(exact_keys(two, 0.8)[0].tolist())
                assert shared or similarity(one, two, 0.8) == 0.0


def template_rows(seed, templates, variants, own, size=84):
    """Longer variants of templates, with smaller ids, and two texts of each that are 0.82 similar."""
    rows, pairs = [], []
    for t in range(templates):
        base = prose(seed * 1000 + t, size).split()
        for v in range(variants):
            rows.append((len(rows), " ".join(base + prose(70_000 + seed * 10_000 + t * 100 + v, own).split())))
        one = [*base[:30], f"changed{t}", *base[31:]]
        pairs.append((len(rows), len(rows) + 1))
        rows += [(len(rows), " ".join(one)), (len(rows) + 1, " ".join([*base[:-3], "x", "y", "z"]))]
    return rows, pairs


def star_rows(seed, count, size=100, changes=2):
    """One text, with the largest id, that all others are near to; the others are apart."""
    chance = random.Random(seed)
    base = prose(seed, size).split()
    rows = []
    for i in range(count):
        text = list(base)
        for k in chance.sample(range(5, size - 5), changes):
            text[k] = f"own{i}x{k}"
        rows.append((i, " ".join(text)))
    return [*rows, (count, " ".join(base))]


@pytest.mark.parametrize("options", [{}, {"least_pairs": 0, "pairs_a_text": 0}], ids=["default", "sharper"])
def test_links_in_groups_with_a_common_template(spark, options):
    rows, pairs = template_rows(1, 60, 30, 25)
    found = {row["doc_id"]: row["group_id"] for row in near_duplicates(documents(spark, rows), **options).collect()}
    assert sum(found[a] == found[b] for a, b in pairs) == 60
    for low, high in pairs[:12]:
        group = [row for row in rows if low - 30 <= row[0] <= high]
        assert {i: found[i] for i, _ in group} == brute_groups(group)


@pytest.mark.parametrize("rows", [
    star_rows(5, 60), star_rows(6, 60, 40, 1), template_rows(7, 3, 60, 30)[0],
    template_rows(8, 6, 20, 8, 26)[0], template_rows(9, 6, 20, 7, 19)[0],
], ids=["star", "short star", "many variants", "short", "shorter"])
def test_groups_of_other_shapes(spark, rows):
    found = near_duplicates(documents(spark, rows), least_pairs=0, pairs_a_text=0).collect()
    assert {row["doc_id"]: row["group_id"] for row in found} == brute_groups(rows)


@pytest.mark.parametrize("seed", range(4))
def test_parts_of_a_group_are_joined_like_all_pairs(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(order_minhash, "SPREAD_PAIRS", 500)
    base, kmers = rng.integers(1, 2**62, 60, dtype=np.uint64), []
    for k in range(60):
        one = base.copy() if k % 3 else kmers[-1].copy() if kmers else base.copy()
        at = rng.choice(60, 3 + k % 4, replace=False)
        one[at] = rng.integers(1, 2**62, len(at), dtype=np.uint64)
        kmers.append(np.r_[one[30:], one[:30]] if k % 10 == 9 else one)
    pairs = [(a, b) for a in range(60) for b in range(a) if similarity(kmers[a], kmers[b], 0.8)]
    ids, half = np.arange(60), np.arange(60) % 2 == 0
    common = order_minhash.common_kmers(kmers, kmers[:20])
    assert (common == [[len(set(a.tolist()) & set(b.tolist())) for b in kmers[:20]] for a in kmers]).all()

    def grouped(links):
        label = list(range(60))
        for a, b in links:
            label = [min(label[a], label[b]) if c in (label[a], label[b]) else c for c in label]
        return label

    parts = [(ids[h], ids[h], [kmers[i] for i in ids[h]]) for h in (half, ~half)]
    links = []
    for one, two in ((parts[0], None), (parts[1], None), tuple(parts)):
        center, member, found = order_minhash.part_links(one, two, 0.8)
        assert all(value >= 0.8 for value in found) and len(center) < 60
        links += zip(center, member)
    assert set(links) <= {(b, a) for a, b in pairs} and grouped(links) == grouped(pairs)


def test_large_groups_in_parts(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "PART_TEXTS", 7)
    rows = template_rows(8, 2, 40, 25)[0]
    found = near_duplicates(documents(spark, rows)).collect()
    assert {row["doc_id"]: row["group_id"] for row in found} == brute_groups(rows)


def test_draws_and_exact_lengths():
    for size in (10, 15, 20):
        bound = exact_length(size, 0.8)
        for length in range(1, 200):
            wanted = later_draws(length, size, 0.8)
            assert wanted == 0 if length < 0.8 * bound else wanted > 0
            if length > bound:  # the chance to share none is within LOSS for the worst partner
                common = int(0.8 * length + 1e-9)
                share = math.comb(common, size) / math.comb(length, size)
                assert (1 - share) ** wanted <= 1.01e-4
                assert later_draws(max(length - 1, bound), size, 0.8) >= 0


def test_near_duplicates_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = {row["doc_id"]: row["group_id"] for row in catalog.op7_order_minhash(spark, FOLDER).collect()}
    assert found == brute_groups(rows)


def test_near_duplicates_of_rows_without_id_and_none(spark):
    frame = documents(spark)
    found = near_duplicates(frame).collect()
    assert len(found) == frame.count()
    assert [row["kept"] for row in found if row["doc_id"] is None] == [True]
    assert near_duplicates(nothing(spark)).count() == 0


def test_alignment_follows_order():
    one = labelled(prose(70, 300))
    half = len(one) // 2
    assert similarity(one, one, 0.8) == 1.0
    assert similarity(one, np.r_[one[half:], one[:half]], 0.8) == 0.0
    assert similarity(one, one[:len(one) // 2], 0.8) == 0.0
    assert similarity(one, one[20:], 0.8) == pytest.approx(len(one[20:]) / len(one))
    assert len(set(labelled("a b " * 50).tolist())) == 96
    assert (sketches(one, 5, 8) == sketches(one.copy(), 5, 8)).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 7), (2, 1), (None, 4), (20, 21), (21, 22), (22, 23), (23, 20)]
    links += [(1000 + i, 1001 + i) for i in range(40)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {row["node"]: row["component"] for row in connected_components(frame, "a", "b").collect()}
    expected = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20, 22: 20, 23: 20}
    assert found == expected | {1000 + i: 1000 for i in range(41)}
    assert connected_components(frame.limit(0), "a", "b").count() == 0
