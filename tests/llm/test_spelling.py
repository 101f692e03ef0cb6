"""Spelling variant groups against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyframe.llm import catalog, spelling
from tallyframe.llm.spelling import variant_groups, word_hashes

from ..support import connect, mismatch
from .samples import documents, nothing

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_variants(rows, ratio=10, least=2):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    words = {w: n for w, n in counts.items() if n >= least}
    near, holes = defaultdict(set), defaultdict(list)
    for w in words:
        for k in range(len(w)):
            holes[w[:k], w[k + 1:]].append(w)
            if w[:k] + w[k + 1:] in words:
                near[w].add(w[:k] + w[k + 1:])
                near[w[:k] + w[k + 1:]].add(w)
    for same in holes.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(
        ((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()),
        key=str,
    )


def found(frame):
    return sorted((tuple(row) for row in frame.select(*COLUMNS).collect()), key=str)


def pairs(frame):
    return [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]


def misspelt(seed, count):
    """Texts with a few words in many spellings, chains of forms and every kind of edit."""
    chance = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzàéÿ×÷ß"
    rows = []
    for i in range(count):
        text = []
        for stem in ("colourful", "Straßenbahn", "mississippi", "aaaaaaaa"):
            text += [stem] * 12
            word = stem
            for _ in range(chance.randint(0, 3)):
                k, c = chance.randrange(len(word)), chance.choice(letters)
                word = word[:k] + chance.choice((c, "", c + word[k])) + word[k + 1:]
                text += [word] * chance.choice((1, 2, 2, 3))
        chance.shuffle(text)
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("pass_blocks", [spelling.PASS_BLOCKS, 7])
def test_variants_against_brute_force(spark, pass_blocks):
    for rows in (misspelt(1, 40), misspelt(2, 8)):
        frame = documents(spark, rows)
        expected = brute_variants(rows)
        assert found(variant_groups(frame, pass_blocks=pass_blocks)) == expected
        assert any(row[1] for row in expected)
    rows = misspelt(3, 5)
    assert found(variant_groups(documents(spark, rows), ratio=2)) == brute_variants(rows, ratio=2)


def test_chains_end_in_their_root(spark):
    # 2, 20 and 200 occurrences, each one letter from the next
    text = " ".join(["abcdefgh"] * 200 + ["abcdefgx"] * 20 + ["abcdefyx"] * 2 + ["zzzzzzzz"] * 2)
    rows = {row["word"]: row for row in variant_groups(documents(spark, [(1, text)]), slip=10**10).collect()}
    assert rows["abcdefyx"]["form"] == "abcdefgx" and rows["abcdefyx"]["root"] == "abcdefgh"
    assert rows["abcdefgh"]["form"] is None and rows["abcdefgh"]["n_near"] == 1
    assert rows["zzzzzzzz"]["root"] == "zzzzzzzz" and rows["zzzzzzzz"]["n_near"] == 0


def test_ties_take_the_smallest_form(spark):
    text = " ".join(["abcdefgb"] * 30 + ["abcdefgc"] * 30 + ["abcdefga"] * 2)
    rows = {row["word"]: row for row in variant_groups(documents(spark, [(1, text)]), slip=10**10).collect()}
    assert rows["abcdefga"]["form"] == "abcdefgb" and rows["abcdefga"]["n_near"] == 2


def test_awkward_empty_and_long(spark):
    frame = documents(spark)
    assert found(variant_groups(frame)) == brute_variants(pairs(frame))
    assert variant_groups(nothing(spark)).count() == 0
    # a run of 100,000 letters, twice, and the same with one letter less, more and changed
    chance = random.Random(5)
    long = "".join(chance.choice("abcd") for _ in range(100_000))
    rows = [(0, long), (0, long), *[
        (i, word) for i in (1, 2) for word in (long[:70_000] + long[70_001:], long + "é", "x" + long[1:])
    ]]
    result = found(variant_groups(documents(spark, rows), slip=10**10))
    assert len(result) == 4 and sorted(row[4] for row in result) == [1, 1, 1, 3]


def test_edited_hashes_are_those_of_the_edited_words():
    words = ["abcabca", "bcabcab", "aaaaaaa", "xyzzyxx"]
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(4, 7)
    all_bits = {size: (1, 0, np.full(1, 2**64 - 1, np.uint64)) for size in (6, 7)}
    seen = set()
    for rows, places, letter, hashes in spelling._edits(letters, word_hashes(letters), b"abcxyz", all_bits):
        for row, place, h in zip(rows, places, hashes):
            word = words[row][:place] + letter + words[row][place + 1:]
            assert word_hashes(np.frombuffer(word.encode(), np.uint8)[None, :])[0] == h
            assert (words[row], word) not in seen
            seen.add((words[row], word))
    assert ("aaaaaaa", "aaaaaa") in seen and ("abcabca", "bbcabca") in seen


def test_query_against_sql(spark):
    for folder in (FOLDER,):
        frame = catalog.op11_spelling_variants(spark, folder)
        assert mismatch(frame, connect(folder), catalog.SQL["op11_spelling_variants"]) is None
        assert found(frame) == brute_variants(pairs(spark.read.parquet(f"{folder}/documents.parquet")))
