"""Language identification, licence scan, decontamination and vector links."""

import hashlib
import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import catalog
from tallyframe.llm.cover_tree import threshold_links
from tallyframe.llm.decontaminate import contamination, remove_contaminated
from tallyframe.llm.langid import LanguageModel, fit, fit_language_model, predict_languages
from tallyframe.llm.licenses import (
    BASE_PHRASES, RARE_WORDS, TEMPLATES, VOTES, document_frequencies, postings, scan_licenses,
)

from ..support import connect, mismatch
from .samples import documents, nothing, prose, texts, words

FOLDER = "/root/testdata/sf0.01"


def test_language_accuracy_on_held_out_documents(spark):
    truth = {
        row["doc_id"]: row["lang"]
        for row in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()
    }
    rows = catalog.op3_language_id(spark, FOLDER).collect()
    assert {row["doc_id"] for row in rows} == set(truth)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1) for row in rows)
    held = [row for row in rows if row["held_out"]]
    right = [row["lang_pred"] == truth[row["doc_id"]] for row in held]
    assert sum(right) > 0.97 * len(held)
    assert sum(row["rejected"] for row in held) < 0.01 * len(held)
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_language_of_awkward_texts(spark):
    model = fit(["the of and to", "der die und das"] * 40, ["en", "de"] * 40)
    found = {row["doc_id"]: row for row in predict_languages(documents(spark, texts()), model).collect()}
    assert {found[i]["lang_pred"] for i in (0, 1, 2, 4)} == {"und"}
    assert all(found[i]["rejected"] and found[i]["score"] == 0 for i in (0, 1, 2, 4))
    assert found[6]["lang_pred"] in ("en", "de")
    assert model.predict("the and")[0] == "en" and model.predict("die das")[0] == "de"
    assert predict_languages(nothing(spark), model).count() == 0
    none = fit_language_model(documents(spark), F.lit(True))
    assert isinstance(none, LanguageModel)
    assert none.predict("text") == ("und", 0.0, False) and none.predict("!") == ("und", 0.0, True)


def test_no_language_is_dropped(spark):
    labels = [f"l{k:03d}" for k in range(201)]
    frame = spark.createDataFrame(
        [(k, f"text {label}", label) for k, label in enumerate(labels)], "doc_id long, text string, lang string"
    )
    with pytest.raises(ValueError, match="more than 200 labels"):
        fit_language_model(frame, F.lit(True))
    with pytest.raises(ValueError, match="more than 2 labels"):
        fit_language_model(frame.limit(3), F.lit(True), max_languages=2)
    few = frame.where("doc_id < 3")
    assert fit_language_model(few, F.lit(True), max_languages=3).languages == labels[:3]


def test_number_signs_are_no_letters(spark):
    rows = [(0, "½"), (1, "² ①"), (2, "Ⅷ 12"), (3, "ª"), (4, "\u02b0"), (5, "中")]
    model = fit(["the of and to", "der die und das"] * 40, ["en", "de"] * 40)
    found = {row["doc_id"]: row["lang_pred"] for row in predict_languages(documents(spark, rows), model).collect()}
    letters = {i for i, text in rows if any(unicodedata.category(c)[0] == "L" for c in text)}
    assert {i for i, lang in found.items() if lang != "und"} == letters == {3, 4, 5}


def plain_prediction(model, text):
    """The model's prediction with dictionaries and one n-gram at a time."""
    folded = [b if b >= 128 else (ord(chr(b).lower()) if chr(b).isalpha() else 32) for b in text.encode()]
    folded = [32, *folded, 32]
    sums, count = [0.0] * len(model.languages), 0
    for length in (1, 2, 3, 4):
        for k in range(len(folded) - length + 1):
            packed = int.from_bytes(bytes(folded[k:k + length]), "big")
            bucket = ((packed + length) * 2654435761 % 2**32) >> 16
            count += 1
            for j in range(len(sums)):
                sums[j] += float(model.weights[j][bucket])
    powers = [math.exp((x / count + float(b)) / model.temperature) for x, b in zip(sums, model.bias)]
    best = max(range(len(powers)), key=powers.__getitem__)
    return model.languages[best], powers[best] / sum(powers)


def test_prediction_against_a_plain_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit_language_model(docs, F.lit(True))
    for row in predict_languages(docs, model).join(docs, "doc_id").limit(40).collect():
        if row["lang_pred"] != "und":
            lang, score = plain_prediction(model, row["text"])
            assert row["lang_pred"] == lang and abs(row["score"] - score) < 1e-6


def test_fitting_reads_the_table_twice(spark):
    docs = spark.createDataFrame(
        [(k, f"text of language {k % 30}", f"l{k % 30}") for k in range(300)],
        "doc_id long, text string, lang string",
    ).repartition(3)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    model = fit_language_model(docs.mapInArrow(counted, docs.schema), F.lit(True))
    assert len(model.languages) == 30 and read.value == 2 * 300


def brute_base(text):
    parts = words(text)
    places = []
    for phrase, label in BASE_PHRASES.items():
        size = len(phrase.split())
        places += [(k, label) for k in range(len(parts)) if parts[k:k + size] == phrase.split()]
    places.sort()
    first, last = (places[0][0], places[-1][0]) if places else (None, None)
    return len(parts), len(places), first, last, ",".join(sorted({label for _, label in places}))


def brute_licenses(rows):
    """All columns of the scan, with sets and one document at a time."""
    cut = [words(text) for _, text in rows]
    frequency = Counter(word for parts in cut for word in set(parts))
    out = []
    for (i, text), parts in zip(rows, cut):
        base = brute_base(text)
        joined, shares = f" {' '.join(parts)} ", {}
        for label, (template, keys) in TEMPLATES.items():
            if not all(f" {key} " in joined for key in keys):
                continue
            own = template.split()
            present = sorted(set(own) & set(parts), key=lambda word: (frequency[word], word))[:RARE_WORDS]
            votes = {}
            for k, word in enumerate(parts):
                if word in present:
                    for j in range(len(own)):
                        if own[j] == word:
                            votes.setdefault(k - j, set()).add(word)
            best = max(map(len, votes.values()))
            if best >= VOTES:
                shares[label] = best / len(present)
        labels = set(shares) | set(base[4].split(",")) - {""}
        score = 1.0 if base[1] else max(shares.values(), default=0.0)
        out.append((i, *base, ",".join(sorted(labels)), score))
    return sorted(map(str, out))


def test_license_base_phrases(spark):
    whole = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for frame in (documents(spark), whole):
        rows = scan_licenses(frame).collect()
        expected = brute_licenses([tuple(r) for r in frame.select("doc_id", "text").collect()])
        assert sorted(str(tuple(row)) for row in rows) == expected
    assert scan_licenses(nothing(spark)).count() == 0


def test_license_templates(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the Software), to deal in the Software without restriction"
    )
    rows = [
        (1, prose(5, 300) + "\n# " + mit + "\n" + prose(6, 300)),
        (2, "granted hereby of charge free permission is associated documentation obtaining"),
        (3, "under the GNU General Public License and " + mit),
    ]
    found = {row["doc_id"]: row for row in scan_licenses(documents(spark, rows)).collect()}
    assert (found[1]["labels"], found[1]["base_labels"]) == ("mit", "")
    assert 0 < found[1]["score"] <= 1
    assert (found[2]["labels"], found[2]["score"]) == ("", 0.0)
    assert found[3]["base_labels"] == "gpl" and "gpl" in found[3]["labels"]
    assert found[3]["score"] == 1.0


def test_license_templates_take_no_votes_from_each_other(spark):
    texts = {label: text for label, (text, _) in TEMPLATES.items()}
    stray = "mozilla waived gnu fee redistribution commons creative neighboring compliance"
    rows = [
        (1, "under the GNU General Public License and " + texts["mit"]),
        (2, f" {prose(7, 50)} ".join(texts[label] for label in sorted(texts))),
        *[(10 + k, f"{stray} {prose(20 + k, 100)} {texts[label]} {prose(40 + k, 100)} {stray}")
          for k, label in enumerate(sorted(texts))],
        *[(100 + k, texts["isc"]) for k in range(40)],  # a hot source
        (200, "form code subject source terms source form " + prose(8, 30) + " mozilla public license"),
    ]
    judged = scan_licenses(documents(spark, rows)).collect()
    assert sorted(str(tuple(row)) for row in judged) == brute_licenses(rows)
    found = {row["doc_id"]: row for row in judged}
    assert found[1]["labels"] == "gpl,mit"
    assert found[2]["labels"] == ",".join(sorted(texts))
    for k, label in enumerate(sorted(texts)):
        assert found[10 + k]["labels"] == label and found[10 + k]["score"] == 1.0
    assert all(found[100 + k]["labels"] == "isc" for k in range(40))
    # of eight words of the template the last three agree on one distance
    assert found[200]["labels"] == "mpl" and found[200]["score"] == 3 / 8


def test_license_words_are_looked_up_by_frequency(spark):
    text = TEMPLATES["mit"][0]
    grant = text[:text.index(" including")]
    rows = [
        (1, prose(9, 80) + " " + text + " " + prose(10, 80)), (2, grant), (3, grant[:60]),
        # in a file that holds the phrases apart from each other, no three words agree
        (4, f" {prose(11, 9)} ".join(TEMPLATES["bsd"][1])), (5, None),
        *[(10 + k, "hereby granted deal restriction dealings noninfringement " + prose(12 + k, 20))
          for k in range(30)],  # what the licence alone has elsewhere is common here
        *[(50 + k, text) for k in range(20)],  # a hot source
    ]
    frame = documents(spark, rows)
    for options in ({}, {"rare_words": 3}, {"votes": 1}):
        found = scan_licenses(frame, **options).collect()
        if not options:
            assert sorted(str(tuple(row)) for row in found) == brute_licenses(rows)
        by_id = {row["doc_id"]: row for row in found}
        assert [by_id[i]["labels"] for i in (1, 2, 3, 5)] == ["mit", "mit", "", ""]
        assert all(by_id[50 + k]["labels"] == "mit" and by_id[50 + k]["score"] == 1.0 for k in range(20))
    vocabulary = sorted({word for word, _, _ in postings()})
    counted = document_frequencies(frame.selectExpr("split(text, ' ') AS w"), vocabulary)
    assert counted["hereby"] == 30 + 23 and counted["noninfringement"] == 30 + 21


def brute_contamination(rows, items):
    windows = {}
    for item, text in items:
        parts = words(text)
        size = min(13, len(parts))
        for k in range(len(parts) - size + 1 if parts else 0):
            windows.setdefault(tuple(parts[k:k + size]), set()).add(str(item))
    out = []
    for i, text in rows:
        parts, hit, found = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(parts) - size + 1):
                if (key := tuple(parts[k:k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(parts), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(parts)))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"filter_bits": 128}, {"broadcast_bytes": 0}])
def test_decontamination(spark, options):
    passage = prose(80, 40)
    items = [(1, passage), (2, "rare pair"), (3, None), (4, "!!"), (5, prose(81, 13)), (10, passage), (6, "solo")]
    rows = texts() + [
        (50, prose(82, 30) + " " + passage.upper() + " " + prose(83, 20)), (51, passage[40:180]),
        (52, prose(84, 500) + "; Rare--PAIR " + prose(85, 300)), (53, prose(81, 13)), (54, prose(81, 12)),
        (55, "solo solo rare pair solo"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    judged = contamination(documents(spark, rows), benchmark, **options).selectExpr(
        "doc_id", "n_words", "n_hit", "cast(size(items) as bigint)", "sha2(array_join(items, ','), 256)",
        "contaminated",
    )
    expected = brute_contamination(rows, items)
    assert sorted(map(tuple, judged.collect())) == expected
    kept = remove_contaminated(documents(spark, rows), benchmark, **options)
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [row[0] for row in expected if not row[5]]


def test_decontamination_of_nothing(spark):
    benchmark = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    assert contamination(nothing(spark), benchmark).count() == 0
    rows = contamination(documents(spark), benchmark.limit(0)).collect()
    assert len(rows) == documents(spark).count() and not any(row["n_hit"] for row in rows)


def test_decontamination_by_many_windows(spark):
    items = [(k, prose(1000 + k, 320)) for k in range(700)]
    rows = [(k, prose(1000 + k * 11, 320)[k:] if k % 2 else prose(5000 + k, 300)) for k in range(60)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    judged = contamination(documents(spark, rows), benchmark)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [window#" in plan and " AS bits#" not in plan  # no row carries the bits
    found = judged.selectExpr(
        "doc_id", "n_words", "n_hit", "cast(size(items) as bigint)", "sha2(array_join(items, ','), 256)",
        "contaminated",
    )
    expected = brute_contamination(rows, items)
    assert sum(row[5] for row in expected) == 30
    assert sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    frame = catalog.queries()[name](spark, folder)
    assert mismatch(frame, connect(folder), catalog.oracle_sql()[name]) is None


def test_native_scans_run_no_python(spark):
    for name in ("op6_license_scan", "op8_decontamination"):
        plan = catalog.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def brute_links(rows, cosine=0.9):
    usable = []
    for k, (i, v) in enumerate(rows):
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, float) / np.abs(v).max()
        usable.append((k, v / np.linalg.norm(v)))
    links, part = [0] * len(rows), {k: k for k in range(len(rows))}
    least = {k: rows[k][0] for k in range(len(rows))}
    edges = [
        (a, b) for x, (a, v) in enumerate(usable) for b, w in usable[x + 1:]
        if len(v) == len(w) and v @ w >= cosine
    ]
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return sorted(
        (str(i), links[k], str(least[k]), i is None or least[k] == i) for k, (i, _) in enumerate(rows)
    )


@pytest.mark.parametrize("shard", [8192, 60])
def test_vector_links(spark, shard):
    chance = np.random.default_rng(5)
    rows = []
    for c in range(12):
        center = chance.normal(size=16)
        for k in range(25):
            rows.append((len(rows) * 3, (center + chance.normal(size=16) * 0.04 * (c + 1)).tolist()))
    rows += [(2000 + k, rows[5][1]) for k in range(30)]  # copies
    rows += [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] + [1.0] * 15), (3003, [1.0, None]),
             (3004, [float("inf"), 1.0]), (3005, []), (3006, [1.0, 0.0]), (3007, [2.0, 0.0]),
             (3008, [1e300] * 16), (3009, [1e-300] * 16), (None, rows[5][1])]
    frame = spark.createDataFrame(
        [(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, point string, shard string"
    ).repartition(3)
    found = threshold_links(frame, shard_points=shard).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in found) == brute_links(rows)
    assert threshold_links(frame.limit(0)).count() == 0


@pytest.mark.parametrize("width", [1e-5, 1e-4, 4.5e-4, 1e-3, 1e-2])
def test_links_of_narrow_clusters_at_the_threshold(width):
    from tallyframe.llm.cover_tree import CoverTree, traverse, unit

    chance = np.random.default_rng(int(width * 1e6))
    for trial in range(400):
        size = int(chance.integers(2, 9))
        one = unit(chance.normal(size=(1, size + 2)))[0]
        side = chance.normal(size=size + 2)
        side -= side @ one * one
        side /= np.linalg.norm(side)
        cosine = 0.9 + chance.choice([-1, 1, 0]) * 10.0 ** -chance.integers(4, 12)
        two = cosine * one + np.sqrt(1 - cosine**2) * side
        noise = chance.normal(size=(6, size + 2)) * width
        points = unit(np.vstack([one, two, one + noise[:3], two + noise[3:]]))
        cosines = points @ points.T
        if np.abs(cosines - 0.9).min() < 1e-14:
            continue  # nearer to the threshold than a double product of other shape can tell
        expected = (cosines >= 0.9).sum(axis=1) - 1
        ids, weights = np.arange(8), np.ones(8, np.int64)
        whole = CoverTree(ids, weights, points)
        assert (traverse(whole, whole, True, 0.9).links == expected).all()
        left, right = CoverTree(ids[:4], weights[:4], points[:4]), CoverTree(ids[4:], weights[4:], points[4:])
        between = traverse(left, right, False, 0.9).links
        own = np.r_[traverse(left, left, True, 0.9).links, traverse(right, right, True, 0.9).links]
        assert (between + own == expected).all()
