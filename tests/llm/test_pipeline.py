"""The corpus pipeline, stage by stage, against brute force."""

import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyframe.llm import stages
from tallyframe.llm.frames import stage
from tallyframe.llm.langid import fit_language_model
from tallyframe.llm.pieces import WORD_LEVEL, vocabulary

from .samples import documents, nothing
from .test_repeats import brute_bytes, brute_groups
from .test_scans import brute_contamination

FOLDER = "/root/testdata/sf0.001"


def pairs(frame):
    return [(row["doc_id"], row["text"]) for row in frame.collect()]


def whole_characters_left(rows):
    """Brute-force removal of repeated bytes, with partly covered characters kept."""
    least = {}
    for i, text in rows:
        body = text.encode()
        for k in range(len(body) - 49):
            least[body[k:k + 50]] = min(i, least.get(body[k:k + 50], i))
    left = {}
    for i, text in rows:
        body = text.encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 49):
            if least[body[k:k + 50]] < i:
                gone[k:k + 50] = True
        out, at = [], 0
        for c in text:
            size = len(c.encode())
            if not gone[at:at + size].all():
                out.append(c)
            at += size
        left[i] = "".join(out)
    return left


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    found = {}
    for name, apply in corpus_pipeline.STAGES:
        before = docs
        docs = stage(apply(spark, docs, FOLDER), name)
        found[name] = (before, docs)
        assert docs.columns == names or name == "packing"

    before, after = found["language_id"]
    model = fit_language_model(before, F.lit(True))
    expected = {i for i, text in pairs(before) if not model.predict(text)[2]}
    assert {i for i, _ in pairs(after)} == expected and len(expected) >= 0.97 * before.count()
    assert all(model.predict(row["text"])[0] == row["lang"] for row in after.collect())

    before, after = found["order_minhash"]
    groups = brute_groups(pairs(before))
    assert sorted(i for i, _ in pairs(after)) == sorted(i for i, g in groups.items() if i == g)

    before, after = found["suffix_dedup"]
    assert dict(pairs(after)) == whole_characters_left(pairs(before))
    assert all(row["n_chars"] == len(row["text"]) for row in after.collect())
    assert any(size for _, _, size, _, _ in brute_bytes(pairs(before), 50))

    before, after = found["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    judged = brute_contamination(pairs(before), items)
    assert sorted(i for i, _ in pairs(after)) == [row[0] for row in judged if not row[5]]

    before, packed = found["packing"]
    tokenizer = Tokenizer.from_file(vocabulary(WORD_LEVEL))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in pairs(before)}
    taken = dict.fromkeys(ids, 0)
    for row in packed.collect():
        part = ids[row["doc_id"]][row["start"]:row["start"] + row["length"]]
        assert zlib.crc32(part.tobytes()) == row["ids_crc32"]
        taken[row["doc_id"]] += row["length"]
    assert taken == {i: len(x) for i, x in ids.items()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_awkward_and_empty_tables(spark):
    for frame in (documents(spark), nothing(spark)):
        docs = frame
        for name, apply in corpus_pipeline.STAGES:
            docs = stage(apply(spark, docs, FOLDER), name)
            assert name == "packing" or docs.columns == frame.columns


def test_stage_functions_are_the_operators():
    assert [apply for _, apply in corpus_pipeline.STAGES] == [
        stages.keep_known_languages, stages.keep_one_of_each_group, stages.remove_repeated_passages,
        stages.remove_benchmark_documents, stages.pack_sequences,
    ]


CLASHES = "row_number string, ROW_NUMBER_0 string, text_key string, kept_text string, __row string, __text string, __text_key string"


def clashing(spark, rows):
    kind = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *"abcdefg") for i, t in rows], kind)


def test_names_of_the_input_stay(spark):
    rows = [(i, f"words of the text number {i} and more words that stand here in a row") for i in range(9)]
    docs = clashing(spark, [*rows, (20, rows[0][1])])
    for name, apply in corpus_pipeline.STAGES[:-1]:
        found = apply(spark, docs, FOLDER)
        assert found.columns == docs.columns
        kept = found.select(*docs.columns[5:]).distinct().collect()
        assert [tuple(row) for row in kept] == [tuple("abcdefg")]


def test_colliding_ids_and_identical_rows(spark):
    one = " ".join(f"one{k}" for k in range(40))
    two = " ".join(f"two{k}" for k in range(40))
    rows = [(1, two), (5, one), (5, two), (9, one), (7, one), (7, one), (3, "alone"), (3, "alone"), (None, one), (None, one)]
    kept = stages.keep_one_of_each_group(spark, clashing(spark, rows), FOLDER)
    assert sorted(pairs(kept), key=str) == sorted(
        [(1, two), (5, one), (3, "alone"), (None, one), (None, one)], key=str
    )
