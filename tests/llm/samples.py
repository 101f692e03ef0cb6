"""Small documents with every awkward case, and brute-force helpers."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# names that the operators use themselves
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in (
        "row", "row_id", "block", "key", "keys", "size", "window", "items", "w", "n_words",
        "center", "member", "similarity", "part", "seq", "label", "n_tokens", "rank", "c",
    )],
])


def lower_ascii(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower_ascii(text or ""))


def prose(seed: int, count: int) -> str:
    chance = random.Random(seed)
    syllables = "ta re mi no lu sen kor vi da pel éa ño".split()
    return " ".join(
        "".join(chance.choice(syllables) for _ in range(chance.randint(1, 4))) for _ in range(count)
    )


def texts() -> list[tuple[int | None, str | None]]:
    shared, other = prose(1, 60), prose(2, 90)
    changed = other.split()
    changed[45] = "changed"
    rows = [
        (0, None), (1, ""), (2, " \n\t "), (3, "a"), (4, "!!! ... ???"), (5, "Çà é ÄÖ İ K 日本語 テキスト"),
        (6, shared), (7, "before " + shared + " after"), (8, shared + "\n" + shared),
        (9, other), (10, " ".join(changed)), (11, other), (12, other + " "),
        (13, prose(3, 6000)), (14, "x " * 3000), (15, "ab" * 4000), (16, prose(4, 400) + " " + shared),
        (17, "<|endoftext|> special <|startoftext|> it's  I'LL\x1c\x85\xa0 end"),
        (18, "Licensed under the Apache License, Version 2.0; see MIT-license or CC BY 4.0."),
        (19, "GNU General Public\nLicense gnu general public license"), (20, "mİt license, mit Licence"),
        (21, "one two three four"), (22, "one two three four"), (23, "one two three five"),
    ]
    return rows


def documents(spark, rows=None):
    """The sample documents; by default with a repeated row and a row without id."""
    if rows is None:
        rows = [*texts(), (9, dict(texts())[9]), (None, "no id " + prose(5, 30))]
    return spark.createDataFrame(
        [(i, text, None, "src", None, *["x"] * 19) for i, text in rows], SCHEMA
    ).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
