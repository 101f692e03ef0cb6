"""Licence scan with a positional index of rare licence words, by DataFrame functions only.

Two findings per document:

* base: the places where the words of a base phrase stand consecutively;
* method: a first pass counts in how many documents each word of the licence templates stands. For
  each template a file's ``rare_words`` words of highest inverse document frequency are looked up
  in the postings of the template; the template is proposed where at least ``votes`` different
  ones stand at the same distance from its start, and it is accepted if all its mandatory key
  phrases occur in the file. Each template has its own rarest words, so that neither another
  licence nor stray words of the file take places or votes from it.

The templates are fixed, so the postings, the vocabulary and its document frequencies have a fixed
size. Key phrases are tested before anything is looked up: only words of documents that hold all
phrases of a template leave their row, and are counted per (row, template, distance), a key no
other row shares.

Defined results: a null text has no words and no label; a document without base phrase has
null first and last word; repeated rows are each judged, and each counts in the document
frequencies; words of equal frequency rank by their bytes. ``score`` is 1 where a base phrase
stands, else the largest share, over the accepted templates, of the looked-up words that agree
on one distance.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import words

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Texts of public licences, or the notice that goes into each file, and the phrases
# all of which must occur.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions the "
        "above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software the software is provided as is without warranty "
        "of any kind express or implied including but not limited to the warranties of "
        "merchantability fitness for a particular purpose and noninfringement in no event shall "
        "the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software",
        ["permission is hereby granted free of charge", "to deal in the software without restriction"],
    ),
    "apache": (
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license "
        "for the specific language governing permissions and limitations under the license",
        ["licensed under the apache license", "in compliance with the license"],
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the "
        "terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version this program is "
        "distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose see the "
        "gnu general public license for more details you should have received a copy of the gnu "
        "general public license along with this program if not see http www gnu org licenses",
        ["redistribute it and or modify it under the terms", "gnu general public license"],
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met redistributions of source "
        "code must retain the above copyright notice this list of conditions and the following "
        "disclaimer redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution",
        ["redistribution and use in source and binary forms",
         "provided that the following conditions are met"],
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies the software is provided as is and the author "
        "disclaims all warranties with regard to this software including all implied warranties "
        "of merchantability and fitness in no event shall the author be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss "
        "of use data or profits whether in an action of contract negligence or other tortious "
        "action arising out of or in connection with the use or performance of this software",
        ["for any purpose with or without fee is hereby granted"],
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
        "copy of the mpl was not distributed with this file you can obtain one at http mozilla "
        "org mpl 2 0",
        ["mozilla public license"],
    ),
    "cc-by": (
        "this work is licensed under a creative commons attribution 4 0 international license to "
        "view a copy of this license visit http creativecommons org licenses by 4 0",
        ["licensed under a creative commons attribution"],
    ),
    "cc0": (
        "to the extent possible under law the person who associated cc0 with this work has "
        "waived all copyright and related or neighboring rights to this work",
        ["waived all copyright and related or neighboring rights"],
    ),
}

VOTES = 3
RARE_WORDS = 12


def postings() -> list[tuple[str, str, int]]:
    """(word, label, position in the template) of all words of all templates."""
    return [
        (word, label, place)
        for label, (text, _) in sorted(TEMPLATES.items())
        for place, word in enumerate(text.split())
    ]


def _known(vocabulary: list[str]) -> Column:
    """The different words of the array ``w`` that are in the vocabulary."""
    return F.array_distinct(F.filter("w", lambda word: word.isin(vocabulary)))


def document_frequencies(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of rows whose array ``w`` holds each word; at most one entry a vocabulary word."""
    counted = rows.select(F.explode(_known(vocabulary)).alias("word")).groupBy("word").count()
    return {row["word"]: row["count"] for row in counted.collect()}


def _phrase_starts(phrase: str) -> Column:
    """Positions in the array ``w`` at which the words of ``phrase`` stand."""
    parts = phrase.split()

    def stands(i: Column) -> Column:
        test = F.try_element_at("w", i + 1) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & F.coalesce(F.try_element_at("w", i + 1 + k) == part, F.lit(False))
        return test

    return F.filter(F.col("places"), stands)


def _labelled(places: Column, label: str) -> Column:
    return F.transform(
        places, lambda i: F.struct(i.alias("place"), F.lit(label).alias("label"))
    )


def _first_word_places(phrases: list[str]) -> Column:
    """Positions in ``w`` of words that begin a phrase; most words end here."""
    first = sorted({phrase.split()[0] for phrase in phrases})
    marked = F.transform("w", lambda word, i: F.when(word.isin(first), i))
    return F.array_compact(marked)


def _contains(phrase: str) -> Column:
    return F.contains("joined", F.lit(f" {phrase} "))


def scan_licenses(
    docs: DataFrame, votes: int = VOTES, rare_words: int = RARE_WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document row: base places, labels of both findings, and a score."""
    spark = docs.sparkSession
    index = postings()
    vocabulary = sorted({word for word, _, _ in index})
    cut = words(F.col(text_col)).alias("w")
    frequency = document_frequencies(docs.select(cut), vocabulary)

    def rarest_first(label: str) -> Column:
        of_template = {word for word, at, _ in index if at == label}
        ranked = sorted(of_template, key=lambda word: (frequency.get(word, 0), word))
        return F.array(*map(F.lit, ranked))

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("doc_id"), cut
    )
    starts = {phrase: _phrase_starts(phrase) for phrase in BASE_PHRASES}
    rows = rows.withColumns({
        "places": _first_word_places(list(BASE_PHRASES)),
        "known": _known(vocabulary),
        "joined": F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")),
    })
    rows = rows.withColumns({
        "base": F.array_sort(F.concat(*[
            _labelled(found, BASE_PHRASES[phrase]) for phrase, found in starts.items()
        ])),
        "verified": F.array_compact(F.array(*[
            F.when(reduce(and_, map(_contains, keys)), F.lit(label))
            for label, (_, keys) in sorted(TEMPLATES.items())
        ])),
    })
    lookups = [
        F.when(F.array_contains("verified", label), F.struct(
            F.lit(label).alias("label"),
            F.slice(F.filter(
                rarest_first(label), lambda word: F.array_contains("known", word)
            ), 1, rare_words).alias("words"),
        ))
        for label in sorted(TEMPLATES)
    ]
    rows = rows.withColumn("lookups", F.when(
        F.size("verified") > 0, F.array_compact(F.array(*lookups))
    ))

    def hits(lookup: Column) -> Column:
        return F.array_compact(F.transform("w", lambda word, i: F.when(
            F.array_contains(lookup["words"], word),
            F.struct(
                lookup["label"].alias("label"), F.size(lookup["words"]).alias("looked_up"),
                word.alias("word"), i.alias("place"),
            ),
        )))

    narrow = rows.select(
        "row_id", "doc_id", F.size("w").cast("bigint").alias("n_words"),
        F.size("base").cast("bigint").alias("n_base"),
        F.try_element_at(F.col("base.place"), F.lit(1)).cast("bigint").alias("first_word"),
        F.try_element_at(F.col("base.place"), F.lit(-1)).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct("base.label")).alias("base_label_list"),
        F.explode_outer(F.flatten(F.transform("lookups", hits))).alias("hit"),
    ).withColumns({"label": F.col("hit.label"), "word": F.col("hit.word")})
    posted = F.broadcast(spark.createDataFrame(index, "word string, label string, template_place int"))
    voted = narrow.join(posted, ["label", "word"], "left")
    kept = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_label_list"]
    per_distance = voted.groupBy(
        "row_id", "label", (F.col("hit.place") - F.col("template_place")).alias("distance")
    ).agg(
        *[F.first(name).alias(name) for name in kept], F.first("hit.looked_up").alias("looked_up"),
        F.collect_set("word").alias("agreeing"),
    )
    agreed = F.when(F.col("label").isNotNull(), F.size("agreeing"))
    enough = agreed >= votes
    labels = F.array_union("base_label_list", "method_labels")
    return per_distance.groupBy("row_id").agg(
        *[F.first(name).alias(name) for name in kept],
        F.collect_set(F.when(enough, F.col("label"))).alias("method_labels"),
        F.max(F.when(enough, agreed / F.col("looked_up"))).alias("best"),
    ).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_label_list", ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(
            F.coalesce("best", F.lit(0.0))
        ).alias("score"),
    )
