"""Pipeline stages: each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of ``docs``, in order; further columns pass through. Every
stage works on all rows of ``docs``, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import remove_contaminated
from .frames import free_name, stage, table
from .langid import fit_language_model, predicted_language
from .order_minhash import near_duplicates
from .packing import pack
from .pieces import WORD_LEVEL, vocabulary
from .suffix_merge import remove_repeated_bytes


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents it rejects go, ``lang`` becomes the prediction.

    Null texts and texts without a letter are rejected.
    """
    model = fit_language_model(docs, F.lit(True))
    return predicted_language(docs, model)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Order MinHash: of each group of near-duplicate rows one stays, that of the smallest doc_id
    (ties: the first row of the staged table).

    Rows are judged by their texts, whatever ids they share: of identical rows one stays, and a
    text that shares its id with a copy of another stays. Rows without doc_id stay all, and take
    no other row away.
    """
    row = free_name(docs, "row_number")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    ids = numbered.select(F.col(row).alias("row"), "doc_id", "text").where(F.col("doc_id").isNotNull())
    groups = near_duplicates(ids, id_col="row").select(F.col("doc_id").alias("row"), "group_id")
    stays = ids.select("row", "doc_id").join(groups, "row").groupBy("group_id").agg(
        F.min(F.struct("doc_id", "row"))["row"].alias(row)
    ).select(row)
    unnamed = numbered.where(F.col("doc_id").isNull()).select(row)
    return numbered.join(stays.union(unnamed), row, "left_semi").select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix dedup: characters of repeated 50-byte strings go, ``n_chars`` follows the text.

    What a row loses is a matter of its doc_id and its text, so rows meet their remaining text by
    doc_id, 64-bit hash and length of the text; equal rows get the same one.
    """
    doc, key, size = (free_name(docs, name) for name in ("id_number", "text_hash", "text_bytes"))
    kept_text = free_name(docs, "kept_text")
    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({
        doc: F.col("doc_id").cast("bigint"), key: F.xxhash64(plain),
        size: F.octet_length(plain).cast("bigint"),
    })
    cut = remove_repeated_bytes(
        docs.select("doc_id", "text", F.xxhash64(plain).alias("row")), row_col="row", characters=True
    ).groupBy("doc_id", "row", "n_bytes").agg(F.first("kept").alias("kept")).select(
        F.col("doc_id").alias("cut_id"), F.col("row").alias("cut_hash"),
        F.col("n_bytes").alias("cut_bytes"), F.col("kept").cast("string").alias(kept_text),
    )
    joined = keyed.drop("text").alias("d").join(
        cut.alias("c"), F.col(f"d.{doc}").eqNullSafe(F.col("c.cut_id"))
        & (F.col(f"d.{key}") == F.col("c.cut_hash")) & (F.col(f"d.{size}") == F.col("c.cut_bytes")),
    )
    columns = {name: F.col(f"d.`{name}`") for name in docs.columns if name != "text"}
    columns["text"] = F.col(f"c.{kept_text}")
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(columns["text"]).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[columns[name].alias(name) for name in docs.columns])


def remove_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents with too many words of benchmark windows go."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row per piece of a training sequence."""
    return pack(docs, vocabulary(WORD_LEVEL))
