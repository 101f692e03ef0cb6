"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Every benchmark item gives its windows of ``n`` consecutive words; an item of fewer words,
but not none, is one window. A document's word positions are scanned inside the row: hashes of
a position's first words, and then of its whole window, are tested against an array of bits;
what passes is looked up, as text, among the windows, so that hits are exact. One row per
document is shuffled, by a key that is unique to the row, which leaves no hot key.

The plan is the same for every number of windows. The bits are the result of a scalar subquery,
16 for each hash and at most ``filter_bits`` (4 MB by default) in all: where they fill up, more
positions pass to the lookup, and the result stays. The windows are broadcast if their texts and
items, which are counted first, have at most ``broadcast_bytes``; beyond that Spark joins them as
it sees fit.

Defined results: a null text has no words and no hit; an empty benchmark hits nothing;
repeated rows are each judged; windows that several items share count for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import free_name, stage
from .words import words

LEAD = 3
BITS_A_HASH = 16
ENTRY_BYTES = 64


def benchmark_windows(benchmark: DataFrame, n: int, item_col: str, text_col: str) -> DataFrame:
    """(window, window_size, prints, items): each distinct window once, with its items."""
    size = F.least(F.size("w"), F.lit(n))
    rows = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")
    ).where(F.size("w") > 0)
    starts = rows.select(
        "item_id", "w", size.alias("window_size"),
        F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("start"),
    )
    window = F.slice("w", F.col("start"), F.col("window_size"))
    return starts.select(
        "item_id", "window_size", F.concat_ws(" ", window).alias("window"),
        F.array(F.xxhash64(F.slice(window, 1, LEAD)), F.xxhash64(window)).alias("prints"),
    ).groupBy("window", "window_size", "prints").agg(F.collect_set("item_id").alias("items"))


def _number_at(found: Column, bits: int) -> Column:
    """Which of the ``bits // 64`` numbers a hash belongs to; its last 6 bits choose the bit."""
    return F.shiftrightunsigned(found, 71 - bits.bit_length())


def bit_array(windows: DataFrame, bits: int) -> DataFrame:
    """One row: the bits of all hashes of the windows, 64 to a number; ``bits`` is a power of two."""
    found = windows.select(F.explode("prints").alias("found"))
    marked = found.select(
        _number_at(F.col("found"), bits).alias("id"),
        F.col("found").bitwiseAND(F.lit(63)).cast("int").alias("bit"),
    ).distinct().groupBy("id").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("mask")
    )
    every = windows.sparkSession.range(bits // 64).join(marked, "id", "left")
    numbered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0)).alias("mask"))))
    return every.agg(F.transform(numbered, lambda entry: entry["mask"]).alias("bits"))


def _candidates(found: Column, size: int, count: int) -> Column:
    """Windows of ``size`` words of the array ``w`` that may be in the set."""
    def marked(hashed: Column) -> Column:
        number = F.get(found["bits"], _number_at(hashed, count).cast("int"))
        return F.getbit(number, hashed.bitwiseAND(F.lit(63)).cast("int")) == 1

    def begins(i: Column, length: int) -> Column:
        # the array of one binds the hash, which is used twice, to a name
        return F.exists(F.array(F.xxhash64(F.slice(found["w"], i + 1, length))), marked)

    def passes(i: Column) -> Column:
        lead = begins(i, min(size, LEAD))
        return lead if size <= LEAD else lead & begins(i, size)

    last = F.size(found["w"]) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.filter(starts, passes), lambda i: F.struct(
        i.alias("start"), F.lit(size).alias("size"),
        F.concat_ws(" ", F.slice(found["w"], i + 1, size)).alias("window"),
    ))


def _scanned(sizes: list[int], count: int) -> Column:
    """(n_words, found) of a row with ``w`` and ``bits``. Both are named one time only, so that
    Catalyst puts their expressions into the scan, and no row carries a copy of the bits."""
    empty = F.array().cast("array<struct<start:int,size:int,window:string>>")

    def scan(row: Column) -> Column:
        parts = [_candidates(row, size, count) for size in sizes]
        return F.struct(
            F.size(row["w"]).cast("bigint").alias("n_words"),
            (F.concat(*parts) if parts else empty).alias("found"),
        )

    return F.get(F.transform(F.array(F.struct("w", "bits")), scan), F.lit(0))


def _covered(spans: Column) -> Column:
    """Number of words in the union of (start, size) spans."""
    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        fresh = F.greatest(F.lit(0), end - F.greatest(span["start"], state["end"]))
        return F.struct(
            (state["n"] + fresh).alias("n"), F.greatest(state["end"], end).alias("end")
        )

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(spans), zero, add, lambda state: state["n"])


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20,
    id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    broadcast_bytes: int = 64 << 20, filter_bits: int = 1 << 25,
) -> DataFrame:
    """Per document row: its hit words and the items whose windows occur in it.

    ``spans`` are the hit (start, size) windows, counted in words. A document is contaminated
    if ``share * n_hit >= n_words`` and there is a hit. ``text_key`` is the text's SHA-256.
    """
    windows = stage(benchmark_windows(benchmark, n, item_col, item_text_col), "benchmark-windows")
    item_bytes = F.aggregate("items", F.lit(0), lambda total, item: total + F.octet_length(item))
    counts = windows.groupBy("window_size").agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length("window") + item_bytes + F.lit(ENTRY_BYTES)).alias("bytes"),
    ).collect()  # at most n rows
    sizes = sorted(row["window_size"] for row in counts)
    hashes = 2 * sum(row["n"] for row in counts)
    n_bits = max(128, min(filter_bits, 1 << (BITS_A_HASH * hashes).bit_length()))
    bits = bit_array(windows, n_bits).scalar()
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.sha2(F.col(text_col).cast("string"), 256).alias("text_key"),
        words(F.col(text_col)).alias("w"), bits.alias("bits"),
    ).select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "text_key",
        _scanned(sizes, n_bits).alias("scan"),
    ).select("row_id", "doc_id", "text_key", "scan.n_words", F.explode_outer("scan.found").alias("c"))
    known = windows.select("window", "items")
    if sum(row["bytes"] for row in counts) <= broadcast_bytes:
        known = F.broadcast(known)
    hits = rows.withColumn("window", F.col("c.window")).join(known, "window", "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("c.start", "c.size"))
    return hits.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"),
        F.first("n_words").alias("n_words"),
        F.collect_set(hit).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    ).withColumn("n_hit", _covered(F.col("spans")).cast("bigint")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    ).drop("row_id")


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """Documents that are not contaminated, with all their columns.

    Being contaminated is a matter of the text alone, so rows are matched by its SHA-256:
    null and repeated ids make no difference.
    """
    judged = contamination(docs, benchmark, text_col=text_col, **options)
    key = free_name(docs, "text_key")
    bad = judged.where("contaminated").select(F.col("text_key").alias(key)).distinct()
    keyed = docs.withColumn(key, F.sha2(F.col(text_col).cast("string"), 256))
    return keyed.join(bad, key, "left_anti").select(*docs.columns)
