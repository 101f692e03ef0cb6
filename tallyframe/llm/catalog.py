"""Queries that apply each operator of this package to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import new_path
from .cover_tree import threshold_links
from .decontaminate import contamination
from .doubling import remove_repeated_windows
from .frames import stage, table
from .langid import fit_language_model, predict_languages
from .licenses import BASE_PHRASES, RARE_WORDS, TEMPLATES, VOTES, scan_licenses
from .order_minhash import near_duplicates
from .packing import pack
from .pieces import BYTE_LEVEL, WORD_LEVEL, vocabulary
from .repair import decoded_documents, token_shards
from .spelling import variant_groups
from .suffix_merge import remove_repeated_bytes
from .token_counts import token_counts
from .warc import read_archives, write_archives
from .whitening import whitened_vectors

Query = Callable[[SparkSession, str], DataFrame]


def op1_repair_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = token_shards(table(spark, folder, "documents"), vocabulary(BYTE_LEVEL))
    return decoded_documents(stage(shards, "token-shards"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), vocabulary(WORD_LEVEL))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = fit_language_model(docs, ~held_out)
    return predict_languages(docs, model).withColumn("held_out", held_out)


def op4_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return threshold_links(table(spark, folder, "embeddings"))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeated_bytes(table(spark, folder, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op7_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    judged = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return judged.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), vocabulary(BYTE_LEVEL))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeated_windows(table(spark, folder, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variant_groups(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_vectors(table(spark, folder, "embeddings"))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    # the place of a row in its file names the row, whichever task reads it
    row = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")
    pages = table(spark, folder, "pages").select("page_id", "url", "html", row.alias("row_name"))
    archives = write_archives(pages, new_path(spark, "archives"), row_col="row_name")
    found = read_archives(spark, archives, payloads=False)
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat("record_id", F.lit(": "), "problem"))
    )
    return found.select(
        "page_id", "payload_bytes", "payload_digest", sound.cast("string").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


QUERIES: dict[str, Query] = {
    "op1_repair_shards": op1_repair_shards,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_cover_tree": op4_cover_tree,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_order_minhash": op7_order_minhash,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_whitening": op12_whitening,
    "op13_warc": op13_warc,
}

_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), " + _CAPITALS + "), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)



def _listed(text: str) -> str:
    return "[" + ", ".join(f"'{word}'" for word in text.split()) + "]"


_BASE_VALUES = ", ".join(f"('{label}', {_listed(phrase)})" for phrase, label in BASE_PHRASES.items())
_TEMPLATE_VALUES = ", ".join(f"('{label}', {_listed(text)})" for label, (text, _) in TEMPLATES.items())
_KEY_VALUES = ", ".join(f"('{label}', ' {key} ')" for label, (_, keys) in TEMPLATES.items() for key in keys)

SQL: dict[str, str] = {
    "op5_suffix_dedup": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b,
                   octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        windows AS (
            SELECT r, doc_id, i, array_slice(b, i, i + 49) AS s
            FROM d, unnest(range(1, n - 48)) AS t(i) WHERE n >= 50),
        later AS (
            SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM windows)
            WHERE least < doc_id),
        steps AS (
            SELECT r, i, CASE WHEN i - lag(i) OVER o <= 50 THEN 0 ELSE 1 END AS opens
            FROM later WINDOW o AS (PARTITION BY r ORDER BY i)),
        numbered AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS run FROM steps),
        runs AS (SELECT r, min(i) AS a, max(i) + 49 AS e FROM numbered GROUP BY r, run),
        ends AS (
            SELECT r, a, e FROM runs UNION ALL SELECT r, n + 1, n + 1 FROM d),
        gaps AS (
            SELECT r, a, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS f FROM ends),
        kept AS (
            SELECT r, string_agg(CASE WHEN f < a THEN hex(array_slice(b, f, a - 1)) ELSE '' END, '' ORDER BY a) AS k
            FROM gaps JOIN d USING (r) GROUP BY r)
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
        FROM d JOIN kept USING (r) LEFT JOIN (
            SELECT r, sum(e - a + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r) USING (r)""",
    "op6_license_scan": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        phrases(label, p) AS (VALUES {_BASE_VALUES}),
        templates(label, t) AS (VALUES {_TEMPLATE_VALUES}),
        keys(label, k) AS (VALUES {_KEY_VALUES}),
        base AS (
            SELECT r, i - 1 AS place, label
            FROM d, unnest(range(1, len(w) + 1)) AS u(i), phrases
            WHERE w[i] = p[1] AND w[i:i + len(p) - 1] = p),
        bases AS (
            SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
            FROM base GROUP BY r),
        frequency AS (
            SELECT word, count(*) AS n FROM (SELECT DISTINCT r, unnest(w) AS word FROM d) GROUP BY word),
        verified AS (
            SELECT r, label FROM d, keys GROUP BY r, label
            HAVING bool_and(contains(' ' || array_to_string(w, ' ') || ' ', k))),
        looked_up AS (
            SELECT r, label, word
            FROM (SELECT r, label, unnest(list_distinct(t)) AS word
                  FROM verified JOIN templates USING (label)) AS x
                 JOIN d USING (r) JOIN frequency USING (word)
            WHERE list_contains(w, word)
            QUALIFY row_number() OVER (PARTITION BY r, label ORDER BY n, word) <= {RARE_WORDS}),
        votes AS (
            SELECT r, label, i - j AS distance, count(DISTINCT word) AS agreeing
            FROM looked_up JOIN d USING (r) JOIN templates USING (label),
                 unnest(range(1, len(w) + 1)) AS u(i), unnest(range(1, len(t) + 1)) AS v(j)
            WHERE w[i] = word AND t[j] = word GROUP BY r, label, distance),
        accepted AS (
            SELECT r, label, max(agreeing) / any_value(n) AS share
            FROM votes JOIN (SELECT r, label, count(*) AS n FROM looked_up GROUP BY r, label)
                 USING (r, label)
            WHERE agreeing >= {VOTES} GROUP BY r, label),
        all_labels AS (
            SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
            FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM accepted) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
               first_word, last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels,
               CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
        FROM d LEFT JOIN bases USING (r) LEFT JOIN all_labels USING (r)
             LEFT JOIN (SELECT r, max(share) AS best FROM accepted GROUP BY r) USING (r)""",
    # SQL has no crc32: one step per byte over a table of 256 values, as in its definition.
    "op11_spelling_variants": f"""
        WITH RECURSIVE steps AS (
            SELECT list(list_reduce([CAST(i AS BIGINT)] || range(8), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
            FROM range(256) AS r(i)),
        runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS owner, unnest(regexp_extract_all(
                translate(coalesce(text, ''), {_CAPITALS}), '[a-zÀ-ÿ]+')) AS run FROM documents),
        counted AS (SELECT owner, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY ALL),
        marked AS (
            SELECT run, c, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
                regexp_extract_all(hex(encode(owner || ':' || run)), '..'),
                lambda x: CAST('0x' || x AS BIGINT)),
                lambda a, b: xor(a >> 8, t[1 + xor(a & 255, b)]))) AS h FROM counted, steps),
        slipped AS (
            SELECT c, CASE WHEN h % 31 = 0 THEN left(run, h % length(run))
                || substr(run, h % length(run) + 2) ELSE run END AS word FROM marked),
        v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7
              GROUP BY word HAVING sum(c) >= 2),
        holes AS (SELECT word, i, left(word, i) AS a, substr(word, i + 2) AS b
                  FROM v, unnest(range(length(word))) AS t(i)),
        shorter AS (SELECT DISTINCT h.word, v.word AS other FROM holes AS h JOIN v ON v.word = h.a || h.b),
        near AS (
            SELECT x.word, y.word AS other FROM holes AS x JOIN holes AS y
            ON x.a = y.a AND x.b = y.b AND x.word <> y.word
            UNION ALL SELECT word, other FROM shorter UNION ALL SELECT other, word FROM shorter),
        best AS (
            SELECT near.word, count(*) AS n_near, first(other ORDER BY v.n DESC, other) AS other,
                   max(v.n) AS other_n FROM near JOIN v ON v.word = near.other GROUP BY near.word),
        judged AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN other_n >= 10 * v.n THEN other END AS form,
                   CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
            FROM v LEFT JOIN best USING (word)),
        chains AS (
            SELECT word, word AS tip, 0 AS steps FROM judged
            UNION ALL SELECT c.word, j.form, c.steps + 1
            FROM chains AS c JOIN judged AS j ON j.word = c.tip WHERE j.form IS NOT NULL),
        ends AS (SELECT word, arg_max(tip, steps) AS root FROM chains GROUP BY word)
        SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)""",
    "op13_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
        bits AS (
            SELECT page_id, body, h, CAST(unhex(h) AS BIT)::VARCHAR AS b,
                   row_number() OVER (PARTITION BY body ORDER BY page_id) AS k,
                   min(page_id) OVER (PARTITION BY body) AS first_page FROM p)
        SELECT page_id, octet_length(encode(body)) AS payload_bytes,
               list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST(CAST(lpad(substr(b, 5 * i + 1, 5), 64, '0') AS BIT) AS BIGINT), 1)
                   FOR i IN range(32)], 'string_agg', '') AS payload_digest,
               CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN k > 1 THEN first_page END AS refers_to
        FROM bits""",
    "op8_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS n,
                   array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
            FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
        places AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
            FROM d, (SELECT DISTINCT n FROM windows) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)
            WHERE len(w) >= n),
        hits AS (SELECT r, i, p.n, item_id FROM places AS p JOIN windows AS v
                 ON p.words = v.words AND p.n = v.n),
        hit_words AS (SELECT r, count(DISTINCT j) AS n_hit
                      FROM hits, unnest(range(i, i + n)) AS t(j) GROUP BY r),
        hit_items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
                      FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)""",
    "op4_cover_tree": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        usable AS (
            SELECT vec_id, e FROM v WHERE e IS NOT NULL AND list_bool_and(
                [x IS NOT NULL AND isfinite(x) FOR x IN e]) AND list_bool_or([x <> 0 FOR x IN e])),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b
            ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                AND list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
             LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
                 USING (vec_id)""",
    "op10_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
            FROM d, unnest(range(1, len(w) - 18)) AS t(i) WHERE len(w) >= 20),
        later AS (
            SELECT doc_id, i FROM windows
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
        gone AS (SELECT DISTINCT doc_id, j FROM later, unnest(range(i, i + 20)) AS t(j)),
        kept AS (
            SELECT d.doc_id, string_agg(w[j], ' ' ORDER BY j) AS k
            FROM d, unnest(range(1, len(w) + 1)) AS t(j)
            WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = d.doc_id AND gone.j = t.j)
            GROUP BY d.doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(k, '')) AS kept_sha256
        FROM d LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
            USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
