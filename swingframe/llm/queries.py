"""The registered queries of this package and the SQL that some of them must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swingframe.llm import chat, exact, lm, mixing, near, neighbours, phrases, pieces, quality, simhash, spelling, toxicity, warc
from swingframe.llm.store import table


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.read_records(warc.write_pages(table(spark, folder, "pages"))).drop("payload")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_classes(table(spark, folder, "documents")).drop("hash")


def op5_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.lm_scores(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return chat.read_back(chat.format_chats(turns.unionByName(probe)))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return mixing.mixture(docs, mixing.labelled_domains(docs, labels), mixing.TARGETS)


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents"), ["doc_id"])


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_components(table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_warc, op3_quality, op4_minhash_near_dedup, op5_nearest_vectors, op6_lm_scoring, op7_toxicity, op8_chat_formatting,
    op9_mixing, op10_sentencepiece, op11_phrases, op12_simhash_near_dedup, op13_spelling_variants)}

ORACLE_TEXTS = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents),
             g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op2_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
             b AS (SELECT hex, max(page_id) AS best FROM p GROUP BY hex)
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
                   (CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> best THEN best END AS refers_to
        FROM p JOIN b USING (hex)""",
    "op8_chat_formatting": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL
                   SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(n)),
             s AS (SELECT *, 17 + length(regexp_replace(role, '([\\#\n]|<[/|])', 'x\1', 'g'))
                                + length(regexp_replace(text, '([\\#]|<[/|])', 'x\1', 'g')) AS marked FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(marked) AS BIGINT) AS formatted_chars
        FROM s GROUP BY conv_id""",
    "op11_phrases": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
             o AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_slice(ws, i, i + k - 1))) AS gram
                   FROM w, range(1, 5) r(k)),
             f AS (SELECT lang, k, gram, count(*) AS f FROM o GROUP BY ALL),
             t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
             c AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
             u AS (SELECT c.lang, c.gram, c.f AS a, cut, x.f AS l, y.f AS r,
                          CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score
                   FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
                   JOIN f x ON x.lang = c.lang AND x.gram = list_slice(c.gram, 1, c.cut)
                   JOIN f y ON y.lang = c.lang AND y.gram = list_slice(c.gram, c.cut + 1, c.k)),
             s AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1),
             b AS (SELECT lang, list_slice(gram, i, j) AS gram, max(f) AS longer
                   FROM (SELECT *, unnest(range(1, k)) AS i FROM c) c, range(2, 5) e(j)
                   WHERE j > i AND j <= k AND j - i + 1 < k GROUP BY ALL),
             z AS (SELECT s.*, array_to_string(s.gram, ' ') AS phrase FROM s LEFT JOIN b ON b.lang = s.lang AND b.gram = s.gram
                   WHERE b.longer IS NULL OR 100 * b.longer < 80 * s.a)
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z) JOIN t USING (lang)
        WHERE rank <= 2000""",
}
