"""The registered queries of the text operators and the SQL that states the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstate.llm import (
    bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    hard_negatives,
    lexical_search,
    line_dedup,
    lm_scoring,
    near_dedup,
    token_files,
    toxicity,
    url_filter,
    warc,
)
from roadstate.llm.common import UPPER, table
from roadstate.session import work_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, VOCABULARY, END_ID)
    return token_files.read_token_files(spark, folder, with_ids=False)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.bpe_round_trip(table(spark, sf_dir, "documents"), VOCABULARY)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), k=3, percent=85)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.capture_index(spark, folder).select(
        F.col("row_id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(
        table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, keep_first=False
    )
    return kept.select(
        "doc_id",
        F.col("line_stats.n_lines").alias("n_lines"),
        F.col("line_stats.n_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    folder = work_dir(spark, "chats")
    chat_format.format_conversations(
        chat_format.replayed(rows), folder, message_cols=("turn", "role", "copy", "row")
    )
    return chat_format.digests(chat_format.formatted(spark, folder))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    moved = F.col("vec_id") % 7 == 0
    own = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd).select(
        "vec_id",
        F.when(moved, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"),
    )
    return hard_negatives.hard_negatives(own, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_token_files": op2_token_files,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_near_dedup": op7_near_dedup,
    "op8_warc": op8_warc,
    "op9_url_filter": op9_url_filter,
    "op10_line_dedup": op10_line_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_chat_format": op12_chat_format,
    "op13_hard_negatives": op13_hard_negatives,
}

LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

WORD = r"[a-z0-9\x{80}-\x{10FFFF}]+"

#: A control string of the chat template behind any number of backslashes.
CONTROL = r"[<\[]\\*(?:/?s>|<SYS>>|</SYS>>|/?INST\]|/?TURN\]|ROLE\])"

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    "op6_decontamination": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
        b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
        bw AS (
            SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS t
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
        ),
        sizes AS (SELECT DISTINCT size FROM bw),
        dw AS (
            SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS t
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
        ),
        hit AS (SELECT doc_id, i, dw.size AS size, item FROM dw JOIN bw USING (size, t)),
        words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hit))
            GROUP BY doc_id
        ),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op7_near_dedup": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS g
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
        ),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (
            SELECT a AS node, a AS low FROM edges
            UNION
            SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.node WHERE r.low < e.b
        ),
        low AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id,
               doc_id = coalesce(low, doc_id) AS kept
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON node = doc_id
    """,
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS size FROM pages),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS first FROM p)
        SELECT page_id, size AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN size >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 1000 AND page_id <> first THEN first END AS refers_to
        FROM m
    """,
    "op10_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (
            SELECT doc_id, lines[i] AS line, i,
                   translate(trim(lines[i], {SPACE}), '{UPPER}', '{UPPER.lower()}') AS k
            FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
        ),
        hot AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
        marked AS (SELECT doc_id, line, i, k IN (SELECT k FROM hot) AS gone FROM l)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op11_lexical_search": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
        n AS (SELECT doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
        s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
        tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY doc_id, t),
        df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
        q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest(w) AS t FROM b) GROUP BY item_id, t),
        scored AS (
            SELECT item_id, doc_id,
                   sum(c * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
                       * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
            FROM q JOIN tf USING (t) JOIN df USING (t) JOIN n USING (doc_id) CROSS JOIN s
            GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
    "op12_chat_format": f"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        f AS (
            SELECT *, length(said) + len(regexp_extract_all(said, '{CONTROL}')) + CASE role
                WHEN 'user' THEN 16 WHEN 'assistant' THEN 10 WHEN 'system' THEN 18
                ELSE 24 + length(role) + len(regexp_extract_all(role, '{CONTROL}')) END AS size
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(said)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(said, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(size)::BIGINT AS formatted_chars
        FROM f GROUP BY conv_id
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                   list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ),
        p AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        ),
        n AS (
            SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        )
        SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 5
    """,
}
