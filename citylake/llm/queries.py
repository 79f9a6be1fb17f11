"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm.bpe import encode_documents
from citylake.llm.chatformat import format_conversations, read_back
from citylake.llm.common import table
from citylake.llm.fertility import fertility_rules
from citylake.llm.registry import ORACLES, QUERIES, query
from citylake.llm.linededup import remove_repeated_lines
from citylake.llm.mixing import DOMAINS, mix, quality_domains
from citylake.llm.sepscan import count_tokens
from citylake.llm.simhash import hex_digits, near_duplicates
from citylake.llm import langid, repair, runs, secrets, toxicity
from citylake.llm.topk import top_k_of_embeddings

__all__ = ["ORACLES", "QUERIES"]


@query("op5_simhash_covering_lsh")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


@query("op10_bpe_segment_tree")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = encode_documents(docs, with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op8_tokeniser_fertility")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility_rules(table(spark, sf_dir, "documents"))


@query("op7_chat_byte_assembly")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(turns.union(probe)))


@query(
    "op3_nra_topk",
    """
    WITH v AS (
        SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id AS vec_id,
               CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.row <> c.row
    )
    SELECT query_id,
           CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s
    QUALIFY row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) <= 10
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_of_embeddings(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op1_toxicity_classifier_chain")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), (1 - F.col("quality")).alias("low_quality"), "toxic"
    )
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.withColumns({c: F.round(c, 6) for c in scored.columns if c.startswith("p_")})


@query("op2_soft_membership_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rates = mix(docs, quality_domains(labels))
    shares = [F.round(f"p_{k}", 6).alias(f"p_{d}") for k, d in enumerate(DOMAINS)]
    return rates.select(F.col("id").alias("doc_id"), "n_tokens", *shares, F.round("rate", 6).alias("rate"))


@query("op4_language_ftrl_tfidf")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


@query(
    "op6_line_window_dedup",
    r"""
    WITH d AS (
        SELECT doc_id, text, str_split(text, chr(10)) AS lines,
               list_concat([''], str_split(text, chr(10)), ['']) AS framed
        FROM documents
    ),
    w AS (SELECT doc_id, framed, unnest(range(len(framed) - 2)) AS pos FROM d WHERE text IS NOT NULL),
    k AS (
        SELECT doc_id, pos, row_number() OVER (
            PARTITION BY framed[pos + 1], framed[pos + 2], framed[pos + 3] ORDER BY doc_id, pos) AS nth
        FROM w
        WHERE regexp_matches(concat(framed[pos + 1], framed[pos + 2], framed[pos + 3]), '[^ \t\r\x0b\x0c]')
    ), covered AS (
        SELECT DISTINCT doc_id, pos + unnest([-1, 0, 1]) AS pos FROM k WHERE nth > 1
    ), l AS (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
    ), kept AS (
        SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
        FROM l ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
    ), lost AS (SELECT doc_id, count(*) AS n FROM covered SEMI JOIN l USING (doc_id, pos) GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
           CAST(coalesce(lost.n, 0) AS INTEGER) AS lines_removed
    FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs)


@query("op9_separator_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


@query("op13_periodic_runs_ntt")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.digests(runs.planted(docs))


@query("op12_windowed_entropy_secrets")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query("op11_survivor_viterbi_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(table(spark, sf_dir, "conversations"))
