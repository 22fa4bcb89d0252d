"""Texts: masking, transcripts, chunks, the embedding cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import EMAIL, PHONE, hash_embed, mask_pii, norm_text, register_sql_functions
from tidemark.operators import chunks, quality
from tidemark.operators.schemas import TABLES
from tidemark.queries.inputs import EXPORT_SQL, bronze_exports, documents, spread_table, table
from tidemark.queries.registry import Registry

registry = Registry()


def mask_sql(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '{EMAIL}', '<EMAIL>', 'g'), '{PHONE}', '<PHONE>', 'g')"


def _chunk_sql(source: str) -> str:
    """Chunks of 40 words, 8 of them shared with the one before, of rows (doc, text)."""
    return f"""
SELECT doc, CAST(i AS INTEGER) AS chunk_idx, array_to_string(w[i * 32 + 1 : i * 32 + 40], ' ') AS chunk_text
FROM (SELECT doc, w, unnest(range(CASE WHEN len(w) = 0 THEN 0 ELSE greatest(1, CAST(ceil((len(w) - 8) / 32.0) AS BIGINT)) END)) AS i
      FROM (SELECT doc, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM ({source})))
"""


# Vectors as whole millionths, joined, so that both sides render them alike.
_EMBED_SQL = """
SELECT text_hash, array_to_string(list_transform(counts, lambda c: CAST(round(1000000 * round(
         c / CASE WHEN len(tokens) = 0 THEN 1.0 ELSE sqrt(list_sum(list_transform(counts, lambda x: x * x))) END, 6)) AS BIGINT)), ',') AS vector
FROM (SELECT text_hash, tokens, list_transform(range(16), lambda b: CAST(len(list_filter(tokens, lambda t: t = substr('0123456789abcdef', b + 1, 1))) AS DOUBLE)) AS counts
      FROM (SELECT text_hash, list_transform(regexp_extract_all(lower(chunk_text), '[\\p{L}\\p{N}_]+'), lambda t: substr(md5(t), 32, 1)) AS tokens
            FROM %s))
"""


def _vector(embedding) -> F.Column:
    return F.array_join(F.transform(embedding, lambda x: F.round(x * 1000000).cast("bigint").cast("string")), ",")


_DOC_SQL = "SELECT doc_id AS doc, text FROM documents"


@registry.query(f"SELECT doc_id, {mask_sql('text')} AS masked FROM documents")
def mask_documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread_table(spark, sf, "documents").select("doc_id", mask_pii(F.col("text")).alias("masked"))


@registry.query(f"SELECT doc_id, {mask_sql('text')} AS masked FROM documents")
def mask_documents_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The mask as a function of SQL."""
    register_sql_functions(spark)
    return spark.sql("SELECT doc_id, mask_pii(text) AS masked FROM {docs}", docs=spread_table(spark, sf, "documents"))


def _leaks(text: str) -> str:
    return f"count(*) FILTER (WHERE regexp_matches({text}, '{EMAIL}') OR regexp_matches({text}, '{PHONE}'))"


@registry.query(f"""
SELECT 'conversations' AS source, count(*) AS n_texts, {_leaks('text')} AS n_leaks FROM conversations
UNION ALL SELECT 'documents', count(*), {_leaks('text')} FROM documents
UNION ALL SELECT 'masked_documents', count(*), {_leaks(mask_sql('text'))} FROM documents
UNION ALL SELECT 'pages', count(*), {_leaks('html')} FROM pages""")
def pii_scan(spark: SparkSession, sf: str) -> DataFrame:
    return quality.pii_scan(
        {
            "conversations": (table(spark, sf, "conversations"), "text"),
            "documents": (spread_table(spark, sf, "documents"), "text"),
            "masked_documents": (mask_documents(spark, sf), "masked"),
            "pages": (spread_table(spark, sf, "pages"), "html"),
        }
    )


@registry.query("SELECT doc_id, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS norm FROM documents")
def normalised_documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread_table(spark, sf, "documents").select("doc_id", norm_text(F.col("text")).alias("norm"))


@registry.query(f"SELECT ticket_id, exported_at, CAST(n_turns AS INTEGER) AS n_turns, {mask_sql('text')} AS text FROM ({EXPORT_SQL})")
def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Every export record as one masked transcript."""
    return chunks.decode_exports(bronze_exports(spark, sf)).drop("_batch_id")


@registry.query(f"""
SELECT ticket_id, exported_at, CAST(n_turns AS INTEGER) AS n_turns, {mask_sql('text')} AS text FROM ({EXPORT_SQL})
QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY turn DESC) = 1""")
def transcript_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest export of every ticket."""
    return chunks.latest_exports(chunks.decode_exports(bronze_exports(spark, sf))).drop("_batch_id")


@registry.query(f"SELECT doc, chunk_idx, chunk_text, sha256(chunk_text) AS text_hash FROM ({_chunk_sql(_DOC_SQL)})")
def doc_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.split_chunks(documents(spark, sf))


def _live(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as transcripts of tickets; one labelled toxic counts as deleted, one without label as unknown."""
    docs = spread_table(spark, sf, "documents")
    tickets = table(spark, sf, "labels").select(
        F.col("doc_id").alias("ticket_id"), (F.col("toxic") == 1).alias("is_deleted"), F.lit("other").alias("category"),
        F.when(F.col("quality") == 1, "high").otherwise("low").alias("priority"), F.lit("open").alias("status"),
    )
    return chunks.live_transcripts(docs.select(F.col("doc_id").alias("ticket_id"), "text"), tickets)


_LIVE_SQL = "SELECT doc_id AS doc, text, CASE quality WHEN 1 THEN 'high' ELSE 'low' END AS priority FROM documents JOIN labels USING (doc_id) WHERE toxic = 0"


@registry.query(f"""
SELECT c.doc AS ticket_id, chunk_idx, chunk_text, priority FROM ({_chunk_sql(_LIVE_SQL)}) c JOIN ({_LIVE_SQL}) l ON l.doc = c.doc""")
def live_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of live tickets only."""
    return chunks.split_chunks(_live(spark, sf)).select("ticket_id", "chunk_idx", "chunk_text", "priority")


@registry.query(_EMBED_SQL % f"(SELECT DISTINCT sha256(chunk_text) AS text_hash, chunk_text FROM ({_chunk_sql(_DOC_SQL)}))")
def chunk_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """The hash embedding of every distinct chunk."""
    texts = chunks.missing_embeddings(chunks.split_chunks(documents(spark, sf)), _empty_cache(spark))
    return chunks.embed(texts).select("text_hash", _vector(F.col("embedding")).alias("vector"))


def _empty_cache(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TABLES["embedding_cache"])


def _live_cache(spark: SparkSession, sf: str) -> DataFrame:
    texts = chunks.missing_embeddings(chunks.split_chunks(_live(spark, sf)), _empty_cache(spark))
    return chunks.embed(texts)


@registry.query(f"""
SELECT DISTINCT sha256(chunk_text) AS text_hash, chunk_text FROM ({_chunk_sql(_DOC_SQL)})
WHERE chunk_text NOT IN (SELECT chunk_text FROM ({_chunk_sql(_LIVE_SQL)}))""")
def cache_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of all documents still to be embedded when those of the live ones are cached."""
    return chunks.missing_embeddings(chunks.split_chunks(documents(spark, sf)), _live_cache(spark, sf))


@registry.query(f"""
SELECT c.doc, c.chunk_idx, e.text_hash, 'hash-embed-v1' AS embedding_model_version, e.vector
FROM ({_chunk_sql(_DOC_SQL)}) c
JOIN ({_EMBED_SQL % f"(SELECT DISTINCT sha256(chunk_text) AS text_hash, chunk_text FROM ({_chunk_sql(_LIVE_SQL)}))"}) e
  ON e.text_hash = sha256(c.chunk_text)""")
def cache_join(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of all documents with their cached embedding, where there is one."""
    found = chunks.with_embeddings(chunks.split_chunks(documents(spark, sf)), _live_cache(spark, sf))
    return found.select("doc", "chunk_idx", "text_hash", "embedding_model_version", _vector(F.col("embedding")).alias("vector"))


@registry.query(_EMBED_SQL % "(SELECT CAST(doc_id AS VARCHAR) AS text_hash, text AS chunk_text FROM documents)")
def document_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """The hash embedding of whole documents."""
    docs = spread_table(spark, sf, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("text_hash"), _vector(hash_embed(F.col("text"))).alias("vector"))
