"""Triples out of sentences, and walks over edge tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import graph
from tidemark.queries.inputs import PART_NOUNS, catalogue, documents, place_edges, table
from tidemark.queries.registry import Registry
from tidemark.session import shared_folder
from tidemark.sources.documents import read_documents
from tidemark.sources.folders import Folders

registry = Registry()

# What the catalogue's sentences state, from the tables they are written from.
_TRIPLES = """
SELECT string_split(p_name, ' ')[2] AS subject,
       CASE p_type WHEN 'PROMO' THEN 'NON_RETURNABLE' WHEN 'LARGE' THEN 'HAS_WARRANTY' ELSE 'RETURNABLE_WITHIN' END AS relation,
       CASE p_type WHEN 'PROMO' THEN 'final sale' ELSE p_size || ' days' END AS object
FROM part
UNION ALL
SELECT lower(n_name), 'IS_A', lower(replace(r_name, ' ', '-')) FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT lower(n_name), 'SHIPS_FROM', 'port of ' || lower(r_name) FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT unnest([lower(c_name), lower(c_name) || '-staff', lower(c_name) || '-family']), 'IS_A', lower(n_name)
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.extract_triples(catalogue(spark, sf), products=PART_NOUNS)


@registry.query(_TRIPLES)
def triples(spark: SparkSession, sf: str) -> DataFrame:
    """Edges found in sentences written about every part, nation and customer."""
    return _edges(spark, sf).select("subject", "relation", "object")


@registry.query("""
SELECT 'nation_' || n_nationkey || '.md' AS doc, lower(n_name) AS subject, 'IS_A' AS relation, lower(replace(r_name, ' ', '-')) AS object
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'nation_' || c_nationkey || '.md', unnest([lower(c_name), lower(c_name) || '-staff', lower(c_name) || '-family']), 'IS_A', lower(n_name)
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def folder_triples(spark: SparkSession, sf: str) -> DataFrame:
    """Edges out of a folder of documents: a file for each nation, with a line for it and each of its customers."""
    folder = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    region = F.replace("r_name", F.lit(" "), F.lit("-"))
    own = nation.select(F.col("n_nationkey").alias("nation"), F.concat("n_name", F.lit(" belong to the "), region, F.lit(" category.")).alias("value"))
    names = [F.col("c_name"), F.lit(" and "), F.col("c_name"), F.lit("-staff, the "), F.col("c_name"), F.lit("-family belong to the ")]
    customer = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    theirs = customer.select(F.col("c_nationkey").alias("nation"), F.concat(F.lit("The "), *names, "n_name", F.lit(" category.")).alias("value"))
    lines = own.unionByName(theirs).withColumn("nation", F.concat(F.lit("nation_"), F.col("nation").cast("string")))
    lines.repartition("nation").write.partitionBy("nation").text(f"{folder}/lines")
    folders = Folders(spark)
    for name in folders.names(f"{folder}/lines"):
        for part in folders.names(f"{folder}/lines/{name}"):
            if part.startswith("part-"):
                folders.move(f"{folder}/lines/{name}/{part}", f"{folder}/docs/{name.removeprefix('nation=')}.md")
    found = graph.extract_triples(read_documents(spark, f"{folder}/docs"), products=PART_NOUNS)
    return found.select(F.col("ord.doc").alias("doc"), "subject", "relation", "object")


@registry.query(f"SELECT relation, object FROM ({_TRIPLES}) WHERE subject = 'widget'")
def one_hop(spark: SparkSession, sf: str) -> DataFrame:
    return graph.one_hop(_edges(spark, sf), "widget")


@registry.query(f"SELECT relation, object FROM ({_TRIPLES}) WHERE subject = 'nation_7' AND relation = 'SHIPS_FROM'")
def one_hop_relation(spark: SparkSession, sf: str) -> DataFrame:
    return graph.one_hop(_edges(spark, sf), "nation_7", "SHIPS_FROM")


@registry.query("""
SELECT CAST(o_custkey AS VARCHAR) AS node FROM orders GROUP BY 1
HAVING bool_or(o_orderstatus = 'F') AND NOT bool_or(o_orderstatus = 'P')""")
def having_and_not(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a finished order and no pending one, over an edge per order."""
    orders = table(spark, sf, "orders")
    edges = orders.select(
        F.col("o_custkey").cast("string").alias("subject"), F.col("o_orderstatus").alias("relation"),
        F.col("o_orderkey").cast("string").alias("object"),
    )
    return graph.having_and_not(edges, "F", "P")


@registry.query("""
SELECT 'world>r' || r_regionkey || '>n' || n_nationkey || '>c' || c_custkey || '>o' || o_orderkey AS path, 4 AS hops,
       'o' || o_orderkey AS answer
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey""")
def traverse(spark: SparkSession, sf: str) -> DataFrame:
    """From one node to every order, four edges away: one more than the hops allowed in between."""
    paths = graph.traverse(place_edges(spark, sf), "world", "PLACED", max_hops=3)
    return paths.select(F.array_join("path", ">").alias("path"), "hops", "answer")


@registry.query("""
SELECT 'world>r' || r_regionkey || '>n' || n_nationkey || '>c' || c_custkey AS path, 3 AS hops, 'c' || c_custkey AS answer
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey""")
def traverse_to_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers that are subjects themselves are walked on from as well."""
    paths = graph.traverse(place_edges(spark, sf), "world", "HAS_CUSTOMER", max_hops=3)
    return paths.select(F.array_join("path", ">").alias("path"), "hops", "answer")


# Sentences: lines that are neither blank nor headings, cut after '.', '!' or '?' and white space.
_SENTENCES = """
SELECT doc_id, i, j, trim(parts[j], ' ' || chr(9)) AS sentence
FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS j
      FROM (SELECT doc_id, i, string_split(regexp_replace(trim(lines[i], ' ' || chr(9)), '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) AS parts
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
            WHERE trim(lines[i], ' ' || chr(9)) <> '' AND trim(lines[i], ' ' || chr(9)) NOT LIKE '#%'))
WHERE trim(parts[j], ' ' || chr(9)) <> ''
"""


@registry.query(f"""
SELECT doc_id AS doc, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS INTEGER) AS sent_no, sentence FROM ({_SENTENCES})""")
def sentence_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return graph.document_sentences(documents(spark, sf))


@registry.query(f"""
SELECT count(*) AS n_chunks,
       arg_min(sentence, (doc_id, i, j)) FILTER (WHERE contains(lower(sentence), 'thereer')) AS chunk_with_subject,
       arg_min(sentence, (doc_id, i, j)) FILTER (WHERE contains(lower(sentence), 'queaux')) AS chunk_with_answer,
       coalesce(bool_or(contains(lower(sentence), 'thereer') AND contains(lower(sentence), 'queaux')), false) AS single_chunk_answers_it
FROM ({_SENTENCES})""")
def retrieval_contrast(spark: SparkSession, sf: str) -> DataFrame:
    return graph.retrieval_contrast(documents(spark, sf), "thereer", "queaux")
