import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from deliveries import export
from tidemark.operators import chunks, labelling
from tidemark.operators.schemas import TABLES
from tidemark.sources.landing import export_records


def empty(spark, table):
    return spark.createDataFrame([], TABLES[table])


def test_exports_become_masked_transcripts_and_the_newest_wins(spark, rows):
    objects = [export("A", "2024-03-01T23:00:00", ("customer", "mail a@b.co")), export("A", "2024-03-02T23:00:00", ("customer", "x"), ("agent", "y")), export("B", "2024-03-01T23:00:00")]
    records = spark.createDataFrame([(json.dumps(o),) for o in objects], "j string").select(F.parse_json("j").alias("record"))
    decoded = chunks.decode_exports(export_records(records, "transcripts", "2024-03-02"))
    assert rows(decoded, "ticket_id", "n_turns", "text") == [("A", 1, "customer: mail <EMAIL>"), ("A", 2, "customer: x\nagent: y"), ("B", 0, "")]
    assert rows(chunks.latest_exports(decoded), "ticket_id", "n_turns") == [("A", 2), ("B", 0)]


def test_chunks_of_live_tickets_only(spark, rows):
    transcripts = spark.createDataFrame([("A", "a b"), ("B", "c"), ("X", "orphan"), ("E", " ")], "ticket_id string, text string")
    tickets = spark.createDataFrame([("A", False), ("B", True), ("E", False)], "ticket_id string, is_deleted boolean")
    tickets = tickets.selectExpr("*", "'bug' category", "'low' priority", "'open' status")
    pieces = chunks.split_chunks(chunks.live_transcripts(transcripts, tickets))
    assert rows(pieces, "ticket_id", "chunk_idx", "chunk_text", "category") == [("A", 0, "a b", "bug")]


def pieces(spark, texts):
    return chunks.split_chunks(spark.createDataFrame(list(enumerate(texts)), "ticket_id int, text string"))


def test_only_new_texts_are_embedded_and_a_new_model_embeds_all(spark, rows):
    first = pieces(spark, ["same text", "same text", "other"])
    missing = chunks.missing_embeddings(first, empty(spark, "embedding_cache"))
    assert missing.count() == 2
    cache = chunks.embed(missing)
    assert chunks.missing_embeddings(first, cache).count() == 0
    assert rows(chunks.missing_embeddings(pieces(spark, ["same text", "new"]), cache), "chunk_text") == [("new",)]
    assert chunks.missing_embeddings(first, cache, "v2").count() == 2
    joined = chunks.with_embeddings(first, cache.unionByName(cache.withColumn("model_version", F.lit("v2"))))
    assert joined.count() == 3 and joined.where("embedding_model_version <> 'hash-embed-v1'").count() == 0


def test_a_python_model_sees_missing_texts_only(spark, rows):
    def model(texts):
        def lengths(batches):
            for pdf in batches:
                yield pd.DataFrame({"text_hash": pdf["text_hash"], "embedding": [[float(len(t))] for t in pdf["chunk_text"]]})

        return texts.mapInPandas(lengths, "text_hash string, embedding array<double>")

    cache = chunks.embed(chunks.missing_embeddings(pieces(spark, ["ab", "abc"]), empty(spark, "embedding_cache")), model, "len-v1")
    assert sorted(r[0] for r in cache.select(F.col("embedding")[0]).collect()) == [2.0, 3.0]
    assert cache.first()["model_version"] == "len-v1"


@pytest.fixture
def texts(spark):
    tickets = [("A", "app", "crash", False), ("B", "gói", "cước", False), ("C", "xuất", "file", False), ("D", None, "x", False), ("E", "dead", "x", True), ("F", "app", "crash", False)]
    return labelling.live_ticket_texts(spark.createDataFrame(tickets, "ticket_id string, subject string, body string, is_deleted boolean"))


def run(texts, cache, version="triage-v1"):
    """One labelling run over a cache; (calls, new cache, judged rows)."""
    fresh = labelling.unanswered(texts, cache, prompt_version=version)
    cache = cache.unionByName(labelling.answers(fresh, labelling.keyword_labeller, labelling.MODEL, version))
    return fresh.count(), cache, labelling.judged(texts, cache, prompt_version=version)


def test_labelling_contract(spark, rows, texts):
    calls, cache, judged = run(texts, empty(spark, "answer_cache"))
    assert calls == 3  # A and F ask the same, D has no text
    assert rows(labelling.gold_labels(judged), "ticket_id", "label") == [("A", "bug"), ("B", "billing"), ("F", "bug")]
    assert rows(labelling.quarantined_labels(judged), "ticket_id", "reason") == [("C", "answer has no allowed label"), ("D", "no answer")]
    again, cache, _ = run(texts, cache)
    assert again == 0
    relabel, cache, judged = run(texts, cache, "triage-v2")
    assert relabel == 3
    assert {r["prompt_version"] for r in judged.collect()} == {"triage-v2"}


def test_cost_counts_every_prompt(spark, texts):
    from tidemark.functions.labels import PROMPT_HEAD

    cost = labelling.label_cost(texts.where("text IS NOT NULL")).first()
    want = sum(len((PROMPT_HEAD + t).split()) + 8 for t in ("app. crash", "gói. cước", "xuất. file", "app. crash"))
    assert (cost["n_texts"], cost["n_tokens"], cost["usd"]) == (4, want, round(want / 1000 * 0.002, 6))
