"""Triples out of text, and questions over the edges they form.

A graph is its edge table (`subject`, `relation`, `object`, `ord`); `ord` is the order of arrival.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.entities import PLURALS, canon_entity
from tidemark.functions.text import bind, sentences, strip
from tidemark.session import cut_lineage, shared_folder

# Product names the policy rules look for, and the patterns of all rules.
PRODUCTS = ("widget", "gadget", "sprocket")
RETURN_DAYS = r"within\s+(\d+)\s*-?\s*day"
ANY_DAYS = r"(\d+)\s*-?\s*day"
BELONGS = r"^(.*?) belong to the ([\w-]+) category"
SHIPS = r"^([\w-]+) ship from the (.+?)[.]?$"

_TRIPLE = "array<struct<subject:string,relation:string,object:string>>"


def document_sentences(documents: DataFrame) -> DataFrame:
    """(`doc`, `sent_no`, `sentence`) of documents (`doc`, `text`), headings and blank lines left out."""
    return documents.select("doc", F.posexplode(sentences(F.col("text"))).alias("sent_no", "sentence"))


def _triple(subject: Column, relation: str, obj: Column) -> Column:
    return F.struct(subject.alias("subject"), F.lit(relation).alias("relation"), obj.alias("object"))


def _u(pattern: str) -> str:
    return "(?U)" + pattern


def _policy_triples(low: Column, products: Sequence[str]) -> Column:
    """Per product named in the sentence, in the given order, what is said about returning it."""
    if not products:
        return F.array().cast(_TRIPLE)
    refund = F.regexp_extract(low, _u(RETURN_DAYS), 1)
    warranty = F.regexp_extract(low, _u(ANY_DAYS), 1)
    terms = F.struct(
        F.when(low.contains("return") & (refund != ""), F.concat(refund, F.lit(" days"))).alias("refund"),
        F.when(low.contains("warranty") & (warranty != ""), F.concat(warranty, F.lit(" days"))).alias("warranty"),
        F.when(low.contains("final sale") | low.contains("cannot be returned"), F.lit("final sale")).alias("final"),
    )
    named = F.filter(F.array(*[F.lit(p) for p in products]), lambda p: low.contains(p))

    def stated(product: Column, t: Column) -> Column:
        return F.array(
            _triple(product, "RETURNABLE_WITHIN", t["refund"]),
            _triple(product, "HAS_WARRANTY", t["warranty"]),
            _triple(product, "NON_RETURNABLE", t["final"]),
        )

    every = bind(terms, lambda t: F.flatten(F.transform(named, lambda p: stated(p, t))))
    return F.filter(every, lambda triple: triple["object"].isNotNull())


def _category_triples(low: Column, plurals: Mapping[str, str]) -> Column:
    members = F.split(F.regexp_extract(low, _u(BELONGS), 1), _u(r",|\band\b"))
    names = F.filter(F.transform(members, lambda m: canon_entity(m, plurals)), lambda m: m != "")
    category = canon_entity(F.regexp_extract(low, _u(BELONGS), 2), plurals)
    triples = bind(category, lambda c: F.transform(names, lambda n: _triple(n, "IS_A", c)))
    return F.when(low.rlike(_u(BELONGS)), triples).otherwise(F.array().cast(_TRIPLE))


def _shipping_triples(low: Column, plurals: Mapping[str, str]) -> Column:
    what = canon_entity(F.regexp_extract(low, _u(SHIPS), 1), plurals)
    triple = _triple(what, "SHIPS_FROM", strip(F.regexp_extract(low, _u(SHIPS), 2)))
    return F.when(low.rlike(_u(SHIPS)), F.array(triple)).otherwise(F.array().cast(_TRIPLE))


def extract_triples(
    documents: DataFrame, products: Sequence[str] = PRODUCTS, plurals: Mapping[str, str] = PLURALS
) -> DataFrame:
    """The edge table the sentence rules find in documents (`doc`, `text`). One narrow pass."""
    low = F.lower("sentence")
    rules = F.concat(_policy_triples(low, products), _category_triples(low, plurals), _shipping_triples(low, plurals))
    # Most sentences state nothing; one test of the fixed phrases spares them the rules.
    relevant = low.rlike("return|warranty|final sale| belong to the | ship from the ")
    stated = document_sentences(documents).where(relevant)
    found = stated.select("doc", "sent_no", F.posexplode(rules).alias("item", "t"))
    return found.select("t.*", F.struct("doc", "sent_no", "item").alias("ord"))


def one_hop(edges: DataFrame, subject: str, relation: str | None = None) -> DataFrame:
    """Facts stated about `subject`, optionally of one relation."""
    facts = edges.where(F.col("subject") == subject)
    if relation is not None:
        facts = facts.where(F.col("relation") == relation)
    return facts.select("relation", "object")


def having_and_not(edges: DataFrame, relation: str, without: str) -> DataFrame:
    """Nodes with an edge of `relation` and none of `without`."""
    flags = edges.groupBy("subject").agg(
        F.bool_or(F.col("relation") == relation).alias("has"), F.bool_or(F.col("relation") == without).alias("hasnt")
    )
    return flags.where("has AND NOT hasnt").select(F.col("subject").alias("node"))


# A node's edges are dealt over so many buckets, as one node may have a third of all edges.
EDGE_SALTS = 8
# A bucket is put in order by one task, so the more edges there are, the more buckets.
BUCKET_EDGES = 500_000
# A level of at most so many rows goes to every task; how well it is packed on disk does not say how large it is there.
BROADCAST_NODES = 100_000


def _buckets(edges: DataFrame) -> int:
    """As many buckets as a shuffle has partitions, more if those would hold too many edges. Of stored tables a count reads the footers."""
    return max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-edges.count() // BUCKET_EDGES))


def _met(nodes: DataFrame, n_rows: int) -> DataFrame:
    """One side of a join: sent to every task if it is small, otherwise put in order beside the other side."""
    return F.broadcast(nodes) if n_rows <= BROADCAST_NODES else nodes.hint("merge")


def bucketed_edges(edges: DataFrame, buckets: int | None = None) -> DataFrame:
    """`node, relation, object, edge` as a table bucketed by node and salt, the only shuffle of the edges.

    Its files belong to the job, like checkpoint files; the session's catalog knows it by a name of its own.
    """
    spark = edges.sparkSession
    buckets = buckets or _buckets(edges)
    hop = edges.select(F.col("subject").alias("node"), "relation", "object", F.col("ord").alias("edge"))
    salted = hop.withColumn("salt", F.pmod(F.xxhash64("object", "relation"), F.lit(EDGE_SALTS)).cast("int"))
    name = f"tidemark_edges_{uuid.uuid4().hex}"
    # Dealt as the buckets are, each bucket is one file.
    dealt = salted.repartition(buckets, "node", "salt")
    dealt.write.bucketBy(buckets, "node", "salt").option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def traverse(edges: DataFrame, start: str, relation: str, max_hops: int = 3) -> DataFrame:
    """Breadth-first walk from `start`; one row (`path`, `hops`, `answer`) per edge of `relation` met.

    A node is walked on from once, by the path that reaches it first. Nodes up to `max_hops` edges away are
    walked on from, so an answer is at most `max_hops + 1` edges away. The edges are shuffled once, into
    buckets; each level meets them where they lie. A level keeps a node, the node it was reached from and
    its turn in the queue; paths are read backwards from the answers at the end. Levels are stored, so a
    lost executor costs one level and the plan does not grow. No level of many nodes is sent to all tasks.
    """
    spark = edges.sparkSession
    buckets = _buckets(edges)
    hop = bucketed_edges(edges, buckets)
    salts = F.explode(F.sequence(F.lit(0), F.lit(EDGE_SALTS - 1))).alias("salt")
    first = spark.range(1).select(F.lit(start).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("turn"))
    levels, sizes = [cut_lineage(first)], [1]
    for _ in range(max_hops):
        steps = hop.select("node", "salt", "object", "edge").join(_met(levels[-1].select("node", "turn", salts), sizes[-1] * EDGE_SALTS), ["node", "salt"])
        reached = steps.groupBy("object").agg(F.min(F.struct("turn", "edge", "node")).alias("by"))
        known = _met(reduce(DataFrame.unionByName, [level.select("node") for level in levels]), sum(sizes))
        fresh = reached.join(known, F.col("object") == F.col("node"), "left_anti").where(F.col("object").isNotNull())
        # The queue's order among the nodes of a level is that of the nodes and edges they were reached by.
        queued = fresh.orderBy("by.turn", "by.edge").select(F.col("object").alias("node"), F.col("by.node").alias("parent"), F.monotonically_increasing_id().alias("turn"))
        levels.append(cut_lineage(queued))
        sizes.append(levels[-1].count())
        if not sizes[-1]:
            break
    walked = reduce(DataFrame.unionByName, [level.select("node", "parent", F.lit(k).alias("depth")) for k, level in enumerate(levels)])
    asked = hop.where(F.col("relation") == relation).select("node", "salt", "object")
    found = asked.join(_met(walked.select("*", salts), sum(sizes) * EDGE_SALTS), ["node", "salt"])
    longer = lambda path: F.when(F.col("parent").isNull(), path).otherwise(F.concat(F.array("parent"), path))
    found = found.select(
        "salt", longer(F.array("node", "object")).alias("path"), (F.col("depth") + 1).alias("hops"), F.col("object").alias("answer"), F.coalesce("parent", "node").alias("_at")
    )
    # The last level is no node's parent.
    for level, n_nodes in reversed([*zip(levels, sizes, strict=True)][1:-1]):
        # A node is of one level only, so paths that have not come to this level yet meet nothing in it.
        back = level.select(F.col("node").alias("_at"), "parent", salts)
        if n_nodes * EDGE_SALTS > BROADCAST_NODES:
            found, back = found.repartition(buckets, "_at", "salt"), back.repartition(buckets, "_at", "salt")
        found = found.join(_met(back, n_nodes * EDGE_SALTS), ["_at", "salt"], "left").select(
            "salt", longer(F.col("path")).alias("path"), "hops", "answer", F.coalesce("parent", "_at").alias("_at")
        )
    return found.drop("_at", "salt")


def retrieval_contrast(documents: DataFrame, subject: str, hint: str) -> DataFrame:
    """What retrieving single sentences can offer for a question that needs two facts.

    One row: number of sentences, the first naming the subject, the first naming the answer, and
    whether any names both.
    """
    low = F.lower("sentence")
    with_subject, with_answer = low.contains(subject.lower()), low.contains(hint.lower())
    place = F.struct("doc", "sent_no")
    return document_sentences(documents).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.min_by("sentence", F.when(with_subject, place)).alias("chunk_with_subject"),
        F.min_by("sentence", F.when(with_answer, place)).alias("chunk_with_answer"),
        F.coalesce(F.bool_or(with_subject & with_answer), F.lit(False)).alias("single_chunk_answers_it"),
    )
