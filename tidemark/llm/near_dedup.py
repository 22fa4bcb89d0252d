"""Near-duplicates by BagMinHash: signatures of shingle multisets, bands, and exact verification.

Documents with equal texts are one node. Nodes that share a band are compared with the band's pivot,
never all with each other; what is verified is the multiset overlap of their texts. A bucket that still
holds nodes of different classes gets more pivots, until every pair of its nodes is in one class or has
been compared; its nodes first part by the shingles that are rare among them, as texts that only share a
passage many have meet in bands, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bag_minhash import band_keys, signatures
from tidemark.llm.common import WordHashes, chunks, mix64, ngrams, row_hash, small_batches, store, texts

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# 32 bands of 5: a pair at 0.8 shares none of them with probability 0.672 ** 32 = 3e-6, a pair at 0.3
# shares one with 8 %.
BANDS, ROWS_PER_BAND = 32, 5
# Bits of the bitmaps by which pairs are ruled out before their texts are looked at.
BITMAP = 1024
# Whole texts, and pairs of them to compare, that a task of a small table has at least.
TASK_TEXTS, TASK_PAIRS = 10_000, 4_000
# Shingles worked on at once in a task; a longer text is worked on alone.
_CHUNK = 200_000


def shingles(text: bytes, hashes: WordHashes, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of `n` words, repeats included; of a shorter text, its words as one run."""
    return ngrams(hashes.of(text.lower().split()), n)


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity of two multisets."""
    values, counts_a = np.unique(a, return_counts=True)
    other, counts_b = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(values, other, assume_unique=True, return_indices=True)
    common = np.minimum(counts_a[i], counts_b[j]).sum()
    return float(common / max(len(a) + len(b) - common, 1))


def elements(found: np.ndarray) -> np.ndarray:
    """A bag as a set: the k-th copy of a shingle is an element of its own."""
    found = np.sort(found)
    first = np.searchsorted(found, found)
    return mix64(found + mix64((np.arange(len(found)) - first).astype(np.uint64)))


def parities(own: np.ndarray) -> list[int]:
    """A bitmap of a set: whether an odd number of its elements falls on a bit, as signed numbers of 64 bits.

    An element in one of two sets turns one bit at most, so sets differ in as many elements as bits at least.
    """
    odd = np.bincount((own >> np.uint64(32)) % np.uint64(BITMAP), minlength=BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _differing(a: Column, b: Column) -> Column:
    """The number of bits in which two bitmaps differ."""
    return reduce(Column.__add__, [F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(BITMAP // 64)])


def _may_be_similar(size_a: Column, size_b: Column, bits_a: Column, bits_b: Column, similarity: float) -> Column:
    """False only of sets that are less similar: what they share is at most half of both less where they differ."""
    both = size_a + size_b
    return (both - _differing(bits_a, bits_b)) / 2 >= similarity / (1 + similarity) * both - 1e-6


def _with_bands(docs: DataFrame, doc_id: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """`doc, hash, bands, size, bits` of each row with a text; a text without words has no bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keys, sizes, bits = [], [], []
            for part in chunks((shingles(t, hashes, n) for t in texts(batch.column(2))), len, _CHUNK):
                own = [np.unique(s, return_counts=True) for s in part if len(s)]
                if own:
                    bag = np.repeat(np.arange(len(own)), [len(e) for e, _ in own])
                    signed = signatures(bag, np.concatenate([e for e, _ in own]), np.concatenate([c for _, c in own]), len(own), bands * rows)
                    found = iter(band_keys(signed, bands).tolist())
                keys += [next(found) if len(s) else [] for s in part]
                sizes += [len(s) for s in part]
                bits += [parities(elements(s)) for s in part]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, longs), pa.array(sizes, pa.int64()), pa.array(bits, longs)], ["doc", "hash", "bands", "size", "bits"]
            )

    known = docs.where(F.col(text).isNotNull())
    rows_in = small_batches(known).select(F.col(doc_id).cast("long").alias("doc"), row_hash(F.col(text)).alias("hash"), F.col(text).alias("text"))
    return rows_in.mapInArrow(sign, "doc long, hash struct<a:long,b:long>, bands array<long>, size long, bits array<long>")


def _similar(pairs: DataFrame, node_texts: DataFrame, n: int, similarity: float) -> DataFrame:
    """`a, b, linked` of pairs of nodes, by the multiset overlap of their whole texts; without those whose
    bitmaps say that they are not similar."""
    left, right = (node_texts.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("text", "size", "bits")]) for x in "ab")
    # The second node of a pair is the bucket's pivot: its rows may be many, and adaptive execution
    # splits them.
    joined = pairs.join(left, "a").join(right, "b")
    joined = joined.where(_may_be_similar(*[F.col(c) for c in ("size_a", "size_b", "bits_a", "bits_b")], similarity)).select("a", "b", "text_a", "text_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, pivot = WordHashes(), None, None
        for batch in batches:
            linked = []
            for b, text_a, text_b in zip(batch.column(1).to_pylist(), texts(batch.column(2)), texts(batch.column(3)), strict=True):
                if b != last:
                    last, pivot = b, shingles(text_b, hashes, n)
                linked.append(overlap(shingles(text_a, hashes, n), pivot) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)], ["a", "b", "linked"])

    return joined.mapInArrow(verify, "a long, b long, linked boolean")


def components(edges: DataFrame, at_most: int | None = None) -> DataFrame:
    """`node, root` for every node with an edge `a, b`: the smallest node it is connected with.

    `at_most` is a bound of the edges' number, for the number of files only.

    Labels go to neighbours and then jump to their label's label, so the rounds grow with the
    logarithm of the longest path. Each round is stored; only a count comes to the driver.
    """
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b")))
    # Every node is its own neighbour, so that one aggregation has its label and its neighbours' together.
    both = store(edges.select(ends.alias("e")).select("e.*").distinct(), None if at_most is None else 4 * at_most)
    n = both.count()
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), n)
    while True:
        mine = F.when(F.col("a") == F.col("b"), F.col("root"))
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"), F.min(mine).alias("old"))
        jump = labels.select(F.col("node").alias("near"), F.col("root").alias("further"))
        new = store(near.join(jump, "near").select(F.col("a").alias("node"), "old", F.least("near", "further").alias("root")), n)
        changed = new.where(F.col("old") != F.col("root")).limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds `root`; a node without an edge is its own."""
    known = roots.select("node", F.col("root").alias("known"))
    return nodes.join(known, "node", "left").withColumn("root", F.coalesce("known", "node")).drop("known")


def _contracted(roots: DataFrame, linked: DataFrame, at_most: int) -> DataFrame:
    """`roots` after the links `a, b` between nodes: only the classes they join are worked on."""
    ends = linked.select(F.col("a").alias("node"), "b")
    ends = _rooted(ends, roots).select(F.col("b").alias("node"), F.col("root").alias("a"))
    met = _rooted(ends, roots).select("a", F.col("root").alias("b")).where("a != b")
    merged = components(met, at_most).select(F.col("node").alias("root"), F.col("root").alias("top"))
    # Nodes that had no edge before are classes of their own.
    alone = merged.select(F.col("root").alias("node"), "root").join(roots.select("node"), "node", "left_anti")
    both = roots.select("node", "root").unionByName(alone)
    return store(both.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root")), roots.count() + 2 * at_most)


def _rare_buckets(nodes: DataFrame, n: int, similarity: float) -> tuple[DataFrame, int]:
    """`key, node, size, most, bits` such that any two nodes with the given similarity share a key, and a
    bound of its rows.

    Each text's shingles are put in order from rare to frequent, counted over these nodes; a multiset
    as similar as that cannot miss all of the first `size - ceil(similarity * size) + 1` of another.
    Passages that many texts share are frequent, so texts with no more than them in common part here.
    """

    def ordered_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                own = elements(shingles(text, hashes, n))
                rest = int(len(own) - np.ceil(similarity * len(own) - 1e-9)) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), node)), pa.array(np.full(len(own), len(own))), pa.array(np.full(len(own), rest)), pa.array(own.view(np.int64))],
                    ["node", "size", "prefix", "element"],
                )

    rows = store(nodes.select("node", "text").mapInArrow(ordered_elements, "node long, size long, prefix long, element long"))
    shared = rows.groupBy("element").agg(F.count(F.lit(1)).alias("n_nodes")).where(F.col("n_nodes") > 1)
    # Elements no other node has come first in every order; they only use up places.
    ordered = rows.join(shared, "element").groupBy("node", "size", "prefix").agg(F.sort_array(F.collect_list(F.struct("n_nodes", "element"))).alias("shared"))
    alone = (F.col("size") - F.size("shared")).cast("int")
    places = (F.col("prefix") - alone).cast("int")
    firsts = F.slice("shared", F.lit(1), places)["element"]
    met = ordered.where(places > 0).select("node", "size", alone.alias("alone"), F.posexplode(firsts).alias("place", "key"))
    # Two texts whose first common element is this share at most what follows it in either, `most`.
    # Of the two the smaller, of size m, must have m elements left but for a ninth (0.8), and the
    # larger one's rest bounds m from above.
    ratio = (1 + similarity) / similarity
    met = met.select("key", "node", "size", (F.col("size") - F.col("alone") - F.col("place")).alias("most"))
    met = met.withColumn("smaller", F.col("most") * ratio >= 2 * F.col("size") - 1e-6).withColumn("largest", F.least(F.col("most") * ratio - F.col("size") + 1e-6, F.col("size")))
    fit = met.groupBy("key").agg(F.min(F.when(F.col("smaller"), F.col("size"))).alias("least"), F.max("largest").alias("bound"))
    met = met.join(fit, "key")
    as_larger = F.col("least") <= F.col("largest")
    as_smaller = F.col("smaller") & (F.col("size") <= F.col("bound"))
    kept = met.where(as_larger | as_smaller).select("key", "node", "size", "most")
    return kept.join(nodes.select("node", "bits"), "node"), rows.count()


def near_duplicate_roots(signed: DataFrame, docs: DataFrame, text: str, n: int, similarity: float) -> DataFrame | None:
    """`node, root` for every node that is similar to another one; None if no two nodes meet.

    `signed` has `node, hash, bands, size, bits` for each distinct text, stored.
    """
    buckets = signed.select("node", F.explode("bands").alias("key"))
    pivots = buckets.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last").select("key", "b")
    # A bucket's pivot leaves it: it has been compared with all others.
    n_nodes = signed.count()
    rest = store(buckets.join(pivots, "key").where("node != b"), n_nodes * BANDS)
    pairs = store(rest.select(F.col("node").alias("a"), "b").distinct(), rest.count())
    n_pairs = pairs.count()
    if not n_pairs:
        return None
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # A third of all rows may have one text, so texts are reduced to one each before they are joined.
    own = docs.where(F.col(text).isNotNull()).select(row_hash(F.col(text)).alias("hash"), F.col(text).alias("text")).dropDuplicates(["hash"])
    node_texts = store(own.join(signed.select("node", "hash", "size", "bits").join(wanted, "node"), "hash").select("node", "text", "size", "bits"), n_nodes, TASK_TEXTS)
    checked = store(_similar(pairs, node_texts, n, similarity), n_pairs, TASK_PAIRS)
    roots = components(checked.where("linked"), n_pairs)

    # What is left of a bucket, if it is of several classes, meets again by what is rare in it.
    split = rest.select("key", "node").transform(lambda df: _rooted(df, roots)).groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    unsettled = store(rest.join(split.where("low != high").select("key"), "key").select("node").distinct(), n_nodes)
    if unsettled.isEmpty():
        return roots
    again = node_texts.join(unsettled, "node")
    buckets, n_rows = _rare_buckets(again, n, similarity)
    each, seen = 8, pairs
    part = similarity / (1 + similarity)
    while True:
        rooted = _rooted(buckets, roots)
        # Every pair of two classes has a node outside the bucket's largest class. Of those nodes the
        # smallest of each residue class is a pivot and then leaves the bucket; there are more of
        # them each time, so that the rounds grow with the logarithm of their number.
        classes = rooted.groupBy("key", "root").count().groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.max(F.struct("count", "root"))["root"].alias("main"))
        held = store(rooted.join(classes.where("classes > 1").select("key", "main"), "key"), n_rows)
        n_rows = held.count()
        if not n_rows:
            return roots
        turn = F.pmod(F.xxhash64("node"), F.lit(each))
        pivots = held.where("root != main").groupBy("key", turn.alias("turn")).agg(F.min(F.struct("node", "root", "size", "most", "bits")).alias("pivot"))
        pivots = store(pivots.select("key", F.col("pivot.node").alias("b"), *[F.col(f"pivot.{c}").alias(f"b_{c}") for c in ("root", "size", "most", "bits")]), n_rows)
        possible = F.least("most", "b_most") >= part * (F.col("size") + F.col("b_size")) - 1e-6
        possible &= _may_be_similar(F.col("size"), F.col("b_size"), F.col("bits"), F.col("b_bits"), similarity)
        pairs = held.join(pivots, "key").where((F.col("root") != F.col("b_root")) & possible)
        pairs = store(pairs.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct().join(seen, ["a", "b"], "left_anti"), n_rows * each)
        n_pairs = pairs.count()
        checked = store(_similar(pairs, node_texts, n, similarity), n_pairs, TASK_PAIRS)
        linked = checked.where("linked").select("a", "b")
        n_linked = linked.count()
        if n_linked:
            roots = _contracted(roots, linked, n_linked)
        seen = seen.unionByName(pairs)
        buckets = held.join(pivots.select("key", F.col("b").alias("node")), ["key", "node"], "left_anti").select("key", "node", "size", "most", "bits")
        each *= 8


def _classes(docs: DataFrame, doc_id: str, text: str, n: int, similarity: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """`doc, hash` of every row with a text, and `hash, root, class_id` of every distinct text.

    A node is a text, whatever ids have it. Nodes are numbered once, as they are stored; the numbers say
    which text is a pivot, and the classes are the same for any. `class_id` is the smallest id of a
    class, null if it has none.
    """
    signed = store(_with_bands(docs, doc_id, text, n, bands, rows))
    firsts = signed.groupBy("hash").agg(F.min("doc").alias("first"), *[F.first(c).alias(c) for c in ("bands", "size", "bits")])
    nodes = store(firsts.withColumn("node", F.monotonically_increasing_id()), signed.count(), TASK_TEXTS)
    roots = near_duplicate_roots(nodes, docs, text, n, similarity)
    if roots is None:
        return signed.select("doc", "hash"), nodes.select("hash", F.col("node").alias("root"), F.col("first").alias("class_id"))
    rooted = nodes.join(roots, "node", "left").select("hash", "first", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    return signed.select("doc", "hash"), rooted.join(smallest, "root").select("hash", "root", "class_id")


def near_duplicates(
    docs: DataFrame, doc_id="doc_id", text="text", shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows_per_band: int = ROWS_PER_BAND
) -> DataFrame:
    """`doc_id, class_id` of every row: the smallest id among all texts its text is connected with.

    Texts are compared as multisets of runs of `shingle_words` words between blanks, ASCII letters in
    lower case. Equal texts are always one class, also empty ones; texts without words are similar to
    nothing else. A null text is a class of its own. A row without an id has the class of its text,
    which is null if no text of the class has an id. An id with several texts has the class of each
    in that text's row. No rows, no classes.
    """
    rows, classed = _classes(docs, doc_id, text, shingle_words, similarity, bands, rows_per_band)
    member = rows.join(classed, "hash").select(F.col("doc").alias("doc_id"), "class_id")
    own = F.col(doc_id).cast("long")
    return member.unionByName(docs.where(F.col(text).isNull()).select(own.alias("doc_id"), own.alias("class_id")))


def first_of_each(
    docs: DataFrame, doc_id="doc_id", text="text", shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows_per_band: int = ROWS_PER_BAND
) -> DataFrame:
    """One row of `docs` of each class: of the smallest id, then text hash, then row hash.

    A row without an id is kept only if its class has none with one. Rows without a text are one class
    for each id; rows with neither are all kept.
    """
    _, classed = _classes(docs, doc_id, text, shingle_words, similarity, bands, rows_per_band)
    own, body = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    # Maps have neither order nor hash; their JSON stands for them.
    plain = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema.fields]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rank = F.struct(own.isNull().alias("no_id"), own.alias("doc"), row_hash(body).alias("hash"), row_hash(*plain).alias("row"))
    # Rows are reduced to one for each text before any move, and only then joined: no key is hot.
    told = docs.where(body.isNotNull()).select(row_hash(body).alias("_hash"), rank.alias("_rank"), whole.alias("_all"))
    each = told.groupBy("_hash").agg(F.min("_rank").alias("_rank"))
    winners = each.join(classed, each["_hash"] == classed["hash"]).groupBy("root").agg(F.min("_rank").alias("_rank"))
    best = told.groupBy("_hash").agg(F.min_by("_all", "_rank").alias("_all"))
    kept = best.join(winners.select(F.col("_rank.hash").alias("_hash")), "_hash", "left_semi").select("_all.*")
    untold = docs.where(body.isNull())
    named = untold.where(own.isNotNull()).select(own.alias("_doc"), rank.alias("_rank"), whole.alias("_all"))
    named = named.groupBy("_doc").agg(F.min_by("_all", "_rank").alias("_all")).select("_all.*")
    return kept.unionByName(named).unionByName(untold.where(own.isNull()))
