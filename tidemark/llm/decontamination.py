"""Benchmark decontamination: an FM-index per training shard, searched for every benchmark phrase.

A shard is what a task has read so far, up to some words; its documents are whole. Each shard is
indexed in the task, all phrases are searched backwards at once, occurrences are located from sampled
suffixes, and overlapping ones are merged into spans. Nothing is shuffled: a document's result depends
on the document and the benchmark alone. The benchmark is the stated query set, in blocks of bounded
size; blocks follow each other, so a larger benchmark takes more passes and not more memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, store, texts
from tidemark.llm.fm_index import FmIndex

WINDOW = 10
# Words indexed at once in a task. A longer document is a shard of its own.
SHARD_WORDS = 1_000_000
# Benchmark words sent to the tasks at once, about 20 MB of phrases.
BLOCK_WORDS = 400_000
# Words: runs of ASCII letters and digits and of everything beyond ASCII, letters in lower case.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_JVM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Phrases:
    """The distinct windows of some benchmark items, by length, as numbers of words from 1 up."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple, set[str]] = {}
        for item, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(numbers))
            for k in range(len(numbers) - size + 1 if size else 0):
                found.setdefault(tuple(numbers[k : k + size]), set()).add(item)
        self.by_length: list[tuple[np.ndarray, list[list[str]]]] = []
        for size in sorted({len(p) for p in found}):
            same = [p for p in found if len(p) == size]
            self.by_length.append((np.array(same, np.int64), [sorted(found[p]) for p in same]))
        self.shortest = min((p.shape[1] for p, _ in self.by_length), default=0)

    def numbers(self, text: bytes) -> np.ndarray:
        """The words of a text; 0 for those no item has."""
        get, own = self.vocabulary.get, words(text)
        return np.fromiter((get(w, 0) for w in own), np.int32, len(own))


def _shard_hits(docs: list[np.ndarray], phrases: Phrases) -> list[tuple[np.ndarray, set[str]]]:
    """For each document which of its words are hit, and the items found in it."""
    hits = [(np.zeros(len(d), bool), set()) for d in docs]
    if not docs or not phrases.by_length:
        return hits
    joined = np.concatenate([np.append(d, 0) for d in docs])
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    # Words that no item has end a run; runs shorter than every phrase cannot hold one.
    known = np.concatenate([[False], joined != 0])
    begin = np.flatnonzero(known[1:] & ~known[:-1])
    end = np.flatnonzero(known[:-1] & ~known[1:])
    if len(end) < len(begin):
        end = np.append(end, len(joined))
    long_enough = end - begin >= phrases.shortest
    begin, end = begin[long_enough], end[long_enough]
    if not len(begin):
        return hits
    lengths = end - begin + 1
    run_starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    origin = np.repeat(begin - run_starts, lengths) + np.arange(lengths.sum())
    symbols = joined[origin]
    symbols[run_starts + lengths - 1] = 0
    index = FmIndex(symbols, len(phrases.vocabulary))
    for windows, items in phrases.by_length:
        first, last = index.search(windows)
        counts = last - first
        rows = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        places = origin[index.locate(rows)]
        size = windows.shape[1]
        doc = np.searchsorted(starts, places, side="right") - 1
        for d, place, phrase in zip(doc.tolist(), (places - starts[doc]).tolist(), np.repeat(np.arange(len(counts)), counts).tolist(), strict=True):
            hits[d][0][place : place + size] = True
            hits[d][1].update(items[phrase])
    return hits


def spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as [start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[Phrases]:
    """The benchmark in blocks whose words were counted to be about `block_words` each."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(text, F.lit("")).alias("text")).distinct()
    total = rows.agg(F.sum(F.regexp_count("text", F.lit(_JVM_WORD)))).first()[0] or 0
    n = -(-total // block_words)
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield Phrases([(r["item"], r["text"].encode()) for r in part.collect()], window)


def _in_shards(batches: Iterator[pa.RecordBatch], column: int, shard_words: int) -> Iterator[tuple[list[pa.RecordBatch], list[bytes]]]:
    held, own, size = [], [], 0
    for batch in batches:
        found = texts(batch.column(column))
        held.append(batch)
        own += found
        size += sum(map(len, found)) // 6
        if size >= shard_words:
            yield held, own
            held, own, size = [], [], 0
    if held:
        yield held, own


_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))


def _searched(rows: DataFrame, blocks: Iterable[Phrases], shard_words: int) -> DataFrame:
    """`rows`, of any `key`, `text` and `n_words`, with their merged hit `spans` and the `items` found.

    Each block is a pass of its own over the rows, so that a task holds one block however many there are.
    """
    spark = rows.sparkSession
    state = small_batches(rows).select("key", "text", "n_words", F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    arrow = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    for phrases in blocks:
        sent = spark.sparkContext.broadcast(phrases)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for held, own in _in_shards(batches, 1, shard_words):
                found = iter(_shard_hits([sent.value.numbers(t) for t in own], sent.value))
                for batch in held:
                    new_spans, new_items = [], []
                    for old, old_items in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                        hit, items = next(found)
                        for s in old:
                            hit[s["first"] : s["last"]] = True
                        new_spans.append([{"first": a, "last": b} for a, b in spans(hit)])
                        new_items.append(sorted(items.union(old_items)))
                    columns = [*batch.columns[:3], pa.array(new_spans, arrow), pa.array(new_items, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "text", "n_words", "spans", "items"])

        state = state.mapInArrow(search, state.schema)
    return state


def _word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_JVM_WORD)).cast("long")


def find_phrases(docs: DataFrame, benchmark: DataFrame, doc_id="doc_id", text="text", item_id="item_id", item_text="text", window: int = WINDOW, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """`doc_id, n_words, spans, items` of every row: merged hit spans of words, and the items found.

    A window is `window` consecutive words of an item; an item of fewer words, but some, is one window
    and an item without words has none. Null texts have no words; a very long text is searched whole, as
    a shard of its own. Items that share an id are one item; a null id is the empty one. Rows that repeat
    get equal results. With an empty benchmark nothing is hit; without documents there are no rows.
    """
    rows = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"), _word_count(F.col(text)).alias("n_words"))
    found = _searched(rows, _blocks(benchmark, item_id, item_text, window, block_words), shard_words)
    return found.select(F.col("key").alias("doc_id"), "n_words", "spans", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`doc_id, n_words, n_hit, n_items, items_sha256, contaminated` of every row, of `find_phrases`.

    The digest is of the found items' ids, sorted as strings and joined by commas.
    """
    found = find_phrases(docs, benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def cut(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words and what stands between them; a line break marks each cut."""
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for first, last in spans(hit):
        kept.append(text[at : places[first][0]])
        at = places[last - 1][1]
    return b"\n".join([*kept, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text="text", item_id="item_id", item_text="text", window: int = WINDOW, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """`docs` with every occurrence of a benchmark window cut out of the texts; rows left without any
    word by that are dropped. Texts without a hit, null ones too, are unchanged to the byte.

    What a cut brings together is searched again until nothing is found. A benchmark of several
    blocks is searched for all of them, each in a pass of its own, before anything is cut. Repeated
    rows are cut alike; a very long text is searched whole. No rows, no result.
    """
    blocks = _blocks(benchmark, item_id, item_text, window, block_words)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs
    if second is not None:
        return _cut_by_blocks(docs, lambda: _blocks(benchmark, item_id, item_text, window, block_words), text, shard_words)
    return _cut_by_one(docs, first, text, shard_words)


def _cut_by_blocks(docs: DataFrame, blocks: Callable[[], Iterable[Phrases]], text: str, shard_words: int) -> DataFrame:
    """Rounds of searching and cutting; a row is done when a round finds nothing in it. A round leaves fewer
    words in every row that goes into the next one."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    todo, done = docs.select(row.alias("key"), F.col(f"`{text}`").alias("text")), []
    while True:
        found = store(_searched(todo.withColumn("n_words", _word_count(F.col("text"))), blocks(), shard_words).drop("items"))
        done.append(found.where(F.size("spans") == 0).select("key", "text"))
        hit = found.where(F.size("spans") > 0)
        if hit.isEmpty():
            break

        def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = []
                for t, n, found in zip(texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    own = np.zeros(n, bool)
                    for s in found:
                        own[s["first"] : s["last"]] = True
                    # A text with nothing else in it goes.
                    new.append(None if own.all() else cut(t, own).decode())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], ["key", "text"])

        todo = store(hit.mapInArrow(shorten, T.StructType(hit.schema.fields[:2])).where("text IS NOT NULL"))
    kept = reduce(DataFrame.unionByName, done)
    return kept.select(*[F.col("text" if c == text else f"key.`{c}`").alias(c) for c in docs.columns])


def _cut_by_one(docs: DataFrame, phrases: Phrases, text: str, shard_words: int) -> DataFrame:
    """All rounds of a row in one pass, with a benchmark of one block."""
    sent = docs.sparkSession.sparkContext.broadcast(phrases)
    place, names = docs.columns.index(text), [f"c{k}" for k in range(len(docs.columns))]
    kind = pa.string()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, own in _in_shards(batches, place, shard_words):
            todo, gone = list(range(len(own))), set()
            changed: dict[int, bytes] = {}
            while todo:
                current = [changed.get(i, own[i]) for i in todo]
                hit = [h for h, _ in _shard_hits([sent.value.numbers(t) for t in current], sent.value)]
                again = []
                for i, t, h in zip(todo, current, hit, strict=True):
                    if h.any():
                        changed[i] = cut(t, h)
                        again.append(i)
                        if h.all():
                            gone.add(i)
                todo = [i for i in again if i not in gone]
            at = 0
            for batch in held:
                rows = range(at, at + len(batch))
                at += len(batch)
                if changed:
                    new = [changed[i].decode() if i in changed else old for i, old in zip(rows, batch.column(place).to_pylist(), strict=True)]
                    batch = batch.set_column(place, pa.field(names[place], kind), pa.array(new, kind))
                    batch = batch.filter(pa.array([i not in gone for i in rows]))
                yield batch

    # Columns go by plain names through the tasks, as their own may have dots.
    schema = T.StructType([T.StructField(name, f.dataType) for name, f in zip(names, docs.schema.fields, strict=True)])
    return small_batches(docs).toDF(*names).mapInArrow(clean, schema).toDF(*docs.columns)
