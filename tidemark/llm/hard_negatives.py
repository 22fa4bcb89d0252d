"""Hard negatives: for an anchor and each of its positives, rows of other labels that score a stated share of it.

A positive's window of negative scores ends at its upper limit. The upper limits of an anchor's positives,
put in order, split all scores into disjoint slots, and a window is a run of slots from one limit down. So a
row is looked at once: tasks keep the best few of each slot while rows stream by, the tasks' bests are merged
slot by slot, and every window, however the windows overlap, is answered by the slots from its own on, read
downwards.

Anchors are a stated set against all rows. They are taken in blocks whose size in bytes is bounded; a block
goes out to all tasks, whose work is one product of matrices for each batch of rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import positions, store
from tidemark.session import shared_folder

POSITIVES, NEGATIVES = 5, 10
# A window in shares of the positive's score, in hundredths.
LEAST, MOST = 30, 90
# Anchors of a block; fewer if their vectors are long, so that a block is at most 16 MB.
BLOCK_ROWS, BLOCK_BYTES = 2_048, 16 << 20
# Scores held at once in a task, 8 bytes each.
_SCORES = 2_000_000
_EXACT = float(2**53)
_LONG = 2**63 - 1
_BEST = "anchor int, score long, id long, group int"


def usable(rows: DataFrame, vec_id="vec_id", vector="embedding", label="label", scale: int = 256) -> DataFrame:
    """`id, label, vector` of the rows that take part, components as whole numbers, still doubles."""
    x = F.col(vector)
    # A comparison with a null or with no number is not true.
    finite = F.forall(F.transform(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False))), lambda ok: ok)
    # A double this large is whole already, and `floor` gives a long; the end of the range stays finite.
    scaled = F.transform(x, lambda v: F.greatest(F.least(v.cast("double") * scale, F.lit(1e300)), F.lit(-1e300)))
    whole = F.transform(scaled, lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v))
    known = rows.where(F.col(label).isNotNull() & x.isNotNull() & finite)
    return known.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole.alias("vector"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows; a shorter one ends in zeros."""
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers, exact; what no long can hold becomes the longest one."""
    bound = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * max(anchors.shape[1], 1)
    if bound < _EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(anchors).dot(whole(rows).T) if anchors.size and rows.size else np.zeros((len(anchors), len(rows)), object)
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


@dataclass
class Best:
    """The first `k` of each group by falling score, then rising id, kept while scores stream by."""

    groups: int
    k: int

    def __post_init__(self):
        self.group = self.score = self.id = np.zeros(0, np.int64)
        self.last_score = np.full(self.groups, -_LONG - 1)
        self.last_id = np.full(self.groups, _LONG)

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        group, score, ident = np.concatenate([self.group, group]), np.concatenate([self.score, score]), np.concatenate([self.id, ident])
        order = np.lexsort((ident, -score, group))
        group, score, ident = group[order], score[order], ident[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        held = place < self.k
        self.group, self.score, self.id = group[held], score[held], ident[held]
        full = np.flatnonzero(place == self.k - 1)
        self.last_score[group[full]], self.last_id[group[full]] = score[full], ident[full]

    def may_enter(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> np.ndarray:
        last = self.last_score[group]
        return (score > last) | ((score == last) & (ident < self.last_id[group]))


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers; a missing one stands last."""
    return np.asarray(column.fill_null(_LONG), np.int64)


def _combine(rows: DataFrame, block, dims: int, k: int, same: bool, n_groups: int) -> DataFrame:
    """Each task's best `k` rows of each anchor and group, among rows of the anchor's label or of others.

    `block` is the broadcast anchors' vectors and labels, and for each anchor the upper limits of its slots,
    falling, and the least score wanted; a row belongs to the last slot whose limit it does not pass.
    """

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, labels, uppers, least = block.value
        n = len(labels)
        kept, size, most = Best(n * n_groups, k), 32, max(_SCORES // max(n, 1), 1)
        for batch in batches:
            ids, own, matrix = _ids(batch.column(0)), np.asarray(batch.column(1), np.int64), _matrix(batch.column(2), dims)
            begin = 0
            # The first batches are small: once a few rows are held, most of the others fall at once.
            while begin < len(ids):
                part = slice(begin, begin + min(size, most))
                begin, size = part.stop, min(size * 2, most)
                scores = _products(vectors, matrix[part])
                wanted = ((labels[:, None] == own[None, part]) == same) & (scores >= least[:, None]) & (scores <= uppers[:, :1])
                slot = np.zeros(scores.shape, np.int64)
                for s in range(1, n_groups):
                    slot += scores <= uppers[:, s : s + 1]
                wanted &= scores >= kept.last_score.reshape(n, n_groups)[np.arange(n)[:, None], slot]
                a, r = np.nonzero(wanted)
                group, score, ident = a * n_groups + slot[a, r], scores[a, r], ids[part][r]
                enters = kept.may_enter(group, score, ident)
                if enters.any():
                    kept.add(group[enters], score[enters], ident[enters])
        anchor, group = np.divmod(kept.group, n_groups)
        if len(kept.group):
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int32)), pa.array(kept.score), pa.array(kept.id), pa.array(group.astype(np.int32))],
                ["anchor", "score", "id", "group"],
            )

    return rows.mapInArrow(best, _BEST)


def _merged(best: DataFrame, k: int) -> DataFrame:
    """The first `k` of each anchor and group over all tasks; tasks cut to `k` before they send."""
    order = Window.partitionBy("anchor", "group").orderBy(F.desc("score"), "id")
    return best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _positives(rows: DataFrame, vectors, labels, ids, dims: int, k: int) -> list[list[tuple[int, int]]]:
    """The first `k` other rows of each anchor's label, as (score, id). An anchor is found as its own row, too:
    one entry with its id and its own score is taken out, whichever of equal ones it is."""
    n = len(labels)
    context = rows.sparkSession.sparkContext
    block = context.broadcast((vectors, labels, np.full((n, 1), _LONG), np.full(n, -_LONG)))
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for r in _merged(_combine(rows, block, dims, k + 1, True, 1), k + 1).orderBy("anchor", "place").collect():
        found[r["anchor"]].append((r["score"], r["id"]))
    for own, vector, ident in zip(found, vectors, ids, strict=True):
        itself = (int(_products(vector[None], vector[None])[0, 0]), int(ident))
        if itself in own:
            own.remove(itself)
        del own[k:]
    return found


def _block_negatives(rows: DataFrame, vectors, labels, ids, dims: int, positives: int, negatives: int, least: int, most: int) -> DataFrame | None:
    found = _positives(rows, vectors, labels, ids, dims, positives)
    # A window whose limits cross, as below zero, is empty and has no slot.
    windows = [[(p, i, -(-p * least // 100), p * most // 100) for p, i in own] for own in found]
    windows = [[w for w in own if w[2] <= w[3]] for own in windows]
    limits = [sorted({w[3] for w in own}, reverse=True) for own in windows]
    slots = max(map(len, limits), default=0)
    if not slots:
        return None
    uppers = np.array([own + [-_LONG] * (slots - len(own)) for own in limits], np.int64)
    floor = np.array([min((w[2] for w in own), default=_LONG) for own in windows], np.int64)
    spark = rows.sparkSession
    block = spark.sparkContext.broadcast((vectors, labels, uppers, floor))
    best = _merged(_combine(rows, block, dims, negatives, False, slots), negatives)
    # At most slots * negatives entries for an anchor, read downwards: a window's first ones are the first
    # entries from its own slot on, and those below its lower limit end it.
    down = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id", "group")))
    each = best.groupBy("anchor").agg(down.alias("entries"))
    told = [(a, int(ids[a]), p, i, low, limits[a].index(high)) for a, own in enumerate(windows) for p, i, low, high in own]
    wanted = spark.createDataFrame(told, "anchor int, anchor_id long, positive_score long, positive_id long, low long, slot int")
    from_slot = F.slice(F.filter("entries", lambda e: e["group"] >= F.col("slot")), 1, negatives)
    inside = F.filter(from_slot, lambda e: -e["down"] >= F.col("low"))
    picked = wanted.join(each, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("rank", "entry"))
    known = [F.when(c != _LONG, c) for c in (F.col("positive_id"), F.col("entry.id"))]
    return picked.select(
        "anchor_id", known[0].alias("positive_id"), (F.col("rank") + 1).cast("int").alias("rank"), known[1].alias("negative_id"),
        "positive_score", (-F.col("entry.down")).alias("negative_score"),
    )


SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    rows: DataFrame, anchor_every: int = 100, vec_id="vec_id", vector="embedding", label="label", scale: int = 256,
    positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The first `negatives` rows of other labels in the window of each anchor and positive, ranked from 1.

    A score is the inner product with the anchor, of components taken as `floor(scale * x)`; higher ones come
    first, ties by the smaller id. Positives are the first `positives` other rows of the anchor's label; a
    negative's score lies between `least` and `most` hundredths of the positive's. Anchors are the rows whose id
    is divisible by `anchor_every`.

    Rows without label or vector, or with a component that is null, infinite or no number, take no part. A
    vector that is shorter than others ends in zeros. A row without an id is no anchor and stands behind rows
    of the same score. Rows of one id are rows of their own: each is an anchor, and a positive of the others.
    Scores are exact up to what a long holds, beyond it they count as the longest one. An anchor without other
    rows of its label, or whose windows are empty, has no rows in the result; neither has an empty table.
    """
    spark = rows.sparkSession
    part = store(usable(rows, vec_id, vector, label, scale))
    dims = part.agg(F.max(F.size("vector"))).collect()[0][0] or 0
    size = max(min(block_rows, BLOCK_BYTES // (8 * max(dims, 1))), 1)
    chosen = part.where(F.col("id") % anchor_every == 0).withColumn("all", F.lit(0))
    dealt = positions(chosen, ["all"], ["id", "label"]).select(F.expr(f"pos div {size}").alias("block"), "id", "label", "vector")
    folder = f"{shared_folder(spark)}/anchors-{uuid.uuid4()}"
    dealt.write.partitionBy("block").parquet(f"{folder}/dealt")
    found = False
    for b in range(-(-dealt.count() // size)):
        # At most `size` rows, whatever the table.
        own = spark.read.schema("id long, label long, vector array<double>").parquet(f"{folder}/dealt/block={b}").toArrow()
        ids, labels = np.asarray(own.column("id"), np.int64), np.asarray(own.column("label"), np.int64)
        mined = _block_negatives(part, _matrix(own.column("vector").combine_chunks(), dims), labels, ids, dims, positives, negatives, least, most)
        if mined is not None:
            mined.write.parquet(f"{folder}/found/block={b}")
            found = True
    empty = spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{folder}/found").select(*empty.columns) if found else empty
