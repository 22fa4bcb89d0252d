"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is reached by complete epochs first. What is left of it is filled with documents in
the order of exponential keys, scaled by the documents' quality, up to the word budget. Everything is
decided by one small row per source, so documents are never sorted as a whole nor gathered by source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, store

# A source's documents are counted in bins by key, so many to each doubling of it; only one bin's rows are ever
# put in order. The rate of an exponential key moves it along this scale and does not change how it is spread:
# whatever the weights, no bin holds more than a share of ln 2 / e / BINS, 3e-5 of them. With 10^10
# documents in a source that is 310,000 short rows.
BINS = 1 << 13
# The plan has a row per source and is broadcast up to this many of them; beyond, it is shuffled.
BROADCAST_SOURCES = 100_000
LEAST_WEIGHT = 1e-6
_SYMBOLS = "#*$%&|<>"


def n_words(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.1 for texts of symbols only to 1 for texts without them."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))
    return 1 - 0.9 * symbols / F.greatest(F.length(text), F.lit(1))


def _digest(doc_id: str, text: str, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(doc_id).cast("string"), F.md5(F.coalesce(text, F.lit("")))))


def _key(digest: Column, text: str, quality: Column | None) -> Column:
    """An exponential variable with the document's quality as its rate, from 52 bits of the digest."""
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    if quality is None:
        return -F.log(uniform) / quality_weight(F.col(text))
    # What is no weight, or none above zero, counts as the least one.
    known = F.when(quality > LEAST_WEIGHT, quality.cast("double"))
    return -F.log(uniform) / F.coalesce(F.when(F.isnan(known), None).otherwise(known), F.lit(LEAST_WEIGHT))


def _sampled(docs: DataFrame, doc_id: str, text: str, source: str, seed: str, quality: Column | None) -> DataFrame:
    """What the sampling looks at: source, size, key with its bin, and a digest that orders equal keys."""
    digest = _digest(doc_id, text, seed)
    rows = docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size"), _key(digest, text, quality).alias("key"), digest.alias("digest"))
    return rows.withColumn("bin", F.floor(F.log2("key") * BINS))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_epochs: int) -> DataFrame:
    """`source, source_size` with each source's `target`, of a table with one row per source.

    Sources by code point, null last, weigh as `weights` repeat. All sizes are shared by weight; a
    target stops at `max_epochs` times its source's size and the excess is shared again by weight.
    Sorted by size over weight, the sources that stop are a prefix: one pass gives the fixed point.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    stop = max_epochs * F.col("source_size")
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("ratio", stop / F.col("weight"))
    shared = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum(stop).over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.sum("weight").over(onward))
        .withColumn("free", F.col("ratio") > F.col("level"))
        # The level of the first source that does not stop holds for all that follow.
        .withColumn("final", F.min(F.when(F.col("free"), F.struct("ratio", "level"))).over(everything)["level"])
    )
    target = F.when(F.col("free"), F.col("weight") * F.col("final")).otherwise(stop.cast("double"))
    return shared.select("source", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame, weights=(1.0, 2.0, 3.0), max_epochs: int = 3, doc_id="doc_id", text="text", source="source", seed="mix", quality: Column | None = None
) -> DataFrame:
    """One row per source: sizes, target, complete `epochs`, and where the fractional epoch ends.

    Documents with a key below `cut` (ties by digest) are taken once more; those equal to it in both,
    which are one document or rows repeating it, share the `room` that is left.
    """
    rows = store(_sampled(docs, doc_id, text, source, seed, quality))
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, max_epochs)
    budget = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    budget = store(budget.withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")))
    small = _bounded(budget)
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        bins.withColumn("before", F.coalesce(F.sum("bin_size").over(before), F.lit(0)))
        .alias("b")
        .join(small.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
        .where((F.col("before") < F.col("budget")) & (F.col("budget") <= F.col("before") + F.col("bin_size")))
        .select("b.source", "bin", "before", "budget")
    )
    # Rows that repeat a document are one entry here, so that a tie is settled by arithmetic.
    entries = (
        rows.alias("r")
        .join(_bounded(store(ends)).alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.bin") == F.col("e.bin")))
        .groupBy("r.source", "before", "budget", "key", "digest")
        .agg(F.sum("size").alias("entry_size"), F.count(F.lit(1)).alias("entry_rows"))
    )
    earlier = Window.partitionBy("source").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        entries.withColumn("reached", F.col("before") + F.coalesce(F.sum("entry_size").over(earlier), F.lit(0)))
        .where((F.col("reached") < F.col("budget")) & (F.col("budget") <= F.col("reached") + F.col("entry_size")))
        .select("source", F.col("key").alias("cut"), F.col("digest").alias("cut_digest"), (F.col("budget") - F.col("reached")).alias("room"), "entry_size", "entry_rows")
    )
    plan = budget.alias("p").join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    return store(plan.select("p.source", "source_size", "target", "epochs", "cut", "cut_digest", "room", "entry_size", "entry_rows"))


def _bounded(per_source: DataFrame) -> DataFrame:
    """Marked for broadcast if it was counted to have few rows; it must be stored already."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_SOURCES else per_source


def mix_documents(
    docs: DataFrame, weights=(1.0, 2.0, 3.0), max_epochs: int = 3, doc_id="doc_id", text="text", source="source", seed="mix", cut_last: bool = True,
    quality: Column | None = None,
) -> DataFrame:
    """All rows and columns of `docs`, and a struct `mix` of `size, source_size, target, taken, copies`.

    `taken` counts the words a document gives to the mix, over all epochs. With `cut_last`, a source's
    last document gives only the words its budget has room for, so sources meet their targets to a
    word; without, documents stay whole, the last one is taken if that comes nearer to the target, and
    `copies` says how often each is taken. No row exceeds `max_epochs` times its size.

    `quality` is the documents' weight within their source, a column expression over `docs`, by default the
    share of plain characters; what is null, no number or at most `LEAST_WEIGHT` counts as that.

    Null texts have no words and give none; a very long text is one document. No rows, no mix; null sources are one source, the last; null ids are as
    good as others. Equal rows share what their source's budget leaves for them evenly, the remainder
    going unused (at most a word a row). Keys come from ids and texts alone, so reruns agree. A column
    called `mix` is replaced.
    """
    plan = _bounded(mix_plan(docs, weights, max_epochs, doc_id, text, source, seed, quality))
    plan = plan.select(F.struct("*").alias("_plan"))
    digest = _digest(doc_id, text, seed)
    own = F.struct(n_words(F.col(text)).alias("size"), _key(digest, text, quality).alias("key"), digest.alias("digest"))
    rows = docs.select(F.struct("*").alias("_row"), own.alias("_own"))
    joined = rows.join(plan, F.col(f"_row.{source}").eqNullSafe(F.col("_plan.source")))
    size, at, end = F.col("_own.size"), F.struct("_own.key", "_own.digest"), F.struct(F.col("_plan.cut").alias("key"), F.col("_plan.cut_digest").alias("digest"))
    if cut_last:
        last = F.floor(F.col("_plan.room") / F.col("_plan.entry_rows"))
    else:
        last = F.when(2 * F.col("_plan.room") >= F.col("_plan.entry_size"), size).otherwise(0)
    more = F.when(F.col("_plan.cut").isNull(), 0).when(at < end, size).when(at == end, last).otherwise(0)
    copies = F.col("_plan.epochs") + F.when(more > 0, 1).otherwise(0)
    mix = F.struct(
        size.alias("size"), F.col("_plan.source_size").alias("source_size"), F.col("_plan.target").alias("target"),
        (F.col("_plan.epochs") * size + more).cast("long").alias("taken"), copies.cast("int").alias("copies"),
    )
    kept = [F.col(f"_row.`{c}`") for c in docs.columns if c != "mix"]
    return joined.select(*kept, mix.alias("mix"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, whole, with the columns of `docs`.

    Documents without words are no part of any budget and come as often as their source's complete
    epochs, or once where there are none, so that the stage never loses them silently.
    """
    # A row travels whole, as it may have a column called `mix` of its own.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    mixed = mix_documents(docs.select("*", whole).drop("mix"), cut_last=False, **options)
    copies = F.when(F.col("mix.size") == 0, F.greatest(F.col("mix.copies"), F.lit(1))).otherwise(F.col("mix.copies"))
    taken = mixed.select("_whole", copies.alias("copies")).where("copies > 0").select("_whole", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col(f"_whole.`{c}`") for c in docs.columns])
