"""A Merkle manifest of a data set: one digest for all of it, one for each source, a proof for each row.

Rows of a source stand in order; while a source has several nodes, every three consecutive ones become
the digest of their digests, and what remains is the source's subroot. Subroots give the root likewise.
A row's proof is the digests beside its way to the root; with them its digest folds to the root again.

A tree is built in blocks of 3 ** 5 rows, so that a source of any size is many tasks. Within a block a node
of level k is held by its first leaf, the row whose place is divisible by 3 ** k: its siblings stand at the
fixed offsets 3 ** k and 2 * 3 ** k before and behind it, which lag and lead read, masked by the node's slot
and the length of its run; the first child's row hashes the parent. All five levels are windows over one
partitioning and one order, so they cost one shuffle. The blocks' nodes are the rows of the next tree up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import positions, store

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
# Levels built by one shuffle, and so the rows of a block.
LEVELS = 5
BLOCK = ARITY**LEVELS
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together; a null part is empty."""
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]).cast("binary"), 256)


def leaf_digest(*values: str | Column) -> Column:
    """The digest of a row: `-` for a null, else the UTF-8 length of the value, a colon and the value."""
    told = [(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in told])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a row's digest and the digests beside its way give."""
    return F.aggregate(path, leaf, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "").cast("binary"), 256)


def _block_levels(nodes: DataFrame) -> DataFrame:
    """Adds `block`, `top`, the block's node on its first row, and `path`, the steps of each row inside its block.

    `nodes` has `tree, pos, n, hash`; `n` is the number of nodes of the tree.
    """
    at = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    rows = Window.partitionBy("tree", "block").orderBy("pos")
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own, steps = F.col("hash"), []
    for level in range(LEVELS):
        width = ARITY**level
        # Nodes of this level in the tree, this node's slot in its run, and the length of that run.
        count = F.expr(f"(n + {width - 1}) div {width}")
        index = F.expr(f"pos div {width}")
        slot = index % ARITY
        run = F.least(F.lit(ARITY), count - (index - slot))
        holds, many = F.col("pos") % width == 0, count > 1
        at = at.withColumn("_own", own)
        # One window reads what stands beside the node, a second expression hashes the parent.
        beside = {k: (F.lag("_own", -k * width) if k < 0 else F.lead("_own", k * width)).over(rows) for k in (-2, -1, 1, 2)}
        at = at.select("*", *[c.alias(f"_beside{k}") for k, c in beside.items()])
        near = {k: F.when((slot + k >= 0) & (slot + k < run), F.col(f"_beside{k}")).otherwise("") for k in beside}
        at = at.withColumn(f"_before{level}", F.when(holds & many, F.concat(near[-2], near[-1])))
        at = at.withColumn(f"_after{level}", F.when(holds & many, F.concat(near[1], near[2])))
        parent = F.when(many, digest(F.col("_own"), near[1], near[2])).otherwise(F.col("_own"))
        at = at.withColumn(f"_node{level}", F.when(F.col("pos") % (width * ARITY) == 0, parent)).drop("_own", *[f"_beside{k}" for k in beside])
        own = F.col(f"_node{level}")
        # Other rows take the steps of the node above them from the row that holds it, the last one before.
        side = [F.last(f"_{name}{level}", ignorenulls=True).over(so_far).alias(name) for name in ("before", "after")]
        steps.append(F.when(many, F.struct(*side)))
    path = F.filter(F.array(*steps), lambda step: step.isNotNull()).cast(PATH)
    kept = [c for c in at.columns if not c.startswith("_")]
    return at.select(*kept, F.when(F.col("pos") % BLOCK == 0, own).alias("top"), path.alias("path"))


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes each tree of blocks starts from, leaves first, and `tree, n, root` of every tree.

    `nodes` has `tree, pos, n, hash` and is stored.
    """
    floors, largest = [nodes], nodes.agg(F.max("n")).collect()[0][0] or 0
    while True:
        blocks = _block_levels(floors[-1]).where(F.col("top").isNotNull())
        tops = store(blocks.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("hash")))
        if largest <= BLOCK:
            return floors, tops.select("tree", F.col("hash").alias("root"))
        floors.append(tops)
        largest = -(-largest // BLOCK)


def _descend(floors: list[DataFrame], roots: DataFrame) -> DataFrame:
    """Adds to the leaves `path`, to the root of all, and the columns of `roots`, which has `tree, path` and more.

    A tree's steps are joined to its topmost nodes, theirs to the blocks below, so that a join's key has the
    rows of a block at most, however many a tree has.
    """
    more = [c for c in roots.columns if c not in ("tree", "path")]
    above = roots.select("tree", F.lit(0).cast("long").alias("block"), F.col("path").alias("_above"), *more)
    for k, nodes in reversed(list(enumerate(floors))):
        here = _block_levels(nodes).drop("top").join(above, ["tree", "block"])
        here = here.withColumn("path", F.concat("path", "_above")).drop("block", "_above")
        if k:
            above = store(here.select("tree", F.col("pos").alias("block"), F.col("path").alias("_above"), *more))
    return here


def proofs(docs: DataFrame, fields: tuple[str, ...] = FIELDS, source="source", doc_id="doc_id", keep: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Each row's proof, and each source's subroot.

    The first has `doc_id, source, leaf, subroot, root, path` for every row and the columns of `keep`,
    named expressions over `docs`; `path` holds, from the leaf up, the digests before and after it in its
    run. The second has `source, n_leaves, subroot, root`.

    A null field is `-`, so it differs from an empty text; a text counts as a whole, however long. Rows
    without a source are a source, the first one; rows without an id come first in theirs. Rows of one id
    stand by their digests; equal rows are leaves of their own, with equal digests and different proofs. A
    source of one row has it as its subroot, one source is the root. No rows, no proofs and no sources.
    """
    leaf = leaf_digest(*fields)
    # The mark makes the missing source a name of its own, below all others.
    tree = F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit("0"))
    extra = [c.alias(f"keep_{name}") for name, c in (keep or {}).items()]
    leaves = store(docs.select(tree.alias("tree"), F.col(doc_id).alias("id"), leaf.alias("hash"), *extra))
    floors, subroots = _climb(store(positions(leaves, ["tree"], ["id", "hash"])))
    counts = floors[0].where("pos = 0").select("tree", F.col("n").alias("n_leaves"))
    subroots = store(subroots.join(counts, "tree").select(F.lit(0).alias("all"), F.col("tree").alias("name"), F.col("root").alias("hash"), "n_leaves"))
    ordered = store(positions(subroots, ["all"], ["name"]).withColumnRenamed("all", "tree"))
    source_floors, whole = _climb(ordered)
    joined = _descend(source_floors, whole.withColumn("path", F.array().cast(PATH)))
    sources = store(joined.select(F.col("name").alias("tree"), "n_leaves", F.col("hash").alias("subroot"), "root", "path"))
    found = _descend(floors, sources.drop("n_leaves"))
    name = F.when(F.col("tree") != "0", F.substring("tree", 2, 2**31 - 1))
    kept = [F.col(f"keep_{k}").alias(k) for k in keep or {}]
    rows = found.select(F.col("id").alias("doc_id"), name.alias("source"), F.col("hash").alias("leaf"), "subroot", "root", "path", *kept)
    return rows, sources.select(name.alias("source"), "n_leaves", "subroot", "root")


def write_manifest(docs: DataFrame, folder: str, **options) -> None:
    """Writes the manifest to `folder`: `leaves` with every row's digest and proof, `sources` with the subroots and the root."""
    rows, sources = proofs(docs, **options)
    rows.write.parquet(f"{folder}/leaves")
    sources.write.parquet(f"{folder}/sources")
