"""Chat formatting at the level of tokens.

Every segment - a turn's marker, role and text - is encoded on its own, and reserved ids that no text
can produce are spliced between them. The loss mask comes from prefix sums over segment lengths. The
output is blocks of turns, so that a conversation of any length is many rows and many tasks.
Control strings inside texts are escaped, so the decoded string can be parsed back as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, store
from tidemark.llm.token_counts import TOKENIZER, encoder

START, END = "<|im_start|>", "<|im_end|>"
# The role whose texts are learned from.
LEARNED = "assistant"
# A control string is a bar after a bracket, with any number of escapes between; escaping adds one.
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
# A block of turns is closed when it has so many tokens.
BLOCK_TOKENS = 1 << 16


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _coder(tokenizer: str):
    """The vocabulary and its two reserved ids, the first that it leaves free."""
    plain = encoder(tokenizer)
    first = plain.max_token_value + 1
    return encoder(tokenizer, {START: first, END: first + 1}), first, first + 1


def _ordered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """`conv_id, turn, role, text` in order over all tasks; a conversation may go on from one task to the next."""
    read = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )
    # Repeated rows part by their arrival, so that they are no hot key of the sort.
    arrived = small_batches(read).withColumn("_arrival", F.monotonically_increasing_id())
    return arrived.orderBy("conv_id", "turn", "role", "text", "_arrival").drop("_arrival")


def _splice(ordered: DataFrame, tokenizer: str, block_tokens: int) -> DataFrame:
    """Blocks of turns as they stream by, each with its place in its task's part of the conversation."""

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, start, end = _coder(tokenizer)
        line_break = coder.encode_ordinary("\n")
        task = TaskContext.get().partitionId()
        segments: list[list[int]] = []
        learned: list[bool] = []
        current, n_turns, n_tokens, block, offset = None, 0, 0, 0, 0

        def finished() -> pa.RecordBatch:
            # Each segment's ends are prefix sums; learned segments open and close the mask there.
            ends = np.cumsum([len(s) for s in segments])
            edges = np.zeros(int(ends[-1]) + 1, np.int8)
            for last, segment, own in zip(ends, segments, learned, strict=True):
                if own:
                    edges[last - len(segment)] += 1
                    edges[last] -= 1
            mask = np.cumsum(edges[:-1]) > 0
            ids = np.fromiter((i for s in segments for i in s), np.int32, int(ends[-1]))
            values = [pa.array([v], pa.int64()) for v in (current, task, block, offset, n_turns)]
            return pa.RecordBatch.from_arrays(
                [*values, pa.array([ids], pa.list_(pa.int32())), pa.array([mask], pa.list_(pa.bool_()))],
                ["conv_id", "task", "part", "offset", "n_turns", "input_ids", "loss_mask"],
            )

        for batch in batches:
            for conversation, who, said in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                if n_turns and (conversation != current or n_tokens >= block_tokens):
                    yield finished()
                    block, offset = (block + 1, offset + n_tokens) if conversation == current else (0, 0)
                    segments, learned, n_turns, n_tokens = [], [], 0, 0
                current, n_turns = conversation, n_turns + 1
                own = [[start], coder.encode_ordinary(escape(who) + "\n"), coder.encode_ordinary(escape(said)), [end, *line_break]]
                segments += own
                learned += [False, False, who == LEARNED, False]
                n_tokens += sum(map(len, own))
        if n_turns:
            yield finished()

    return ordered.mapInArrow(splice, "conv_id long, task long, part long, offset long, n_turns long, input_ids array<int>, loss_mask array<boolean>")


def format_conversations(
    turns: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text", tokenizer: str = TOKENIZER, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """`conv_id, block, n_blocks, first_token, n_turns, input_ids, loss_mask`: the conversations in blocks of turns.

    A turn is the start id, its role and a line break, its text, the end id and a line break. The mask
    covers the ids of assistant texts alone. Rows are ordered by turn; equal or missing numbers by
    role and text, missing first; a repeated row is a turn of its own. Rows without a conversation id
    are one conversation, whose id is null. Null texts and roles are empty. No rows, no conversations.

    A block is closed by the turn that brings it to `block_tokens`, so no row holds much more than that or
    one turn, however long the conversation; a very long text is one turn. The blocks of a conversation,
    numbered from 0, follow each other, and `first_token` is where a block begins in it. Rows are
    sorted over all tasks, and each task encodes and splices its own; of a conversation that goes on
    over several tasks only the sums of each task are put together.
    """
    blocks = store(_splice(_ordered(turns, conv_id, turn, role, text), tokenizer, block_tokens))
    sums = blocks.groupBy("conv_id", "task").agg(F.count(F.lit(1)).alias("parts"), F.sum(F.size("input_ids")).alias("tokens"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("_conv"), F.col("task").alias("_task"), F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("_blocks"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("_tokens"), F.sum("parts").over(whole).alias("n_blocks"),
    )
    # A conversation of several blocks is of many tokens or lies on a border between two tasks. The many-token
    # ones are as many as there are blocks' worth of tokens, so this side is not broadcast unless it is small.
    several = sums.where("n_blocks > 1")
    placed = blocks.join(several, blocks["conv_id"].eqNullSafe(F.col("_conv")) & (F.col("task") == F.col("_task")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return placed.select(
        "conv_id", (F.col("part") + zero(F.col("_blocks"))).alias("block"), F.coalesce("n_blocks", F.lit(1)).alias("n_blocks"),
        (F.col("offset") + zero(F.col("_tokens"))).alias("first_token"), "n_turns", "input_ids", "loss_mask",
    )


def read_back(ids: np.ndarray, mask: np.ndarray, tokenizer: str = TOKENIZER) -> tuple[list[tuple[str, str]], str, str]:
    """What an output row says: its turns, the text under the mask, unescaped, and the whole string."""
    coder, start, end = _coder(tokenizer)
    turns, learned = [], []
    starts, ends = np.flatnonzero(ids == start), np.flatnonzero(ids == end)
    for first, last in zip(starts.tolist(), ends.tolist(), strict=True):
        role, _, said = coder.decode(ids[first + 1 : last].tolist()).partition("\n")
        turns.append((unescape(role), unescape(said)))
    # Parts of the mask that do not touch are texts of their own.
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    for first, last in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        learned.append(unescape(coder.decode(ids[first:last].tolist())))
    return turns, "".join(learned), coder.decode(ids.tolist())


def _told(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """What each block says: its turns as one text, what is learned from, and the length of the formatted string."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(len(batch)):
                ids, mask = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (4, 5))
                turns, learned, whole = read_back(ids, mask, tokenizer)
                rows.append((len(turns), "".join(f"{role}\n{text}\n" for role, text in turns).encode(), len(learned), learned.encode(), len(whole)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["conv_id", "block", "n_blocks", "n_turns", "said", "loss_chars", "learned", "formatted_chars"],
            )

    rows = formatted.select("conv_id", "block", "n_blocks", "n_turns", "input_ids", "loss_mask")
    return rows.mapInArrow(read, "conv_id long, block long, n_blocks long, n_turns long, said binary, loss_chars long, learned binary, formatted_chars long")


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What `read_back` finds in each conversation, as counts and sha256 digests.

    Every block is read where it lies. A digest runs over a conversation's blocks one after the other, which
    is inherent to it; no more than a few blocks are held at a time.
    """
    told = _told(formatted, tokenizer)
    one = told.where("n_blocks = 1").select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), "loss_chars", F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums, hashes = None, [0, 0, 0], []

        def row() -> pa.RecordBatch:
            values = [at[0], sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conversation, n, said, chars, learned, whole in zip(*(batch.column(c) for c in (0, 3, 4, 5, 6, 7)), strict=True):
                if at != (conversation.as_py(),):
                    if at is not None:
                        yield row()
                    at, sums, hashes = (conversation.as_py(),), [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
                sums = [have + more.as_py() for have, more in zip(sums, (n, chars, whole), strict=True)]
                hashes[0].update(said.as_buffer())
                hashes[1].update(learned.as_buffer())
        if at is not None:
            yield row()

    several = told.where("n_blocks > 1").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return one.unionByName(several.mapInArrow(run, _DIGESTS))
