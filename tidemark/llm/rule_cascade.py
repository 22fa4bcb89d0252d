"""Quality rules as a short-circuit cascade, ordered by what a sample says about them.

Each rule looks at the text and may reject it. On a sample every rule is timed and its rejections are
counted; rules then run in the order of rejections per second, and a text that one rejects is not
looked at by the others. The order changes the cost and never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, ngrams, small_batches, texts

_SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
# The order is estimated on about so many documents, taken by chance from all over the table. The order
# changes what a verdict costs and never the verdict.
SAMPLE_ROWS = 2_000


class Text:
    """One text and what the rules measure of it, each measure taken when first asked for."""

    def __init__(self, text: bytes, hashes: WordHashes):
        self.text, self.hashes = text, hashes
        self.words = text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that do not continue a code point, less blanks."""
        joined = b"".join(self.words)
        return len(joined.decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, _SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [line for line in self.text.split(b"\n") if line.strip()]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows that are found at least twice in the text, the first ones included."""
        if len(self.words) < WINDOW:
            return 0
        windows = ngrams(self.hashes.of(self.words), WINDOW)
        _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
        edges = np.zeros(len(self.words) + 1, np.int64)
        starts = np.flatnonzero(counts[place] > 1)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        return int(np.count_nonzero(np.cumsum(edges[:-1])))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _too_short(t: Text) -> bool:
    return t.n_words < MIN_WORDS


def _repetitive(t: Text) -> bool:
    return 100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words


def _symbols(t: Text) -> bool:
    """More than one symbol in three words."""
    return 3 * t.n_symbols > t.n_words


def _duplicate_lines(t: Text) -> bool:
    """More than half of the lines are copies of earlier ones."""
    return 2 * t.n_dup_lines > 1 + t.text.count(b"\n")


def _shouting(t: Text) -> bool:
    """More than half of the words end in an exclamation mark."""
    return 2 * sum(w.endswith(b"!") for w in t.words) > t.n_words


def _stutter(t: Text) -> bool:
    """More than half of the words repeat the one before."""
    return 2 * sum(a == b for a, b in zip(t.words, t.words[1:], strict=False)) > t.n_words


def _long_words(t: Text) -> bool:
    """Words of more than 25 code points on average: no prose."""
    return t.word_chars > 25 * max(t.n_words, 1)


BASE_RULES = (Rule("too_short", _too_short), Rule("repetitive", _repetitive))
RULES = (
    *BASE_RULES, Rule("symbols", _symbols), Rule("duplicate_lines", _duplicate_lines),
    Rule("shouting", _shouting), Rule("stutter", _stutter), Rule("long_words", _long_words),
)


def estimate(docs: DataFrame, text="text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`rule, n_sampled, n_rejected, seconds`: every rule run alone on the sample.

    Each task measures the rows of its own part that are in the sample; no text leaves it.
    """
    # Of a Parquet table the count reads the file footers only.
    share = sample_rows / max(docs.count(), 1)
    picked = docs.select(F.col(text).alias("text"))
    picked = picked.sample(share, seed=9) if share < 1 else picked

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), 0
        rejected, seconds = np.zeros(len(rules), np.int64), np.zeros(len(rules))
        for batch in batches:
            for t in texts(batch.column(0)):
                seen += 1
                for k, rule in enumerate(rules):
                    # Alone: what other rules have measured of the text is not at hand.
                    own, began = Text(t, hashes), time.perf_counter()
                    rejected[k] += rule.rejects(own)
                    seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array([r.name for r in rules]), pa.array([seen] * len(rules), pa.int64()), pa.array(rejected), pa.array(seconds)],
            ["rule", "n_sampled", "n_rejected", "seconds"],
        )

    small_batches(docs)
    measured = picked.select("text").mapInArrow(measure, "rule string, n_sampled long, n_rejected long, seconds double")
    return measured.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("n_sampled", "n_rejected", "seconds")])


def ordered(estimates: list, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Rules by falling rejections per second; those that reject nothing come last, cheapest first."""
    by_name = {e["rule"]: e for e in estimates}

    def rank(rule: Rule):
        e = by_name.get(rule.name)
        if e is None or not e["n_sampled"]:
            return (0.0, 0.0, rule.name)
        return (-e["n_rejected"] / max(e["seconds"], 1e-9), e["seconds"], rule.name)

    return tuple(sorted(rules, key=rank))


def cascade(docs: DataFrame, doc_id="doc_id", text="text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, measures: bool = True) -> DataFrame:
    """`doc_id, kept, n_rules_run` of every row, and with `measures` the base measures of its text.

    A text is kept if no rule rejects it. `n_words` counts words between ASCII blanks, `word_chars`
    their code points, `n_symbols` the characters `#*$%&|<>`, `n_dup_lines` lines with a word that
    equal an earlier line, `n_repeat_words` words in 8-word windows found twice or more;
    `base_failed` says that one of the two base rules rejects. Null and empty texts have no words and
    fail. Rows that repeat, and null ids, are judged like all others; a text is judged whole by one task,
    however long. No rows, no result. `n_rules_run` is how far the cascade came, which depends on its order.
    """
    run = ordered(estimate(docs, text, rules, sample_rows).collect(), rules)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_rules_run int"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for t in texts(batch.column(1)):
                own, kept, n = Text(t, hashes), True, 0
                for n, rule in enumerate(run, 1):
                    if rule.rejects(own):
                        kept = False
                        break
                values = (None,) * 6
                if measures:
                    repeats = own.n_repeat_words
                    failed = own.n_words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * own.n_words
                    values = (own.n_words, own.word_chars, own.n_symbols, own.n_dup_lines, repeats, failed)
                rows.append((*values, kept, n))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_rules_run"],
            )

    result = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(judge, schema)
    return result if measures else result.select("doc_id", "kept", "n_rules_run")
