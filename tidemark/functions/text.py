"""Column functions over text: masking, words, chunks, sentences, the hash embedding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# What counts as an e-mail address and as a Vietnamese phone number.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(\+84|0)[ .-]?[0-9]{2,3}[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}"

# Finds exactly what EMAIL finds. A match can only begin at the start of a run of name characters or
# where the previous match ended; saying so keeps the scan linear on long runs without an '@'.
_EMAIL_SCAN = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

# Unicode white space plus the four ASCII separators that Python's str.split also honours.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_NEWLINE = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\u2028\u2029]"
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]++|(?<![\s\x1c-\x1f])[\s\x1c-\x1f]++\z"
# Letters, digits and underscore of any script, without combining marks.
_TOKEN = r"[\p{L}\p{N}_]+"

EMBEDDING_SIZE = 16


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mask_pii(text: Column) -> Column:
    """Replace e-mail addresses, then phone numbers. Null stays null; names are not touched."""
    no_mail = F.regexp_replace(text, F.lit(_EMAIL_SCAN), F.lit("<EMAIL>"))
    return F.regexp_replace(no_mail, F.lit(PHONE), F.lit("<PHONE>"))


def register_sql_functions(spark: SparkSession) -> None:
    """Makes `mask_pii(text)` callable from SQL in this session, as an SQL function of the same patterns."""
    literal = lambda s: "r'" + s + "'"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_pii(text STRING) RETURNS STRING RETURN "
        f"regexp_replace(regexp_replace(text, {literal(_EMAIL_SCAN)}, '<EMAIL>'), {literal(PHONE)}, '<PHONE>')"
    )


def has_pii(text: Column) -> Column:
    return text.rlike(_EMAIL_SCAN) | text.rlike(PHONE)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_EDGE_SPACE), F.lit(""))


def words(text: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def norm_text(text: Column) -> Column:
    """Lower case with every run of white space made one blank; null becomes ''."""
    return F.array_join(words(F.lower(F.coalesce(text, F.lit("")))), " ")


def chunk_words(text: Column, size: int, overlap: int) -> Column:
    """Windows of `size` words, each starting `size - overlap` words after the one before.

    The last window is the first to reach the end of the text. No words, no windows.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than size")
    step = size - overlap

    def windows(all_words: Column) -> Column:
        count = F.greatest(F.lit(1), F.ceil((F.size(all_words) - overlap) / step)).cast("int")
        joined = F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda i: F.array_join(F.slice(all_words, i * step + 1, size), " "),
        )
        return F.when(F.size(all_words) > 0, joined).otherwise(F.array().cast("array<string>"))

    return bind(words(text), windows)


def text_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def hash_embed(text: Column) -> Column:
    """Count tokens in 16 buckets (md5 of the token modulo 16), scale to length 1, round to 6 places."""
    # md5 modulo 16 is its last hex digit.
    tokens = F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))
    digits = F.array_join(F.transform(tokens, lambda t: F.substring(F.md5(t.cast("binary")), 32, 1)), "")

    def unit(counts: Column) -> Column:
        length = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c))
        return F.transform(counts, lambda c: F.round(c / F.when(length > 0, length).otherwise(1.0), 6))

    def counts(ds: Column) -> Column:
        # How often a digit occurs is how much shorter the string of digits is without it.
        buckets = [F.lit(format(b, "x")) for b in range(EMBEDDING_SIZE)]
        return F.array(*[(F.length(ds) - F.length(F.replace(ds, b, F.lit("")))).cast("double") for b in buckets])

    return bind(bind(digits, counts), unit)


def sentences(text: Column) -> Column:
    """Sentences of all lines that are neither blank nor headings ('#...')."""
    lines = F.transform(F.split(text, _NEWLINE), strip)
    kept = F.filter(lines, lambda line: (line != "") & ~line.startswith("#"))
    pieces = F.flatten(F.transform(kept, lambda line: F.split(line, r"(?U)(?<=[.!?])[\s\x1c-\x1f]+")))
    return F.filter(F.transform(pieces, strip), lambda s: s != "")


def transcript_text(turns: Column) -> Column:
    """One 'role: text' line per turn."""
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit(": "), t["text"]))
    return F.array_join(lines, "\n")
