import hashlib
import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import entities, fingerprints, labels, text, times

ODD_SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　"
TEXTS = st.lists(st.text(alphabet="abZ.!?#0é ß1_-@%" + ODD_SPACES, max_size=60), min_size=1, max_size=40)


def over(spark, values, *columns):
    """Columns of `F.col('s')` over a list of strings, in the order of the list."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def windows(s, size, overlap):
    w = s.split()
    starts = range(0, max(len(w) - overlap, 1), size - overlap) if w else []
    return [" ".join(w[i : i + size]) for i in starts]


def embedding(s):
    # The low four bits of the digest's last byte are the digest modulo 16.
    buckets = Counter(hashlib.md5(token.encode()).digest()[-1] & 15 for token in re.findall(r"\w+", s.lower()))
    length = math.hypot(*(buckets[b] for b in range(16)))
    return [round(buckets[b] / length, 6) if length else 0.0 for b in range(16)]


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_words_norm_and_chunks_follow_python_splitting(spark, values):
    got = over(spark, values, text.words(F.col("s")), text.norm_text(F.col("s")), text.chunk_words(F.col("s"), 4, 1))
    for s, (w, norm, chunks) in zip(values, got):
        assert w == s.split()
        assert norm == " ".join(s.lower().split())
        assert chunks == windows(s, 4, 1)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 39, 40, 41, 71, 72, 73, 100, 104, 105])
def test_chunk_windows_at_their_edges(spark, n):
    s = " ".join(f"w{i}" for i in range(n))
    assert over(spark, [s], text.chunk_words(F.col("s"), 40, 8))[0][0] == windows(s, 40, 8)


def test_neighbouring_chunks_share_their_overlap(spark):
    s = " ".join(f"word{i % 7}-{i}" for i in range(61))
    found = [c.split() for c in over(spark, [s], text.chunk_words(F.col("s"), 13, 5))[0][0]]
    assert all(a[-5:] == b[:5] for a, b in zip(found, found[1:])) and len(found) == 7


def test_overlap_must_be_smaller_than_size():
    with pytest.raises(ValueError):
        text.chunk_words(None, 4, 4)


def test_embedding_matches_brute_force(spark):
    values = ["", "b a b", "le prix est de 12 euros", "two_parts ÜBER ü", "y" * 70, "?!", "４ ٥"]
    for s, (vector,) in zip(values, over(spark, values, text.hash_embed(F.col("s")))):
        assert vector == pytest.approx(embedding(s), abs=1e-9)


MASKED = "Reach sales+eu@shop.example.org or x_1@a-b.io; call +84.28.123.4567 before 12:30, room 7, total 45,50 EUR"


def test_mask_replaces_addresses_and_numbers_only(spark):
    want = "Reach <EMAIL> or <EMAIL>; call <PHONE> before 12:30, room 7, total 45,50 EUR"
    assert over(spark, [MASKED, None], text.mask_pii(F.col("s"))) == [(want,), (None,)]


def test_the_mask_is_a_function_of_sql_too(spark):
    text.register_sql_functions(spark)
    values = [MASKED, None, "a@b.co.x@y.zz 0912345678", "it's \\ plain"]
    df = spark.createDataFrame([(v,) for v in values], "s string").select("s", text.mask_pii(F.col("s")).alias("m"))
    assert df.selectExpr("mask_pii(s) AS n", "m").where("NOT (n <=> m)").count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab.@c%0+84 -9", max_size=40), min_size=1, max_size=60))
def test_mask_finds_what_the_plain_patterns_find(spark, values):
    fixed = ["a@b.co.x@y.zz", "a@b.cc@d.ee", "x@y.zzz%q@r.ss", "@@a@b.cc", "a" * 40 + "@b.cc"]
    values = values + fixed
    for s, (masked, leaks) in zip(values, over(spark, values, text.mask_pii(F.col("s")), text.has_pii(F.col("s")))):
        assert masked == re.sub(text.PHONE, "<PHONE>", re.sub(text.EMAIL, "<EMAIL>", s))
        assert leaks == bool(re.search(text.EMAIL, s) or re.search(text.PHONE, s))


def test_long_run_without_an_at_sign_is_scanned_in_linear_time(spark):
    s = "a" * 400_000
    assert over(spark, [s], F.length(text.mask_pii(F.col("s"))))[0][0] == len(s)


def python_sentences(s):
    # White space after a stop becomes a line break; what is left of headings and blanks goes.
    lines = [line.strip() for line in s.splitlines()]
    broken = "\n".join(re.sub(r"([.!?])\s+", r"\1\n", line) for line in lines if line[:1] != "#")
    return [sentence.strip() for sentence in broken.split("\n") if sentence.strip()]


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_sentences_match_brute_force(spark, values):
    values = values + ["# head. line\nOne. Two! Three?x\n\n  # no\r\nFour.", ""]
    for s, (found,) in zip(values, over(spark, values, text.sentences(F.col("s")))):
        assert found == python_sentences(s)


def test_transcript_lines(spark):
    df = spark.sql("SELECT array(named_struct('role', 'a', 'text', 'x'), named_struct('role', 'b', 'text', 'y z')) AS t")
    assert df.select(text.transcript_text(F.col("t"))).first()[0] == "a: x\nb: y z"


def test_times(spark):
    iso = ["2026-08-12T21:10:00Z", "2026-08-12T21:10:00+07:00", "2026-08-12 21:10:00.5", "2026-08-12", "soon", "2026", None]
    got = [str(r[0]) for r in over(spark, iso, times.from_iso(F.col("s")))]
    assert got == ["2026-08-12 21:10:00", "2026-08-12 14:10:00", "2026-08-12 21:10:00.500000", "2026-08-12 00:00:00", "None", "None", "None"]
    unix = ["1786784402", "1786784402000", "-5.5", "20000000000", "x1", "2026-08-12T21:10:00Z"]
    got = [str(r[0]) for r in over(spark, unix, times.from_event_time(F.col("s")))]
    assert got == ["2026-08-15 09:00:02", "2026-08-15 09:00:02", "1969-12-31 23:59:54.500000", "2603-10-11 11:33:20", "None", "2026-08-12 21:10:00"]
    row = spark.range(1).select(times.from_millis(F.lit(1786784402000)), times.from_micros(F.lit(1786784402000001))).first()
    assert [str(v) for v in row] == ["2026-08-15 09:00:02", "2026-08-15 09:00:02.000001"]
    beyond = ["99999999999999999999", "99999999999999999", "-99999999999999999", "253402300799", "9" * 40]
    assert [str(r[0]) for r in over(spark, beyond, times.from_event_time(F.col("s")))] == ["None", "None", "None", "1978-01-11 21:31:40.799000", "None"]


def test_labels(spark):
    tickets = ["App CRASH", "Hoá đơn sai", "xuất file lỗi", "hello", None]
    answers = [r[0] for r in over(spark, tickets, labels.keyword_answer(F.col("s")))]
    assert answers[0] == '{"label": "bug"}' and answers[1] == '{"label": "billing"}' and answers[3] == '{"label": "other"}'
    assert "export" in answers[2] and answers[4] is None
    raw = ['Sure! {"label": "bug"} ok', '{"label": "export"}', "no json", '{"label": bug}', '{"a": {"b": 1},\n"label": "other"}', '{"label": "bug"} }', '{"label": 1}']
    assert [r[0] for r in over(spark, raw, labels.parse_label(F.col("s")))] == ["bug", None, None, None, "other", None, None]
    tokens = over(spark, ["a b  c"], labels.token_estimate(labels.prompt(F.col("s"))))[0][0]
    assert tokens == len((labels.PROMPT_HEAD + "a b  c").split()) + 8


def test_entities(spark):
    names = [" The Widgets. ", "an accessory", "Industrial-parts", "theory", "a the b", "..x.."]
    assert [r[0] for r in over(spark, names, entities.canon_entity(F.col("s")))] == ["widget", "accessory", "industrial-part", "theory", "the b", "x"]


def test_checksum_sees_values_names_and_copies_but_not_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    same = spark.createDataFrame([(2, None), (1, "x")], "a int, b string").repartition(3)
    assert fingerprints.checksum(a) == fingerprints.checksum(same)
    others = [a.unionByName(a), a.withColumnRenamed("b", "c"), a.fillna("x"), a.limit(0)]
    assert len({fingerprints.checksum(d) for d in [a, *others]}) == 5
    assert fingerprints.combined_checksum(["a", "b"]) == hashlib.md5(b"a|b").hexdigest()
