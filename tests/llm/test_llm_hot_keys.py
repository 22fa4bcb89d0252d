"""A third of all rows under one key and a third under none, for operators that work by key; and FTRL in plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import documents, prose

from tidemark.llm import chat_format, decontamination, license_scan, mixing, near_dedup, quality_classifier, rule_cascade, sharding, token_counts
from tidemark.llm.common import WordHashes
from tidemark.llm.linear import Ftrl, features, score, train, train_classes

# Chat formatting in blocks


def brute_digests(rows):
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, own in by.items():
        said = "".join(f"{role}\n{text}\n" for role, text in own)
        learned = "".join(text for role, text in own if role == "assistant")
        chars = sum(24 + len(chat_format.escape(role)) + len(chat_format.escape(text)) for role, text in own)
        out[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), chars)
    return out


def test_a_long_conversation_is_many_blocks(spark):
    rng = random.Random(1)
    rows = [(c, rng.randrange(900), rng.choice(["user", "assistant", None]), prose(k, 12)) for k in range(900) for c in [(None, 7, k % 40 + 100)[k % 3]]]
    rows += [(8, 1, "assistant", prose(3, 4000)), (8, 0, "user", "short"), (7, 5, "user", "same"), (7, 5, "user", "same")]
    turns = spark.createDataFrame([(*r, 0, 1) for r in rows], "conv_id long, turn long, role string, text string, block long, task long").repartition(6)
    formatted = chat_format.format_conversations(turns, block_tokens=300)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_format.digests(formatted).collect()}
    assert got == brute_digests(rows)
    blocks = formatted.collect()
    longest = max(len(token_counts.encoder(token_counts.TOKENIZER).encode_ordinary(r[3])) for r in rows)
    by = {}
    for r in blocks:
        assert len(r["input_ids"]) == len(r["loss_mask"]) <= 300 + longest + 20
        by.setdefault(r["conv_id"], []).append(r)
    assert len(by[7]) > 20 and len(by[None]) > 20
    for own in by.values():
        own.sort(key=lambda r: r["block"])
        assert [r["block"] for r in own] == list(range(len(own))) and {r["n_blocks"] for r in own} == {len(own)}
        assert [r["first_token"] for r in own] == [sum(len(b["input_ids"]) for b in own[:k]) for k in range(len(own))]


# Sharding


@pytest.mark.parametrize("ids", ["null", "one"])
def test_shards_are_even_with_a_third_of_the_rows_under_one_id(spark, ids):
    hot = None if ids == "null" else 5
    docs = documents(spark, [(k if k % 3 else hot, prose(k, 5 + k % 90), "s") for k in range(3000)])
    slot_map, weights = sharding.stored_map(docs, 8)
    loads = Counter()
    for r in sharding.place_records(docs, slot_map).select("placed.*").collect():
        loads[r["shard"]] += r["size"]
    assert len(loads) == 8 and max(loads.values()) < 1.02 * min(loads.values())
    assert weights.agg(F.max("records")).first()[0] < 20


def test_a_map_is_edited_and_both_versions_stay(spark, tmp_path):
    docs = documents(spark, [(k, prose(k, 30), "s") for k in range(1500)])
    first, weights = sharding.stored_map(docs, 4, folder=str(tmp_path / "map"))
    edited = sharding.edited_map(first, weights, 4, str(tmp_path / "map"))
    before, after = ({r["virtual_slot"]: r["shard"] for r in m.collect()} for m in (sharding.load_map(spark, str(tmp_path / "map"), 0), edited))
    assert {after[s] for s in before if before[s] != after[s]} == {4} and edited.first()["version"] == 1


# Quality classifier


def test_one_text_of_a_labelled_id_is_learned_from(spark):
    hot = 4001
    rows = [(k, prose(k, 30) if k % 4 else "### ".join(prose(k, 30).split()), "s") for k in range(300)] + [(hot, prose(9000 + k, 20), "s") for k in range(600)] + [(None, prose(k, 5), "s") for k in range(300)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(300)] + [(hot, 1)], "doc_id long, quality int")
    one = min((t for i, t, _ in rows if i == hot), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    single = documents(spark, [r for r in rows if r[0] != hot] + [(hot, one, "s")])
    assert np.array_equal(quality_classifier.train_model(docs, labels), quality_classifier.train_model(single, labels))
    assert np.array_equal(quality_classifier.train_model(docs, labels), quality_classifier.train_model(docs.repartition(7), labels))


def plain_ftrl(examples, s):
    """Follow the regularised leader, one coordinate at a time."""
    z, n, last = Counter(), Counter(), 1 << s.bits

    def weight(i):
        l1 = 0.0 if i == last else s.l1
        if abs(z[i]) <= l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)

    for _ in range(s.passes(len(examples))):
        for index, value, label in examples:
            w = {i: weight(i) for i in index}
            margin = sum(w[i] * v for i, v in zip(index, value))
            p = 1 / (1 + np.exp(-margin))
            for i, v in zip(index, value):
                g = (p - label) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in {*z, last}}


def test_training_and_scores_against_plain_python():
    settings, hashes = Ftrl(bits=12, updates=300), WordHashes()
    texts = [prose(k, 15 + k % 20).encode() if k % 3 else b" ".join([b"spam!"] * (5 + k % 4)) for k in range(60)]
    examples = [(*features(t, hashes, 12), float(k % 3 > 0)) for k, t in enumerate(texts)]
    got = train(examples, settings)
    want = plain_ftrl([(i.tolist(), v.tolist(), y) for i, v, y in examples], settings)
    assert got[sorted(want)] == pytest.approx([want[i] for i in sorted(want)], abs=1e-9)
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values())
    for t, (index, value, _) in zip(texts, examples):
        margin = sum(want.get(i, 0.0) * v for i, v in zip(index.tolist(), value.tolist()))
        assert score(t, got, hashes, 12) == pytest.approx(1 / (1 + np.exp(-margin)))
    both = train_classes([e[:2] for e in examples], np.array([[y, 1 - y] for *_, y in examples]), settings)
    assert both[:, 0] == pytest.approx(got) and both.shape == (4097, 2)


# Mixing


def test_bins_are_small_whatever_the_weights(spark):
    docs = documents(spark, [(k, "#" * 50 + " " + prose(k, 2), "low") for k in range(20_000)])
    rows = mixing._sampled(docs, "doc_id", "text", "source", "mix", F.lit(0.1))
    assert rows.groupBy("bin").count().agg(F.max("count")).first()[0] < 20


def test_weights_by_a_column_decide_what_is_taken(spark):
    rows = [(k, prose(k, 20), "a") for k in range(400)] + [(1000 + k, prose(k, 4), "b") for k in range(3000)]
    docs = documents(spark, rows).withColumn("worth", F.when(F.col("doc_id") % 2 == 0, 1.0).when(F.col("doc_id") % 10 == 1, None).otherwise(0.001))
    got = mixing.mix_documents(docs, weights=(1.0, 8.0), quality=F.col("worth")).select("doc_id", "source", "mix.*").collect()
    part = [r for r in got if r["source"] == "a"]
    good, bad = (sum(r["taken"] for r in part if r["doc_id"] % 2 == k) for k in (0, 1))
    assert abs(good + bad - part[0]["target"]) <= 1 and good > 3 * bad


# Quality rules


def test_the_sample_is_measured_where_it_lies(spark):
    docs = documents(spark, [(None if k % 3 else k, prose(k, 10 + k % 30), "s") for k in range(3000)])
    plan = rule_cascade.estimate(docs, sample_rows=200)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan.replace("SortAggregate", "")
    rows = rule_cascade.estimate(docs, sample_rows=200).collect()
    assert len(rows) == len(rule_cascade.RULES) and 100 < rows[0]["n_sampled"] < 320


def test_a_measure_is_taken_once():
    taken = []

    class Counting(WordHashes):
        def of(self, words):
            taken.append(len(words))
            return super().of(words)

    text = rule_cascade.Text(prose(1, 50).encode(), Counting())
    assert [rule.rejects(text) for rule in rule_cascade.RULES] == [False] * 7 and text.n_repeat_words == 0 and taken == [50]


# Licences


def test_near_misses_are_unknown_and_no_family(spark):
    near = [
        "Permission is hereby granted to print this page, free of charge, for private study.", "Redistribution of the data is not permitted without written consent.",
        "By using this website you agree to these terms of use.", "Licensed under the terms of the agreement with the vendor.",
        "You may not use this file except with the permission of the editor.", "Released under the Acme License.",
    ]
    rows = [(k, prose(k, 80), "s") for k in range(150)] + [(1000 + k, f"{prose(k, 30)}\n\n{t}\n\n{prose(k + 1, 30)}", "s") for k, t in enumerate(near)]
    rows += [(2000 + k, "\n".join([prose(k, 8), *[" ".join(t.split()[j : j + 5]) for j in range(0, len(t.split()), 5)]]), "s") for k, t in enumerate(near)]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(documents(spark, rows)).collect()}
    assert all(r["licenses"] == [] for r in got.values())
    assert sum(got[i]["n_unknown"] > 0 for i in got if i >= 1000) >= 8
    with pytest.raises(ValueError, match="fits no piece"):
        license_scan._template("word " * 41)


# Decontamination


def test_many_blocks_cut_what_one_block_cuts(spark):
    items = spark.createDataFrame([(k, prose(500 + k, 25)) for k in range(12)] * 2, "item_id long, text string")
    passages = [prose(500 + k, 25).split() for k in range(12)]
    rows = [(k, f"{prose(k, 10)} {' '.join(passages[k % 12][3:20])} end {prose(k, 6)}", "s") for k in range(60)]
    # What a cut brings together is an item again; and a text with nothing else in it.
    inner, outer = " ".join(passages[1]), passages[2]
    rows += [(200, " ".join([*outer[:12], inner, *outer[12:]]), "s"), (201, " ".join(passages[3]), "s"), (202, None, "s"), (203, "clean text", "s")]
    docs = documents(spark, rows)
    one, many = (decontamination.decontaminate(docs, items, block_words=n) for n in (400_000, 60))
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)
    assert one.columns == many.columns == docs.columns
    assert not {200, 201} & {r["doc_id"] for r in many.collect()} and {202, 203} <= {r["doc_id"] for r in many.collect()}


# Near-duplicates


def test_bitmaps_rule_out_no_similar_pair(spark):
    rng, hashes = random.Random(6), WordHashes()
    pairs = []
    for k in range(300):
        words = prose(k, rng.choice([8, 40, 300])).split()
        other = [w if rng.random() > rng.choice([0.01, 0.05, 0.2]) else f"x{rng.randrange(99)}" for w in words]
        pairs.append([near_dedup.shingles(" ".join(t).encode(), hashes) for t in (words, other)])
    rows = [(near_dedup.overlap(a, b), len(a), len(b), near_dedup.parities(near_dedup.elements(a)), near_dedup.parities(near_dedup.elements(b))) for a, b in pairs]
    df = spark.createDataFrame(rows, "similarity double, n long, m long, a array<long>, b array<long>")
    judged = df.select("similarity", near_dedup._may_be_similar(F.col("n"), F.col("m"), F.col("a"), F.col("b"), 0.8).alias("may")).collect()
    assert all(r["may"] for r in judged if r["similarity"] >= 0.8) and any(r["similarity"] >= 0.8 for r in judged)
    assert sum(not r["may"] for r in judged if r["similarity"] < 0.6) > 50
