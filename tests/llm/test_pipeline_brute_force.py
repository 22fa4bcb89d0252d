"""The corpus pipeline, stage by stage and as a whole, against plain Python over a small table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from test_llm_operators import brute_classes, edited, prose

import corpus_pipeline
from tidemark.llm import quality_classifier
from tidemark.llm.common import WordHashes
from tidemark.llm.linear import score

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, `a.b` string, tags map<string,int>, mix long, placed int, row int"


def corpus():
    rng, rows = random.Random(2), []
    item = lambda k: prose(500 + k, 25)
    for k in range(160):
        text = prose(k, 25 + k % 40)
        if k % 5 == 1:
            text = " ".join(f"{w}!!!" for w in text.split())
        if k % 11 == 2:
            text = f"{text}\n{' '.join(item(k % 6).split()[2:18])}, {prose(900 + k, 7)}"
        rows.append([k, text, f"s{rng.randrange(3)}" if k % 9 else None])
    # Exact copies, near copies, a copy of a rejected text, a text that is an item, no text, no words.
    rows += [[300, rows[7][1], "s1"], [301, edited(prose(999, 90), 1, 1), "s0"], [302, prose(999, 90), "s0"], [303, rows[6][1], "s2"], [304, item(2), "s1"], [305, None, "s1"], [306, " ", "s0"], [307, "", None]]
    return [(i, t, "en", s, None if t is None else len(t), 5, "x", "dot", {"k": 1}, 7, 8, 9) for i, t, s in rows]


LABELS = [(k, int(k % 5 != 1)) for k in range(160)]
ITEMS = [(k, prose(500 + k, 25)) for k in range(6)]


def items_words(text):
    return [(m.group().translate({c: c + 32 for c in range(65, 91)}), *m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_cut(text):
    """Benchmark windows cut out until none is left; None if nothing is left of a text with a hit."""
    while True:
        own = items_words(text)
        words, hit = [w for w, _, _ in own], [False] * len(own)
        for _, item in ITEMS:
            it = [w for w, _, _ in items_words(item)]
            n = min(10, len(it))
            for a in range(len(it) - n + 1):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == it[a : a + n]:
                        hit[p : p + n] = [True] * n
        if not any(hit):
            return text
        if all(hit):
            return None
        parts, at, k = [], 0, 0
        while k < len(own):
            if hit[k]:
                last = k
                while last + 1 < len(own) and hit[last + 1]:
                    last += 1
                parts.append(text[at : own[k][1]])
                at, k = own[last][2], last
            k += 1
        text = "\n".join([*parts, text[at:]])


def brute_mix(rows, weights=(1.0, 2.0, 3.0)):
    """How often each row is taken, whole."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    held = {s: sum(size(r[1]) for r in rows if r[3] == s) for s in names}
    total, stop = sum(held.values()), {}
    while True:
        free = [s for s in names if s not in stop]
        share = {s: (total - sum(stop.values())) * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * held[s]]
        if not above:
            break
        stop |= {s: 3 * held[s] for s in above}
    target, out = stop | share, {}
    for s in names:
        epochs = int(target[s] // held[s]) if held[s] else 0
        budget, keyed = math.floor(target[s] - epochs * held[s] + 0.5), []
        for r in (r for r in rows if r[3] == s):
            t = r[1] or ""
            digest = hashlib.md5(f"mix:{r[0]}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()
            quality = 1 - 0.9 * sum(t.count(c) for c in "#*$%&|<>") / max(len(t), 1)
            keyed.append((-math.log((int(digest[:13], 16) + 0.5) / 2**52) / quality, digest, r))
        before = 0
        for _, _, r in sorted(keyed, key=lambda k: k[:2]):
            n, room = size(r[1]), budget - before
            more = n > 0 and (room >= n or (room > 0 and 2 * room >= n))
            out[r[0]] = epochs + more if n else max(epochs, 1)
            before += n
    return out


def brute_shards(rows, shards=40):
    size = lambda r: len((r[1] or "").encode()) + 16
    slot = lambda r: int(hashlib.md5(f"{r[0]}:{zlib.crc32((r[1] or '').encode())}:{size(r)}".encode()).hexdigest()[:12], 16) % 4096
    held = Counter()
    for r in rows:
        held[slot(r)] += size(r)
    loads, shard = [0] * shards, {}
    for s, n in sorted(held.items(), key=lambda x: (-x[1], x[0])):
        shard[s] = loads.index(min(loads))
        loads[shard[s]] += n
    return Counter((r[0], r[1], size(r), slot(r), shard[slot(r)], 0) for r in rows)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf


def plain(df):
    return sorted(((*r[:8], tuple((r[8] or {}).items()), *r[9:]) for r in (tuple(x) for x in df.collect())), key=repr)


def test_the_pipeline_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = corpus()
    # Learned weights, scored here by a plain dot product.
    weights = quality_classifier.train_model(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    rows = [r for r in rows if score((r[1] or "").encode(), weights, WordHashes(), 18) >= 0.3]
    assert 0 < len(corpus()) - len(rows) < 60
    told = lambda rs: sorted(((*r[:8], tuple(r[8].items()), *r[9:]) for r in rs), key=repr)
    docs = corpus_pipeline.quality(spark, docs, tables)
    assert plain(docs) == told(rows)

    classes = brute_classes([(r[0], r[1], None) for r in rows])
    rows = [r for r in rows if r[1] is None or classes[r[0]] == r[0]]
    docs = corpus_pipeline.near_duplicates(spark, docs, tables)
    assert plain(docs) == told(rows)

    cut = [(r, brute_cut(r[1])) for r in rows]
    rows = [(r[0], t, *r[2:4], None if t is None else len(t), *r[5:]) for r, t in cut if r[1] is None or t is not None]
    assert any(t != r[1] for r, t in cut)
    docs = corpus_pipeline.benchmark_passages(spark, docs, tables)
    assert plain(docs) == told(rows)

    copies = brute_mix(rows)
    rows = [r for r in rows for _ in range(copies[r[0]])]
    docs = corpus_pipeline.mix(spark, docs, tables)
    assert plain(docs) == told(rows)

    want = brute_shards(rows)
    kept = [c for c in docs.columns if c not in ("size", "shard")]
    for last in (corpus_pipeline.shards(spark, docs, tables), corpus_pipeline.run(spark, tables)):
        assert last.columns == [*kept, "size", "virtual_slot", "shard", "map_version"]
        got = Counter((r["doc_id"], r["text"], r["size"], r["virtual_slot"], r["shard"], r["map_version"]) for r in last.collect())
        assert got == want


def test_the_pipeline_over_no_rows(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
