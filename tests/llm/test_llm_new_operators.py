"""Hard negatives, the Merkle manifest and secret scans against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import ODD, documents, prose

from tidemark.llm import hard_negatives, merkle, secret_scan
from tidemark.llm.common import positions

# Hard negatives


VECTORS = "vec_id long, embedding array<float>, label int, anchor int, score int, id string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS).repartition(4)


def brute_negatives(rows, every=100, k_pos=5, k_neg=10, least=30, most=90):
    """In Python's whole numbers. A row without an id stands behind others and is no anchor."""
    part = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            part.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    late = 2**63
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    clip = lambda s: max(min(s, 2**63 - 1), 1 - 2**63)
    out = []
    for n, (i, v, label) in enumerate(part):
        if i is None or i % every:
            continue
        scored = sorted((-clip(dot(v, w)), late if j is None else j, own, m) for m, (j, w, own) in enumerate(part))
        same = [(-s, j) for s, j, own, m in scored if own == label and m != n][:k_pos]
        for p, pid in same:
            other = [(j, -s) for s, j, own, _ in scored if own != label and least * p <= 100 * -s <= most * p]
            out += [(i, None if pid == late else pid, r, None if j == late else j, p, s) for r, (j, s) in enumerate(other[:k_neg], 1)]
    return Counter(out)


def mined(df):
    return Counter((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def random_vectors(seed, n, dims=8, labels=3):
    rng = np.random.default_rng(seed)
    # Few distinct components, so that scores tie.
    return [(k, (rng.integers(-2, 6, dims) / 8).tolist(), int(rng.integers(labels))) for k in range(n)]


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_hard_negatives_against_brute_force(spark, block_rows):
    rows = random_vectors(1, 700)
    got = hard_negatives.hard_negatives(vectors(spark, rows), anchor_every=20, block_rows=block_rows)
    want = brute_negatives(rows, every=20)
    assert mined(got) == want and len(want) > 500


def test_hard_negatives_of_odd_rows(spark):
    rows = random_vectors(2, 120)
    rows += [(None, rows[5][1], 0), (None, rows[6][1], 1), (20, rows[20][1], rows[20][2]), (20, rows[20][1], rows[20][2]), (40, rows[3][1], 1)]
    rows += [(200, None, 1), (201, [0.5, None] * 4, 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 1), (204, [1.0] * 8, None), (220, [], 1), (240, [0.5] * 3, 2), (-20, [0.5] * 8, 1)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), anchor_every=20)
    assert mined(got) == brute_negatives(rows, every=20)
    assert hard_negatives.hard_negatives(vectors(spark, [])).collect() == []
    assert hard_negatives.hard_negatives(vectors(spark, rows[1:20])).collect() == []


def test_a_common_vector_and_large_components(spark):
    rows = random_vectors(3, 60) + [(1000 + k, [0.5] * 8, k % 3) for k in range(400)]
    rows += [(3000 + k, [1e30 * (k + 1)] + [0.0] * 7, k % 2) for k in range(6)] + [(3020 + k, [3e13 * (k + 1)] * 8, k % 2) for k in range(6)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), anchor_every=20)
    assert mined(got) == brute_negatives(rows, every=20)


def test_a_task_keeps_a_few_rows_of_each_slot():
    best = hard_negatives.Best(2, 3)
    rng = np.random.default_rng(4)
    seen = []
    for _ in range(20):
        group, score, ident = rng.integers(0, 2, 50), rng.integers(0, 9, 50), rng.integers(0, 1000, 50)
        seen += zip(group.tolist(), score.tolist(), ident.tolist())
        enters = best.may_enter(group, score, ident)
        best.add(group[enters], score[enters], ident[enters])
    want = [t for g in (0, 1) for t in sorted((t for t in seen if t[0] == g), key=lambda t: (-t[1], t[2]))[:3]]
    assert list(zip(best.group.tolist(), best.score.tolist(), best.id.tolist())) == want


# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(leaves):
    level, at, paths = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p - p % 3 : p - p % 3 + 3]
            paths[i].append(("".join(run[: p % 3]), "".join(run[p % 3 + 1 :])))
        at = [p // 3 for p in at]
        level = [H(*level[k : k + 3]) for k in range(0, len(level), 3)]
    return level[0], paths


def brute_proofs(rows, fields):
    by_source = {}
    for row in rows:
        leaf = brute_leaf([row[f] for f in fields])
        by_source.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf, row["doc_id"]))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    root, tops = brute_tree([trees[s][0] for s in names])
    out = Counter()
    for s, top in zip(names, tops):
        for x, path in zip(sorted(by_source[s], key=lambda x: x[:3]), trees[s][1]):
            out[(x[3], s, x[2], trees[s][0], root, tuple(path + top))] += 1
    return out


def proved(df):
    return Counter((r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], tuple(tuple(p) for p in r["path"])) for r in df.collect())


FIELDS = ("doc_id", "source", "hash", "node", "text")


def test_proofs_against_brute_force(spark):
    # One source of three blocks and a bit, so a second storey of blocks; single rows; no source; the empty one.
    rows = [(k, prose(k, 3), "hot") for k in range(800)] + [(5000 + k, f"é{k}", f"s{k}") for k in range(20)] + [(7000, "x", None), (7001, None, None), (7002, "", ""), *ODD]
    docs = documents(spark, rows)
    got, sources = merkle.proofs(docs, fields=FIELDS)
    want = brute_proofs([r.asDict() for r in docs.collect()], FIELDS)
    assert proved(got) == want
    held = {r["source"]: (r["n_leaves"], r["subroot"], r["root"]) for r in sources.collect()}
    assert held["hot"][0] == 800 and len(held) == len({k[1] for k in want}) and len({v[2] for v in held.values()}) == 1


def test_trees_of_all_shapes(spark):
    """Sources of these sizes at once, each a tree of its own."""
    shapes = [1, 2, 3, 4, 5, 9, 10, 27, 28, 81, 82, 242, 243, 244, 729, 730]
    docs = documents(spark, [(1000 * n + k, str(k), f"s{n}") for n in shapes for k in range(n)])
    assert proved(merkle.proofs(docs, fields=FIELDS)[0]) == brute_proofs([r.asDict() for r in docs.collect()], FIELDS)


def test_a_change_is_found_where_it_is(spark):
    docs = documents(spark, [(k, prose(k, 5), f"s{k % 3}") for k in range(100)])
    changed = F.when(F.col("doc_id") == 7, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    rows, _ = merkle.proofs(docs, fields=FIELDS, keep={"present": merkle.leaf_digest("doc_id", "source", "hash", "node", changed)})
    checked = rows.select("doc_id", (merkle.folded(F.col("present"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert [r["doc_id"] for r in checked if not r["ok"]] == [7]
    assert merkle.proofs(documents(spark, []), fields=FIELDS)[0].collect() == []


def test_a_written_manifest_reads_back(spark, tmp_path):
    docs = documents(spark, [(k, prose(k, 5), f"s{k % 3}") for k in range(30)])
    merkle.write_manifest(docs, str(tmp_path / "m"), fields=FIELDS)
    leaves, sources = (spark.read.parquet(str(tmp_path / "m" / name)) for name in ("leaves", "sources"))
    assert leaves.count() == 30 and sources.agg(F.sum("n_leaves")).first()[0] == 30
    assert leaves.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_positions_of_a_hot_group(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), (F.col("id") % 5).alias("o"), "id")
    got = positions(rows, ["g"], ["o"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["pos"], r["o"], r["n"]))
    for own in by.values():
        own.sort()
        assert [p for p, _, _ in own] == list(range(len(own))) and [o for _, o, _ in own] == sorted(o for _, o, _ in own)
        assert {n for _, _, n in own} == {len(own)}
    assert len(got) == 1000


# Secret scans


def brute_entropy(text):
    """Every window of every candidate, counted afresh."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        own = m.group()
        if len(own) < 20 or any(form.fullmatch(own) for form in secret_scan.ALLOWED):
            continue
        passing = {}
        for k in range(len(own) - 19):
            window = own[k : k + 20]
            kind = next(c for c in secret_scan.CLASSES if set(window) <= set(c.characters))
            bits = -sum(n / 20 * math.log2(n / 20) for n in Counter(window).values())
            if bits >= kind.bits:
                passing.setdefault(kind.name, set()).update(range(m.start() + k, m.start() + k + 20))
        for name, places in passing.items():
            for p in sorted(places):
                if p - 1 not in places:
                    end = p
                    while end in places:
                        end += 1
                    found.append((f"entropy_{name}", p, end))
    return found


def random_text(rng):
    pieces = [
        lambda: "".join(rng.choices("0123456789abcdef", k=rng.randrange(15, 60))), lambda: "".join(rng.choices("ABCDEFabcdefXYZ0189+/=_-", k=rng.randrange(15, 60))),
        lambda: "AKIA" + "".join(rng.choices("ABCD0189", k=rng.randrange(10, 25))), lambda: rng.choice(["password", "API_KEY", "apikey", "Secret", "token", "passwd"]) + rng.choice(['"', "'", ""]) + rng.choice([" = ", ":", "  ", ": '"]) + rng.choice(["x", "abcdefg", "token: secret9"]),
        lambda: "a" * rng.randrange(10, 40), lambda: "some-words_and+1234/more", lambda: "é🙂 ", lambda: "ſecret = abcdefgh ", lambda: "12345678-1234-1234-1234-123456789abc", lambda: "sha256-" + "".join(rng.choices("0123456789abcdef", k=40)),
    ]
    return "".join(rng.choice(pieces)() + rng.choice([" ", "", "\n", "é"]) for _ in range(rng.randrange(1, 14)))


def test_windows_by_counts_equal_windows_counted_afresh():
    rng = random.Random(8)
    hits = 0
    for _ in range(400):
        text = random_text(rng)
        assert sorted(secret_scan.entropy_spans(text)) == sorted(brute_entropy(text))
        hits += len(brute_entropy(text))
    assert hits > 200


def brute_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    value = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", *m.span()) for m in re.finditer("(password|passwd|secret|token|api_?key)" + value, low) if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return found + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]


def test_secrets_of_the_query_against_brute_force(spark):
    rng = random.Random(9)
    rows = [*ODD, *[(100 + k, random_text(rng), "s") for k in range(60)]]
    got = Counter(tuple(r) for r in secret_scan.scan_secrets(documents(spark, rows)).collect())
    want = Counter()
    for i, text, _ in rows:
        base, order = brute_base(text or ""), secret_scan.KINDS.index
        line = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], order(x[0]))))
        n = Counter(k for k, _, _ in base)
        want[(i, n["assign"], n["access"], n["hex"], hashlib.sha256(line(base).encode()).hexdigest(), line(base + brute_entropy(text or "")))] += 1
    assert got == want
    assert secret_scan.scan_secrets(documents(spark, [])).collect() == []


def test_clean_texts_have_no_spans():
    for seed in range(50):
        assert secret_scan.base_spans(prose(seed, 200)) == [] and secret_scan.entropy_spans(prose(seed, 200)) == []
    long = "0123456789abcdef" * 20_000
    assert secret_scan.entropy_spans(long) == [("entropy_lower_hex", 0, len(long))] and secret_scan.base_spans(long) == [("hex", 0, len(long))]
