import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import graph, traces
from tidemark.plans.flywheel import flywheel
from tidemark.sources.documents import read_documents, read_trace_export, write_jsonl


def span(span_id, *children, **fields):
    attributes = fields.pop("attributes", None)
    out = {"span_id": span_id, "name": fields.pop("name", "n"), **fields}
    if attributes is not None:
        out["attributes"] = attributes
    if children:
        out["children"] = list(children)
    return out


def land(spark, folder, *files):
    for n, roots in enumerate(files):
        (folder / f"{n}.json").write_text(json.dumps(roots, indent=1), encoding="utf-8")
    return traces.flatten_spans(read_trace_export(spark, str(folder)))


def turn(trace, question, status="ok", answer=None, **attributes):
    fields = {"attributes": {"input": question, "output": answer, **attributes}, "trace_id": trace}
    return span(f"s-{trace}", status=status, **fields)


def test_flatten_inherits_defaults_and_hoists(spark, rows, tmp_path):
    chat = span("c", parent_id="r", status="error", attributes={"gen_ai.request.model": "m", "gen_ai.usage.input_tokens": 5, "tool.name": "t", "error.type": "E"})
    root = span("r", chat, span("d", parent_id="r"), trace_id="x", duration_ms=10)
    spans = land(spark, tmp_path, [root, span("alone")])
    got = rows(spans, "trace_id", "span_id", "parent_id", "depth", "duration_ms", "status", "model", "input_tokens", "tool_name", "error_type")
    assert got == [
        ("alone", "alone", None, 0, 0, "ok", None, None, None, None),
        ("x", "c", "r", 1, 0, "error", "m", 5, "t", "E"),
        ("x", "d", "r", 1, 0, "ok", None, None, None, None),
        ("x", "r", None, 0, 10, "ok", None, None, None, None),
    ]
    assert json.loads(spans.where("span_id = 'c'").first()["attributes_json"])["tool.name"] == "t"
    assert spans.where("span_id = 'd'").first()["attributes_json"] == "{}"


def test_trees_of_any_depth(spark, tmp_path):
    node = span("s0")
    for n in range(1, 130):
        node = span(f"s{n}", node)
    spans = land(spark, tmp_path, [node])
    assert spans.agg(F.max("depth"), F.count("*")).first()[:] == (129, 130)


def test_summary_eval_pairs_and_decontamination(spark, rows, tmp_path):
    a = [turn("1", "Q  one?", answer="good1", split="eval"), turn("2", "q one?", "error", "bad1"), turn("3", "Two", answer="good2"), turn("4", "two ", "error", None), turn("5", " TWO", "error", "bad3")]
    b = [turn("6", "two", answer="later"), turn("7", "only good", answer="g"), turn("8", None, "error", "x"), turn("9", "no answer", split="eval")]
    spans = land(spark, tmp_path, a, b)
    assert rows(traces.eval_set(spans)) == [("1", "Q  one?", "good1")]
    pairs = traces.preference_pairs(spans)
    # The first bad answer to 'two' is an empty one; it is the first all the same.
    assert rows(pairs) == [("q one?", "good1", "bad1"), ("two", "good2", None)]
    assert rows(traces.decontaminate(pairs, traces.eval_set(spans))) == [("two", "good2", None)]


@pytest.mark.parametrize("name", ["traces.json", "traces.jsonl"])
def test_flywheel_from_traces_to_data_sets(spark, tmp_path, name):
    from test_features import sample

    turns = [turn("1", "q one?", answer="good1", split="eval"), turn("2", "Q one?", "error", "bad1"), turn("3", "two", answer="first"), turn("4", "two", "error", "bad"), turn("5", "two", answer="second")]
    text = json.dumps(turns) if name.endswith(".json") else "\n".join(json.dumps(t) for t in turns) + "\n\n"
    (tmp_path / name).write_text(text, encoding="utf-8")
    out = str(tmp_path / "out")
    got = flywheel(spark, str(tmp_path / name), out, *sample(spark))
    assert got == {"n_spans": 5, "n_traces": 5, "n_eval": 1, "n_pairs_raw": 2, "n_pref": 1, "leaks": 2}
    pair = json.loads(spark.read.text(f"{out}/preference_pairs").first()[0])
    assert pair == {"prompt": "two", "chosen": "first", "rejected": "bad"}


def test_summary(spark, rows, tmp_path):
    child = span("c", attributes={"gen_ai.usage.input_tokens": 3, "gen_ai.usage.output_tokens": 4}, status="error")
    spans = land(spark, tmp_path, [span("r", child, trace_id="x", duration_ms=7, attributes={"input": "i"})])
    assert rows(traces.trace_summary(spans)) == [("x", "i", None, "ok", 7, 7, 2)]


def test_jsonl_keeps_nulls_and_unicode(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    assert write_jsonl(df, str(tmp_path / "out")) == 1
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"a":"é","b":null}'


CATALOG = "# Catalog\nWidgets and gadgets, the sprockets belong to the accessory category. Accessories ship from the Hanoi Hub.\n"
POLICY = "# Policy\nCustomers may return widgets within 30 days. Gadgets carry a 90-day warranty.\n\nSprockets are final sale and cannot be returned!"


@pytest.fixture
def docs(spark, tmp_path):
    (tmp_path / "a.md").write_text(CATALOG, encoding="utf-8")
    (tmp_path / "b.md").write_text(POLICY, encoding="utf-8")
    (tmp_path / "c.txt").write_text("Widgets ship from the moon.", encoding="utf-8")
    return read_documents(spark, str(tmp_path))


def test_triples_in_order_of_arrival(docs):
    found = [tuple(r) for r in graph.extract_triples(docs).orderBy("ord").select("subject", "relation", "object").collect()]
    assert found == [
        ("widget", "IS_A", "accessory"), ("gadget", "IS_A", "accessory"), ("sprocket", "IS_A", "accessory"),
        ("accessory", "SHIPS_FROM", "hanoi hub"), ("widget", "RETURNABLE_WITHIN", "30 days"),
        ("gadget", "HAS_WARRANTY", "90 days"), ("sprocket", "NON_RETURNABLE", "final sale"),
    ]


def test_lookups_and_walk(spark, rows, docs):
    edges = graph.extract_triples(docs)
    assert rows(graph.one_hop(edges, "widget")) == [("IS_A", "accessory"), ("RETURNABLE_WITHIN", "30 days")]
    assert rows(graph.one_hop(edges, "widget", "IS_A")) == [("IS_A", "accessory")]
    assert rows(graph.having_and_not(edges, "RETURNABLE_WITHIN", "NON_RETURNABLE")) == [("widget",)]
    assert rows(graph.traverse(edges, "widget", "SHIPS_FROM")) == [(["widget", "accessory", "hanoi hub"], 2, "hanoi hub")]
    contrast = graph.retrieval_contrast(docs, "Widget", "hanoi").first()
    assert (contrast["n_chunks"], contrast["single_chunk_answers_it"]) == (5, False)
    assert contrast["chunk_with_subject"].startswith("Widgets and") and contrast["chunk_with_answer"].startswith("Accessories")


def edge_table(spark, triples):
    return spark.createDataFrame([(s, r, o, n) for n, (s, r, o) in enumerate(triples)], "subject string, relation string, object string, ord bigint")


def brute_walk(triples, start, relation, max_hops):
    """Level by level, nodes of a level in the order they were first reached."""
    out, seen, level = [], {start}, [[start]]
    subjects = {s for s, _, _ in triples}
    while level:
        following = []
        for path in level:
            for s, r, o in triples:
                if s != path[-1]:
                    continue
                if r == relation:
                    out.append((path + [o], len(path), o))
                if o in subjects and o not in seen:
                    seen.add(o)
                    following.append(path + [o])
        level = following if len(level[0]) < max_hops + 1 else []
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_hops", [0, 1, 3])
def test_walk_equals_brute_force_on_cycles_hubs_and_duplicates(spark, rows, max_hops):
    rnd = random.Random(max_hops)
    triples = [(f"n{rnd.randrange(12)}", rnd.choice("AB"), f"n{rnd.randrange(16)}") for _ in range(60)]
    triples += [("n0", "A", f"n{i}") for i in range(16)] + [("n0", "B", "n1")] * 2
    assert rows(graph.traverse(edge_table(spark, triples), "n0", "B", max_hops)) == brute_walk(triples, "n0", "B", max_hops)


def test_answers_reach_one_edge_past_the_hops(spark, rows):
    chain = [(f"n{i}", "R" if i == 3 else "X", f"n{i + 1}") for i in range(6)]
    assert rows(graph.traverse(edge_table(spark, chain), "n0", "R", 3)) == [(["n0", "n1", "n2", "n3", "n4"], 4, "n4")]
    assert rows(graph.traverse(edge_table(spark, chain), "n0", "R", 2)) == []
    assert rows(graph.traverse(edge_table(spark, chain), "nowhere", "R")) == []


def test_large_levels_are_not_sent_to_all_tasks_and_buckets_grow_with_the_edges(spark, rows, monkeypatch):
    rnd = random.Random(9)
    triples = [(f"n{rnd.randrange(12)}", rnd.choice("AB"), f"n{rnd.randrange(16)}") for _ in range(60)]
    edges = edge_table(spark, triples)
    monkeypatch.setattr(graph, "BROADCAST_NODES", 0)
    monkeypatch.setattr(graph, "BUCKET_EDGES", 7)
    found = graph.traverse(edges, "n0", "B", 3)
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == brute_walk(triples, "n0", "B", 3)
    assert graph._buckets(edges) == 9
