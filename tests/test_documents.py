"""Document trees, figures, run checks, verdicts, model files and new runs."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from quarry.operators import adjudication as A
from quarry.operators import documents as D
from quarry.sources import gguf, runs, sinks


def test_body_items_unfold_groups(spark):
    tree = {
        "body": {"children": [{"$ref": "#/texts/1"}, {"$ref": "#/groups/0"}, {"$ref": "#/texts/0"}]},
        "groups": [{"children": [{"$ref": "#/pictures/0"}, {"$ref": "#/groups/1"}]}, {"children": [{"$ref": "#/texts/2"}]}],
        "texts": [{"label": "a", "text": "last"}, {"label": "a", "text": "first"}, {"label": "a", "text": "deep"}],
        "pictures": [{"label": "p"}],
    }
    rows = D.body_items(spark.createDataFrame([(1, json.dumps(tree)), (2, "{}")], "doc int, json string")).orderBy("ord").collect()
    assert [(r.kind, r.text) for r in rows] == [("texts", "first"), ("pictures", None), ("texts", "deep"), ("texts", "last")]


def test_figures(spark):
    pictures = spark.createDataFrame([(1, 2, 0, "p1", "t1", "cap one"), (1, None, 1, "p2", None, None)], "doc int, page int, ord int, id string, caption_id string, caption string")
    captions = spark.createDataFrame([(1, 2, 0, "t1", "cap one"), (1, 1, 1, "t2", "lone")], "doc int, page int, ord int, id string, text string")
    found = D.figure_candidates(pictures, captions).orderBy("place").collect()
    assert [r.caption for r in found] == ["lone", "cap one", None]
    figures = spark.createDataFrame([(1, "f1", 2, "cap"), (1, "f2", None, "none such"), (1, "f3", 9, "cap")], "doc int, figure_id string, page int, caption string")
    nodes = spark.createDataFrame([(1, "n1", 0, "paragraph", "cap", 2, 2), (1, "n2", 1, "caption", "a cap", 1, 2), (1, "n3", 2, "figure", "cap", 2, 2)], "doc int, node_id string, ord int, type string, text string, page_start int, page_end int")
    assert {r.figure_id: r.node_id for r in D.figure_nodes(figures, nodes).collect()} == {"f1": "n2", "f2": None, "f3": None}


def test_each_check_fails_on_its_fault_alone(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    good = {
        "headings": df([("H",)], "text string"), "units": df([("H",), ("x",)], "text string"), "tables": df([("t1",)], "table_id string"), "files": df([("t1",)], "table_id string"),
        "citations": df([(1,), (None,)], "page int"), "pages": df([(1,)], "page int"), "evidence": df([("a", "abc")], "quote string, chunk_text string"),
        "figures": df([("f1", False, "missing"), ("f2", True, None)], "figure_id string, extracted boolean, note string"), "texts": df([(1, "fine text")], "page int, text string"),
    }
    faults = {
        "headings_recovered": {"headings": df([("H",), ("gone",)], "text string")}, "tables_present": {"files": df([], "table_id string")}, "page_citations_valid": {"citations": df([(7,)], "page int")},
        "evidence_quotes_verbatim": {"evidence": df([("z", "abc")], "quote string, chunk_text string")}, "figures_accounted_for": {"figures": df([("f1", False, None)], "figure_id string, extracted boolean, note string")},
        "no_ocr_garbage": {"texts": df([(1, "\x00\x01ab")], "page int, text string")},
    }
    passed = lambda **k: {r["check"]: r.passed for r in D.run_checks(spark, **k).collect()}
    assert all(passed(**good).values()) and len(passed(**good)) == 6
    for name, fault in faults.items():
        assert [n for n, ok in passed(**good | fault).items() if not ok] == [name]
    assert {r.detail for r in D.run_checks(spark).collect()} == {"skipped"}


def test_verdicts(spark):
    candidates = spark.createDataFrame([("k", ["r1", "r2"]), ("l", ["r3"])], "key string, relation_ids array<string>")
    rows = [("k", 1, "maybe", ["r1"], "x"), ("k", 2, "unclear", ["r9"], "x"), ("k", 3, "unclear", ["r1"], " "), ("k", 4, "unclear", ["r1"], "ok"), ("k", 5, "contradiction", [], "late"), ("zz", 1, "unclear", [], "x")]
    replies = spark.createDataFrame(rows, "key string, ord int, verdict string, relation_ids array<string>, rationale string")
    assert [(r.key, r.ord) for r in A.valid_verdicts(replies, candidates).collect()] == [("k", 4)]
    scored = spark.createDataFrame([("a", "a"), ("a", "unclear"), ("a", "b"), ("a", None)], "e string, g string").select(A.verdict_score(F.col("e"), F.col("g")))
    assert [r[0] for r in scored.collect()] == [1.0, 0.5, 0.0, 0.0]


def test_records(spark):
    records = spark.createDataFrame([("l1", '{"claims":[]}'), ("l2", "{}")], "locator string, body string")
    bait = spark.createDataFrame([("l1", '["x"]')], "locator string, claims string")
    assert {r.locator: r.body for r in A.merged_bait(records, bait).collect()} == {"l1": '{"claims":["x"]}', "l2": "{}"}
    one = spark.range(1).select(A.conversation_record(F.lit("s"), F.lit("u"), F.lit("a")).alias("m")).first().m
    assert [(x.role, x.content) for x in one] == [("system", "s"), ("user", "u"), ("assistant", "a")]
    pool = A.instruction_pool(spark.createDataFrame([("Say {}",), ("Draw {}",)], "template string"), spark.createDataFrame([("a",), ("b",)], "topic string"), 3)
    assert len({r.prompt for r in pool.collect()}) == 3


def gguf_file(tokens, types, version=3):
    text = lambda s: struct.pack("<Q", len(s)) + s.encode()
    listed = lambda key, kind, n, body: text(key) + struct.pack("<IIQ", 9, kind, n) + body
    body = text("name") + struct.pack("<I", 8) + text("m") + listed("tokenizer.ggml.tokens", 8, len(tokens), b"".join(map(text, tokens))) + listed("tokenizer.ggml.token_type", 5, len(types), struct.pack(f"<{len(types)}i", *types))
    return b"GGUF" + struct.pack("<IQQ", version, 0, 3) + body


def test_model_files(spark, tmp_path):
    (tmp_path / "a.gguf").write_bytes(gguf_file(["<x>", "<y>", "z"], [3, 1, 1]))
    (tmp_path / "b.gguf").write_bytes(gguf_file(["<x>"], [3])[:-3])
    (tmp_path / "c.gguf").write_bytes(gguf_file([], [], version=2))
    rows = gguf.read_metadata(spark, str(tmp_path)).cache()
    assert rows.where("problem is not null").count() == 2
    found = gguf.control_token_problems(rows.where("problem is null"), ["<x>", "<y>", "<q>"]).collect()
    assert {(r.token, r.problem) for r in found} == {("<y>", "not a control token"), ("<q>", "missing")}


def test_new_runs_and_pages(spark, tmp_path):
    source = runs.start_research_run(spark, str(tmp_path), "https://a.org/x?y=1", "intro\n# A\nbody", "2024-01-01T00:00:00Z")
    assert source.startswith("a-org-x-") and json.loads((tmp_path / source / "manifest.json").read_text())["source_url"] == "https://a.org/x?y=1"
    assert {r.node_id for r in spark.read.json(f"{tmp_path}/{source}/chunks.jsonl").collect()} == {f"{source}:c01", f"{source}:c02"}
    page = f"{tmp_path}/page.md"
    runs.scaffold_page(spark, page, "Topic", "T", "2024-01-01")
    with pytest.raises(sinks.RefusedError):
        runs.scaffold_page(spark, page, "Topic", "T", "2024-01-01")
    runs.scaffold_page(spark, page, "Topic", "New", "2024-01-01", force=True)
    assert '"New"' in open(page).read()
