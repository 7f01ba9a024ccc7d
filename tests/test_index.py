"""Index build, tools, sinks and streams on small folders of our own."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quarry.plans.index import Index, compile_index
from quarry.sources import jsonl, sinks
from quarry.streaming import ledger


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    (root / "kb/sub").mkdir(parents=True)
    (root / "kb/index.md").write_text("---\ntype: Index\ntitle: Start\ntimestamp: 2024-01-01\n---\nSee [a](sub/a.md), [out](../out.md), [web](https://x.org/y.md).\n")
    (root / "kb/sub/a.md").write_text('---\ntype: Topic\ntitle: "On tides"\nstatus: conflicted\ntimestamp: 2024-01-02\nsource: doc1\nsource_docs:\n  - d1\n  - "d2"\ntags: [x, \'y\']\n---\nTides rise. [up](/index.md)\n')
    (root / "kb/plain.md").write_text("no front matter")
    run = root / "pdf/doc1"
    run.mkdir(parents=True)
    write = lambda name, rows: (run / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    write("chunks.jsonl", [{"node_id": "n1", "text": "The tide rises twice a day."}])
    write("claims.jsonl", [
        {"claim_id": "c_1", "document_id": "doc1", "claim": "Tides rise twice", "supporting_evidence": [{"node_id": "n1", "quote": "rises twice", "page": 1}]},
        {"claim_id": "c_2", "document_id": "doc1", "claim": "Tides sleep", "supporting_evidence": [{"node_id": "n1", "quote": "sleeps"}]},
    ])
    write("entities.jsonl", [{"entity_id": "e1", "name": "Moon", "type": "body", "aliases": ["Luna"], "mentions": ["n1"]}])
    write("relations.jsonl", [{"relation_id": "r1", "subject": "e1", "predicate": "causes", "object": "tide"}, {"relation_id": "r2", "subject": "e1", "predicate": "causes", "object": "night"}])
    (root / "web").mkdir()
    return root


def test_compile_and_tools(spark, project):
    folder = f"{project}/index"
    roots = {"pdf": f"{project}/pdf", "web": f"{project}/web"}
    for _ in range(2):  # a second build replaces the first
        counts = compile_index(spark, folder, f"{project}/kb", roots)
    assert counts["wiki_pages"] == 2 and counts["claims"] == 2 and counts["entities"] == 1 and counts["relations"] == 2
    index = Index(spark, folder)
    assert index.degraded
    assert [r.claim_id for r in index.search_claims("twice").collect()] == ["c_1"]
    assert index.search_claims("twice", producer="web").count() == 0
    assert [r.title for r in index.search_wiki("tides").collect()] == ["On tides"]
    assert index.get_entity("MOON").first().aliases == ["Luna"]
    assert {(r.node, r.depth) for r in index.neighbors("tide", 2).collect()} == {("e1", 1), ("night", 2)}
    assert [(r.kind, r.objects, r.path) for r in index.find_contradictions().orderBy("kind").collect()] == [("conflicted_page", None, "sub/a.md"), ("relation", ["night", "tide"], None)]
    # links are resolved against their page, and those that leave the base are gone
    assert {(r.from_path, r.to_path) for r in index.tables["wiki_links"].collect()} == {("index.md", "sub/a.md"), ("sub/a.md", "index.md")}
    assert [(r.node, r.depth) for r in index.link_neighbors("index.md").collect()] == [("sub/a.md", 1)]
    moon = index.get_entity("e1").first()
    assert moon.mentions == ["n1"] and [tuple(r)[0] for r in moon.relations] == ["r1", "r2"]
    assert index.get_entity("tide").count() == 0
    front = json.loads(index.read_page("sub/a.md").first().frontmatter_json)
    assert front["title"] == "On tides" and json.loads(front["source_docs"]) == ["d1", "d2"] and json.loads(front["tags"]) == ["x", "y"]
    assert tuple(index.get_sources(page="sub/a.md").first()) == ("sub/a.md", "doc1", '["d1","d2"]', None)
    assert [(r.claim_id, r.status) for r in index.compose_dossier(["c_2", "c_1"]).collect()] == [("c_2", "rejected"), ("c_1", "included")]
    assert index.get_sources(claim="c_1").first().source_id == "doc1"
    assert index.search_wiki("tides").first().status == "conflicted"
    # lexical answers come from the postings: without them there are none, and they equal a search of the texts
    from quarry.operators import search

    stored, figures, claims = index.tables["claim_postings"], index.tables["claim_figures"], index.tables["claims"]
    for question in ("tides", "twice tides sleep", "absent", ""):
        assert {tuple(r) for r in search.bm25_of_postings(stored, figures, question).collect()} == {tuple(r) for r in search.bm25_scores(claims, "claim_id", "claim", question).collect()}
    assert re.search(r"PushedFilters: \[[^]]*In\(term", search.bm25_of_postings(stored, figures, "tides twice")._jdf.queryExecution().executedPlan().toString())
    index.tables["claim_postings"] = stored.limit(0)
    assert index.search_claims("twice").count() == 0


def test_vectors_are_compiled_and_searched(spark, project):
    lengths = lambda texts: [[float(len(t)), 1.0] for t in texts]  # noqa: E731  by value, so that workers need no module of it
    folder = f"{project}/vector-index"
    counts = compile_index(spark, folder, f"{project}/kb", {"pdf": f"{project}/pdf"}, lengths, "lengths")
    assert counts["claim_vectors"] == 2 and counts["wiki_vectors"] == 2
    assert Index(spark, folder).degraded and not Index(spark, folder, lengths).degraded
    # "Tides sleep" has eleven characters, like the question, and no word of it
    assert [r.claim_id for r in Index(spark, folder, lengths).search_claims("abcdefghijk", k=1).collect()] == ["c_2"]
    assert {r.key: r.value for r in Index(spark, folder).tables["meta"].collect()}["embedder"] == "lengths"


def test_a_failed_rename_leaves_the_old_index(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/i"
    sinks.build_index(spark, folder, {"t": spark.range(3)}, [])
    sinks.build_index(spark, folder, {"t": spark.range(5)}, [])
    assert sinks.read_index(spark, folder)["t"].count() == 5 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["i"]


def test_folders_without_claims_are_no_runs(spark, project):
    other = project / "pdf/notes"
    other.mkdir()
    (other / "chunks.jsonl").write_text('{"node_id": "x", "text": "no run"}\n')
    assert {r.run for r in jsonl.run_rows(spark, f"{project}/pdf", "pdf", "chunks").collect()} == {"doc1"}


def test_refusals(spark, project, tmp_path):
    (tmp_path / "mine").mkdir()
    (tmp_path / "mine/file").write_text("x")
    rows = {"t": spark.range(3)}
    with pytest.raises(sinks.RefusedError):
        sinks.build_index(spark, f"{tmp_path}/mine", rows, [])
    with pytest.raises(sinks.RefusedError):
        sinks.build_index(spark, f"{project}/kb", rows, [f"{project}/kb/"])
    assert (tmp_path / "mine/file").read_text() == "x"


def test_jsonl(spark, tmp_path):
    assert jsonl.read(spark, f"{tmp_path}/none.jsonl", "a int").count() == 0
    assert jsonl.read(spark, f"{tmp_path}/none.jsonl", "a int", "none") is None
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n\n{"a": \n')
    with pytest.raises(Exception):
        jsonl.read(spark, f"{tmp_path}/bad.jsonl", "a int").collect()
    judged = jsonl.judged_lines(jsonl.read_lines(spark, f"{tmp_path}/bad.jsonl"), "line").orderBy("offset_order").collect()
    assert [r.corrupt for r in judged] == [False, True]
    jsonl.write(spark.createDataFrame([(1, "x")], "a int, v string"), f"{tmp_path}/out", {"schema_version": "2", "v": "stamp"})
    assert spark.read.json(f"{tmp_path}/out").first().asDict() == {"a": 1, "v": "x", "schema_version": "2"}


def test_manifest_and_ledger(spark):
    m = spark.createDataFrame([({"s": {"a": "1", "b": "2"}, "t": {"c": "3"}},)], "m map<string,map<string,string>>")
    merged = m.select(sinks.merged_stage(F.col("m"), "s", F.create_map(F.lit("b"), F.lit("9"))).alias("m")).first().m
    assert merged == {"s": {"a": "1", "b": "9"}, "t": {"c": "3"}}
    old, new = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z"), (2, "z")], "k int, v string")
    assert [(r.k, r.v) for r in sinks.new_ledger_rows(old, new, ["k"]).collect()] == [(2, "z")]
    audit = spark.createDataFrame([(["a", "b"], ["b", "c"])], "o array<string>, n array<string>")
    assert audit.select(sinks.appended_audit(F.col("o"), F.col("n"))).first()[0] == ["a", "b", "c"]


def test_grids_and_figures(spark):
    cells = [("t", 0, 0, "a", 1), ("t", 0, 1, "1,000", 2), ("t", 1, 1, "", 3), ("t", 1, 1, "z", 4), ("t", 1, 1, "late", 5)]
    found = sinks.grid_table(spark.createDataFrame(cells, "table_id string, row int, col int, text string, ord int")).orderBy("row").collect()
    assert [r.line for r in found] == ['a,"1,000"', ",z"]
    uris = spark.createDataFrame([("data:image/png;base64,aGk=",), ("file.png",)], "u string").select(sinks.figure_bytes(F.col("u")).alias("b")).collect()
    assert bytes(uris[0].b) == b"hi" and uris[1].b is None


def test_ledger_stream_appends_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"k": 1, "v": "a"}\n{"k": 1, "v": "a"}\n')
    for n in (1, 2):
        stream = ledger.ledger_stream(spark, f"{tmp_path}/in", "k int, v string")
        ledger.append_once(stream, f"{tmp_path}/out", ["k"], f"{tmp_path}/cp{n}").awaitTermination()  # delivered twice
    (tmp_path / "in/2.json").write_text('{"k": 2, "v": "b"}\n')
    ledger.append_once(ledger.ledger_stream(spark, f"{tmp_path}/in", "k int, v string"), f"{tmp_path}/out", ["k"], f"{tmp_path}/cp2").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]
