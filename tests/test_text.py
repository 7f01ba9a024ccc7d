"""Expressions on hand-made rows."""

from pyspark.sql import functions as F

from quarry.functions import text as X


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(expr).collect()]


def test_verbatim(spark):
    rows = [("", "x"), ("b", "abc"), (None, "abc"), ("x", None), ("B", "abc")]
    assert column(spark, rows, "q string, t string", X.verbatim_ok(F.col("q"), F.col("t"))) == [False, True, False, False, False]


def test_slices_and_spans(spark):
    rows = [("abcdef", 1, 4), ("abcdef", -1, 2), ("abcdef", 2, 2), ("abcdef", 0, 7), ("a😀bc", 1, 3), (None, 0, 1)]
    assert column(spark, rows, "t string, s int, e int", X.slice_span(F.col("t"), F.col("s"), F.col("e"))) == ["bcd", None, None, None, "😀b", None]
    rows = [("abcdef", 1, 4, "bce"), ("abcdef", 1, 4, "bcd"), ("abcdef", 1, 4, None), ("abcdef", 1, 4, ""), ("abcdef", 0, 9, None)]
    assert column(spark, rows, "t string, s int, e int, q string", X.span_ok(F.col("s"), F.col("e"), F.col("t"), F.col("q"))) == [False, True, True, False, False]


def test_wilson(spark):
    low, high = X.wilson(F.col("p"), F.col("n"))
    found = column(spark, [(5, 5), (0, 0)], "p int, n int", F.struct(F.round(low, 3), F.round(high, 3)))
    assert [tuple(x) for x in found] == [(0.566, 1.0), (0.0, 1.0)]


def test_heading_depth(spark):
    assert column(spark, [("2. A", None), ("2.1 B", None), ("Title", None), ("Title", 3)], "t string, l int", X.heading_depth(F.col("t"), F.col("l"))) == [1, 2, 1, 3]


def test_keys_ignore_case_and_order(spark):
    rows = [("The  Cat, sat!", ["b", "a"]), ("the cat sat", ["a", "b"]), ("the cat", ["a", "b"])]
    a, b, c = column(spark, rows, "c string, l array<string>", X.claim_key(F.col("c"), F.col("l")))
    assert a == b != c


def test_replies(spark):
    rows = [("<think>a</think> yes",), ("no <think>cut",), ("plain",)]
    assert column(spark, rows, "r string", X.strip_think(F.col("r"))) == ["yes", "no", "plain"]
    rows = [('Sure ```json\n{"a": 1}\n``` ok',), ("none",), ('<output>[1]</output> {"x": 2}',)]
    assert column(spark, rows, "r string", X.json_block(F.col("r"))) == ['{"a": 1}', None, "[1]"]


def test_jaccard_of_empty_sets(spark):
    rows = [([], []), (["a"], []), (["a", "b"], ["b", "c"])]
    assert column(spark, rows, "a array<string>, b array<string>", F.round(X.jaccard(F.col("a"), F.col("b")), 3)) == [1.0, 0.0, 0.333]


def test_links_resolve(spark):
    rows = [("a/b.md", "c.md"), ("a/b.md", "../c.md"), ("a/b.md", "/c.md"), ("b.md", "./c.md")]
    assert column(spark, rows, "p string, l string", X.resolved_link(F.col("p"), F.col("l"))) == ["a/c.md", "c.md", "c.md", "c.md"]


def test_markers_and_slugs(spark):
    assert column(spark, [("see [claim:c_1], [claim:b] and [claim:c_1]",)], "t string", X.marker_ids(F.col("t"))) == [["c_1", "b"]]
    assert column(spark, [("--Hello, World--",)], "t string", X.slug(F.col("t"))) == ["hello-world"]


def test_hash_embedding_has_length_one(spark):
    v = column(spark, [("abc",)], "t string", X.hash_embedding(F.col("t")))[0]
    assert len(v) == 16 and abs(sum(x * x for x in v) - 1) < 1e-9


def test_hash_embedding_hashes_the_text_once(spark):
    import hashlib

    docs = spark.createDataFrame([("abc",), ("",), (None,)], "t string")
    vectors = docs.select("t", X.hash_embedding(F.col("t")).alias("v"))
    assert vectors._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1
    for r in vectors.collect():
        raw = [None if r.t is None else b / 255.0 * 2.0 - 1.0 for b in hashlib.sha256((r.t or "").encode()).digest()[:16]]
        assert r.v == raw if r.t is None else max(abs(a - x / sum(y * y for y in raw) ** 0.5) for a, x in zip(r.v, raw)) < 1e-12
