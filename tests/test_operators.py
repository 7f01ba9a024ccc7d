"""Operators on hand-made rows and against brute force."""

import random
import re

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import curation as C
from quarry.operators import evaluation as V
from quarry.operators import evidence as E
from quarry.operators import graph, lint, search, structure


def test_rrf_order(spark):
    lists = [spark.createDataFrame([(x, i + 1) for i, x in enumerate(l)], "id string, rank long") for l in (["a", "b", "c"], ["b", "d", "a"])]
    assert [r.id for r in search.rrf_fuse(lists).orderBy("rank").collect()] == ["b", "a", "d", "c"]


def test_bm25_without_terms_or_rows(spark):
    docs = spark.createDataFrame([(1, "a cat"), (2, None)], "id long, text string")
    assert search.bm25_topk(docs, "id", "text", "...", 5).count() == 0
    assert [r.id for r in search.bm25_topk(docs, "id", "text", "Cat", 5).collect()] == [1]
    assert search.bm25_topk(docs.limit(0), "id", "text", "cat", 5).count() == 0


def test_hybrid_degrades_to_lexical(spark):
    docs = spark.createDataFrame([(1, "a cat"), (2, "cat cat")], "id long, text string")
    assert {r.id for r in search.hybrid(docs, "id", "text", "cat", None, "", "", None, 2).collect()} == {1, 2}


def test_neighbors(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), (None, "a")], "x string, y string")
    found = lambda d: {(r.node, r.depth) for r in graph.neighbors(edges, "x", "y", "a", d).collect()}
    assert found(1) == {("b", 1), ("c", 1)}
    assert found(2) == {("b", 1), ("c", 1), ("d", 2)}


def test_contradictions(spark):
    rows = spark.createDataFrame([("r1", "s", "p", "1", "x"), ("r2", "s", "p", "2", "y"), ("r3", "s", "q", "1", "x"), ("r4", "s", "q", "1", "x"), ("r5", None, "p", "1", "x")], "relation_id string, subject string, predicate string, object string, source_id string")
    found = E.contradictions(rows).collect()
    assert [(r.subject, r.predicate, r.objects, r.relation_ids) for r in found] == [("s", "p", ["1", "2"], ["r1", "r2"])]


def test_entity_merge(spark):
    rows = [("e", "AB", [], "x", "p2", "s", 2), ("e", "A", [], "y", "p1", "s", 1), ("e", "AC", ["AB", ""], "y", "p3", "s", 3), (None, "Z", [], "y", "p", "s", 4), ("", "Z", [], "y", "p", "s", 5)]
    merged = E.merge_entities(spark.createDataFrame(rows, "entity_id string, name string, aliases array<string>, type string, producer string, source_id string, ord int")).collect()
    assert [(r.entity_id, r.name, r.aliases, r.type, r.producer) for r in merged] == [("e", "AB", ["A", "AC"], "y", "p1")]


def test_support_union(spark):
    rows = [("k1", "p1", 1), ("k1", "p1", 2), ("k2", "p1", 3), ("k1", "p2", 4), ("k3", "p3", 5)]
    df = spark.createDataFrame(rows, "k string, pass string, ord int")
    assert [(r.k, r.ord, r.support) for r in E.support_union(df, F.col("k"), 2).collect()] == [("k1", 1, 2)]


def test_claims_check_reasons(spark):
    claims = spark.createDataFrame([("a", "pdf", "s"), ("b", "pdf", "s"), ("c", "web", "s")], "claim_id string, producer string, source_id string")
    ev = spark.createDataFrame([("a", "pdf", "s", 0, "l1", "cat"), ("b", "pdf", "s", 0, "l1", "dog"), ("b", "pdf", "s", 1, "l9", "cat"), ("b", "pdf", "s", 2, "l1", "")], "claim_id string, producer string, source_id string, pos int, locator string, quote string")
    chunks = spark.createDataFrame([("l1", "a cat")], "locator string, text string")
    found = {r.claim_id: (r.ok, r.reasons) for r in E.claims_check(claims, ev, chunks).collect()}
    assert found == {"a": (True, ""), "b": (False, "not verbatim: l1; not verbatim: l9; empty quote: l1"), "c": (False, "no evidence")}
    claims = claims.withColumn("claim", F.lit("text"))
    ids = spark.createDataFrame([("c", 0), ("a", 1), ("x", 2), ("b", 3)], "claim_id string, pos int")
    rows = E.dossier(ids, claims, ev, chunks)
    assert [(r.claim_id, r.status) for r in rows.orderBy("pos").collect()] == [("c", "rejected"), ("a", "included"), ("x", "rejected"), ("b", "rejected")]
    assert E.render_dossier(rows).first().markdown == "1. text [claim:a]\n\nOmitted: 3"


def test_substring_pairs_by_brute_force(spark):
    rng = random.Random(4)
    words = ["a", "b", "cc", "d.", "e"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    quotes = [(i, t[1][rng.randint(0, 5) : rng.randint(6, 40)]) for i, t in enumerate(rng.sample(texts, 40))] + [(100, ""), (101, "a b")]
    found = E.substring_pairs(spark.createDataFrame(texts, "text_id int, text string"), spark.createDataFrame(quotes, "quote_id int, quote string"))
    assert sorted((r.text_id, r.quote_id) for r in found.collect()) == sorted((i, j) for i, t in texts for j, q in quotes if q and q in t)


def test_sections_fold(spark):
    kinds = ["paragraph", "heading", "paragraph", "table", "paragraph"]
    units = spark.createDataFrame([(1, i, k, k) for i, k in enumerate(kinds)], "doc int, ord long, type string, text string")
    assert [r.section for r in structure.fold_sections(units).orderBy("ord").collect()] == [0, 1, 1, 2, 3]


def test_section_paths_by_brute_force(spark):
    rng = random.Random(5)
    rows = [(d, i, rng.random() < 0.6, rng.randint(1, 4), f"u{i}") for d in range(20) for i in range(rng.randint(1, 15))]
    expected = {}
    for d in range(20):
        stack = []
        for _, i, head, depth, label in [r for r in rows if r[0] == d]:
            if head:
                stack = [s for s in stack if s[0] < depth]
            expected[d, i] = "/".join(s[1] for s in stack)
            if head:
                stack.append((depth, label))
    found = structure.section_paths(spark.createDataFrame(rows, "doc int, ord long, is_heading boolean, depth int, label string"))
    assert {(r.doc, r.ord): r.path for r in found.collect()} == expected


def test_section_paths_of_nulls_and_a_long_document(spark):
    kind = "doc int, ord long, is_heading boolean, depth int, label string"
    rows = [(1, 0, True, 1, "a"), (1, 1, True, None, "b"), (1, 2, None, None, None), (1, 3, True, 2, None), (1, 4, True, 3, "c"), (1, 5, False, None, "d"), (None, 0, True, 1, "x"), (None, 1, False, None, "y")]
    found = {(r.doc, r.ord): r.path for r in structure.section_paths(spark.createDataFrame(rows, kind)).collect()}
    assert found == {(1, 0): "", (1, 1): "", (1, 2): "b", (1, 3): "", (1, 4): "", (1, 5): "c", (None, 0): "", (None, 1): "x"}
    assert structure.section_paths(spark.createDataFrame([], kind)).count() == 0
    long = spark.range(60000).selectExpr("1 as doc", "id as ord", "id % 3 = 0 as is_heading", "cast(1 + id % 2 as int) as depth", "concat('u', id) as label")
    last = structure.section_paths(long).where("ord in (59998, 59999)").orderBy("ord").collect()
    assert [r.path for r in last] == ["u59994/u59997", "u59994/u59997"]


def test_markdown_chunks(spark):
    docs = spark.createDataFrame([(1, "intro\n# A\nx\n## B\n"), (2, ""), (3, None), (4, "# only")], "id int, text string")
    found = [(r.chunk_id, r.title, r.text) for r in structure.markdown_chunks(docs, "id", "text").orderBy("chunk_id").collect()]
    assert found == [("1:c01", "", "intro"), ("1:c02", "A", "A\n\nx"), ("1:c03", "B", "B"), ("4:c01", "only", "only")]


def test_greedy_curation_by_brute_force(spark):
    rng = random.Random(6)
    rows = [(g, i, sorted(rng.sample("abcdefgh", rng.randint(1, 5))), rng.randint(1, 9)) for g in "xyz" for i in range(30)]

    def like(a, b):
        return len(set(a) & set(b)) / len(set(a) | set(b))

    expected = set()
    for g in "xyz":
        kept = []
        for _, i, w, n in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[3], r[1])):
            if len(kept) < 4 and all(like(w, k) < 0.5 for k in kept):
                kept.append(w)
                expected.add((g, i))
    found = C.greedy_curate(spark.createDataFrame(rows, "g string, id int, w array<string>, n int"), "g", "id", "w", "n", 0.5, 4)
    assert {(r.g, r.id) for r in found.collect()} == expected


def test_greedy_curation_in_rounds(spark):
    """Rounds of two rows, sets given as an expression, a group of copies, rows without text and without a group."""
    rng = random.Random(16)
    rows = [(g, 100 * k + i, " ".join(rng.sample("abcdefghij", rng.randint(1, 5))), rng.randint(1, 9)) for k, g in enumerate(["x", "y", None]) for i in range(30)]
    rows += [("copies", 1000 + i, "a b c", 9) for i in range(20)] + [("copies", 1100, "d e", 1), ("x", 1200, None, None), ("y", 1201, None, 9)]
    expected = set()
    for g in {r[0] for r in rows}:
        kept = []
        for _, i, t, n in sorted((r for r in rows if r[0] == g and r[2] is not None), key=lambda r: (-r[3], r[1])):
            w = set(t.split())
            if len(kept) < 4 and all(len(w & k) / len(w | k) < 0.4 for k in kept):
                kept.append(w)
                expected.add((g, i, len(kept)))
    docs = spark.createDataFrame(rows, "g string, id long, t string, n int")
    for batch in (2, 64):
        found = C.greedy_curate(docs, "g", "id", X.token_set(F.col("t")), "n", 0.4, 4, batch)
        assert {(r.g, r.id, r.pick) for r in found.collect()} == expected


def test_postings_by_brute_force(spark):
    """Ids that stand once need no table of terms; rows of one id (also none) and one length fold."""
    from collections import Counter

    once = [(1, "b a B. a"), (2, None), (3, "z"), (4, "Über 7 über"), (5, "")]
    twice = [(6, "a b"), (6, "b c"), (6, "b"), (None, "q q"), (None, "q r")]
    for rows in (once, once + twice):
        expected = Counter()
        for i, t in rows:
            words = re.findall(r"[^\W_]+", (t or "").lower())
            for w in words:
                expected[i, w, len(words)] += 1
        found = search.postings(spark.createDataFrame(rows, "id long, t string"), "id", "t")
        assert sorted(map(repr, found.select("id", "term", "dl", "tf").collect())) == sorted(map(repr, spark.createDataFrame([(*k, n) for k, n in expected.items()], "id long, term string, dl long, tf long").collect()))
        assert rows is not once or "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_prefixes_carry_what_tells_pairs_apart(spark):
    """Parity bits and the words before travel with each prefix word, so a pair is met about once and no set goes to a pair."""
    rng = random.Random(26)
    sets = [(i, [rng.getrandbits(62) for _ in range(rng.randint(1, 60))]) for i in range(40)]
    rows = C.rare_prefixes(spark.createDataFrame(sets, "id long, x array<long>"), 80).collect()
    for i, x in sets:
        mine = sorted((r for r in rows if r.id == i), key=lambda r: r.at)
        assert [r.at for r in mine] == list(range(len(x) - (len(x) * 80 + 99) // 100 + 1))
        places = {p for p in range(1024) if sum(v % 1024 == p for v in x) % 2}
        for r in mine:
            assert [r[f"p{k}"] for k in range(C.EARLIER)] == [mine[r.at - k].x if r.at >= k else None for k in range(1, C.EARLIER + 1)]
            assert sum((r[f"b{k}"] & (1 << 64) - 1).bit_count() for k in range(C.LONGS)) == len(places)


def test_shared_words_of_pairs(spark):
    words = {1: ["a", "b", "c"], 2: ["b", "c", "d"], 3: ["x"], 4: []}
    asked = [(1, 2), (1, 3), (2, 4)]
    pairs = spark.createDataFrame([(a, b, len(words[a]), len(words[b])) for a, b in asked], "id_a long, id_b long, n_a long, n_b long")
    found = C.shared_words(pairs, spark.createDataFrame([*words.items()], "id long, w array<string>"))
    assert {(r.id_a, r.id_b): r.both for r in found.collect()} == {(a, b): len({*words[a]} & {*words[b]}) for a, b in asked}


def test_quote_overlap_both_ways(spark, tmp_path):
    from quarry.plans.registry import QUERIES

    items = {1: "one two three four five six seven", 2: "short item", 3: "the eleventh hour has come again", 4: "alpha beta gamma", 5: "tiny", 6: ""}
    docs = {1: "before one two three four five six seven after", 2: "short item", 3: "eleventh hour", 4: "beta gamma", 5: "a tiny short item", 6: "", 7: "two three four five six seven", 8: "alpha beta gamma", 9: None}
    spark.createDataFrame([(i, t, "de" if i == 3 else "en") for i, t in docs.items()], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*items.items()], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def overlap(a, b):
        short, long = sorted((a or "", b), key=len)
        return bool(a and b) and (a == b or len(short) >= 12 and short in long)

    met = {(d, i) for d, t in docs.items() for i, u in items.items() if overlap(t, u)}
    assert {(3, 3), (2, 2), (7, 1)} < met and not {(4, 4), (5, 2), (5, 5)} & met
    found = {r.lang: (r.n, r.recalled) for r in QUERIES["quote_overlap_recall"](spark, str(tmp_path)).collect()}
    assert found == {"en": (6, len({i for d, i in met if d != 3})), "de": (6, 1)}
    matched = {r.lang: (r.n, r.matched) for r in QUERIES["quote_overlap_matched"](spark, str(tmp_path)).collect()}
    assert matched == {"en": (8, len({d for d, _ in met if d != 3})), "de": (1, 1)}


def test_similar_sets_by_brute_force(spark):
    rng = random.Random(46)
    rows = {i: sorted(rng.sample("abcdefghijklmnop", rng.randint(0, 12))) for i in range(0, 600, 3)}
    rows |= {5000 + 7 * i: list(w) for i, w in list(rows.items())[:20]} | {9000: list("abcde"), 9500: list("abcd"), 9900: [], 9990: []}
    found = C.similar_sets(spark.createDataFrame([*rows.items(), (9999, None)], "doc_id int, w array<string>")).collect()
    least = {}
    for i, w in sorted(rows.items()):
        least.setdefault(frozenset(w), i)
    expected = {(least[frozenset(w)], i): 1.0 for i, w in rows.items() if least[frozenset(w)] != i}
    for a, i in least.items():
        for b, j in least.items():
            if i < j and 100 * len(a & b) >= 80 * len(a | b):
                expected[i, j] = len(a & b) / len(a | b)
    assert len(found) == len(expected) and {(r.doc_id, r.like_id): r.jaccard for r in found} == expected
    assert 0.8 in expected.values()
    assert sum(j - i > 1 for i, j in expected) == len(expected)  # none of them adjacent


def test_near_copies_by_brute_force(spark):
    rng = random.Random(7)
    sets = lambda n: [(i, sorted(rng.sample("abcdefghij", rng.randint(0, 9)))) for i in range(n)]
    a, b = sets(60), sets(40)
    found = C.near_copies(spark.createDataFrame(a, "id int, w array<string>"), spark.createDataFrame(b, "id int, w array<string>"))
    expected = {(i, j) for i, x in a for j, y in b if x and y and 10 * len(set(x) & set(y)) >= 8 * len(set(x) | set(y))}
    assert {(r.left_id, r.right_id) for r in found.collect()} == expected


def test_split_sizes_and_partition(spark):
    rows = spark.createDataFrame([("a", i) for i in range(4)] + [("b", 10 + i) for i in range(30)], "s string, id int")
    found = C.stratified_split(rows, "s", "id", 0.1).collect()
    assert len(found) == 34 and sum(r.part == "val" and r.s == "a" for r in found) == 1 and sum(r.part == "val" and r.s == "b" for r in found) == 3


def test_round_robin_by_brute_force(spark):
    import hashlib

    rng = random.Random(8)
    rows = [(s, i) for s in "abc" for i in range(40) if rng.random() < 0.4]
    order = lambda i: hashlib.sha256(f"7|{i}".encode()).hexdigest()
    pools = {s: sorted((i for t, i in rows if t == s), key=order) for s in "abc"}
    seen, expected = set(), []
    for r in range(40):
        for s in "abc":
            if r < len(pools[s]) and pools[s][r] not in seen and len(expected) < 12:
                seen.add(pools[s][r])
                expected.append((s, pools[s][r]))
    found = C.round_robin_sample(spark.createDataFrame(rows, "s string, id int"), "s", "id", 12)
    assert [(r.s, r.id) for r in found.orderBy("place").collect()] == expected


def test_repetition_loops(spark):
    rows = [(1, "go on " * 20), (2, "x " * 40), (3, "x " * 39), (4, "a b c d e f g " * 6 + "end"), (5, None), (6, "a b c d e f g " * 5), (7, "start then " + "one two " * 25)]
    found = {r.id: r.loops for r in C.repetition_loops(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()}
    assert found == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False, 7: True}


def test_contamination_and_dedup(spark):
    rows = spark.createDataFrame([(1, "A  b"), (2, "c"), (3, None)], "id long, text string")
    guarded = spark.createDataFrame([(9, "a B "), (2, "zzz"), (None, "q")], "locator long, text string")
    assert {(r.id, r.by_locator, r.by_text) for r in C.contamination(rows, "id", "text", guarded).collect()} == {(1, False, True), (2, True, False)}
    once = C.first_of_each(spark.createDataFrame([("k", 2), ("k", 1), ("l", 3), (None, 4), (None, 5)], "k string, o int"), F.col("k"), "o")
    assert sorted(r.o for r in once.collect()) == [1, 3, 4]


def test_corpus_hash_ignores_order(spark):
    rows = [(i, f"t{i}") for i in range(50)]
    a = C.corpus_hash(spark.createDataFrame(rows, "id long, t string"), "id", "t").first()[0]
    b = C.corpus_hash(spark.createDataFrame(rows[::-1], "id long, t string").repartition(7), "id", "t").first()[0]
    c = C.corpus_hash(spark.createDataFrame(rows[1:], "id long, t string"), "id", "t").first()[0]
    assert a == b != c


def test_coverage_rules(spark):
    share, foreign, passed = V.coverage(F.col("c"), F.col("a"), 0.8)
    rows = [(["1", "2"], ["1", "2", "3"]), (["1", "2", "3"], [str(i) for i in range(1, 11)]), (["1", "2", "3"], ["1", "2", "3"]), (["9"], ["1"])]
    found = spark.createDataFrame(rows, "c array<string>, a array<string>").select(F.round(share, 2), foreign, passed).collect()
    assert [tuple(r) for r in found] == [(0.67, 0, False), (0.3, 0, False), (1.0, 0, True), (0.0, 1, False)]


def test_bootstrap_agrees_with_itself_and_is_sane(spark):
    rows = spark.createDataFrame([("g", i, float(i % 10)) for i in range(300)], "g string, id long, x double")
    a, b = V.bootstrap_means(rows, "g", "id", "x", 100).first(), V.bootstrap_means(rows.repartition(5), "g", "id", "x", 100).first()
    assert abs(a.low - b.low) < 1e-9 and a.low < 4.5 < a.high and a.significant
    assert V.mt_bootstrap([], 10, 1) == (0.0, 0.0, 0.0, False)


def test_gates_and_deltas(spark):
    gate = V.promotion_gate(*[F.col(c) for c in "abcde"])
    rows = spark.createDataFrame([(True,) * 5, (False,) * 5, (True, True, False, False, True)], "a boolean, b boolean, c boolean, d boolean, e boolean")
    assert [r[0] for r in rows.select(gate).collect()] == [0, 6, 3]
    deltas = V.paired_deltas(spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(2,), (3,)], "id int"), "id")
    assert {(r.id, r.delta) for r in deltas.collect()} == {(1, 1), (2, 0), (3, -1)}


def test_suffixes_resolve(spark):
    names = spark.createDataFrame([("d:1",), ("e:1",), ("d:22",)], "id string")
    asked = spark.createDataFrame([("d:1",), ("1",), ("22",), ("2",), ("zz",)], "emitted string")
    assert {r.emitted: r.id for r in lint.resolve_suffixes(asked, names).collect()} == {"d:1": "d:1", "1": None, "22": "d:22", "2": None, "zz": None}


def test_similar_vectors_in_blocks(spark):
    rng = random.Random(9)
    vec = lambda n, k: [(k + i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(n)]
    p, r = vec(30, 0), vec(20, 100) + [(200, [0.0] * 4)]

    def cos(a, b):
        na, nb = sum(x * x for x in a) ** 0.5, sum(x * x for x in b) ** 0.5
        return sum(x * y for x, y in zip(a, b)) / (na * nb) if na * nb else 0.0

    found = V.similar_vectors(spark.createDataFrame(p, "id long, v array<double>"), spark.createDataFrame(r, "id long, v array<double>"), 0.7, block=7)
    assert {x.id for x in found.collect()} == {i for i, v in r if any(cos(v, w) >= 0.7 for _, w in p)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert search.postings(none, "doc_id", "text").count() == 0
    assert C.repetition_loops(none, "doc_id", "text").count() == 0
    assert C.stratified_split(none, "source", "doc_id").count() == 0
    assert C.greedy_curate(none.select("source", "doc_id", X.token_set(F.col("text")).alias("w"), F.lit(1).alias("n")), "source", "doc_id", "w", "n").count() == 0
    assert structure.markdown_chunks(none, "doc_id", "text").count() == 0


def test_running_sums_in_order_by_brute_force(spark):
    from quarry.operators.prefix import running_in_order

    rng = random.Random(10)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.randint(0, 9)) for i in range(400)]
    found = running_in_order(spark.createDataFrame(rows, "k string, o int, x int"), "x", ["k"], ["o"], "before").collect()
    assert {r.o: r.before for r in found} == {o: sum(y for j, p, y in rows if j == k and p < o) for k, o, _ in rows}
    left = C.prefix_budget(spark.createDataFrame(rows, "k string, o int, x int"), "k", ["o"], "x", 100).groupBy("k").agg(F.sum("taken").alias("t")).collect()
    assert all(r.t == min(100, sum(x for k, _, x in rows if k == r.k)) for r in left)
