"""The ten operators against brute force, libraries and round trips, and on odd tables."""

import hashlib
import math
import os
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import chat, decontaminate, licences, mixing, neardup, sharding, token_counts, topk, toxicity, warc
from quarry.llm.queries import vocabulary_path

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, row string, text_key string, h string, score string, shard string, taken string"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def docs_of(spark, rows):
    """Rows (doc_id, text, source) as documents with extra columns of clashing names."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * 8) for i, t, s in rows], SCHEMA)


LONG = "lorem ipsum dolor sit amet under the MIT License " * 20_000
ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, LONG, "b"),
    (5, "under the MIT license", "b"),
    (5, "under the MIT license", "b"),
    (6, "under the MIT license", None),
    (None, "one two three", "c"),
    (None, None, None),
    (7, "Über <|endoftext|> 中文 é!? 😀", "\U0001f600"),
    (7, "another text of the same id", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(rng, n, words=400):
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(words)]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]


# 1 token counts


def test_tokens_equal_the_library(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    rng = random.Random(1)
    alphabet = [chr(c) for c in range(0x250)] + list("​　 \xa0中😀́٠²Ⅷ")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["a" * 3000, "ab" * 900, "I'll don't", "<|endoftext|><|endoftext|> x", " " * 500]
    counter = token_counts.Counter(token_counts.MergeTable.from_json(vocabulary_path()), memo=500)
    assert counter.batch(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    found = token_counts.count_tokens(odd, vocabulary_path()).collect()
    expected = Counter((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, _ in ODD)
    assert Counter(map(tuple, found)) == expected
    assert token_counts.count_tokens(none, vocabulary_path()).count() == 0


def test_stretches_of_a_long_text(monkeypatch):
    table = token_counts.MergeTable.from_json(vocabulary_path())
    text = "it's a text, and  another\n\n one" * 40
    whole = token_counts.Counter(table).batch([text])
    monkeypatch.setattr(token_counts, "STRETCH", 7)
    assert token_counts.Counter(table).batch([text]) == whole


def test_long_words_equal_the_library():
    from tokenizers import Tokenizer

    library, table, rng = Tokenizer.from_file(vocabulary_path()), token_counts.MergeTable.from_json(vocabulary_path()), random.Random(11)
    words = ["".join(rng.choice(letters) for _ in range(n)) for n, letters in ((1025, "ab"), (3001, "a"), (2048, "a"), (9000, "abcdefghijklmnopqrstuvwxyz"), (8000, "etaoinshrdlu"), (1500, "éü😀"))] + ["the", ""]
    assert table.count([w.encode() for w in words]).tolist() == [len(library.encode(w, add_special_tokens=False).ids) for w in words]
    began = time.perf_counter()
    assert table.count(["".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000)).encode()])[0] > 100_000
    assert time.perf_counter() - began < 60


def test_other_vocabulary_settings_are_refused():
    good = {"model": {"type": "BPE"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}}
    token_counts.MergeTable.check(good)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": {"type": "WordPiece"}}, {"model": {"type": "BPE", "byte_fallback": True}}):
        with pytest.raises(ValueError):
            token_counts.MergeTable.check(good | change)


# 2 decontamination


def brute_hits(text, items):
    words, hit, names = ALNUM.findall(lower(text)), set(), set()
    for name, item in items:
        w = ALNUM.findall(lower(item))
        k = min(10, len(w))
        windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(words) - k + 1 if w else 0):
            if tuple(words[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                if name is not None:
                    names.add(str(name))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [200_000, 5])
def test_decontamination_by_brute_force(spark, odd, block, monkeypatch):
    monkeypatch.setattr(decontaminate.find_overlaps, "__defaults__", ("doc_id", "text", 10, block))
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 50))) for _ in range(40)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 4, 9, 10, 12])))) for i in range(12)] + [(12, None), (1, "MIT license"), (13, "the MIT License lorem"), (None, "a b c a b"), (None, "text of the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(100 + i, t, "s") for i, t in enumerate(texts)] + ODD
    found = decontaminate.digest(docs_of(spark, rows), bench).collect()
    assert Counter(map(tuple, found)) == Counter((i, *brute_hits(t, items)) for i, t, _ in rows)


def test_decontamination_of_empty_tables(spark, odd, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(none, bench).count() == 0
    assert decontaminate.digest(odd, bench).where("contaminated").count() == 0
    bench = spark.createDataFrame([(1, "mit LICENSE"), (None, "one")], "item_id long, text string")
    kept = decontaminate.clean_rows(odd, bench)
    assert kept.columns == odd.columns
    # the item without an id takes "one two three" out, but isn't named
    dirty = {(r.doc_id, r.n_hit, r.n_items) for r in decontaminate.digest(odd, bench).where("contaminated").collect()}
    assert (None, 1, 0) in dirty and kept.count() == len(ODD) - decontaminate.digest(odd, bench).where("contaminated").count()


@pytest.mark.parametrize("block", [1000, 200_000])
def test_a_window_of_very_many_items(spark, block):
    hot = "a passage of ten words that very many items quote"
    items = spark.range(300_000).selectExpr("id AS item_id", f"'{hot}' AS text").union(spark.range(300_000, 302_500).selectExpr("id", "concat('word', id, ' and more')"))
    docs = docs_of(spark, [(1, f"so {hot} here", "s"), (2, "word300007 and more of word302001 and more", "s"), (3, "none", "s")])
    found = {r.doc_id: r for r in decontaminate.digest(docs, items).collect()} if block > 1000 else {r.doc_id: r for r in decontaminate.find_overlaps(docs, items, block=block).collect()}
    if block > 1000:
        assert (found[1].n_hit, found[1].n_items, found[2].n_items, found[2].n_hit, found[3].n_hit) == (10, 300_000, 2, 6, 0)
    else:
        assert len(found[1]["items"]) == 300_000 and found[2]["items"] == ["300007", "302001"] and [tuple(s) for s in found[2]["spans"]] == [(0, 3), (4, 7)]
        assert [r.doc_id for r in decontaminate.clean_rows(docs, items, block=block).collect()] == [3]
    _, numbered, parts = decontaminate.blocks_of(items, "text", 10, block)
    assert numbered.count() == 2501 and parts == -(-2501 // block)
    assert max(len(decontaminate._broadcast_block(numbered, i).value[1]) for i in range(parts)) <= 1.2 * min(block, 2501)


# 3 mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    names = ["a", "b", "c", "d", None, "Z", "é", "\U0001f600", "empty"]
    rows = [(i, "" if s == "empty" else t, s) for i, (t, s) in enumerate((t, rng.choices(names, [30, 3, 3, 1, 2, 1, 1, 1, 1])[0]) for t in prose(rng, 300))]
    found = mixing.digest(docs_of(spark, rows + rows[:5])).collect()
    sizes = Counter()
    for i, t, s in rows + rows[:5]:
        sizes[s] += len(SPACED.findall(t))
    targets = brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    assert len(found) == len(rows) + 5
    for r in found:
        assert r.source_size == sizes[source[r.doc_id]] and abs(r.target - targets[source[r.doc_id]]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 5 * mixing.block_length(sum(sizes.values())) + 1
    again = mixing.digest(docs_of(spark, rows + rows[:5]).repartition(7)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_mix_of_odd_tables(spark, odd, none):
    found = mixing.digest(odd).collect()
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((i, len(SPACED.findall(t or ""))) for i, t, _ in ODD)
    assert mixing.digest(none).count() == 0
    blank = docs_of(spark, [(1, None, "a"), (2, " ", None)])
    assert [(r.target, r.taken) for r in mixing.digest(blank).collect()] == [(0.0, 0), (0.0, 0)]
    rows = mixing.mixed_rows(odd)
    assert rows.columns == odd.columns and rows.where("row <> 'x' or text_key <> 'x'").count() == 0


def test_mix_of_tiny_sources_in_long_blocks(spark, monkeypatch):
    rng = random.Random(33)
    monkeypatch.setattr(mixing, "block_length", lambda total: 4096)
    tiny = {f"s{k:03}": rng.randint(50, 1300) for k in range(40)}
    rows = [(i, "w " * 40_000, "huge") for i in range(300)] + [(1000 + 10 * k + j, "w " * (n // 5 + (j < n % 5)), s) for k, (s, n) in enumerate(tiny.items()) for j in range(5)]
    docs = docs_of(spark, rows)
    found = mixing.digest(docs).collect()
    taken, targets = Counter(), {}
    source = {i: s for i, _, s in rows}
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
    assert len(found) == len(rows)
    assert all(targets[s] == taken[s] == 3 * n for s, n in tiny.items())
    assert abs(taken["huge"] - targets["huge"]) <= 5 * 4096
    copies = Counter(r.doc_id for r in mixing.mixed_rows(docs).where("source <> 'huge'").select("doc_id").collect())
    assert copies == {i: 3 for i, _, s in rows if s != "huge"}


def test_schedule_is_even_and_ranks_have_no_gaps(spark):
    sizes = docs_of(spark, [(i, "w " * (100 + i), s) for i, s in enumerate("abcd")])
    targets = mixing.source_targets(mixing.sized(sizes, "doc_id", "text", "source", 1))
    rows = mixing.slot_schedule(targets, 9000).collect()
    assert sorted(r.slot for r in rows) == list(range(9000))
    for n in range(4):
        assert sorted(r["rank"] for r in rows if r.number == n) == list(range(sum(r.number == n for r in rows)))
    half = Counter(r.number for r in rows if r.slot < 4500)
    assert all(abs(half[n] - sum(r.number == n for r in rows) / 2) < 4 for n in range(4))


# 4 top k


@pytest.mark.parametrize("small", [False, True])
def test_top_k_by_brute_force(spark, small, monkeypatch):
    if small:
        for name, value in (("SHARD", 12), ("BLOCK", 3), ("PIVOTS", 6), ("DIRECTORY", 7)):
            monkeypatch.setattr(topk, name, value)
    rng = random.Random(4)
    v = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(160)]
    v += [(200 + i, v[i % 3][1]) for i in range(60)]  # copies and ties
    odd = [(300, None), (301, [0.1, None] * 4), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, [0.5] * 8), (350, [0.0] * 8), (400, [0.1, 0.2])]
    rows = v + odd + [v[0]]
    found = topk.nearest_neighbours(spark.createDataFrame([(i, x, 0) for i, x in rows], "vec_id long, embedding array<double>, score int")).collect()
    import math

    q = {i: [math.floor(256 * x) for x in e] for i, e in v + [odd[5], odd[6]]}
    expected = set()
    for a in q:
        if a % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a)[:5]
            expected |= {(a, n + 1, b, -s) for n, (s, b) in enumerate(best)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)


def test_top_k_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.nearest_neighbours(spark.createDataFrame([], schema)).count() == 0
    assert topk.nearest_neighbours(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    assert [tuple(r) for r in topk.nearest_neighbours(spark.createDataFrame([(0, [1.0]), (1, [0.5])], schema)).collect()] == [(0, 1, 1, 256 * 128)]


@pytest.mark.parametrize("size", [1e7, 1e9, 1e30, 1e300])
def test_top_k_of_large_components(spark, size):
    import math

    rng = random.Random(8)
    v = {i: [size * rng.gauss(0, 1), rng.gauss(0, 1), size] for i in range(60)} | {60: [0.0, 0.0, 0.0], 61: [1e308, 0.0, 0.0]}
    # scores that differ by less than a double can tell, and ties
    v |= {100: [size, 1.0, 3 / 256], 101: [size, 1.0, 2 / 256], 102: [size, 1.0, 3 / 256], 103: [size, 1.0, 4 / 256]}
    found = topk.nearest_neighbours(spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>")).collect()
    whole = {i: [math.floor(256 * x) for x in e] for i, e in v.items() if i != 61}
    expected = set()
    for a in (0, 50, 100):
        best = sorted((-sum(x * y for x, y in zip(whole[a], whole[b])), b) for b in whole if b != a)[:5]
        expected |= {(a, n + 1, b, max(-(2**63), min(2**63 - 1, -s))) for n, (s, b) in enumerate(best)}
    assert {tuple(r) for r in found} == expected and len(found) == 15


# 5 near-duplicates


def brute_components(rows, width, percent):
    sets = []
    for i, t, _ in rows:
        w = SPACED.findall(lower(t))
        sets.append({tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for a in range(len(rows)):
        if rows[a][0] is not None:
            r = find(a)
            least[r] = min(least.get(r, rows[a][0]), rows[a][0])
    return [(rows[a][0], len(sets[a]), least.get(find(a)) if sets[a] else rows[a][0]) for a in range(len(rows))]


@pytest.mark.parametrize("width,block", [(2, 1024), (5, 1024), (2, 4)])
def test_near_duplicates_by_brute_force(spark, width, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(5)
    rows = []
    for base in prose(rng, 40, 2000):
        rows.append(base.split())
        for _ in range(rng.choice([0, 0, 1, 6])):
            w = base.split()
            for _ in range(rng.randint(0, 6)):
                if w:
                    w[rng.randrange(len(w))] = f"edit{rng.randint(0, 9)}"
            rows.append(w)
    rng.shuffle(rows)
    rows = [(i, " ".join(w), "s") for i, w in enumerate(rows)] + [(1000 + (i or 0) if i else None, t, s) for i, t, s in ODD]
    found = neardup.near_duplicates(docs_of(spark, rows), width).collect()
    expected = brute_components(rows, width, 80)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(expected)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in found)


def test_unique_rows_keep_one_of_each(spark, odd, none):
    kept = neardup.unique_rows(odd, 2)
    assert kept.columns == odd.columns and neardup.unique_rows(none, 2).count() == 0 and neardup.digest(none).count() == 0
    found = Counter((r.doc_id, (r.text or "")[:21]) for r in kept.collect())
    assert found[5, "under the MIT license"] == 1 and found[6, "under the MIT license"] == 0
    assert all(found[i, ""] == 1 for i in (1, 2)) and found[7, "another text of the s"] == 1


def test_registers_and_estimates():
    import numpy as np

    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    for share in (0.2, 0.5, 0.8):
        a, b = pool[: int(2000 * (1 + share) / 2)], pool[int(2000 * (1 - share) / 2) : 2000]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        estimate, _ = neardup.estimates(neardup.registers(a), neardup.registers(b)[None], len(a), np.array([len(b)]), 80)
        assert abs(estimate[0] - true) < 0.12
    assert neardup.registers(pool[:1]).tolist().count(int(neardup.EMPTY)) == neardup.REGISTERS - 1
    assert len(neardup.band_keys(neardup.registers(pool[:1]))) == neardup.BANDS


# 6 chat


def test_round_trip_of_conflicting_texts():
    rng = random.Random(6)
    bits = ["[INST] ", " [/INST]", "</s>", "<s>", "<\\s>", "<\\\\/s>", "<<SYS>>", "<</SYS>>", "<\\<SYS>>", "[ROLE=", "[/ROLE]", "]", "[", "<", "\\", "%5d", " ", "a", "\n"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "a]b%[", "[INST]"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))) for _ in range(rng.randint(1, 4))]
        text, spans = chat.format_conversation(turns)
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    for bad in ("", "x", "[INST] a", "[INST] a</s>", "<s>a[INST] </s>"):
        if bad:
            with pytest.raises(chat.NotInGrammar):
                chat.parse(bad)


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", None), (1, 2, None, "c"), (2, 0, "assistant", "x" * 300_000), (None, 0, "user", "q"), (3, None, "user", "q"), (3, 0, "user", "q"), (3, 0, "user", "q")]
    schema = "conv_id long, turn long, role string, text string, formatted string"
    found = {r.conv_id: r for r in chat.digest(spark.createDataFrame([(*r, "x") for r in rows], schema)).collect()}
    conflict = "</s>[INST] ok [/INST]"
    expected = {1: [("user", ""), ("assistant", "b</s>"), ("", "c")], 2: [("assistant", "x" * 300_000)], None: [("user", "q")], 3: [("user", "q")] * 3, -7: [("user", conflict), ("assistant", conflict)]}
    assert set(found) == set(expected)
    for conv, turns in expected.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {r.conv_id for r in chat.digest(spark.createDataFrame([], schema)).collect()} == {-7}


# 7 WARC


def test_warc_round_trip(spark, tmp_path, monkeypatch):
    big, other = "é" * 600, "z" * 1000
    rows = [(1, "http://www.Example.com:80/a?b#c", big), (2, "http://x.org/", big), (2, "http://x.org/", big), (3, None, None), (4, "http://x.org/", "short"), (5, "http://x.org/y z\n", "short"), (None, "http://x.org/", big), (None, "u", other), (None, "u", other), (6, "http://x.org/", "w" * 999), (7, "http://x.org/", "w" * 999)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload string, digest string")
    found = Counter(map(tuple, warc.digest(pages).collect()))
    largest = {big: 2, other: None}
    expected = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and i != largest[html]
        expected[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", largest[html] if revisit else None] += 1
    assert found == expected
    assert warc.digest(pages.limit(0)).count() == 0


def test_warc_lookup_through_small_blocks(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://{'abc'[i % 3]}.com/{i % 7}", f"text {i}") for i in range(500)], "page_id long, url string, html string")
    _, parts, index_folder, archives = warc.archive(pages, f"file://{tmp_path}/w")
    index = warc.Index(parts, index_folder, archives, files=2)
    for url in ("http://a.com/0", "http://b.com/4", "https://C.com/6"):
        expected = [i for i in range(500) if f"http://{'abc'[i % 3]}.com/{i % 7}" == url.lower().replace("https", "http")]
        assert [c.page_id for c in index.of_url(url)] == expected
        assert all(c.payload == f"text {c.page_id}".encode() for c in index.of_url(url))
    assert list(index.of_url("http://nowhere.com/")) == []
    assert warc.url_key("http://u@www.Example.com:80/a?b#c") == "com,example,www)/a?b"


# 8 toxicity


def test_toxicity_learns(spark, odd, none):
    rng = random.Random(8)
    rows = [(i, t + (" you scumbag fool" if i % 4 == 0 else " kind words"), "s") for i, t in enumerate(prose(rng, 500))]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _, _ in rows] + [(0, 0, None), (None, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.digest(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    test = [r for r in found if r.held_out]
    assert len(test) > 50 and sum(r.predicted == int(r.doc_id % 4 == 0) for r in test) / len(test) > 0.97
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, toxicity.digest(docs, flipped).collect())) == sorted(map(tuple, found))  # held-out labels are not read
    scored = toxicity.digest(odd, labels).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.digest(none, labels).count() == 0
    assert {r.score for r in toxicity.digest(odd, labels.limit(0)).select(F.round("score", 6).alias("score")).collect()} == {0.1}
    kept = toxicity.clean_rows(docs, labels)
    assert kept.columns == docs.columns and all(r.doc_id % 4 for r in kept.where(toxicity.held_out(F.col("doc_id"))).collect())


def test_weights_equal_a_scalar_learner(spark):
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for i in range(120)]
    labels = {i: int("word7" in t.split() or rng.random() < 0.1) for i, t in rows}
    docs = spark.createDataFrame([*rows, (0, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, y in labels.items()], "doc_id long, toxic int")
    bits = 12
    places, weights, intercept = toxicity.train(toxicity.training_rows(docs, marks, bits=bits), epochs=3, bits=bits)
    order = [r[0] for r in spark.createDataFrame([(i,) for i, _ in rows], "id long").selectExpr("id", "xxhash64(id) AS h").orderBy("h").collect()]
    # id 0 has two texts: the one of smallest SHA-256 teaches
    texts = dict(rows) | {0: min((rows[0][1], ""), key=lambda t: hashlib.sha256(t.encode()).hexdigest())}
    features = toxicity.Features(bits)
    z, n = {}, {}

    def weight(at):
        if at not in z or (at != "intercept" and abs(z[at]) <= toxicity.L1):
            return 0.0
        threshold = 0.0 if at == "intercept" else toxicity.L1
        return -(z[at] - math.copysign(threshold, z[at])) / ((toxicity.BETA + math.sqrt(n[at])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(3):
        for i in order:
            if zlib.crc32(str(i).encode()) % 5 == 0:
                continue
            at = [*sorted(set(features.of(texts[i].encode()).tolist())), "intercept"]
            w = {a: weight(a) for a in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[i]
            for a in at:
                step = (math.sqrt(n.get(a, 0.0) + g * g) - math.sqrt(n.get(a, 0.0))) / toxicity.ALPHA
                z[a], n[a] = z.get(a, 0.0) + g - step * w[a], n.get(a, 0.0) + g * g
    expected = {a: weight(a) for a in z if a != "intercept" and weight(a)}
    assert expected and set(places.tolist()) == set(expected) and intercept == pytest.approx(weight("intercept"))
    assert all(w == pytest.approx(expected[a]) for a, w in zip(places.tolist(), weights))


# 9 licences

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def test_licences_by_brute_force(spark, odd, none):
    rng = random.Random(9)
    bits = ["under", "the", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "cc-by-nc", "Apache License, Version 2.0", "Under The MIT-License", "word", "GNU General Public License, version 3", "licensed"]
    rows = [(100 + i, " ".join(rng.choice(bits) for _ in range(rng.randint(0, 40))), "s") for i in range(200)] + ODD
    found = Counter(map(tuple, licences.digest(docs_of(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()))
    expected = Counter()
    for i, t, _ in rows:
        w = ALNUM.findall(lower(t))
        starts = sorted((j, label) for label, p in PHRASES.items() for j in range(len(w)) if w[j : j + len(p.split())] == p.split())
        expected[i, len(w), len(starts), starts[0][0] if starts else None, starts[-1][0] if starts else None, ",".join(sorted({x for _, x in starts}))] += 1
    assert found == expected
    assert licences.digest(none).count() == 0
    named = {r.doc_id: (r.labels, r.score) for r in licences.digest(docs_of(spark, [(1, "This work is licensed under the GNU General Public License, version 3.", "s"), (2, "nothing here", "s"), (3, "the MIT license", "s"), (4, "Licensed under CC BY-NC 4.0", "s")])).collect()}
    assert named[1][0] == "gpl-3" and named[1][1] == 1.0 and named[2] == ("", 0.0) and named[4][0] == "cc-by-nc"


FSF = "as published by the Free Software Foundation"
REAL = [
    ("GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n", "gpl-3", 1.0),
    ("under the terms of the GNU General Public License, version 3", "gpl-3", 1.0),
    (f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License {FSF}, either version 3 of the License, or (at your option) any later version.", "gpl-3", 1.0),
    (f"you can redistribute it and/or modify\n * it under the terms of the GNU General Public License\n * {FSF}; either version 2\n * of the License, or (at your option) any later version.", "gpl-2", 1.0),
    (f"modify it under the terms of the GNU Lesser General Public License {FSF}; either version 2.1 of the License, or (at your option) any later version.", "lgpl", 1.0),
    ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "agpl", 1.0),
    ("Mozilla Public License Version 2.0\n====", "mpl-2", 1.0),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL", "mpl-2", 1.0),
    ("CC BY-SA 3.0", "cc-by-sa", 1.0),
    ("photo: CC BY-SA 2.5", "cc-by-sa", 0.6),
    ("it is GNU General Public License version 3 code", "gpl-3", None),
    # the key phrase alone doesn't tell these apart
    ("Mozilla Public License Version 1.1", "", 0.0),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", "", 0.0),
]


def test_licences_of_real_notices(spark):
    found = {r.doc_id: r for r in licences.digest(docs_of(spark, [(i, t, "s") for i, (t, _, _) in enumerate(REAL)])).collect()}
    for i, (text, labels, score) in enumerate(REAL):
        assert found[i].labels == labels, text
        assert 0 < found[i].score < 1 if score is None else found[i].score == score, text


def test_licence_bodies(spark):
    bodies = [("MIT License\n\nCopyright (c) 2019 Somebody Else\n\n" + licences._MIT, "mit"), (licences._BSD_2 + licences._BSD_END, "bsd"), (licences._BSD_2 + "\n * " + licences._BSD_3 + licences._BSD_END, "bsd,bsd-3"), (licences._ISC, "isc"), (licences._ZLIB.replace("you must", "and you really must"), "zlib"), (licences._APACHE_2, "apache-2"), (licences._UNLICENSE, "unlicense"), (licences._BOOST, "boost")]
    found = {r.doc_id: r for r in licences.digest(docs_of(spark, [(i, t, "s") for i, (t, _) in enumerate(bodies)])).collect()}
    for i, (text, labels) in enumerate(bodies):
        assert found[i].labels == labels and found[i].score >= 0.9, text
    # one key phrase of several doesn't make a match, nor do two that are far apart
    apart = licences._ISC.replace("provided that", "provided that " + "word " * 60)
    assert [r.labels for r in licences.digest(docs_of(spark, [(1, "Altered source versions must be plainly marked", "s"), (2, apart, "s")])).orderBy("doc_id").collect()] == ["", ""]


def test_licence_matches_come_from_the_postings():
    text = [w.encode() for w in "this is under the mit license and cc by nc".split()]
    index = licences.PositionalIndex(licences.TEMPLATES, 10, {b"license": 9, b"the": 10})
    assert {licences.TEMPLATES[k].label for k, _, _ in index.matches(text)} == {"mit", "cc-by-nc"}
    mit = next(f for f, (k, _, _) in enumerate(index.phrases) if licences.TEMPLATES[k].base and licences.TEMPLATES[k].label == "mit")
    assert (mit, 2) in index.alignments(text) and all(start == 2 for f, start in index.alignments(text) if f == mit)
    # the second posting must stand at the same relative position
    assert mit not in {f for f, _ in index.alignments([b"under", b"mit", b"the", b"license"])}
    for rank in range(licences.ANCHORS):
        broken = licences.PositionalIndex(licences.TEMPLATES, 10, {})
        broken.postings[rank], broken.orders[rank] = {}, []
        assert not [m for m in broken.matches(text) if broken.needed[0] > rank]


# 10 sharding


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 7, 24, 100, 997):
        assert sorted(sharding.place(i, n, 3) for i in range(n)) == list(range(n))
        (a, b), keys = sharding.halves(n), sharding.round_keys(3)
        assert n <= a * b < n + a + b and all(sharding.unpermuted(sharding.permuted(x, a, b, keys), a, b, keys) == x for x in range(a * b))


@pytest.mark.parametrize("piece", [65_536, 3])
def test_shards(spark, odd, none, piece, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", piece)
    rows = [(i, f"text {i}", "s") for i in range(90)] + ODD + [(500, "same", "s")] * 20
    docs = docs_of(spark, rows)
    found = sharding.digest(docs).collect()
    n = len(rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted(r.row_number for r in found) == list(range(n))
    for r in found:
        at = sharding.place(r.row_number, n, 20_240_229)
        assert (r.shard, r.slot) == (at % 24, at // 24) and r.law == "rows" and r.grown_shard is None
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(24)) <= 1
    assert Counter(map(tuple, sharding.digest(docs.repartition(9)).collect())) == Counter(map(tuple, found))
    assert sharding.digest(none).count() == 0


def test_native_operators_run_no_python(spark, odd):
    for df in (mixing.digest(odd), sharding.digest(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


# the registered queries against their SQL


def test_queries_against_sql(spark):
    import duckdb

    from quarry.llm.oracles import ORACLES
    from quarry.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf)
        columns = sorted(df.columns)
        cursor = con.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns, name
        assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(repr([r[names.index(c)] for c in columns]) for r in cursor.fetchall()), name
