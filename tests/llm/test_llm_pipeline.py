"""The pipeline's stages on planted cases and on odd tables."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, docs, labels=(), bench=()):
    for name, rows, schema in (("documents", docs, COLUMNS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(list(rows), schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_planted_cases(spark, tmp_path):
    rng = random.Random(1)
    pool = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(3000)]
    text = lambda: " ".join(rng.choice(pool) for _ in range(80))
    docs = {i: text() + (" you vile scumbag" if i % 10 == 0 else "") for i in range(400)}
    bench = [(1, text()), (2, text())]
    for i in (11, 21):
        docs[i] = docs[i] + " " + " ".join(bench[0][1].split()[20:45])
    copies = {1000: docs[3], 1001: " ".join("edited" if k == 40 else w for k, w in enumerate(docs[3].split())), 1002: docs[5]}
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in {**docs, **copies}.items()]
    sf = write(spark, tmp_path, rows, [(i, 1, int(i % 10 == 0)) for i in docs], bench)
    frame, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf)
        frame.write.parquet(f"{sf}/out/{name}")
        frame = spark.read.parquet(f"{sf}/out/{name}")
        kept[name] = [r.doc_id for r in frame.collect()]
        if name != "sharding":
            assert frame.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    clean = {i for i in docs if i % 10}
    assert set(kept["toxicity"]) == clean | set(copies)
    assert Counter(kept["near_duplicates"]) == Counter(clean)
    assert Counter(kept["decontamination"]) == Counter(clean - {11, 21})
    mixed = Counter(kept["mixing"])
    assert set(mixed) <= clean - {11, 21} and max(mixed.values()) <= 3
    assert Counter(kept["sharding"]) == mixed
    rows = frame.collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and all(sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s])) for s in sizes)
    assert corpus_pipeline.run(spark, sf).count() == len(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "a", 0), (2, "a b c d e f", None, None, 5), (2, "a b c d e f", None, None, 5), (3, "x" * 300_000, "en", "a", 1)]])
def test_odd_tables(spark, tmp_path, rows):
    sf = write(spark, tmp_path, rows)
    frame = spark.read.parquet(f"{sf}/documents.parquet").withColumn("row", F.lit(1)).withColumn("own_id", F.lit("c"))
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf)
        frame.write.parquet(f"{sf}/out/{name}")
        frame = spark.read.parquet(f"{sf}/out/{name}")
    if rows:
        assert {r.doc_id for r in frame.collect()} == {2, 3}
