"""The pipeline's stages on a small corpus, each judged on its own input by brute force."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helixframe.session import scratch_path
from test_join_fixity import gram_set
from test_tokens import check_sequences

WORDS = ("the of and house river stone walking morning people light water garden table letter window paper music winter summer "
         "mountain village bridge harvest silver lantern meadow orchard travel reading painter kitchen").split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)

    def prose(n):
        return ". ".join(" ".join(rng.choices(WORDS, k=9) + [f"w{rng.randrange(10**6)}"]) for _ in range(n)) + "."

    docs, labels = [], []
    for i in range(330):
        t, toxic, good = prose(rng.randint(3, 8)), int(i % 5 == 0), int(i % 4 != 0)
        if toxic:
            t = t.replace(" the ", " idiot moron ", 1).replace(" of ", " worthless ", 1) + " you idiot moron."
        if not good:
            t = " ".join(w.upper() + "!!" for w in t.split())
        docs.append((i, t))
        labels.append((i, good, toxic))
    clean = [i for i, g, x in labels if g and not x]
    items = [(k, prose(2)) for k in range(4)]
    for k, i in enumerate(clean[:4]):
        docs[i] = (i, docs[i][1] + " " + items[k][1].upper())
    docs += [(1000, docs[clean[10]][1]), (1001, docs[clean[10]][1] + " once more"), (1002, None), (1003, ""), (None, prose(4)), (1004, "word " * 9000)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    folder = scratch_path(spark, "pipeline_in")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, labels, items


def test_every_stage_on_its_own_input(spark, corpus):
    folder, labels, items = corpus
    docs = spark.read.parquet(os.path.join(folder, "documents.parquet"))
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = scratch_path(spark, f"test-{name}")
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            a = {(r.doc_id, r.text) for r in before.collect()}
            b = [(r.doc_id, r.text) for r in docs.collect()]
            assert set(b) <= a and len(b) == len(set(b))
            seen[name] = (a, set(b))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "jaccard_join", "decontamination", "packing"]
    kept = lambda name: {i for i, _ in seen[name][1]}
    good, bad = {i for i, g, x in labels if g and not x}, {i for i, _, x in labels if x}
    assert len(bad & kept("toxicity")) <= 0.05 * len(bad) and len(good & kept("toxicity")) >= 0.97 * len(good)
    low = {i for i, g, x in labels if not g and not x}
    assert len(low & kept("quality")) <= 0.05 * len(low) and len(good & kept("quality")) >= 0.93 * len(good)
    # one of each group of near copies, in the stage's own input
    a, b = seen["jaccard_join"]
    sets = {x: gram_set(x[1]) for x in a}
    near = lambda x, y: sets[x] and sets[y] and 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])
    kept_rows = sorted(b, key=repr)
    assert not any(near(x, y) for i, x in enumerate(kept_rows) for y in kept_rows[:i])
    assert all(x in b or any(near(x, y) for y in a if y != x) for x in a)
    # benchmark items are gone, and nothing else
    a, b = seen["decontamination"]
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    grams = lambda t: {tuple(words(t)[i:i + 5]) for i in range(len(words(t)) - 4)}
    assert a - b == {x for x in a if any(len(grams(x[1]) & grams(t)) >= 0.8 * len(grams(t)) for _, t in items)}
    # every remaining document is packed whole
    packed = [r.asDict() for r in docs.collect()]
    check_sequences(packed, 4096)
    assert {r["doc_id"] for r in packed} == {i for i, _ in seen["decontamination"][1]}


def test_run_gives_the_rows_of_the_last_stage_and_takes_empty_tables(spark, corpus):
    folder, _, _ = corpus
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
    empty = scratch_path(spark, "pipeline_empty")
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(os.path.join(folder, f"{t}.parquet")).limit(0).write.parquet(os.path.join(empty, f"{t}.parquet"))
    assert corpus_pipeline.run(spark, empty).collect() == []
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_of_clashing_names_come_back_unchanged(spark, corpus):
    folder, _, _ = corpus
    names = ["UID", "Score", "uid_", "PACK_UID", "Doc", "Sequence_ID_", "rep", "digest", "item_id", "need"]
    docs = spark.read.parquet(os.path.join(folder, "documents.parquet")).filter("n_chars < 5000")
    docs = docs.withColumnRenamed("text", "Text")
    for k, n in enumerate(names):
        docs = docs.withColumn(n, F.concat(F.lit(f"{k}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    path = scratch_path(spark, "clash")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{k}-{'none' if r.doc_id is None else r.doc_id}" for r in rows for k, n in enumerate(names)), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()
