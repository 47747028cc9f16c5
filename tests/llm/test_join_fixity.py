"""Jaccard join against all pairs; components; Merkle audit against planted damage; oracles."""

import hashlib
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helixframe.llm import fixity, jaccard_join
from helixframe.llm.components import components
from helixframe.llm.queries import registry
from helixframe.session import scratch_path


def gram_set(t):
    w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    return frozenset(" ".join(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [gram_set(t) for _, t in rows]
    n = len(rows)
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    groups, same = {}, {}
    for i in range(n):
        groups.setdefault(find(i), []).append(i)
        same.setdefault(sets[i] or i, []).append(i)
    low = lambda own: min((rows[i][0] for i in own if rows[i][0] is not None), default=None)
    return [(rows[i][0], low(groups[find(i)]), low(same[sets[i] or i]), links[i]) for i in range(n)], len(groups)


def make_rows():
    rng = random.Random(7)
    rows = []
    for g in range(25):
        base = [f"t{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(9999)}"
            rows.append((len(rows) + 100, " ".join(w)))
    rows += [(3, None), (4, ""), (5, " ... "), (6, "one two"), (7, "One, two!"), (8, "two one"), (None, rows[0][1]), (6, "one two"), (9, "y " * 20_000)]
    return rows


@pytest.mark.parametrize("block", [2048, 3])
def test_join_matches_all_pairs(spark, block):
    rows = make_rows()
    want, groups = brute(rows)
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, uid int, class_id string")
    got = jaccard_join.jaccard_join(df, block_docs=block).collect()
    assert sorted(((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in got), key=repr) == sorted(want, key=repr)
    kept = jaccard_join.keep_one_per_group(df)
    assert kept.columns == df.columns and kept.count() == groups
    assert jaccard_join.jaccard_join(df.limit(0)).collect() == []
    assert jaccard_join.keep_one_per_group(df.limit(0)).collect() == []


def test_banding_reaches_its_recall():
    for recall in (0.9, 0.99, 0.9999):
        bands, rows = jaccard_join.banding(0.8, recall)
        assert 1 - (1 - 0.8 ** rows) ** bands >= recall and bands * rows <= 128
    with pytest.raises(ValueError):
        jaccard_join.banding(0.01, 0.999999, 4)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    random.Random(1).shuffle(edges)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}


def test_fixity_finds_exactly_the_damage(spark):
    rows = [(i, f"http://h/{i}", "x" * (i % 50)) for i in range(600)] + [(7, "http://h/7", "x" * 7)] * 90 + [(None, None, None), (900, None, "é" * 2000), (7, "http://h/7", "other")]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "page_id long, url string, html string, place int, Digest string")
    fault = F.col("record_id").isin(13, 200, 900)
    got = fixity.fixity_report(df, fault).collect()

    def record(i, u, h):
        body = (h or "").encode()
        return (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:{'' if i is None else i}>\r\nWARC-Target-URI: {u or ''}\r\n"
                f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"

    want = [(i, len(r := record(i, u, h)), hashlib.sha256(r).hexdigest(), rows.count((i, u, h)), i not in (13, 200, 900)) for i, u, h in set(rows)]
    assert sorted(((r.page_id, r.length, r.sha256, r.copies, r.intact) for r in got), key=repr) == sorted(want, key=repr)
    spans = {}
    for r in got:
        spans.setdefault(r.segment, []).append((r.segment_offset, r.length * r.copies))
    for s in spans.values():                                       # records lie side by side
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
    assert fixity.fixity_report(df.limit(0), fault).collect() == []


def test_audit_of_replicas_written_on_their_own(spark):
    base = scratch_path(spark, "audit_test")
    df = spark.range(6000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    a = fixity.write_replica(df, f"{base}/a")
    again = fixity.write_replica(df.orderBy(F.xxhash64("page_id")).repartition(7), f"{base}/b")
    _, none, trail = fixity.compare_replicas(a, again)
    assert none.count() == 0 and trail == [{"level": 3, "compared": 1, "differ": 0}]
    # one missing, one extra, one changed, one stored twice
    other = (df.filter("page_id <> 40").union(df.filter("page_id = 99")).union(spark.sql("select 7000L, 'u', 'new'"))
             .withColumn("html", F.when(F.col("page_id") == 77, "changed").otherwise(F.col("html"))).repartition(5))
    _, bad, trail = fixity.compare_replicas(a, fixity.write_replica(other, f"{base}/c"))
    got = sorted((r.record_id, r.copies_a, r.copies_b) for r in bad.select("record_id", F.coalesce("copies_a", F.lit(0)).alias("copies_a"),
                                                                          F.coalesce("copies_b", F.lit(0)).alias("copies_b")).collect())
    assert got == [(40, 1, 0), (77, 0, 1), (77, 1, 0), (99, 1, 2), (7000, 0, 1)]
    assert [t["differ"] for t in trail][0] == 1 and all(t["differ"] <= 5 and t["compared"] <= 80 for t in trail)
    # one missing record touches one node a level
    _, bad, trail = fixity.compare_replicas(a, a.filter("record_id <> 5"))
    assert bad.count() == 1 and [t["differ"] for t in trail] == [1] * len(trail)


@pytest.mark.parametrize("name", [k for k, (_, sql) in registry().items() if sql])
def test_queries_match_their_sql(spark, name):
    fn, sql = registry()[name]
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t)}.parquet')")
    df = fn(spark, SF001)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
