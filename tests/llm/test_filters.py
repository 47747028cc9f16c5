"""URL rules, containment search, quality rules: brute force on small tables, and the odd cases."""

import re

import pytest
from pyspark.sql import functions as F

from helixframe.llm import decontaminate, quality_rules, url_filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("a.com", "/fr", "block"), ("org", "/x/", "block"), ("org", "/x/", "allow")]


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


@pytest.mark.parametrize("parts", [1, 7])
def test_url_filter_matches_brute_force(spark, parts):
    hosts = ["org", "x.org", "WWW.Example.ORG", "example.org", "notexample.org", "a.com", "b.a.com", "ba.com", "com", "example.org:80", "", "org.", "é.org"]
    paths = ["", "/", "/es/", "/es", "/en/12", "/en/2?x=/es/", "/fr/1#a", "/de/", "/x/y", "//", "/FR/", "?q=://org/"]
    urls = [None, "", "no scheme/es/", "://", "http:/org/"] + [f"http://{h}{p}" for h in hosts for p in paths]
    urls += ["https://hot.example.org/es/%d" % (i % 3) for i in range(300)]            # one host, repeated rows
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(None, "http://org/", "c", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, `range` string")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    got = sorted((tuple(r) for r in url_filter.filter_urls(df, rules, ranges=parts).collect()), key=repr)
    assert got == sorted(((i, *brute_url(u)) for i, u, _, _ in rows), key=repr)


def test_url_filter_equal_rows_travel_once_and_all_come_back(spark, monkeypatch):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    hot, n = "http://hot.example.org/es/1", 30_000
    pages = spark.range(0, 2 * n, 1, 3).select(F.when(F.col("id") % 2 == 0, F.lit(8)).otherwise(F.col("id")).alias("page_id"),
                                               F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.concat(F.lit("http://a.org/"), "id")).alias("url"))
    got = url_filter.filter_urls(pages, rules, ranges=5)
    assert [tuple(r) for r in got.groupBy("page_id", "host", "path", "rule", "verdict").count().filter("count > 1").collect()] == [(8, *brute_url(hot), n)]
    assert got.count() == 2 * n and got.filter("host = 'hot.example.org'").count() == n


def test_url_filter_empty_tables(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.filter_urls(pages, rules).collect()] == [(1, "a.org", "/", None, "allow")]
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


def grams(t, n=5):
    w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}


def test_containment_matches_brute_force(spark):
    import random
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(3, 60)))) for i in range(30)] + [(None, "a b c d e f g"), (90, None), (91, "")]
    docs = []
    for i in range(150):
        text = rng.choices(vocab, k=rng.choice([0, 4, 30, 600]))
        if i % 3 == 0:                                            # planted, some with a part missing
            item = items[i % 30][1].split()
            cut = item[: int(len(item) * rng.choice([1, 0.9, 0.8, 0.7, 0.5]))]
            text[len(text) // 2: len(text) // 2] = cut
        docs.append((i, " ".join(text).upper() if i % 2 else ", ".join(text)))
    docs += [(None, items[5][1]), (500, None), (501, ""), (502, "x " * 30_000 + items[6][1]), (503, items[7][1]), (503, items[8][1])]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, size int, h string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, k int")
    want = set()
    sets = {}
    for i, t in docs:
        sets[i] = sets.get(i, set()) | grams(t)
    for i, s in sets.items():
        for j, t in items:
            q = grams(t)
            if j is not None and q and len(s & q) >= 0.8 * len(q) - 1e-6:
                want.add((i, j, len(s & q), len(q)))
    for bound in (2_000_000, 0):                                  # broadcast, and the shuffled way beyond the bound
        got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontaminate.contained_items(df, bench, broadcast_rows=bound).collect()}
        assert got == want and len(want) > 20
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == sorted(
        (i if i is not None else -1) for i, _ in docs if i not in {a for a, *_ in want})
    assert decontaminate.contained_items(df.limit(0), bench).collect() == []
    assert decontaminate.contained_items(df, bench.limit(0)).collect() == []


def test_rows_that_share_an_id_are_dropped_one_by_one(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    first, last = "one two three four five six seven eight", "five six seven eight nine ten eleven twelve"
    rows = [(None, item), (None, "a clean text of some words"), (None, None), (7, "x " + item.upper()), (7, "another clean text of words"),
            (8, first), (8, last)]                                # 8: only both texts together hold the item
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, uid int")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    for bound in (2_000_000, 0):
        kept = decontaminate.drop_contaminated(docs, bench, broadcast_rows=bound)
        assert kept.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
            (x for i, x in enumerate(rows) if i not in (0, 3)), key=repr)


def test_sketch_misses_nothing_at_the_threshold(spark):
    # an item may lack (1 - t) of its shingles; more minima than that are kept for every size
    items = spark.createDataFrame([(n, i, i, n) for n in range(1, 70) for i in range(n)], "item_id long, sh long, h long, size int")
    kept = {r["item_id"]: r["n"] for r in decontaminate.item_sketch(items, 0.8).groupBy("item_id").agg(F.count("*").alias("n")).collect()}
    assert all(kept[n] >= min(n, n - -(-8 * n // 10) + 1) for n in range(1, 70))


def brute_base(text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    win = {}
    for i in range(len(words) - 7):
        win.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {j for at in win.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit))


def test_base_rules_match_brute_force(spark):
    texts = [None, "", " \n\t ", "a b", "é　ü\u0085x \x1c y", "the cat\n\nthe cat\nthe cat", "|#*$%&<> " * 9,
             "a b c d e f g h i " * 5, "x " * 40_000, "one two three four five six seven eight nine " + " ".join(f"w{i}" for i in range(40)),
             " ".join(f"the w{i} of" for i in range(200))]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(3, "a b", False), (None, "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    got = {(r.doc_id, *tuple(r)[1:6], r.base_failed) for r in quality_rules.quality_rules(df).collect()}
    want = {(i, *(b := brute_base(t)), b[0] < 20 or 100 * b[4] > 30 * b[0]) for i, t, _ in rows}
    assert got == want
    assert quality_rules.quality_rules(df.limit(0)).collect() == []


def test_divergence_rejects_what_differs_from_its_language(spark):
    import random
    rng = random.Random(1)
    words = quality_rules.COMMON_WORDS["en"] + ["table", "reading", "morning", "people", "nature"] * 6
    clean = [" ".join(rng.choices(words, k=120)) + "." for _ in range(60)]
    noisy = [" ".join(w + "$$$%%%" for w in rng.choices(words, k=60)) + " the of and" for _ in range(5)]
    short = ["the of and to in " + "#### " * 20]                    # below both minimum lengths: base rules alone
    df = spark.createDataFrame(list(enumerate(clean + noisy + short)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert all(got[i].kept for i in range(60))
    assert not any(got[i].kept for i in range(60, 65))
    assert got[65].char_distance is None and got[65].kept is not got[65].base_failed


def test_js_distance():
    import numpy as np
    p, q = np.array([[1.0, 0.0], [0.5, 0.5]]), np.array([[0.0, 1.0], [0.5, 0.5]])
    assert np.allclose(quality_rules.js_distance(p, q), [1, 0])


LISTED = quality_rules.COMMON_WORDS["en"]


def _prose(rng, words, listed, n):
    return " ".join(rng.choice(listed) if rng.random() < 0.3 else rng.choice(words) + str(rng.randrange(1000)) for _ in range(n))


def test_divergence_verdict_matches_brute_force_and_spares_other_languages(spark):
    import math
    import random
    rng = random.Random(9)
    english = ["river", "house", "window", "Winter", "paper", "stone,", "garden."]
    russian = ["река", "дом", "окно", "зима", "бумага", "камень,", "сад."]
    rows = [(i, _prose(rng, english, LISTED, 120)) for i in range(60)]
    rows += [(100 + i, _prose(rng, russian, ["лес"], 120) + " the") for i in range(8)]
    rows += [(200 + i, " ".join(w.upper() + "!?#" for w in _prose(rng, english, LISTED, 120).split())) for i in range(6)]
    rows += [(300, _prose(rng, english, LISTED, 30)), (301, None), (302, "")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, lead int")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert all(got[i].kept and got[i].char_distance is None for i in range(100, 108))            # no language: base rules alone
    assert not any(got[i].kept for i in range(200, 206)) and not any(got[i].base_failed for i in range(200, 206))

    def hists(t):
        raw, c = t.encode(), [0] * 8
        for ch in t:
            k = (0 if ch.islower() and ch.isascii() else 1 if ch.isupper() and ch.isascii() else 2 if ch.isdigit() else 3 if ch in " \t" else
                 4 if ch == "\n" else 7 if not ch.isascii() else 5 if ch in ".,;:!?'\"()-" else 6)
            c[k] += 1
        words = t.lower().split()
        w = [words.count(x) for x in LISTED]
        assert len(raw.split()) == len(words)
        return [x / sum(c) for x in c], [x / len(words) for x in w] + [1 - sum(w) / len(words)]

    def js(p, q):
        return math.sqrt(sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q, strict=True)) / 2)

    # all shouted texts hold listed words as well, so they are English and in its reference
    own = [i for i in got if got[i].char_distance is not None and got[i].n_words >= 50 and not got[i].base_failed]
    texts = dict(rows)
    parts = {i: hists(texts[i]) for i in own}
    mean = [[sum(parts[i][k][j] for i in own) / len(own) for j in range(len(parts[own[0]][k]))] for k in (0, 1)]
    for i in own:
        dc, dw = js(parts[i][0], mean[0]), js(parts[i][1], mean[1])
        assert abs(dc - got[i].char_distance) < 1e-9 and abs(dw - got[i].word_distance) < 1e-9
        assert got[i].kept == (dc <= 0.25 and dw <= 0.6 and (dc + dw) / 2 <= 0.23)
