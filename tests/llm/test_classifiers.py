"""Held-out accuracy of the classifiers, that labels of held-out rows are never used, and the odd cases."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from helixframe.llm import langid, quality, toxicity

WORDS = ("the of and house river stone walking morning people light water garden table letter window paper music winter summer "
         "mountain village bridge harvest silver lantern meadow orchard travel reading painter kitchen").split()
INSULTS = ["idiot", "moron", "worthless", "pathetic", "scumbag"]


def fold(i, k):
    return zlib.crc32(str(i).encode()) % k


def sentences(rng, n):
    return ". ".join(" ".join(rng.choices(WORDS, k=9)).capitalize() for _ in range(n)) + "."


@pytest.fixture(scope="module")
def toxic_rows():
    rng, rows = random.Random(1), []
    for i in range(400):
        t = sentences(rng, rng.randint(1, 6)).split(" ")
        bad = i % 4 == 0
        if bad:
            for w in rng.sample(INSULTS, 2):
                if fold(i, 5) == 0:                      # held out: gapped or with a letter inserted
                    k = rng.randint(1, len(w) - 1)
                    w = rng.choice([".".join(w), w[:k] + rng.choice("xz") + w[k:], w.upper() + "!!"])
                t.insert(rng.randrange(len(t)), w)
        rows.append((i, " ".join(t), int(bad)))
    return rows


def test_toxicity_held_out(spark, toxic_rows):
    docs = spark.createDataFrame([(i, t, 9.0) for i, t, _ in toxic_rows], "doc_id long, text string, score double")
    # labels of held-out rows are wrong on purpose: they must not matter
    labels = spark.createDataFrame([(i, y if fold(i, 5) else 1 - y) for i, _, y in toxic_rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    test = [(i, y) for i, _, y in toxic_rows if fold(i, 5) == 0]
    assert all(got[i].held_out == (fold(i, 5) == 0) and got[i].predicted == int(got[i].score >= 0.5) for i in got)
    assert sum(got[i].predicted for i, y in test if y) >= 0.9 * sum(y for _, y in test)
    assert sum(got[i].predicted for i, y in test if not y) <= 0.03 * sum(1 - y for _, y in test)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.score < 0.5}


def test_kernel_tolerates_gaps_and_insertions():
    base = ["worthless"]
    near = toxicity.kernel([toxicity.fold_word(w) for w in ("w.o.r.t.h.l.e.s.s", "worxthless", "w0rthless", "worthles", "worthless")], base)[:, 0]
    far = toxicity.kernel(["morning", "weather", "kitchen", "worship"], base)[:, 0]
    assert near[0] == near[2] == near[4] and near.min() > 0.6 > 0.45 > far.max()


def test_words_of_other_scripts_are_told_apart():
    fold_word = toxicity.fold_word
    groups = [("идиот", "домик", "мороз"), ("ηλίθιος", "άνθρωπος"[:7]), ("バカ", "ハナ"), ("바보", "나무"), ("हत्यारा", "हत्यारी"), ("احمق", "بيوت"), ("笨蛋", "房子")]
    assert all(len(set(map(fold_word, g))) == len(g) for g in groups)
    assert fold_word("идио́т") == fold_word("идиот") and fold_word("ИДИОТ!".lower()) == "идиот" and fold_word("ídïót") == "idiot"
    k = toxicity.kernel([fold_word(x) for x in ("идиот", "ид-иот", "идиxот", "домик", "мороз", "петух")], ["идиот"])[:, 0]
    assert k[0] == k[1] > 0.9 and k[2] > 0.6 and k[3:].max() < 0.3
    rng = random.Random(4)
    plain, bad = "домик река камень город свет вода поле книга песня зима лето мост".split(), ["идиот", "тупица"]
    rows = [(f"{i} " + " ".join(rng.choices(plain, k=12) + ([bad[i // 2 % 2]] if i % 2 else [])), i % 2) for i in range(200)]
    import pyarrow as pa
    from helixframe.llm.common import Words
    got = toxicity.train(rows, 0.5).scores(Words(pa.array(["река и тупица", "город идиот зима", "город мост зима", "река вечер"])))
    assert got[:2].min() > 0.5 > got[2:].max()


def test_rare_insults_are_learned_beside_frequent_ones():
    import numpy as np
    import pyarrow as pa
    from helixframe.llm.common import Words
    rng, rare = random.Random(6), ["scumbag", "cretino", "gilipollas"]
    rows = []
    for i in range(600):
        bad = [] if i % 2 else ["idiot" if i % 10 else rare[i // 10 % 3]]         # 240 of one word, 20 of each rare one
        rows.append((f"{i} " + " ".join(rng.choices(WORDS, k=20) + bad), 1 - i % 2))
    learned = toxicity.witnesses([set(t.split()) for t, _ in rows], np.array([y for _, y in rows]))
    got = [toxicity.above(*learned[:2], q) for q in toxicity.LEVELS]
    assert {"idiot", *rare} <= set(got[0]) and all(set(a) <= set(b) for a, b in zip(got, got[1:]))
    model = toxicity.train(rows, 0.5)
    p = model.scores(Words(pa.array([" ".join(rng.choices(WORDS, k=20) + [w]) for w in ["idiot", *rare]] + [" ".join(rng.choices(WORDS, k=20)) for _ in range(20)])))
    assert p[:4].min() > 0.5 > p[4:].max()


def odd_rows(extra=()):
    return [(1000, None), (1001, ""), (1002, " \n "), (1003, "y" * 200_000), (1004, "漢字 😀"), (None, "the house"), (1005, "i d i o t you"), (1005, "again"), *extra]


def test_toxicity_odd_cases(spark, toxic_rows):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(i, t) for i, t, _ in toxic_rows] + odd_rows(), schema)
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_rows] + [(None, 1), (7, None), (8, 5)], "doc_id long, toxic int")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == len(toxic_rows) + len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert next(r for r in rows if r.doc_id is None).held_out is False
    clean = next(r.score for r in rows if r.doc_id is None)
    assert max(r.score for r in rows if r.doc_id == 1005) > 5 * clean       # written letter by letter
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity_scores(docs, none).collect()} == {0.0}
    assert toxicity.toxicity_scores(docs.limit(0), labels).collect() == []


@pytest.fixture(scope="module")
def quality_rows():
    rng, rows = random.Random(2), []
    for i in range(300):
        t, bad = sentences(rng, rng.randint(2, 8)), i % 3 == 0
        if bad:
            t = rng.choice([" ".join(w.upper() + "!!" for w in t.split()), " ".join(w + "$$$" for w in t.split()),
                            " ".join(w for w in t.split() for _ in range(6))])
        rows.append((i, t, int(not bad)))
    return rows


def test_quality_held_out(spark, quality_rows):
    docs = spark.createDataFrame([(i, t, 0.0, i % 2) for i, t, _ in quality_rows], "doc_id long, text string, score double, lang int")
    labels = spark.createDataFrame([(i, y if fold(i, 3) != 1 else 1 - y) for i, _, y in quality_rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    test = [(i, y) for i, _, y in quality_rows if fold(i, 3) == 1]
    assert all(got[i].held_out == (fold(i, 3) == 1) for i in got)
    assert sum(got[i].predicted == y for i, y in test) >= 0.95 * len(test)
    kept = quality.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.score >= 0.5}


def test_quality_odd_cases(spark, quality_rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in quality_rows] + odd_rows(), "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in quality_rows], "doc_id long, quality int")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(quality_rows) + len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    one = labels.filter("quality = 1")
    assert {r.score for r in quality.quality_scores(docs, one).collect()} == {1.0}
    assert quality.quality_scores(docs.limit(0), labels.limit(0)).collect() == []


def test_quality_scores_do_not_depend_on_the_rows_before(quality_rows):
    import numpy as np
    import pyarrow as pa
    signs = "!#$%&*+,-./:;<=>?@^~"
    noise = pa.array([" ".join(f"w{a}{b}{c}{d}" for c in signs for d in signs) for a in signs for b in signs])   # over 100,000 shapes
    probe = pa.array(["the house (]}) and river {)( stone |)} light", "people walking |({ home ])| again"])
    model = quality.train([(t, y) for _, t, y in quality_rows], 0.6)
    alone = model.scores(probe)
    model.vectors.clear()
    model.scores(noise)
    assert np.array_equal(model.scores(probe), alone)
    model.vectors.clear()
    together = model.scores(pa.concat_arrays([noise, probe]))
    assert np.allclose(together[-2:], alone, rtol=1e-9, atol=1e-12)


def test_temperature_and_repeats():
    import numpy as np
    import pyarrow as pa
    from helixframe.llm.common import Words
    w = Words(pa.array(["a a a b", "x y z x y z x", None, ""]))
    assert w.counts.tolist() == [4, 7, 0, 0]
    again, seen = quality.repeats(w)
    assert again.tolist() == [2, 0, 0, 0] and seen.tolist() == [0, 2, 0, 0]
    rng = np.random.default_rng(0)
    net = quality.Network(3)
    X = rng.normal(size=(4000, 3))
    true = net.logits(X)
    net.calibrate(X, (rng.random(4000) < 1 / (1 + np.exp(-true / 4))).astype(float), np.ones(4000))
    assert 3 < net.temperature < 5.5


LANG = {"en": "the house and river of the morning with people walking through light water", "de": "und der fluss ist nicht weit von dem alten haus mit schönen gärten über",
        "fr": "la maison et les rivières du matin avec des gens qui marchent où été", "es": "la casa y los ríos de la mañana con gente que camina por el agua niño"}


def test_language_held_out(spark):
    rng, rows = random.Random(3), []
    for i in range(480):
        lang = sorted(LANG)[i % 4]
        rows.append((i, " ".join(rng.choices(LANG[lang].split(), k=rng.randint(8, 60))), lang))
    wrong = [(i, t, lang if fold(i, 4) != 2 else "zz") for i, t, lang in rows]           # held-out labels must not matter
    odd = [(2000, None, "en"), (2001, "", "en"), (2002, "12 -- 34", "en"), (None, "the house and the river", "en"), (2003, "the " * 30_000, None), (2004, "ß", None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in wrong + odd], "doc_id long, text string, lang string, score double")
    rows_ = langid.language_predictions(docs).collect()
    got = {r.doc_id: r for r in rows_}
    test = [(i, lang) for i, _, lang in rows if fold(i, 4) == 2]
    assert sum(got[i].lang_pred == lang for i, lang in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*LANG, "und"} for r in rows_)
    assert [got[i].lang_pred for i in (2000, 2001, 2002)] == ["und"] * 3 and got[2003].lang_pred == "en"
    assert langid.language_predictions(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.language_predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_sample_is_the_same_for_any_order_of_rows(spark):
    import numpy as np
    rng = random.Random(9)
    rows = [(i % 30, " ".join(rng.choices(LANG[k].split(), k=12)), k) for i in range(300) for k in ("de", "en")]      # repeated ids
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = (langid.fit(d, per_language=20) for d in (docs, docs.orderBy(F.desc("text")).repartition(5)))
    assert a.langs == b.langs and np.array_equal(a.W, b.W)


def test_codewords_are_far_apart_and_decoding_flags_ambiguity():
    code = langid.codewords(6)
    d = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(d) >= 8 and all(len(set(c.tolist())) == 2 for c in code.T)
    rng = random.Random(5)
    model = langid.train([(" ".join(rng.choices(LANG[k].split(), k=20)), k) for k in LANG for _ in range(40)])
    names, score, unsure = model.predict([LANG["de"], LANG["fr"] + " " + LANG["es"], "la"])
    assert names[0] == "de" and not unsure[0] and score[0] > 0.9
    assert not (score[1] > score[0])
