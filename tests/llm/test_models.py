from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from refinery.llm import boosted_toxicity, ordinal_quality, samples, word_language
from refinery.llm.queries import QUERIES
from tests.llm.cases import empty, messy

LARGER = "/root/testdata/sf0.01"


def held(doc_id: int, modulus: int, part: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % modulus == part


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def labels_for(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def ranked_above(scores, marks) -> float:
    """Share of pairs of unlike labels in the right order."""
    scores, marks = np.array(scores), np.array(marks)
    high, low = scores[marks == 1], scores[marks == 0]
    return float(np.mean([(high > x).mean() + (high == x).mean() / 2 for x in low]))


def test_language_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    found = QUERIES["op6_word_language"](spark, LARGER).collect()
    assert len(found) == len(docs)
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 for r in found)
    unseen = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in unseen) >= 0.98 * len(unseen)


def test_known_words_come_first_then_shorter_and_shorter_grams():
    counts = [("en", "the", 0, 9), ("de", "der", 0, 9), ("en", "^the", 4, 5), ("en", "the$", 4, 5), ("de", "der", 3, 4), ("de", "x", 1, 2), ("en", "y", 1, 2)]
    model = word_language.LanguageModel(counts)
    best = lambda word: model.languages[int(model.word(word).argmax())]
    assert best("the") == "en" and best("derx") == "de" and best("yy") == "en" and best("xx") == "de"
    assert (model.word("derx") == model.logs[3][model.tables[3]["der"]]).all()
    assert (model.word("???") == 0).all()


def test_language_of_awkward_rows(spark):
    docs = messy(spark)
    found = word_language.language_report(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if r["doc_id"] in (3, 4, 5, 9):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert word_language.language_report(empty(spark)).count() == 0
    nothing = word_language.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


def test_every_word_of_the_sample_is_kept(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in letters[:6] for b in letters for c in letters for d in letters]
    rows = [(1, " ".join(words), "en"), (2, f"der die das {words[-1]}", "de")]
    model = word_language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    places = {model.tables[0][w] for w in words}
    assert len(places) == len(words) == 105_456 and len(model.tables[0]) == len(words) + 3
    # English counted it once, so it is not smoothed there as a word never seen.
    assert np.allclose(np.exp(model.word(words[-1])), [1.5 / (4 + 0.5 * 105_459 + 1), 1.5 / (105_456 + 0.5 * 105_459 + 1)])


def test_more_languages_than_fit_a_byte(spark):
    rows = [(i, f"word{i}x same".replace(str(i), "".join(chr(97 + int(c)) for c in str(i))), f"l{i:03}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = word_language.learn(docs)
    assert len(model.languages) == 300 and len(model.tables[0]) == 301
    found = word_language.language_column(docs, model).select("lang", "language.lang_pred").collect()
    assert len(found) == 300 and all(r["lang"] == r["lang_pred"] for r in found)


def test_scorer_forgets_and_stays_right():
    model = word_language.LanguageModel([("en", "the", 0, 9), ("de", "der", 0, 9), ("en", "a", 1, 9), ("de", "b", 1, 9)])
    small, large = word_language.LanguageScorer(model, entries=2), word_language.LanguageScorer(model)
    for text in ["the der a", "b b bb aab", "der der", "the aaa", "?"]:
        assert small(text) == large(text)


def test_toxicity_query(spark):
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    found = QUERIES["op7_boosted_toxicity"](spark, LARGER).collect()
    assert len(found) == 1000
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    unseen = [r for r in found if r["held_out"] and r["doc_id"] in marks]
    assert ranked_above([r["score"] for r in unseen], [marks[r["doc_id"]] for r in unseen]) > 0.75


def test_toxic_features():
    features = boosted_toxicity.ToxicFeatures({"idiot": 5.0, "moro-": 3.0})
    plain, hit, hidden = features("you are a kind person"), features("you are an idiot, MORON!!!"), features("you 1d1ot and id!ot")
    assert plain[:8] == [0.0] * 8 and hit[2] > 0 and hit[9] > 0 and hit[4] == 5.0
    assert hidden[7] > 0 and hidden[2] == 0
    assert features(None) == features("") == [0.0] * boosted_toxicity.FEATURES
    assert len(features("x")) == len(features("!!")) == len(features("你好 " * 3)) == boosted_toxicity.FEATURES


def test_disguises_count_whatever_stands_around_them():
    features = boosted_toxicity.ToxicFeatures({"idiot": 5.0, "moron": 4.0, "worthless": 3.0, "scum": 3.0})
    for token in ("1diot", "worthle$$", "$cum", "m-o-r-o-n", "i.d.i.o.t", "id!ot", "1" + "d" * 60 + "iot"):
        alone, beside = features(f"you {token} there"), features(f"you {token} there a_b")
        assert alone[7] == beside[7] == math.log1p(1), token


def test_toxicity_of_awkward_rows(spark):
    docs = messy(spark)
    toxic = labels_for(spark, [(i, 1, i % 2) for i in range(1, 12)] + [(2, 1, 1), (None, 1, 1), (4, 1, None), (999, 1, 1)])
    found = boosted_toxicity.toxicity_report(docs, toxic).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    stay = boosted_toxicity.drop_toxic(docs, toxic)
    assert stay.columns == docs.columns and stay.dtypes == docs.dtypes
    assert boosted_toxicity.toxicity_report(empty(spark), toxic).count() == 0
    assert {r["score"] for r in boosted_toxicity.toxicity_report(docs, no_labels(spark)).collect()} == {0.0}
    assert boosted_toxicity.drop_toxic(docs, no_labels(spark)).count() == docs.count()


def test_samples_are_bounded_and_fixed(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = labels_for(spark, [(i, 1, i % 2) for i in range(500)] * 2)
    one, two = (
        sorted(r["doc_id"] for r in samples.labelled_texts(docs, labels, F.max("toxic"), F.col("doc_id") > 9, 100).collect())
        for _ in range(2)
    )
    assert one == two and len(one) == 100 and min(one) > 9


def test_quality_query(spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    found = QUERIES["op4_ordinal_quality"](spark, LARGER).collect()
    assert len(found) == 1000
    assert all(0 <= r["tail_prob"] <= 1 and 0 <= r["expected_grade"] <= 2 and r["selected"] == (r["tail_prob"] >= 0.5) for r in found)
    unseen = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert ranked_above([r["tail_prob"] for r in unseen], [labels[r["doc_id"]]["quality"] for r in unseen]) > 0.85
    good = [r for r in unseen if labels[r["doc_id"]]["quality"] == 1]
    assert sum(r["selected"] for r in good) >= 0.97 * len(good)


def test_fit_is_a_cumulative_link_fit():
    source = np.random.RandomState(4)
    texts, grades = [], []
    for _ in range(900):
        good, bad = source.binomial(6, 0.5), source.binomial(6, 0.5)
        texts.append(" ".join(["good"] * (good > 3) + ["bad"] * (bad > 3) + [f"w{source.randint(30)}" for _ in range(8)]))
        grades.append(int(np.clip(1 + (good > 3) - (bad > 3) + (source.rand() > 0.9), 0, 2)))
    model = ordinal_quality.fit(texts, np.array(grades))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    tails = model.tails(texts)
    assert (tails[:, 0] >= tails[:, 1]).all()
    for k in range(2):
        assert abs(tails[:, k].mean() - (np.array(grades) > k).mean()) < 0.03
        assert ranked_above(tails[:, k], (np.array(grades) > k).astype(int)) > 0.8


def test_fit_of_nothing_keeps_everything():
    for grades in ([], [1, 1]):
        model = ordinal_quality.fit(["a"] * len(grades), np.array(grades, dtype=np.int64))
        assert model.tails(["x", None, ""]).shape == (3, 0)


def test_quality_of_awkward_rows(spark):
    docs = messy(spark)
    labels = labels_for(spark, [(i, i % 2, 0) for i in range(1, 12)] + [(None, 1, 0), (3, None, 1)])
    found = ordinal_quality.quality_report(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r["tail_prob"] <= 1 for r in found)
    stay = ordinal_quality.select_quality(docs, labels)
    assert stay.columns == docs.columns and stay.dtypes == docs.dtypes
    assert ordinal_quality.select_quality(docs, no_labels(spark)).count() == docs.count()
    assert ordinal_quality.quality_report(empty(spark), labels).count() == 0


@pytest.mark.parametrize("text", ["", None, "a", "!!! ???", "\n\n", "x " * 3000])
def test_hashes_of_any_text(text):
    assert len(ordinal_quality.hashed(text)) > 0


# Plain versions: every row scored again, one by one, from what was fitted.


def plain_tail(model, text, k):
    """P(grade > k) by the formula, token by token."""
    tokens = ordinal_quality.hashed(text).tolist()
    eta = math.fsum(float(model.weights[t]) for t in tokens) / math.sqrt(len(tokens))
    return 1 / (1 + math.exp(-max(-40, min(40, eta - float(model.thresholds[k])))))


def test_quality_rows_against_a_plain_scorer(spark):
    docs, labels = spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet")
    model = ordinal_quality.learn(docs, labels, ~F.coalesce(samples_fold() == 0, F.lit(False)))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in QUERIES["op4_ordinal_quality"](spark, LARGER).collect():
        tails = [plain_tail(model, texts[r["doc_id"]], k) for k in range(2)]
        assert abs(r["tail_prob"] - tails[0]) < 1e-4 and abs(r["expected_grade"] - sum(tails)) < 1e-4
        assert r["held_out"] == held(r["doc_id"], 5, 0)


def samples_fold():
    from refinery.llm.common import fold

    return fold("doc_id", 5)


def test_learning_sees_all_grades_it_is_given(spark):
    docs = spark.createDataFrame([(i, " ".join(["fine"] * (i % 4) + ["word"] * 5)) for i in range(400)], "doc_id long, text string")
    labels = labels_for(spark, [(i, i % 4, 0) for i in range(400)])
    model = ordinal_quality.learn(docs, labels, F.lit(True), grade=F.min("quality"))
    assert len(model.thresholds) == 3
    assert len(ordinal_quality.learn(docs, labels, F.lit(True)).thresholds) == 2  # 0 and 2 of label_grade
    assert ordinal_quality.FIT_ROWS >= 10_000


def test_labels_beyond_0_and_1_are_none(spark):
    docs = spark.createDataFrame([(i, f"you idiot moron {i}" if i % 2 else f"a kind word {i}") for i in range(200)], "doc_id long, text string")
    labels = labels_for(spark, [(i, 1, i % 2) for i in range(200)] + [(3, 1, 7), (4, 1, -1), (6, 5, 2)])
    model = boosted_toxicity.learn(docs, labels, F.lit(True))
    assert model.trees is not None
    scores = {r["doc_id"]: r["toxicity"] for r in model.score(docs).collect()}
    assert min(scores[i] for i in range(1, 200, 2)) > max(scores[i] for i in range(0, 200, 2))


def plain_tree(node, x):
    while hasattr(node, "subtreeDepth") and node.subtreeDepth() > 0:
        split = node.split()
        node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
    return node.prediction()


def plain_steps(steps, raw):
    """Isotonic regression by its boundaries: straight lines between them."""
    boundaries, values = steps.boundaries.toArray(), steps.predictions.toArray()
    return float(np.interp(raw, boundaries, values))


def test_toxicity_rows_against_a_plain_scorer(spark):
    docs, labels = spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet")
    model = boosted_toxicity.learn(docs, labels, F.lit(True))
    features = boosted_toxicity.ToxicFeatures(model.lexicon)
    trees = [(weight, tree._java_obj.rootNode()) for weight, tree in zip(model.trees.treeWeights, model.trees.trees)]
    rows = docs.filter("doc_id % 7 = 0").select("doc_id", "text")
    for r in model.score(rows).collect():
        x = features(r["text"])
        margin = sum(weight * plain_tree(root, x) for weight, root in trees)
        raw = 1 / (1 + math.exp(-2 * margin))
        assert abs(r["toxicity"] - (0.999 * plain_steps(model.steps, raw) + 0.001 * raw)) < 1e-9


def plain_language(counts, totals, keys, text):
    """Words by their counts, unseen ones by ever shorter n-grams, from plain dictionaries."""
    languages = sorted(totals[0])
    words = word_language.WORD.findall((text or "").lower())
    if not any(any(map(str.isalpha, w)) for w in words):
        return "und", 0.0
    log = lambda size, key, lang: math.log((counts.get((size, key, lang), 0) + 0.5) / (totals[size].get(lang, 0) + 0.5 * len(keys[size]) + 1))
    total = [0.0] * len(languages)
    for word in words:
        found = [(0, word)] if word in keys[0] else []
        for size in range(4, 0, -1):
            found = found or [(size, g) for g in word_language.grams(word, size) if g in keys[size]]
        for i, lang in enumerate(languages):
            total[i] += math.fsum(log(size, g, lang) for size, g in found) / len(found) if found else 0.0
    scaled = [t / math.sqrt(len(words)) for t in total]
    best = max(range(len(languages)), key=lambda i: (scaled[i], -i))
    return languages[best], 1 / math.fsum(math.exp(s - scaled[best]) for s in scaled)


def test_language_rows_against_a_plain_scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    counts, totals, keys = {}, [{} for _ in range(5)], [set() for _ in range(5)]
    for r in docs.collect():
        if held(r["doc_id"], 4, 2) or r["lang"] is None or r["text"] is None:
            continue
        for word in word_language.WORD.findall(r["text"].lower()):
            for size in range(5):
                for key in [word] if size == 0 else word_language.grams(word, size):
                    counts[size, key, r["lang"]] = counts.get((size, key, r["lang"]), 0) + 1
                    totals[size][r["lang"]] = totals[size].get(r["lang"], 0) + 1
                    keys[size].add(key)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in word_language.language_report(docs).collect():
        language, score = plain_language(counts, totals, keys, texts[r["doc_id"]])
        assert r["lang_pred"] == language and abs(r["score"] - score) < 1e-6
