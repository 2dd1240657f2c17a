"""Language, toxicity and quality: methods against direct definitions, and held-out accuracy."""

import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, quality, toxicity
from tidemark.llm.common import class_fractions, read, remainder

SF = "/root/testdata/sf0.01"


def edits(a, b):
    """Optimal string alignment distance, by its definition."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


# ------------------------------------------------------------------------------- language

def test_language_held_out(spark):
    out = language.op1_language_id(spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count()
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_back_off():
    model = language.Model(["de", "en"], {"haus": {"de": 9}, "house": {"en": 9}},
                           {1: {"h": {"de": 5, "en": 1}}, 2: {"th": {"en": 5}}, 3: {"sch": {"de": 5}}})
    score = lambda word: model.scores([word])[0, :-1]
    assert np.allclose(score("house"), model.matrix[model.words["house"]])  # words first
    assert np.allclose(score("schth"), model.matrix[model.grams[3]["sch"]])  # then the longest known length
    assert np.allclose(score("thx"), model.matrix[model.grams[2]["th"]])
    assert np.allclose(score("xh"), model.matrix[model.grams[1]["h"]])
    assert np.allclose(score("zz"), 0)
    assert model.predict("house, house!")[0] == "en" and model.predict("Haus 1 haus")[0] == "de"


def test_language_defined_cases(spark):
    rows = [(1, "the house of the man", "en"), (2, "das haus der mann", "de"), (3, None, "en"), (4, "", None),
            (5, "12 !! \n", "de"), (6, "the the the", None), (None, "das das", None), (6, "the the the", None)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    model = language.fit(docs, F.lit(True))
    out = [(r.doc_id, *r.p) for r in docs.select("doc_id", language.predictor(spark, model)("text").alias("p")).collect()]
    assert [(i, lang) for i, lang, _ in out] == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"),
                                                (None, "de"), (6, "en")]
    empty = language.fit(docs.limit(0), F.lit(True))
    assert empty.predict("anything") == ("und", 0.0)
    tie = language.Model(["aa", "bb"], {"x": {"aa": 1, "bb": 1}}, {})
    assert tie.predict("x") == ("aa", 0.5)


def direct_language(text, training, languages):
    """The back-off score by its definition, from raw counts."""
    counts = {}
    for lang, t in training:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            for size, g in [(0, w), *((k, f"^{w}$"[i:i + k]) for k in range(1, 5) for i in range(max(1, len(w) + 3 - k)))]:
                counts.setdefault((size, g), {}).setdefault(lang, 0)
                counts[size, g][lang] += 1
    totals = {(s, x): sum(c.get(x, 0) for (k, _), c in counts.items() if k == s) + sum(k == s for k, _ in counts)
              for s in range(5) for x in languages}
    log = lambda s, g: np.array([math.log((counts[s, g].get(x, 0) + 0.5) / totals[s, x]) for x in languages])
    total, words = np.zeros(len(languages)), re.findall(r"[^\W\d_]+", text.lower())
    for w in words:
        if (0, w) in counts:
            total += log(0, w)
            continue
        for size in (4, 3, 2, 1):
            known = [g for i in range(len(w) + 3 - size) if (size, g := f"^{w}$"[i:i + size]) in counts]
            if known:
                total += sum(log(size, g) for g in known) / len(known)
                break
    odds = np.exp((total - total.max()) / math.sqrt(len(words)))
    return languages[int(odds.argmax())], float((odds / odds.sum()).max())


def test_language_equals_its_definition(spark, monkeypatch):
    rng = random.Random(8)
    alphabet = {"aa": "abcde", "bb": "cdefg", "cc": "efgha"}
    word = lambda lang: "".join(rng.choice(alphabet[lang]) for _ in range(rng.randint(1, 7)))
    training = [(lang, " ".join(word(lang) for _ in range(12))) for lang in alphabet for _ in range(15)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(training)], "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    texts = [" ".join(word(rng.choice("aa bb cc".split())) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    texts += ["x" * 70 + " abc", "abc " * 30_000, "ab,cd.ef 12 GH"]
    monkeypatch.setattr(language, "REMEMBERED", 10_050)  # the memory starts anew between texts
    for text in texts:
        lang, score = direct_language(text, training, sorted(alphabet))
        got = model.predict(text)
        assert got[0] == lang and got[1] == pytest.approx(score, rel=1e-6)


def test_language_bounds_are_shared_by_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "WORDS", 4)
    monkeypatch.setattr(language, "GRAMS", 2)
    rows = [(1, "a a a b b c", "x1"), (2, "d d d e e f", "x2")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert sorted(model.words) == ["a", "b", "d", "e"] and all(len(t) <= 2 for t in model.grams.values())


def test_rare_language_keeps_its_documents(spark, monkeypatch):
    monkeypatch.setattr(language, "TRAIN_DOCS", 40)
    rows = [(i, "the house of the man", "en") for i in range(3000)] + [(5000 + i, "das haus der mann", "de") for i in range(3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert model.languages == ["de", "en"] and model.predict("das haus")[0] == "de"


def test_class_fractions_keep_the_bound_and_small_classes():
    for counts in ({"a": 10}, {"a": 1000, "b": 3}, {"a": 500, "b": 60, "c": 1}, {"a": 0, "b": 900}, {}):
        shares = class_fractions(100, counts)
        kept = {k: n * shares[k] for k, n in counts.items()}
        assert sum(kept.values()) == pytest.approx(min(100, sum(counts.values())))
        assert all(shares[k] == 1 for k, n in counts.items() if n <= 100 / len(counts))


# ------------------------------------------------------------------------------- toxicity

def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    terms = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(4, 8))) for _ in range(40)})
    lexicon = toxicity.Lexicon(terms, [], [])
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(3, 9)))
        near = any(edits(word, t) <= 1 for t in terms)
        assert (lexicon.accepts(word) is not None) == near
        assert bool(lexicon.match(word)) == near  # the pigeonhole test loses nothing


def test_misspellings_stems_and_clean_look_alikes():
    lexicon = toxicity.Lexicon(["moron", "stupid"], ["lowei"], ["oron"])
    assert [lexicon.match(w) for w in ("moron,", "m0ron", "mroon", "stupiid!", "oron", "loweixyz", "table", "...")] == [
        toxicity.EXACT, toxicity.FUZZY, toxicity.FUZZY, toxicity.FUZZY, 0, toxicity.EXACT, 0, 0]


def test_misspellings_inside_a_stem():
    family = ["idiot", "idiots", "idiotic", "idiocy", "idiotically"]
    lexicon = toxicity.Lexicon(family, ["idio"], [])
    assert [lexicon.match(w) for w in ("idoit", "1diot", "idot", "diots", "idi0cy", "idiotas", "table")] == [
        *[toxicity.FUZZY] * 5, toxicity.EXACT, 0]
    for word in ("idoit", "1diot", "idot"):  # a learned stem takes nothing away
        assert lexicon.match(word) == toxicity.Lexicon(["idiot"], [], []).match(word)


def test_quotation_is_not_abuse():
    matcher = toxicity.Matcher(toxicity.Lexicon(["idiot"], [], []))
    abuse = toxicity.features(matcher, "you are an idiot and more of this")
    quote = toxicity.features(matcher, 'he used the "idiot" here')
    said = toxicity.features(matcher, "the word idiot is old")
    assert abuse[0] > 0 and abuse[2] == 0
    assert quote[0] == 0 < quote[2] and said[0] == 0 < said[2]


def test_toxicity_held_out(spark):
    out = toxicity.op5_toxicity(spark, SF).join(read(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    clean = out[out.toxic == 0]
    assert (clean.predicted == 0).mean() >= 0.98
    assert out[out.toxic == 1].predicted.mean() >= 0.6  # some labelled texts of this size hold no term at all
    assert out[out.toxic == 1].score.mean() > clean.score.mean()


def test_rare_toxic_label_keeps_its_documents(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_DOCS", 400)
    rows = [(i, f"w{i}a w{i}b w{i}c w{i}d w{i}e" + (" you idiot" if i % 100 == 0 else ""), int(i % 100 == 0)) for i in range(8000)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(data.select("doc_id", "text"), data.select("doc_id", "toxic"), F.lit(True))
    assert "idiot" in model.matcher.lexicon.terms
    abusive, plain = model.score(["one two three you idiot", "one two three four five"])
    assert abusive > 0.5 and plain < 0.01  # odds as among all rows, one of a hundred of them toxic


def test_clean_look_alikes_beyond_the_bound_are_the_most_frequent(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CLEAN", 2)
    near = {"idiom": 1, "adiot": 9, "odiot": 2, "idipt": 9, "udiot": 1, "idiob": 3, "idyot": 1, "zidiot": 1, "idio": 2}
    words = [*["idiot"] * 40, *(w for w, n in near.items() for _ in range(n)), *["house"] * 20]
    rows = [(int(w == "idiot"), f"w{i}a w{i}b w{i}c {w} w{i}d w{i}e") for i, w in enumerate(words)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "toxic int, text string"))
    assert lexicon.terms == {"idiot"} and lexicon.clean == {"adiot", "idipt"}


def test_toxicity_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (2, "", "c"), (None, "x" * 200_000, "c")],
                                 "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    scores = [r.s for r in docs.select(toxicity.scorer(spark, model)("text").alias("s")).collect()]
    assert len(scores) == 4 and len(set(scores)) == 1 and 0 <= scores[0] <= 1
    none = toxicity.fit(docs.limit(0), labels.limit(0), F.lit(True))
    assert none.score(["a"])[0] == pytest.approx(0.5)


# -------------------------------------------------------------------------------- quality

def test_quality_held_out(spark):
    out = quality.op10_quality(spark, SF).join(read(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    assert (out.predicted == out.quality).mean() >= 0.95
    assert out.score.between(0, 1).all()


def test_risk_is_the_unbiased_one():
    """Unlabelled data of a known mixture: the learned boundary separates its parts."""
    rng = np.random.default_rng(0)
    positive = np.c_[rng.normal(2, 1, 1500), np.ones(1500)]
    hidden = rng.random(3000) < 0.7
    unlabelled = np.c_[np.where(hidden, rng.normal(2, 1, 3000), rng.normal(-2, 1, 3000)), np.ones(3000)]
    w = quality.descend(positive, unlabelled, 0.7)
    assert ((unlabelled @ w > 0) == hidden).mean() > 0.95


def test_curve_is_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(1.5 * x - 0.5)))).astype(int)
    slope, offset = quality.logistic_curve(x, y)
    assert abs(slope - 1.5) < 0.2 and abs(offset + 0.5) < 0.2


def test_quality_defined_cases(spark):
    assert quality.statistics(None) == quality.statistics("") == quality.statistics(" \n") == [0.0] * quality.WIDTH
    assert len(quality.statistics("a b | c!!")) == quality.WIDTH and all(map(math.isfinite, quality.statistics("x " * 90_000)))
    docs = spark.createDataFrame([(1, None, "c"), (2, "a b", "c"), (2, "a b", "c"), (None, "z", "c")],
                                 "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    for d, la in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        model = quality.fit(d, la, F.lit(True))
        scores = docs.select(quality.scorer(spark, model)("text").alias("s")).toPandas().s
        assert len(scores) == 4 and scores.between(0, 1).all() and scores[1] == scores[2]


def test_held_out_rows_are_never_learned_from(spark):
    """Changing the labels and languages of held-out rows changes nothing."""
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    flip = F.when(remainder("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    a = quality.fit(docs, labels, remainder("doc_id", 5) != 0)
    b = quality.fit(docs, labels.withColumn("quality", flip), remainder("doc_id", 5) != 0)
    assert np.allclose(a.weights, b.weights) and a.slope == pytest.approx(b.slope)
    assert isinstance(pd.Series(a.score(np.zeros((1, quality.WIDTH)))), pd.Series)
