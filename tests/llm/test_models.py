import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import langid, toxicity

SF = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["schl", "ung", "ver", "eit"], "cc": ["eau", "que", "oux", "ille"]}


def _text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def _model(spark):
    rng = random.Random(1)
    rows = [(i, k, _text(rng, k, 60)) for i, k in enumerate(list(SYLLABLES) * 20)]
    rows += [(900, None, "zzz"), (901, "", "zzz"), (902, "dd", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    return langid.fit(df)


def test_mixture_shares_are_estimated(spark):
    model = _model(spark)
    assert model.languages == ["aa", "bb", "cc"]
    rng = random.Random(2)
    two = _text(rng, "aa", 120) + " " + _text(rng, "cc", 60)
    shares = model.shares([two, _text(rng, "bb", 50), "  ", ""])
    letters = [len(_text(random.Random(9), k, 500)) for k in ("aa", "cc")]
    expected = 120 * letters[0] / (120 * letters[0] + 60 * letters[1])
    assert abs(shares[0][0] - expected) < 0.15 and shares[0][1] == 0 and shares[0][2] > 0.1
    assert shares[1].tolist() == [0, 1, 0]
    assert np.allclose(shares[:2].sum(axis=1), 1)


def test_shares_do_not_depend_on_the_batch(spark):
    model = _model(spark)
    rng = random.Random(3)
    texts = [_text(rng, k, n) + _text(rng, "bb", m) for k in SYLLABLES for n in (1, 30) for m in (0, 20)]
    whole = model.shares(texts)
    for t, row in zip(texts, whole):
        assert np.allclose(model.shares([t])[0], row, atol=1e-4)


def test_predictions_of_odd_rows(spark):
    rows = [(1, None, "x", 1.0), (2, "", "x", 1.0), (3, "123 !?", "x", 1.0), (4, "kato miru " * 30000, "x", 1.0),
            (5, "schlung vereit", "x", 1.0), (5, "schlung vereit", "x", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in langid.predict(df, _model(spark)).collect())
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert got[3][1] == "aa" and got[4] == got[5] and got[4][1] == "bb"
    nothing = langid.fit(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}
    assert langid.predict(df.limit(0), nothing).count() == 0


def test_language_accuracy_on_held_out_documents(spark):
    got = langid.languages(spark, SF).where("held_out").join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 250
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_folding():
    assert toxicity.fold_text("Ihr 1d10t!! Ídіоt ver$agt 2024 c00l") == " ihr idiot idiot versagt 2024 cool "
    assert toxicity.fold_text("naïve Straße, don't") == " naive strasse don t "
    assert toxicity.fold_text("") == "  "


def test_matching_and_exceptions():
    lex = toxicity.Lexicon({" bad ": 2.0, " ugl": 1.0, " ugly ": 3.0}, {" not bad ", " bad hair "})
    assert sum(lex.matches(toxicity.fold_text("bad, UGLIER and ügly")).values()) == 6.0
    assert lex.matches(toxicity.fold_text("not bad; bad hair; badly snugly")) == {}
    assert len(lex.matches(toxicity.fold_text("not bad but bad"))) == 1
    assert toxicity.Lexicon({}).score("bad") == 0.0


def _naive_matches(weights, exceptions, folded):
    """Every term tried at every place, word by word."""
    hits = {i: max(w for t, w in weights.items() if folded.startswith(t, i))
            for i in range(len(folded)) if any(folded.startswith(t, i) for t in weights)}
    for e in exceptions:
        for i in range(len(folded)):
            if folded.startswith(e, i):
                hits = {s: w for s, w in hits.items() if not i <= s < i + len(e) - 1}
    return hits


def test_automaton_against_a_naive_scan():
    rng = random.Random(8)
    for _ in range(300):
        words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(12)]
        weights = {t: rng.uniform(1, 5) for t in rng.sample(sorted({f" {w} " for w in words} | {f" {w}" for w in words}), 5)}
        exceptions = {f" {rng.choice(words)} {rng.choice(words)} " for _ in range(3)}
        folded = toxicity.fold_text(" ".join(rng.choices(words, k=25)))
        assert toxicity.Lexicon(weights, exceptions).matches(folded) == _naive_matches(weights, exceptions, folded)


def test_folding_by_character_is_folding_by_run():
    def by_run(run):
        run = "".join(toxicity.HOMOGLYPHS.get(c, c) for c in run).replace("ß", "ss")
        return "".join(c if c < "\x80" else toxicity.HOMOGLYPHS.get(c) or ("q" if c.isalpha() else " ")
                       for c in unicodedata.normalize("NFKD", run)
                       if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")

    for text in ("Ünïcödé ｆｕｌｌ Ａ１ ﬁ é\u0301\u200bx", "한국어 日本 ß ẞ аеорс", "№ ½ ™ İ ǆ", "\U0001f600 a\u00adb"):
        assert text.lower().translate(toxicity._PLAIN) == by_run(text.lower())
    assert toxicity.fold_text("ｆｕｌｌ ﬁx") == " full fix "


def test_term_counts_and_choice_against_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FLUSH_TERMS", 50)
    rows = [(r.text, r.toxic) for r in _labelled(spark).collect()]
    without = {" moron ": 1.0}
    naive = {}
    for t, toxic in rows:
        folded = toxicity.fold_text(t)
        if toxic and not _naive_matches(without, (), folded):
            for term in toxicity.terms_of(set(folded.split())) | {""}:
                naive[term] = naive.get(term, 0) + 1
    bad = spark.createDataFrame([(t,) for t, toxic in rows if toxic], "text string").repartition(3)
    counts = toxicity._term_counts(bad, without)
    assert {r.term: r.n for r in counts.collect()} == naive
    other = {"": 1000, " scum ": 9, " lorem1 ": 500}
    got = toxicity._significant(counts, naive[""], spark.createDataFrame(list(other.items()), "term string, n long"),
                                1000, 6)
    for term, a in naive.items():
        b = other.get(term, 0)
        rate = (a + b) / (naive[""] + 1000)
        part = lambda x, n: x * np.log(x / (n * rate)) if x else 0.0
        wanted = (term and a >= 6 and (a + .5) / (naive[""] + 1) > 4 * (b + .5) / 1001
                  and 2 * (part(a, naive[""]) + part(b, 1000)) > 30)
        assert (term in got) == bool(wanted), term


def test_rare_terms_are_learned_and_copies_count_once(spark):
    rng = random.Random(4)
    plain = lambda: " ".join(f"w{rng.randrange(200)}" for _ in range(30))
    rows = [(plain() + " moron", 1) for _ in range(1500)] + [(plain() + " zzrare", 1) for _ in range(12)]
    rows += [(plain(), 0) for _ in range(1500)] + [("only copies say moron here", 0)] * 800
    df = spark.createDataFrame(rows, "text string, toxic int")
    sample = toxicity.draw_texts(df, 10 ** 6)
    assert sample.where("text LIKE 'only copies%'").count() == 1
    lex = toxicity.fit(df)
    assert " zzrare " in lex.weights and " moron " in lex.weights   # 0.8 % of the toxic documents
    drawn = toxicity.draw_texts(df, 300).groupBy("toxic").count().collect()
    assert all(200 < r["count"] < 400 for r in drawn)


def _labelled(spark, n=1200):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) + str(rng.randrange(30)) for _ in range(40)]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["moron", "m0ron", "scum", "grunzel" + rng.choice("abcdefgh")])
        elif i % 40 == 1:
            words[3:5] = ["pond", "scum"]
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_learned_lexicon(spark):
    df = _labelled(spark)
    lex = toxicity.fit(df)
    assert " moron " in lex.weights and any(t.startswith(" grun") for t in lex.weights)
    assert " pond scum " in lex.exceptions
    for text, toxic in [("you MORON there", 1), ("lorem1 ipsum2", 0), ("", 0), (None, 0), ("grunzelz lorem", 1),
                        ("lorem1 pond scum ipsum2", 0)]:
        assert (lex.score(text) >= 0.3) == bool(toxic), text
    out = toxicity.score(df.withColumn("score", F.lit("x")), lex)
    wrong = [r for r in out.collect() if (r.score >= 0.3) != bool(r.toxic)]
    assert len(wrong) <= 0.02 * df.count()
    assert toxicity.score(df.limit(0), lex).count() == 0
    assert toxicity.fit(df.where("toxic = 0")).weights == {}
    assert toxicity.fit(df.withColumn("toxic", F.lit(None).cast("int"))).score("moron") == 0.0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_toxicity_on_held_out_documents(spark, sf):
    got = toxicity.toxicity(spark, sf).where("held_out").join(
        spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    bad = [r.predicted for r in got if r.toxic == 1]
    fine = [r.predicted for r in got if r.toxic == 0]
    assert sum(bad) / len(bad) > 0.9 and sum(fine) / len(fine) < 0.02
    assert all(0 <= r.score <= 1 for r in got)
