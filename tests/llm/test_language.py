"""Language ID: held-out accuracy, calibration and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np

from meridia.llm import language

WORDS = {"a": ["tha", "ther", "ing", "whe", "sho", "and"], "b": ["einé", "schö", "über", "ung", "keit", "der"], "c": ["ción", "los", "ellá", "mente", "que", "ñor"]}


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice("abc")
        text = " ".join("".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))
        rows.append((i, text, lang))
    return rows


def test_held_out_accuracy_and_inputs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.with_languages(df).collect()
    truth = {i: lang for i, _, lang in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) <= 6
    # labels of held-out rows have no say
    other = spark.createDataFrame([(i, t, "a" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language.with_languages(other).collect()} == {r.doc_id: r.lang_pred for r in got}


def test_odd_rows(spark):
    rows = [*corpus(60), (1000, None, "a"), (1001, "", "b"), (1002, "12 34 !!", "c"), (None, "thaing ther whesho", "a"), (1003, "thaing " * 50_000, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in language.with_languages(df).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (1000, 1001, 1002))
    assert got[1003].lang_pred == "a" and got[None].lang_pred == "a" and got[None].held_out is False
    assert language.with_languages(df.limit(0)).count() == 0
    none = df.select("doc_id", "text").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language.with_languages(none).collect()} == {"und"}
    kept = language.accepted(df)
    assert kept.columns == df.columns and kept.filter("doc_id IN (1000, 1001, 1002)").count() == 0


def test_subwords_agree_with_a_plain_count():
    texts = ["ab c", "", "12", "Über x", "a"]
    for k, (_, ends) in enumerate(language.subwords(texts), 1):
        want = []
        for text in texts:
            padded, n = "\n" + text + "\n", 0
            for i in range(len(text) + 1):
                w = padded[i : i + k]
                n += len(w) == k and (w.isalpha() if k == 1 else any(c.isalpha() for c in w) if k == 2 else w[1:-1].isalpha())
            want.append(n)
        assert np.diff(ends, prepend=0).tolist() == want


def test_a_text_is_predicted_alike_in_any_company(spark):
    model = language.train([(x, k, np.arange(5 * k, 5 * k + 5), np.ones(5)) for k, x in enumerate(["a", "b", None])])
    alone = [model.predict([t])[1][0] for t in ("thaing ther", "", "einé", "x")]
    assert np.allclose(model.predict(["thaing ther", "", "einé", "x"])[1], alone)


def test_what_is_in_no_learned_language_is_rejected(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("text IS NOT NULL")
    got = language.with_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    all_, gone, right = got.agg(F.count("*"), F.count_if("rejected"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert gone <= 0.003 * all_ and right >= 0.99 * all_
    # a language left out of training, and no language at all
    model = language.learned(docs.filter("lang <> 'de'").withColumn("held_out", F.lit(False)))
    unknown = [r.text for r in docs.filter("lang = 'de' AND n_chars > 100").limit(300).collect()]
    assert model.predict(unknown)[2].mean() >= 0.9
    rng = np.random.default_rng(5)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), n)) for n in rng.integers(60, 600, 200)]
    assert model.predict(noise)[2].mean() >= 0.95
    # short texts and mixtures stay
    short = [language.short_piece(r.text, rng, 3) for r in docs.filter("lang IN ('en', 'fr') AND n_chars > 20").limit(300).collect()]
    assert model.predict(short)[2].mean() <= 0.02


def test_many_languages_are_all_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 60)
    rng = random.Random(2)
    rows = [(12 * k + i, " ".join("".join(chr(97 + k) + rng.choice("aeiou") for _ in range(3)) for _ in range(20)), f"l{k:02d}") for k in range(20) for i in range(12)]
    got = language.with_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len({r.lang_pred for r in got}) == 20
