import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from odometer.llm.language_id import (
    Model,
    _spherical_kmeans,
    drop_unidentified,
    held_out,
    identify,
    ngram_counts,
    train,
    train_on_open_rows,
)

SYLLABLES = {"aa": "ka to mi ren so ul", "bb": "zwe plo gri sht vux", "cc": "éa ñi oç üra ll"}


def text(rng, lang, words):
    s = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(s) for _ in range(rng.choice([1, 2, 3]))) for _ in range(words)) + "."


def labelled(spark, n=150, extra=()):
    rng = random.Random(9)
    rows = [(i, text(rng, lang, rng.choice([3, 30, 200])), lang, 1) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string, found int")


ODD = [
    (900, None, "aa", 1), (901, "", "aa", 1), (902, "123 !? 456", "bb", 1), (903, "ka to", None, 1), (None, "zwe plo gri", "bb", 1),
    (904, "ka to mi " * 200_000, "aa", 1), (905, "пример текста на другом языке " * 20, None, 1),
]


def test_held_out_accuracy_and_odd_rows(spark):
    docs = labelled(spark, 300, ODD)
    model = train_on_open_rows(docs)
    assert model.languages == ["aa", "bb", "cc"] and len(model.centroids) <= 12
    judged = identify(docs, model)
    assert judged.columns == [*docs.columns, "found_"]
    rows = judged.withColumn("h", held_out(F.col("doc_id"))).collect()
    assert len(rows) == 300 + len(ODD)
    test = [r for r in rows if r.h and r.doc_id is not None and r.doc_id < 900]
    assert len(test) > 40 and np.mean([r.lang == r.found_.lang_pred for r in test]) > 0.97
    by_id = {r.doc_id: r.found_ for r in rows if r.doc_id is None or r.doc_id >= 900}
    for i in (900, 901, 902):
        assert tuple(by_id[i]) == ("und", 0.0, True)
    assert by_id[903].lang_pred == "aa" and by_id[None].lang_pred == "bb" and by_id[904].lang_pred == "aa"
    assert by_id[905].rejected and by_id[905].lang_pred in model.languages
    assert all(0 <= r.found_.score <= 1 for r in rows)
    assert not any(r.found_.rejected for r in rows if r.doc_id is not None and r.doc_id < 900)
    kept = drop_unidentified(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {900, 901, 902, 905}


def test_held_out_rows_teach_nothing(spark):
    docs = labelled(spark, 200)
    poisoned = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = train_on_open_rows(docs), train_on_open_rows(poisoned)
    assert a.languages == b.languages and np.allclose(a.centroids, b.centroids) and a.floor == b.floor


def test_sample_is_bounded_whatever_the_skew(spark):
    docs = labelled(spark, 400)
    docs = docs.unionByName(docs.filter("doc_id = 0").crossJoin(spark.range(500).select(F.lit(1).alias("z"))).drop("z"))
    model = train(docs, sample=20)
    again = train(docs.repartition(5), sample=20)
    assert np.allclose(model.centroids, again.centroids)
    assert np.mean([r.lang == r.found_.lang_pred for r in identify(docs, model).collect()]) > 0.95


def test_ngrams_of_long_texts_are_whole():
    unit = "ka to mi. "
    long = unit * 250_000  # over two stretches
    assert ngram_counts(long).sum() >= ngram_counts(unit * 1000).sum() * 249
    assert ngram_counts("12 34") is None and ngram_counts(None) is None and ngram_counts("É") is not None


def test_kmeans_is_the_same_every_time():
    x = np.abs(np.random.default_rng(0).normal(size=(50, 8)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.array_equal(_spherical_kmeans(x, 3, 5), _spherical_kmeans(x, 3, 5))
    assert len(_spherical_kmeans(np.repeat(x[:1], 5, axis=0), 3, 5)) == 1


def test_empty_tables(spark):
    empty = labelled(spark, 0)
    model = train_on_open_rows(empty)
    assert isinstance(model, Model) and model.languages == []
    assert identify(empty, model).count() == 0
    assert identify(labelled(spark, 3), model).select("found_.*").collect()[0] == ("und", 0.0, True)


@pytest.mark.parametrize("left_out", ["fr", "es"])
def test_a_left_out_language_of_the_same_script_is_rejected(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null")
    learned = docs.filter(F.col("lang") != left_out)
    judged = identify(docs.select("doc_id", "lang", "text"), train_on_open_rows(learned), ["doc_id", "lang"])
    rows = judged.withColumn("h", held_out(F.col("doc_id"))).collect()
    strange = [r.found.rejected for r in rows if r.lang == left_out]
    own = [r.found.rejected for r in rows if r.lang != left_out]
    held = [r.found.rejected for r in rows if r.lang != left_out and r.h]
    assert len(strange) > 50 and np.mean(strange) >= 0.9
    assert np.mean(own) <= 0.01 and np.mean(held) <= 0.01


def test_one_mislabelled_row_loosens_no_floor(spark):
    docs = labelled(spark, 400)
    odd = spark.createDataFrame([(5000, "пример текста на другом языке " * 8, "aa", 1)], docs.schema)
    before, after = train(docs), train(docs.unionByName(odd))
    assert max(before.floor) == max(after.floor)
    assert all(after.floor[c] > 0.5 * before.floor[c] for c in before.floor)
