"""Held-out accuracy of language, toxicity and quality, and defined results of odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tulha.llm import language, quality, toxicity
from tulha.llm.common import CHANCES, labelled, remainder, share, some_texts, table

FOLDER = "/root/testdata/sf0.1"
ODD = [(1, None, "en"), (2, "", None), (3, "!!! 12 ###", "fr"), (None, "the house", "en"), (4, "é" * 70_000, "de")]
ODD += [(5, "word " * 60_000, "en")] * 2
SCHEMA = "doc_id long, text string, lang string, score string, y int, v string"


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "q", 3, "w") for r in rows], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int, text string")


def held(i, modulus, rest):
    return zlib.crc32(str(i).encode()) % modulus == rest


def test_remainder_is_crc32_of_the_text(spark):
    rows = spark.range(200).select("id", remainder("id", 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_language_held_out(spark):
    docs = table(spark, FOLDER, "documents")
    rows = language.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in rows)
    out = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(rows) == docs.count() and np.mean(out) > 0.98
    assert sum(r.rejected for r in rows) < 0.002 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


FOREIGN = [
    "Il vecchio pescatore usciva ogni mattina prima dell'alba e tornava soltanto quando il sole era alto sopra le colline. ",
    "De oude visser ging elke ochtend voor zonsopgang naar buiten en kwam pas terug toen de zon hoog boven de heuvels stond. ",
    "Stary rybak wychodził każdego ranka przed świtem i wracał dopiero wtedy gdy słońce stało wysoko nad wzgórzami. ",
    "Vanha kalastaja lähti joka aamu ennen auringonnousua ja palasi vasta kun aurinko oli korkealla kukkuloiden yllä. ",
]


def test_unknown_languages_and_noise_are_rejected(spark):
    docs = table(spark, FOLDER, "documents")
    model = language.train(docs)
    letters = np.random.default_rng(1).integers(97, 123, (3000, 7), np.uint8)
    noise = " ".join(bytes(word).decode() for word in letters)
    bad = [t * n for t in FOREIGN for n in (9, 40, 200)] + [noise[:n] for n in (1000, 4000, 20_000)]
    assert all(model.predict(bad)[2])
    rows = docs.where(remainder("doc_id", 4) == 2).select("text").collect()
    for size in (20, 40, 80, 160, 1000):
        assert np.mean(model.predict([r.text[:size] for r in rows])[2]) < 0.01


@pytest.mark.parametrize("name, module, modulus, rest", [("toxic", toxicity, 5, 0), ("quality", quality, 3, 1)])
def test_held_out(spark, name, module, modulus, rest):
    docs, labels = (table(spark, FOLDER, t) for t in ("documents", "labels"))
    rows = module.report(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r[name] for r in labels.collect()}
    assert all(r.held_out == held(r.doc_id, modulus, rest) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    out = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in out]) > 0.95
    rare = 1 if name == "toxic" else 0
    assert np.mean([b == rare for a, b in out if a == rare]) > 0.7
    assert np.mean([b == rare for a, b in out if a != rare]) < 0.01


def test_labels_and_ids_are_no_inputs(spark):
    """Other ids, languages and sources give the same scores with the same model."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = language.train(docs)
    texts = [r.text for r in docs.collect()]
    first = model.predict(texts)
    again = model.predict(texts[::-1])
    assert first[0] == again[0][::-1]


@pytest.mark.parametrize("rows", [ODD, []])
@pytest.mark.parametrize("labels", [[(5, 1, 0, "x"), (3, 0, 1, "y"), (3, None, 1, "z"), (None, 1, 1, "")], []])
def test_odd_rows(spark, rows, labels):
    docs, marks = frames(spark, rows, labels)
    want = sorted(str(r[0]) for r in rows)
    found = language.report(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == want
    und = {str(r.doc_id) for r in found if r.lang_pred == "und"}
    assert {"1", "2", "3"} <= und or not rows
    assert all(r.rejected and r.score == 0 for r in found if r.lang_pred == "und")
    for module in (toxicity, quality):
        found = module.report(docs, marks).collect()
        assert sorted(str(r.doc_id) for r in found) == want
        assert all(0 <= r.score <= 1 for r in found)


def test_long_texts_are_read_whole(monkeypatch):
    """Slices add up: a toxic word far behind the first slice counts."""
    monkeypatch.setattr("tulha.llm.common.SLICE", 1000)
    model = toxicity.Model(np.array([int(toxicity.sets(["moron"])[0][0])]), np.array([9.0], np.float32), -4.0)
    score = model.scores(["and " * 5000, "and " * 5000 + "moron"], model.dense())
    assert score[0] < 0.1 and score[1] > 0.9
    whole = language.counts(["abc " * 3000])
    assert whole.sum() == pytest.approx(33_000, rel=0.01)
    assert quality.statistics(["a b " * 900])[0][1] == pytest.approx(np.log1p(1800))


def test_isotonic_and_ftrl_small():
    fitted = quality.isotonic(np.array([0.1, 0.5, 0.3, 0.9]), np.ones(4))
    assert fitted == pytest.approx([0.1, 0.4, 0.4, 0.9])
    rows = [np.array([1, 2]), np.array([3]), np.array([1, 4]), np.array([3, 4])] * 50
    model = toxicity.ftrl(rows, [1, 0, 1, 0] * 50)
    assert 1 in model.index and model.weight[list(model.index).index(1)] > 0


def hot_rows(spark):
    """One id with 2,000 texts, one row 2,000 times, and 2,000 other ids; all may be learned."""
    free = [i for i in range(8000) if not held(i, 5, 0) and not held(i, 4, 2)][:2002]
    n = F.col("id").cast("int")
    ids = F.array(*[F.lit(i).cast("long") for i in free])
    return spark.range(6000).select(
        F.when(n < 2000, F.lit(free[0])).when(n < 4000, F.lit(free[1])).otherwise(F.get(ids, n - 3998)).cast("long").alias("doc_id"),
        F.when((n >= 2000) & (n < 4000), "the same text").otherwise(F.concat(F.lit("words of "), F.hash("id").cast("string"), F.lit(" and more"))).alias("text"),
        F.lit("en").alias("lang"), (n % 2).alias("toxic"),
    ).repartition(16)


def test_training_samples_are_bounded_by_rows(spark, monkeypatch):
    rows = hot_rows(spark)
    docs, marks = rows.select("doc_id", "text", "lang"), rows.select("doc_id", "toxic")
    everything = labelled(docs, marks, "toxic", 5, 0, 10_000)
    assert everything.count() == docs.select("doc_id", "text").distinct().count() == 4001
    for bound in (100, 1000):
        found = labelled(docs, marks, "toxic", 5, 0, bound).count()
        assert found < 1.4 * bound
    monkeypatch.setattr(toxicity, "SAMPLE", 1000)
    assert toxicity.train(docs, marks).bias is not None


def test_language_sample_is_bounded_by_rows(spark):
    docs = hot_rows(spark)
    out = language.sampled(docs, {"en": share(1000, 6000)}).where("lang IS NOT NULL")
    chosen = out.select("n").distinct().count()
    assert 0.7 * 2 * 4001 / 6 < chosen < 1.3 * 2 * 1000
    copies = out.groupBy("n").count().agg(F.max("count")).first()[0]
    assert copies <= docs.rdd.getNumPartitions()  # a row repeated 2,000 times: once a task
    assert set(language.train(docs).languages) == {"en"}


def test_unlabelled_sample_is_bounded_by_rows(spark):
    """op1 and op3: the hot id and the hot row count as their different texts."""
    docs = hot_rows(spark)
    assert some_texts(docs, 10_000, 3).count() == docs.select("text").distinct().count()
    for bound in (300, 1500):
        found = [some_texts(docs, bound, seed).count() for seed in (3, 17)]
        assert all(0.45 * bound < n < 1.2 * bound for n in found)
    odd = spark.createDataFrame([(None,), ("",), ("",)], "text string")
    assert [r.text for r in some_texts(odd, 5, 3).collect()] == [""]
    assert some_texts(odd.limit(0), 5, 3).count() == 0


def test_share_of_very_large_tables():
    assert share(1000, 10) == share(1000, 1000) == CHANCES
    assert share(1000, 10**13) * 10**13 / CHANCES == pytest.approx(1000)
