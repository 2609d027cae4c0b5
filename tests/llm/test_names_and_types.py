"""Clashing names, ids of other types, letters of other scripts, groups of null keys."""

import random

import pytest
from pyspark.sql import functions as F

from readkin.llm import brown, copies, decontamination, lines, mixing, outliers, quality, sharding, simhash, toxicity

CLASHES = ("toxicity", "fingerprint", "features", "evidence", "__hash", "__row", "__id", "__gone", "__size", "__taken", "__key", "gone", "of", "score", "_c9", "c0")


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(12)
    rows = [(f"d{k:03}", " ".join(rng.choice("one two three four five six seven eight".split()) for _ in range(40)), "en", "s", int(k % 5 == 0)) for k in range(40)]
    rows = [(i, t + " moron scum idiot" * y, lang, s, y) for i, t, lang, s, y in rows]
    return spark.createDataFrame(rows, "doc_id string, text string, lang string, source string, y int")


def test_clashing_names_are_kept(spark, texts):
    docs = texts.drop("y").withColumns({c: F.lit("KEEP") for c in CLASHES})
    labels = texts.select("doc_id", F.col("y").alias("toxic"))
    items = spark.createDataFrame([("q1", texts.first().text)], "item_id string, text string")
    made = {
        "toxicity": toxicity.clean(docs, labels), "simhash": simhash.one_of_each(docs), "copies": copies.one_of_each(docs), "decontamination": decontamination.clean(docs, items), "mixing": mixing.mixed(docs), "lines": lines.without_repeats(docs),
    }
    for name, got in made.items():
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert rows and all(r[c] == "KEEP" for r in rows for c in CLASHES), name
    assert {r.doc_id for r in made["decontamination"].collect()} == {r.doc_id for r in docs.collect()} - {"d000"}


def test_string_ids(spark, texts):
    labels = texts.select("doc_id", F.col("y").alias("toxic"), (1 - F.col("y")).alias("quality"))
    items = spark.createDataFrame([("q1", texts.first().text)], "item_id string, text string")
    docs = texts.drop("y")
    assert [(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()] == [("d000", "q1")]
    for got in (toxicity.scores(docs, labels), brown.score(docs, F.lit(True), brown.Rules(classes=8, sweeps=1)), quality.classify(docs, labels), outliers.judge(docs), sharding.assign(docs), simhash.components(docs)):
        assert {r.doc_id for r in got.select("doc_id").collect()} == {f"d{k:03}" for k in range(40)}


def test_lower_case_of_other_scripts(spark):
    """Both sides of the search fold letters alike, final sigmas too."""
    words = "ΟΔΥΣΣΕΥΣ ΠΟΛΥΤΡΟΠΟΣ ΑΝΗΡ ΜΑΛΑ ΠΟΛΛΑ ΠΛΑΓΧΘΗ ΕΠΕΙ ΤΡΟΙΗΣ ΙΕΡΟΝ ΠΤΟΛΙΕΘΡΟΝ ΕΠΕΡΣΕΝ ΠΟΛΛΩΝ ΑΝΘΡΩΠΩΝ ΙΔΕΝ ΑΣΤΕΑ ΚΑΙ ΝΟΟΣ"
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    docs = spark.createDataFrame([(1, words), (2, words.replace("Σ", "σ")), (3, "nothing of note"), (4, words.lower())], "doc_id long, text string")
    assert {r.doc_id for r in decontamination.leaks(docs, items).collect()} == {1, 2, 4}
    lower = spark.createDataFrame([(1, words.lower())], "item_id long, text string")
    assert {r.doc_id for r in decontamination.leaks(docs, lower).collect()} == {1, 2, 4}


def test_evidence_beside_a_column_of_features(spark):
    docs = spark.createDataFrame([(k, f"some words of text {k} " * 5, "mine") for k in range(40)], "doc_id long, text string, features string")
    labels = spark.createDataFrame([(k, float(k % 2)) for k in range(40)], "doc_id long, quality double")
    got = quality.evidence(docs, labels)
    assert "features" in got.columns and {r.features for r in got.collect()} == {"mine"}


def test_many_small_indexes_find_the_same(spark):
    rng = random.Random(3)
    items = [(k, " ".join(f"q{rng.randint(0, 300)}" for _ in range(30))) for k in range(40)]
    docs = spark.createDataFrame([(100 + k, "before it " + t + " behind it") for k, t in items[::2]], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    small = decontamination.Rules(index_bytes=2500)
    assert len(list(decontamination.indexes(bench, small))) > 2
    whole, sliced = ({tuple(r) for r in decontamination.leaks(docs, bench, rules).collect()} for rules in (decontamination.Rules(), small))
    assert whole == sliced and len(whole) == 20 and decontamination.clean(docs, bench, small).count() == 0


def test_null_group_is_apart_from_small_groups(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    body = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(30, 120)))
    nulls = [(k, body(), None, None) for k in range(100)]
    few = [(1000 + k, " ".join(f"{rng.choice(words)}$$#" for _ in range(60)), "en", f"s{k % 9}") for k in range(90)]
    schema = "doc_id long, text string, lang string, source string"
    alone = {r.doc_id: r.distance for r in outliers.judge(spark.createDataFrame(nulls, schema)).collect()}
    beside = {r.doc_id: r.distance for r in outliers.judge(spark.createDataFrame(nulls + few, schema)).collect()}
    assert all(abs(alone[k] - beside[k]) < 1e-6 for k in alone)
