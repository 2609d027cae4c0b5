"""Every operator on nulls, empty and long texts, repeated rows, empty tables, extra columns."""

import pytest
from pyspark.sql import functions as F

from readkin.llm import brown, decontamination, lines, mixing, outliers, quality, sharding, simhash, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000 + "idiot"
ROWS = [
    (1, "A plain text of a few words that says nothing of note at all.", "en", "s", 10),
    (1, "A plain text of a few words that says nothing of note at all.", "en", "s", 10),
    (None, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t\n ", "de", None, 4), (4, LONG, "en", "t", 1), (None, "null id", "fr", "t", 1), (5, "é\x1cx ñ", "es", "s", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 0), (None, 1, 1), (2, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(7, "A plain text of a few words that says nothing of note at all."), (8, None), (9, "")], "item_id long, text string")


def operators(spark, labels, items):
    return {
        "simhash": lambda d: simhash.components(d), "one_of_each": lambda d: simhash.one_of_each(d), "sharding": lambda d: sharding.assign(d), "mix": lambda d: mixing.mix(d), "mixed": lambda d: mixing.mixed(d),
        "leaks": lambda d: decontamination.leaks(d, items), "clean": lambda d: decontamination.clean(d, items), "toxicity": lambda d: toxicity.scores(d, labels), "toxic_clean": lambda d: toxicity.clean(d, labels),
        "outliers": lambda d: outliers.judge(d), "brown": lambda d: brown.score(d, F.lit(True), brown.Rules(classes=8, sweeps=1)), "lines": lambda d: lines.classes(d), "quality": lambda d: quality.classify(d, labels),
    }


#: Rows out for the rows above.
SIZES = {"simhash": 8, "sharding": 8, "mix": 8, "toxicity": 8, "outliers": 8, "brown": 8, "quality": 8, "leaks": 2, "clean": 6, "lines": 5}
ALL = ["simhash", "one_of_each", "sharding", "mix", "mixed", "leaks", "clean", "toxicity", "toxic_clean", "outliers", "brown", "lines", "quality"]


@pytest.mark.parametrize("name", ALL)
def test_odd_rows(spark, docs, labels, items, name):
    got = operators(spark, labels, items)[name](docs).collect()
    assert len(got) == SIZES.get(name, len(got))
    if name == "one_of_each":
        # the empty texts are copies of each other, the plain rows too
        assert len(got) == 5


@pytest.mark.parametrize("name", ALL)
def test_empty_table(spark, docs, labels, items, name):
    assert operators(spark, labels, items)[name](docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", ALL)
def test_extra_columns(spark, docs, labels, items, name):
    more = docs.withColumns({c: F.lit("x") for c in ("size", "score", "learn", "n", "key", "shard", "p", "evidence1", "line", "fp", "total", "cut", "rank", "mask", "host", "path", "t", "u", "a.b")})
    got = operators(spark, labels, items)[name](more)
    assert got.count() == SIZES.get(name, got.count())
    if name in ("one_of_each", "mixed", "clean", "toxic_clean"):
        assert got.columns == more.columns


@pytest.mark.parametrize("name", ["toxicity", "toxic_clean", "quality"])
def test_without_labels(spark, docs, labels, items, name):
    got = operators(spark, labels.limit(0), items)[name](docs).collect()
    if name == "toxicity":
        assert {r.doc_id for r in got if r.toxicity >= 0.5} == {4}
    if name == "quality":
        assert all(r.kept for r in got)


def test_urls_edges(spark):
    pages = spark.createDataFrame([(1, None, 1), (2, "/relative", 1), (3, "https://User@WWW.a.com:80//x///y/?q#f", 5), (3, "https://User@WWW.a.com:80//x///y/?q#f", 5), (4, "http://b.com", None), (5, "", 3)], "page_id int, url string, fetched_at int")
    events = spark.createDataFrame([("l", "block", "domain", "a.com", "add", 2), ("l", "block", "domain", "a.com", "remove", 4), ("l", "block", "domain", "a.com", "add", 5), ("m", "allow", "prefix", "www.a.com/x/y", "add", 6), ("m", "allow", "prefix", None, "add", 0)], "list string, verdict string, kind string, pattern string, action string, at int")
    got = urls.judge(pages, events).orderBy("page_id").collect()
    assert [(r.page_id, r.verdict) for r in got] == [(1, "none"), (2, "none"), (3, "block"), (3, "block"), (4, "none"), (5, "none")]
    later = urls.judge(pages.withColumn("fetched_at", F.lit(7)), events).where("page_id = 3").first()
    assert (later.verdict, later.pattern) == ("allow", "www.a.com/x/y")
    assert {r.verdict for r in urls.judge(pages, events.limit(0)).collect()} == {"none"}
    assert urls.judge(pages.limit(0), events).collect() == []
    with pytest.raises(ValueError):
        urls.judge(pages.withColumn("kind", F.lit(1)), events)


def test_urls_deep_and_odd(spark):
    """URLs of thousands of parts have no more keys than the entries are deep; entries that no URL can have match nothing."""
    deep = "http://a.b.com/" + "/".join(f"p{k}" for k in range(8000))
    wide = "http://" + ".".join(["x"] * 4000) + ".com/q"
    pages = spark.createDataFrame([(1, deep, 5), (2, wide, 5), (3, "http://a.b.com/p0", 5), (4, "http://c..com/", 5)], "page_id int, url string, fetched_at int")
    url = F.col("url")
    sizes = [r.n for r in pages.orderBy("page_id").select(F.size(urls.keys_of(urls.host_of(url), urls.path_of(url), 2, 3)).alias("n")).collect()]
    assert sizes == [2 + 1 + 3, 2 + 1 + 1, 2 + 1 + 1, 2 + 1]
    long = "a.b.com/" + "/".join(f"p{k}" for k in range(700))
    entries = [("prefix", long), ("prefix", "a.b.com"), ("prefix", "a.b.com/"), ("prefix", "a.b.com/p0/"), ("prefix", ""), ("domain", ".com"), ("domain", ""), ("host", "b.com"), ("other", "a.b.com"), ("domain", "x.x.com")]
    events = spark.createDataFrame([("l", "block", k, p, "add", 0) for k, p in entries], "list string, verdict string, kind string, pattern string, action string, at int")
    got = {r.page_id: (r.kind, r.pattern) for r in urls.judge(pages, events).collect()}
    assert got == {1: ("prefix", long), 2: ("domain", "x.x.com"), 3: (None, None), 4: ("domain", ".com")}
