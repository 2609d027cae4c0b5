"""Operators against brute force, exact round trips and held-out accuracy on small tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from readkin.llm import brown, common, decontamination, lines, mixing, outliers, quality, sharding, simhash, toxicity, urls

WORD = r"[^\x20\x09-\x0D]+"


def text(rng, n, words="the of and to in is was for on with as at by from alpha beta gamma delta".split()):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        t = text(rng, rng.randint(5, 120)) + (" " + " ".join(f"w{rng.randint(0, 4000)}" for _ in range(30)))
        rows.append((i, t, rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b", "c", None])))
    for i in range(240, 280):  # exact and near copies
        base = rows[i % 20][1].split()
        if i % 2:
            base[rng.randrange(len(base))] = "changed"
        rows.append((i, " ".join(base), "en", "b"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()


def test_simhash_components(spark, corpus):
    rows = corpus.collect()

    def fingerprint(t):
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if not w:
            return 0
        sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {r.doc_id: fingerprint(r.text) for r in rows}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fp)
    for a in ids:
        for b in ids:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fingerprint & (2**64 - 1), r.component_id) for r in simhash.components(corpus).collect()}
    assert got == {i: (fp[i], find(i)) for i in ids}
    kept = {r.doc_id for r in simhash.one_of_each(corpus).collect()}
    assert kept == {find(i) for i in ids}


def test_vantage_trees_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = [s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for s in seeds for _ in range(4)]
    fps = np.unique(np.array(near, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash.linked(df, leaf_size=32, tile=64)
    got = {r.node: r.root for r in common.connected_components(edges).collect()}
    parent = {int(x): int(x) for x in fps.view(np.int64)}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, x in enumerate(fps):
        for y in fps[k + 1 :][np.bitwise_count(fps[k + 1 :] ^ x) <= 3]:
            a, b = find(int(x.view(np.int64))), find(int(y.view(np.int64)))
            parent[max(a, b)] = min(a, b)
    assert {i: got.get(i, i) for i in parent} == {i: find(i) for i in parent}


def test_shards(corpus):
    rows = sharding.assign(corpus).collect()
    size = {s: sum(r.size for r in rows if r.shard == s) for s in range(16)}
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in rows) + 0.02 * sum(size.values())
    for s in range(16):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    texts = {r.doc_id: r.text for r in corpus.collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)


def test_mix(corpus):
    rows = mixing.mix(corpus).collect()
    sizes = Counter()
    for r in rows:
        assert r["__size"] == len(re.findall(WORD, r.text)) and r["__taken"] <= 3 * r["__size"]
        sizes[r.source] += r["__size"]
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:  # water filling
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        full = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not full:
            break
        fixed |= {s: 3 * sizes[s] for s in full}
    goal = {s: fixed.get(s, weight[s] * level) for s in names}
    for s in names:
        mine = [r for r in rows if r.source == s]
        assert all(abs(r["__target"] - goal[s]) < 1e-6 * total and r["__source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["__taken"] for r in mine) - goal[s]) <= 2
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(corpus).collect()), key=repr)


def test_apportionment(spark):
    goals = spark.createDataFrame([("a", 1, 53.0, 1000), ("b", 2, 24.0, 1000), ("c", 3, 23.0, 1000)], "key string, ord int, target double, total long")
    got = mixing.quotas(goals, shards=4, blocks_per_shard=25).groupBy("key").agg(F.sum("blocks").alias("n")).collect()
    seats = Counter()
    for _ in range(100):
        seats[max("abc", key=lambda k: {"a": 53, "b": 24, "c": 23}[k] / (2 * seats[k] + 1))] += 1
    assert {r.key: r.n for r in got} == dict(seats)


def test_leaks(spark, corpus):
    rng = random.Random(9)
    items = [(k, " ".join(f"q{rng.randint(0, 900)}" for _ in range(40)) + ". The answer is " + f"x{k}") for k in range(30)]
    rows = [(1000 + k, text(rng, 80) + " " + t.upper() + " " + text(rng, 80)) for k, t in items[:10]]
    half = [(2000 + k, " ".join(t.split()[:10])) for k, t in items[10:20]]
    docs = corpus.select("doc_id", "text").union(spark.createDataFrame(rows + half, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1000 + k, k) for k in range(10)}
    kept = {r.doc_id for r in decontamination.clean(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {1000 + k for k in range(10)}


def test_retrieval_is_exhaustive():
    """The pruned search returns what scoring every passage against every part returns."""
    rng = random.Random(2)
    vocab = [f"v{k}".encode() for k in range(60)]
    items = [(k, b" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 90)))) for k in range(40)]
    rules = decontamination.Rules(passage=32, stride=16, threshold=0.5, block=4)
    parts = [(i, p) for i, (_, t) in enumerate(items) for p in decontamination.item_parts(decontamination.words_of(t), rules.part)]
    df = Counter(w for _, p in parts for w in set(p))
    mean = sum(len(p) for _, p in parts) / len(parts)
    index = decontamination.ImpactIndex(items, df, len(parts), mean, rules)
    texts = [[rng.choice(vocab) for _ in range(rng.randint(0, 100))] for _ in range(30)] + [decontamination.words_of(t) for _, t in items[:5]]
    expected = set()
    for d, words in enumerate(texts):
        n = 1 + max(0, -(-(len(words) - 32) // 16)) if words else 0
        for k in range(n):
            seen = set(words[k * 16 : k * 16 + 32])
            for i, p in parts:
                tf, norm = Counter(p), rules.k1 * (1 - rules.b + rules.b * len(p) / mean)
                w = {t: math.log(1 + (len(parts) - df[t] + 0.5) / (df[t] + 0.5)) * c * (rules.k1 + 1) / (c + norm) for t, c in tf.items()}
                if sum(x for t, x in w.items() if t in seen) / sum(w.values()) >= rules.threshold - 1e-9:
                    expected.add((d, k * 16, i))
    assert index.retrieve(texts) == expected


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    bad = ["grobax", "flimzor", "krundle"]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = text(rng, 60).split()
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = toxicity.scores(docs, labels, learn=F.col("doc_id") % 5 != 0).collect()
    right = [(r.toxicity >= 0.5) == (r.doc_id % 6 == 0) for r in got if r.doc_id % 5 == 0]
    assert sum(right) >= 0.98 * len(right) and all(0 <= r.toxicity <= 1 for r in got)


@pytest.mark.parametrize("in_task", [1e-6, 0.01])
def test_brown_scores(spark, corpus, in_task):
    """Base by brute force, probabilities that sum to 1, rare words joined or at hand alike."""
    rules = brown.Rules(classes=12, own_unit=5e-3, in_task=in_task, sweeps=2)
    learn = F.col("doc_id") % 4 != 0
    got = {r.doc_id: r for r in brown.score(corpus, learn, rules).collect()}
    tokens = {r.doc_id: [*re.findall(WORD, r.text.lower()), ""] for r in corpus.collect()}
    c = Counter(w for i, t in tokens.items() if i % 4 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        assert abs(got[i].base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) < 1e-6
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(w in c for w in t), n)
    held = [i for i in tokens if i % 4 == 0]
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)
    model, _ = brown.fit(corpus.where(learn).select("text"), rules)
    cls = {w: model.cls[model.units.of(w.encode())] for w in c}
    emitted = np.zeros(12)
    for w, k in c.items():
        emitted[cls[w]] += (k - model.discount) / 10 ** model.room[cls[w]]
    emitted += 10 ** (model.unseen - model.room)
    assert np.allclose(emitted, 1) and np.allclose((10**model.transition).sum(axis=1), 1, atol=1e-6)


def test_rare_words_joined_equal_at_hand(corpus):
    a, b = ({r.doc_id: r.score for r in brown.score(corpus, F.lit(True), brown.Rules(classes=8, own_unit=0.02, in_task=x, sweeps=1)).collect()} for x in (1e-6, 0.02))
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_exchange_gain():
    """The gain of a move is the difference of the likelihoods before and after."""
    rng = np.random.default_rng(0)
    pairs, cls = rng.integers(0, 9, (20, 20)).astype(float), rng.integers(0, 4, 20)
    t = lambda c: np.array([[pairs[np.ix_(c == i, c == j)].sum() for j in range(4)] for i in range(4)])
    for u in range(20):
        rest = np.arange(20) != u
        left, right = (np.bincount(cls[rest], x[rest], 4) for x in (pairs[:, u], pairs[u]))
        b, gain = brown.best_class(left, right, pairs[u, u], cls[u], t(cls))
        options = [brown.likelihood(t(np.where(np.arange(20) == u, k, cls))) for k in range(4)]
        assert abs(max(options) - brown.likelihood(t(cls)) - gain) < 1e-6 and b == int(np.argmax(options))


def test_line_links(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(18, 50))) for _ in range(40)]
    found = set(base)
    for x in base:
        for _ in range(6):
            b = list(x)
            for _ in range(rng.randint(1, 3)):
                k, op = rng.randrange(len(b)), rng.random()
                b[k : k + 1] = [[rng.choice("abcé"), b[k]], [], [rng.choice("abcz")]][int(op * 3)]
            found.add("".join(b).strip())
    df = spark.createDataFrame(list(enumerate(sorted(x for x in found if x))), "line_id long, line string")
    got = {(r.a, r.b) for r in lines.linked(df).collect()}
    x, y = df.alias("x"), df.alias("y")
    slow = x.crossJoin(y).where("x.line_id > y.line_id and length(x.line) >= 20 and length(y.line) >= 20 and levenshtein(x.line, y.line) <= 2")
    assert got == {(r.a, r.b) for r in slow.select(F.col("x.line_id").alias("a"), F.col("y.line_id").alias("b")).collect()}


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(600):
        a = [rng.choice("abé") for _ in range(rng.randint(1, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = [rng.choice("abé")] * rng.randint(0, 1)
        if b:
            rows.append(tuple(sorted(("".join(a), "".join(b)), key=len, reverse=True)))
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select(F.levenshtein("a", "b").alias("l"), lines.bit_distance(F.split("a", ""), F.split("b", ""), edits).alias("m")).collect():
        assert r.l == r.m if r.l <= edits else r.m > edits


def test_line_classes_and_rewrite(spark):
    same, near = "a line that is long enough to be linked", "a line that is long enough to be linkd"
    docs = spark.createDataFrame([(1, f"{same}\n\nshort"), (2, f"x\n  {near} \nshort"), (3, same)], "doc_id long, text string")
    got = {(r.doc_id, r.line_no): r for r in lines.classes(docs).collect()}
    assert {k for k, r in got.items() if r.kept} == {(1, 0), (1, 2), (2, 0)}
    assert got[2, 1].links == 1 and got[3, 0].copies == 2 and got[2, 1].class_id == got[1, 0].class_id and got[2, 1].first_doc_id == 1
    assert {r.doc_id: r.text for r in lines.without_repeats(docs).collect()} == {1: f"{same}\n\nshort", 2: "x", 3: ""}


def test_text_statistics():
    for t in ("", "a b c d e a b c d e f", "x y\x1c z q é#é\n\n é#é\n é#é", "|a| <b> " * 30, "\x1d\x1e a\x85b"):
        w = re.findall(WORD, t)
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        hit = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        kept = [x for x in t.split("\n") if re.search(WORD, x)]
        assert outliers.statistics_of(t.encode())[:5] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(kept) - len(set(kept)), len(hit))


def test_outliers_found(spark):
    rng = random.Random(8)
    rows = [(i, text(rng, rng.randint(30, 200), [f"w{k}" for k in range(500)]), "en", "ab"[i % 2]) for i in range(400)]
    rows += [(1000 + i, text(rng, 100, [f"w{k}$$$#" for k in range(500)]), "en", "a") for i in range(30)]
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i].kept for i in range(30))
    assert sum(got[i].kept for i in range(400)) >= 0.99 * 400


def test_quality_held_out(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(400):
        good = rng.random() < (0.9 if i % 3 else 0.4)
        rows.append((i, text(rng, 80) if good else text(rng, 80).upper().replace(" ", "!! "), "en", f"s{i % 3}"))
        marks.append((i, int(good)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(marks, "doc_id long, quality int")
    got = quality.classify(docs, labels, learn=F.col("doc_id") % 4 != 0).collect()
    right = [r.kept == bool(marks[r.doc_id][1]) for r in got if r.doc_id % 4 == 0]
    assert sum(right) >= 0.97 * len(right)
    assert len({r.n_host for r in got}) > 0 and min(r.host_posterior for r in got) < max(r.host_posterior for r in got)


@pytest.mark.parametrize("options", [{}, {"hot": 5}, {"hot": 5, "broadcast_rows": 0}])
def test_urls_crowded_keys(spark, options):
    """Verdicts by a loop over all entries, whether or not crowded keys are dealt to parts."""
    rng = random.Random(4)
    hosts = [f"{x}{y}.com" for x in ("", "www.", "a.b.") for y in ("big", "big", "mid", "rare")]
    pages = [(i, f"http://{rng.choice(hosts)}/{rng.choice('xyz')}/{rng.choice('pq')}", rng.randrange(30)) for i in range(300)]
    pages += [(i, pages[0][1], pages[0][2]) for i in range(300, 340)] + [(340, None, 1), (341, "mailto:a", 1)]
    entries = [("l1", "block", "domain", "big.com"), ("l1", "block", "host", "www.mid.com"), ("l2", "allow", "prefix", "big.com/x"), ("l2", "block", "prefix", "a.b.big.com/y/p"), ("l3", "allow", "domain", "big.com")]
    spans = [(*e, since, since + 9) for e in entries for since in (rng.randrange(8), 8 + 9 + rng.randrange(4))]
    events = [(*e, action, at) for *e, since, upto in spans for action, at in (("add", since), ("remove", upto))]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string, fetched_at int"), spark.createDataFrame(events, "list string, verdict string, kind string, pattern string, action string, at int"), **options)

    def verdict(url, at):
        rest = (url or "").partition("//")[2]
        host = rest.partition("/")[0]
        fits = {"host": lambda p: host == p, "domain": lambda p: host == p or host.endswith("." + p), "prefix": lambda p: rest == p or rest.startswith(p + "/")}
        hits = [(list(urls.KINDS).index(k), len(p), v == "allow", name, v, k, p, since) for name, v, k, p, since, upto in spans if rest and since <= at < upto and fits[k](p)]
        return max(hits)[4:] if hits else ("none", None, None, None)

    rows = got.collect()
    assert len(rows) == len(pages)
    assert all((r.verdict, r.kind, r.pattern, r.valid_from) == verdict(r.url, r.fetched_at) for r in rows)
    assert len({r.verdict for r in rows}) == 3


def near_lines(n, seed=0, kinds="abcdefghijklmnopqrstuvwxyz"):
    """A line of 40 letters and copies of it with one or two letters changed, left out or put in."""
    rng = random.Random(seed)
    base = [rng.choice(kinds) for _ in range(40)]
    found = {"".join(base)}
    while len(found) < n:
        b = list(base)
        for _ in range(rng.randint(1, 2)):
            k = rng.randrange(len(b))
            b[k : k + 1] = rng.choice([[rng.choice(kinds)], [], [rng.choice(kinds), b[k]]])
        found.add("".join(b))
    return sorted(found)


@pytest.mark.parametrize("hot, tile", [(4, 8), (20, 1000), (10_000, 8)])
def test_line_links_in_tiles(spark, hot, tile):
    """Counts and classes of links by brute force, whether keys are hot or not."""
    rng = random.Random(11)
    found = set(near_lines(60)) | set(near_lines(40, seed=3)) | {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(7, 45))) for _ in range(60)}
    found |= {"short line a", "short line b", "short linea", "aaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaaaab"}
    df = spark.createDataFrame(list(enumerate(sorted(found))), "line_id long, line string")
    x, y = df.alias("x"), df.alias("y")
    near = "x.line_id <> y.line_id and levenshtein(x.line, y.line) <= case when least(length(x.line), length(y.line)) >= 20 then 2 when least(length(x.line), length(y.line)) >= 9 then 1 else -1 end"
    slow = [(r.a, r.b) for r in x.crossJoin(y).where(near).select(F.col("x.line_id").alias("a"), F.col("y.line_id").alias("b")).collect()]
    table = lines.keyed(df, lines.BANDS).where("size(own) > 0").select("line_id", "counts", "own", "asks")
    got = lines.links(table, df, hot=hot, tile=tile).cache()
    assert {r.id: r.n for r in got.groupBy("id").agg(F.sum("n").alias("n")).collect()} == Counter(a for a, _ in slow)
    group = lambda edges: {r.node: r.root for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert group([(r.id, r.other) for r in got.collect()]) == group(slow)


def test_large_group_of_near_lines(spark):
    """What is sent on from a group of 600 near copies grows with its lines, not with its pairs."""
    rng = random.Random(1)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30)]
    found = {"".join(base[:k] + [c] + base[k + 1 :]) for k in range(30) for c in map(chr, range(0x100, 0x100 + 170))}
    rows = list(enumerate(sorted(found)))[:600]
    df = spark.createDataFrame(rows, "line_id long, line string").repartition(8)
    table = lines.keyed(df, lines.BANDS).select("line_id", "counts", "own", "asks")
    got = lines.links(table, df, tile=200).cache()
    assert {r.n for r in got.groupBy("id").agg(F.sum("n").alias("n")).collect()} == {599}
    assert got.count() <= 8 * 600
    assert common.connected_components(got.select(F.col("id").alias("a"), F.col("other").alias("b"))).select("root").distinct().count() == 1


def test_mix_by_shards(corpus):
    """Every shard takes its quota from its own stretch of the ring, walked token by token."""
    docs = corpus.where("source is not null")
    for shards in (1, 5):
        got = mixing.mix(docs, shards=shards).collect()
        sizes = Counter()
        for r in got:
            sizes[r.source] += r["__size"]
        goals = mixing.targets(docs.sparkSession.createDataFrame([("s" + k, v) for k, v in sizes.items()], "key string, size long"))
        portions = {r.key[1:]: r.portions for r in mixing._portions(goals, mixing.quotas(goals, shards), 3, 17).collect()}
        # the documents of a source in their seeded order
        order = mixing._keyed(docs, 17).select("doc_id", "source", "__sub", "__h").collect()
        place = {r.doc_id: (r["__sub"], r["__h"], r.doc_id) for r in order}
        for source, parts in portions.items():
            mine = sorted((r for r in got if r.source == source), key=lambda r: place[r.doc_id])
            ring = [r.doc_id for r in mine for _ in range(r["__size"])]
            taken = Counter()
            for p in parts:
                stretch = ring[p.lo : p.hi]
                taken.update(stretch[(p.origin + k) % len(stretch)] for k in range(p.length))
            assert len(parts) == shards and {r.doc_id: r["__taken"] for r in mine} == {r.doc_id: taken[r.doc_id] for r in mine}
    one = {r.doc_id: r["__taken"] for r in mixing.mix(docs, shards=1).collect()}
    assert one != {r.doc_id: r["__taken"] for r in got}


def test_shard_cuts(spark, corpus):
    """Every row is in the shard of its first byte, but for small groups, which go whole with their first row."""
    docs = corpus.select("doc_id", "text").union(spark.createDataFrame([(5000 + k, f"copy {k % 3} " + "of a text " * 4) for k in range(60)], "doc_id long, text string"))
    got = {r.doc_id: r for r in sharding.assign(docs, shards=7, tolerance=0.05).collect()}
    h = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    order = sorted(got.values(), key=lambda r: (r.text_crc32, h[r.doc_id], r.doc_id))
    total, at, cut, groups = sum(r.size for r in order), 0, {}, {}
    for r in order:
        cut[r.doc_id] = at * 7 // total
        at += r.size
        groups.setdefault((r.text_crc32, h[r.doc_id]), []).append(r)
    for rows in groups.values():
        small = sum(r.size for r in rows) * 7 <= total * 0.05
        for r in rows:
            assert r.shard == (cut[rows[0].doc_id] if small else cut[r.doc_id])
    for s in range(7):
        assert [r.slot for r in order if r.shard == s] == list(range(sum(r.shard == s for r in order)))
