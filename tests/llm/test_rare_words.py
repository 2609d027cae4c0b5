"""Rare words of the class model: classes of their own, by the same sums as the exchange."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readkin.llm import brown


def test_many_words_move_as_one_does():
    """Classes of many words at once are those of one after the other, also of words next to words of their own class."""
    rng = np.random.default_rng(3)
    c = 6
    for trial in range(20):
        a = rng.integers(0, c, 30)
        n = rng.integers(1, 40, 30) if trial % 2 else rng.integers(1, 4, 30)
        left, right = (np.array([np.bincount(rng.integers(0, c, k), minlength=c) for k in n]).astype(float) for _ in range(2))
        t = rng.integers(0, 30, (c, c)).astype(float)
        for x, y, k in zip(left, right, a):  # their own counts are in the pairs
            t[:, k] += x
            t[k, :] += y
        expected = [b if gain > 1e-6 else k for x, y, k in zip(left, right, a) for b, gain in [brown.best_class(x, y, 0.0, k, t)]]
        assert brown.Moves(t).best(left, right, a).tolist() == expected


def made(rng, n):
    """Words of two kinds, each at three places of a row, in the surroundings of a frequent word of their kind; all end alike."""
    around = [("car", ["red", "blue"], ["runs", "sits"]), ("go", ["quickly", "often"], ["home", "away"])]
    rows = []
    for i in range(n):
        frequent, before, behind = around[i % 2]
        rows.append((i, " ".join(f"{rng.choice(before)} {word} {rng.choice(behind)}" for word in [f"{'xy'[i % 2]}{i // 2}qq", frequent] * 3)))
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("in_task", [1e-6, 0.02])
def test_rare_words_have_classes_of_their_own(spark, partitions, in_task):
    """Words of one ending, all rare, are put into classes by what stands around them, not by the ending."""
    docs = spark.createDataFrame(made(random.Random(2), 400), "doc_id long, text string").repartition(partitions)
    rules = brown.Rules(classes=8, own_unit=0.02, in_task=in_task, sweeps=2)
    known = brown.vocabulary(docs.select("text"), rules)
    assert not any(w.endswith(b"qq") for w in known.units.words)
    kinds = {b"red": 2, b"blue": 2, b"quickly": 3, b"often": 3, b"runs": 4, b"sits": 4, b"home": 5, b"away": 5, b"car": 6, b"go": 7, b"": 1}
    cls = np.zeros(len(known.units.count), np.int16)
    for w, k in kinds.items():
        cls[known.units.of(w)] = k
    t = np.zeros((8, 8))
    for _, x in made(random.Random(2), 400):
        c = [1, *(kinds.get(w, 0) for w in brown.tokens(x.encode()))]
        np.add.at(t, (c[:-1], c[1:]), 1)
    texts = brown.scratch(brown.coded(docs.select("text", "doc_id", F.lit(True).alias("learn")), known.units).withColumn("rid", F.monotonically_increasing_id()), "coded")
    if in_task < 0.02:  # they are at hand
        now = brown.middle_classes(texts, cls, t, known.units, rules, flush=100)
        assert {(w[:1], int(now[k])) for w, k in known.units.at_hand.items() if k >= known.units.middle and w.endswith(b"qq")} == {(b"x", 6), (b"y", 7)}
        return
    rows = brown.rare_classes(texts, cls, t, known.units, rules).join(texts.select("rid", "doc_id"), "rid").collect()
    assert len(rows) == 1200 and sum(r.value & 1 for r in rows) == 400 and {(r.value >> 1) // 8 for r in rows} == {3}
    assert {(r.doc_id % 2, (r.value >> 1) % 8) for r in rows} == {(0, 6), (1, 7)}


@pytest.mark.parametrize("in_task", [1e-6, 0.02])
def test_scores_by_a_plain_sum(spark, in_task):
    """Rows of all tokens again: pairs, kinds and scores from one word's class each, with words that only held-out texts have."""
    rng = random.Random(4)
    rows = made(rng, 300) + [(1000 + i, None if i == 0 else "" if i == 1 else "red new1qq sits often new1qq x3qq home " + "strange " * 40) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    rules = brown.Rules(classes=8, own_unit=0.02, in_task=in_task, sweeps=2)
    learn = F.col("doc_id") < 1000
    got = {r.doc_id: r for r in brown.score(docs, learn, rules).collect()}
    known = brown.vocabulary(docs.where(learn).select("text"), rules, docs.where(~learn).select("text"))
    k = known.units.at_hand[b"strange"]
    assert known.units.exchanged <= k < known.units.middle and known.units.count[k] == 0
    texts = brown.scratch(brown.coded(docs.select("text", "doc_id", learn.alias("learn")), known.units).withColumn("rid", F.monotonically_increasing_id()), "coded")
    cls, t = brown.unit_classes(texts.where("learn"), known.units, rules)
    words = {i: brown.tokens((x or "").encode()) for i, x in rows}
    place = {(r.doc_id, r.pos): r.value for r in brown.rare_classes(texts, cls, t, known.units, rules).join(texts.select("rid", "doc_id"), "rid").collect()}
    own = {}
    for (i, p), value in place.items():
        assert own.setdefault(words[i][p], value >> 1) == value >> 1
    of = lambda w: own[w] % 8 if w in own else int(cls[known.units.of(w)])
    count = {}
    pairs = np.zeros((8, 8))
    for i in words:
        if i < 1000:
            for a, b in zip([b"", *words[i]], words[i]):
                count[b] = count.get(b, 0) + 1
                pairs[of(a), of(b)] += 1
    m = known.model(cls, pairs, np.bincount([of(w) for w in count], minlength=8), rules)
    assert all(own[w] // 8 == count.get(w, 0) for w in own)
    for i, t in words.items():
        c = [int(cls[1]), *map(of, t)]
        emitted = sum(np.log10(count[w] - m.discount) if w in count else m.unseen[of(w)] for w in t)
        assert abs(got[i].score - emitted - sum(m.transition[a, b] - m.room[b] for a, b in zip(c, c[1:]))) < 1e-6
        assert got[i].n_known == sum(w in count for w in t)
    for k in range(8):
        assert abs(sum(count[w] - m.discount for w in count if of(w) == k) + 10 ** m.unseen[k] - 10 ** m.room[k]) < 1e-6
