"""Near copies of the pipeline against brute force over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from readkin.llm import copies


def near_copies(seed, groups, per):
    """Short and medium texts, each with copies that have a changed word or two, and chains of such copies."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        t = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(3, 140))]
        for _ in range(rng.randint(1, per)):
            rows.append((len(rows), " ".join(t)))
            t = list(t)
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = f"x{rng.randint(0, 3000)}"
            if rng.random() < 0.2:
                t = [t[0].upper(), *t[1:]]
    return rows


def brute(rows, overlap=0.8):
    """Least doc_id of each component of pairs."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= overlap * len(sets[a] | sets[b]) - 1e-9:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in sets}


def test_stage_drops_changed_words(spark):
    rows = near_copies(1, 120, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()} == brute(rows)


@pytest.mark.parametrize("tile", [3, 8])
def test_large_groups_in_blocks(spark, tile):
    rows = near_copies(2, 3, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in copies.one_of_each(docs, tile=tile).collect()} == brute(rows)


def test_odd_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "A  b\nc"), (None, None), (2, ""), (3, " \n\t"), (4, "word " * 60_000), (5, "a b d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a.b", F.lit("x"))
    got = copies.one_of_each(docs)
    assert got.columns == docs.columns and sorted((r.doc_id or 0, (r.text or "")[:5]) for r in got.collect()) == [(0, ""), (1, "a b c"), (4, "word "), (5, "a b d")]
    assert copies.one_of_each(docs.limit(0)).collect() == []
