"""Every registered query of the subpackage, and the pipeline, over whole tables, against what must hold of their rows."""

import os
import re
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
QUERIES = __spark_entry__.queries()
NAMES = sorted(k for k in QUERIES if k.startswith("op"))


def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def held_out(i, n, k):
    return zlib.crc32(str(i).encode()) % n == k


def check_op4(rows):
    assert all(r.held_out == held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def check_op5(rows):
    assert all(r.held_out == held_out(r.doc_id, 7, 2) and r.score < 0 and r.n_known <= r.n_tokens for r in rows)
    size = {i: len(words(t)) + 1 for i, t, *_ in docs()}
    assert all(r.n_tokens == size[r.doc_id] for r in rows)


def check_op6(rows):
    size = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs()}
    assert all((r.size, r.text_crc32) == size[r.doc_id] and r.law == "bytes" and 0 <= r.shard < 16 for r in rows)
    for s in range(16):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def check_op8(rows):
    size, of = Counter(), {}
    for i, t, _, s in docs():
        of[i] = (len(words(t)), s)
        size[s] += len(words(t))
    taken = Counter()
    for r in rows:
        assert (r.size, r.source_size) == (of[r.doc_id][0], size[of[r.doc_id][1]]) and 0 <= r.taken <= 3 * r.size
        taken[of[r.doc_id][1]] += r.taken
    goal = {of[r.doc_id][1]: r.target for r in rows}
    assert all(abs(taken[s] - goal[s]) <= 3 for s in goal) and abs(sum(goal.values()) - sum(size.values())) < 1e-3


def check_op9(rows):
    text = {i: t for i, t, *_ in docs()}
    for r in rows:
        w = words(text[r.doc_id])
        windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        assert (r.n_words, r.n_repeat_words) == (len(w), len(again)) and r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and not (r.base_failed and r.kept)


def check_op10(rows):
    root = {r.doc_id: r.component_id for r in rows}
    fp = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert all(len(r.fingerprint) == 16 and root[r.component_id] == r.component_id <= r.doc_id for r in rows)
    assert all(root[a] == root[b] for a in fp for b in fp if (fp[a] ^ fp[b]).bit_count() <= 3)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows
    if name.split("_")[0] in ("op4", "op5", "op6", "op7", "op8", "op9", "op10"):
        assert sorted(r.doc_id for r in rows) == sorted(i for i, *_ in docs())
    check = globals().get("check_" + name.split("_")[0])
    if check:
        check(rows)


@pytest.mark.parametrize("name", sorted(k for k in __spark_entry__.oracle_sql() if k.startswith("op")))
def test_sql(spark, name):
    """DuckDB gives the same rows."""
    got = QUERIES[name](spark, SF)
    with duckdb.connect() as c:
        for f in os.listdir(SF):
            c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
        want = c.sql(__spark_entry__.oracle_sql()[name])
        assert sorted(got.columns) == sorted(want.columns)
        order = [want.columns.index(k) for k in got.columns]
        assert sorted((tuple(r[k] for k in order) for r in want.fetchall()), key=repr) == sorted(map(tuple, got.collect()), key=repr)


def test_pipeline(spark):
    """Each stage gives rows of its predecessor in the columns of documents; the last one shards them all."""
    table = corpus_pipeline.table(spark, SF, "documents")
    before = table
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = corpus_pipeline.scratch(stage(spark, before, SF), f"test{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == table.columns
            assert after.join(before, "doc_id", "left_anti").isEmpty() and after.count()
        else:
            assert after.count() == before.count() and {r.shard for r in after.collect()} <= set(range(16))
        before = after
    assert {r.doc_id for r in QUERIES["pipeline"](spark, SF).collect()} == {r.doc_id for r in after.collect()}
