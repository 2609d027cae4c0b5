"""Steps whose tasks must not grow with the table, and filters that must not be computed at the source."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from readkin import queries
from readkin.functions.sequence import gene_of, masked
from readkin.operators import qc, tables, trim
from readkin.plans import families

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_by_rows(spark):
    """Tasks by rows, not only by cores; no shuffle where the partitions do."""
    few = spark.range(0, 1000, 1, 2)
    assert tables.spread(few, 30).rdd.getNumPartitions() == 34 and tables.spread(few, 30).count() == 1000
    assert tables.spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "Exchange" not in plan(tables.spread(spark.range(0, 1000, 1, 40), 30))


@pytest.mark.parametrize("name", ["q_with_indels", "q_paralog_sort", "q_sliding_window_trim", "q_overrepresented", "q_wrong_identifiers"])
def test_filters_stay_above_the_shuffle_of_events(spark, name):
    """One file is one task: what is filtered below the shuffle is made there, by one core, and made again above it."""
    lines = plan(__spark_entry__.queries()[name](spark, SF)).splitlines()
    assert any("RoundRobinPartitioning" in x for x in lines) and not [x for x in lines if "Filter " in x and "md5(" in x]


def test_filters_read_their_verdict(spark):
    """The filter on ``shifted`` is on a column, not on the expressions that it is made of."""
    text = plan(__spark_entry__.queries()["q_with_indels"](spark, SF))
    assert max(len(x) for x in text.splitlines() if "Filter " in x) < 200


@pytest.mark.parametrize("least", [0, 20, 28])
def test_mask_by_stretches(spark, least):
    rng, rows = random.Random(3), []
    for _ in range(300):
        n = rng.randint(0, 20)
        rows.append(("".join(rng.choice("ACGT") for _ in range(n)), "".join(chr(33 + rng.choice([0, 2, 19, 20, 21, 27, 28, 93])) for _ in range(n))))
    for r in spark.createDataFrame(rows, "s string, q string").select("s", "q", masked(F.col("s"), F.col("q"), least).alias("m")).collect():
        assert r.m == "".join("N" if ord(c) - 33 < least else b for b, c in zip(r.s, r.q))


def test_windows_of_a_batch(spark):
    """Windows lie in one read, also where bad ones of the next follow; short, empty and missing qualities."""
    rng, rows = random.Random(5), [("", ""), ("AC", "!!"), ("ACG", None), ("ACG", "III"), ("A", "!")]
    for _ in range(500):
        n = rng.randint(0, 12)
        rows.append(("A" * n, "".join(chr(33 + rng.choice([2, 25, 30, 40, 40, 40])) for _ in range(n))))

    def plain(s, q):
        for k in range(len(q or "") - 2):
            if sum(ord(c) - 33 for c in q[k : k + 3]) < 84:
                return s[:k], q[:k]
        return s, q

    got = qc.sliding_window_trim(spark.createDataFrame(rows, "seq string, qual string").coalesce(1), mean=28, least=2)
    want = [x for x in (plain(s, q) for s, q in rows) if len(x[0]) >= 2]
    assert [tuple(r) for r in got.collect()] == want


def _computing(df):
    """Filters and join conditions of a plan that make reads, or align or call them, instead of reading columns."""
    return [x for x in plan(df).splitlines() if ("Filter " in x or "Join " in x) and ("md5(" in x or "regexp_extract_all(" in x or "raise_error(" in x)]


@pytest.mark.parametrize("made", ["_called", "_eligible"])
def test_alignments_are_made_once_and_above_the_shuffle(spark, made):
    """``usable`` and the excluded alleles are filters on columns: neither is pushed to the one task of the file, nor are alleles called twice."""
    df = getattr(queries, made)(spark, SF)
    assert "RoundRobinPartitioning" in plan(df) and not _computing(df)


def test_barcodes_with_an_n_are_filtered_above_the_shuffle(spark):
    """Before the alignment, but not by masking, making and splitting all reads in the one task of the file."""
    raw = queries._raw(spark, SF).select(F.lit("S0").alias("title"), "header", "seq", "qual")
    assert not _computing(families.alignments_of(raw, queries._refs(spark), queries.FACTORS))


def test_runs_of_a_union_share_one_call(spark, monkeypatch):
    """Alleles are called once for both runs, whose rows are those of the runs alone."""
    calls, call = [], queries.mutations.call
    monkeypatch.setattr(queries.mutations, "call", lambda *a, **k: calls.append(1) or call(*a, **k))
    got = queries.q_family_tables_union(spark, SF)
    assert len(calls) == 1
    alone = queries.q_family_table_bc3_missing(spark, SF)
    missing = got.where("run = 'BC3_missing'").drop("run")
    assert sorted(map(str, missing.collect())) == sorted(map(str, alone.collect())) and got.where("run = 'all'").count() == queries.q_family_table(spark, SF).count()


def test_place_sums_equal_a_plain_loop(spark):
    """Reads of unlike lengths, without scores, with more bases than scores and the other way round; no row is made for a letter."""
    rows = [("ACGTN", "IIII5"), ("NNG", "4"), ("", ""), (None, "55"), ("G", "I5I"), ("ACG", None), ("CCC", "🙂!~")]
    df = spark.createDataFrame(rows, "seq string, qual string")
    stats = qc.position_stats(df)
    want = {}
    for seq, qual in rows:
        for i, c in enumerate(qual or ""):
            b = (seq or "")[i : i + 1]
            want.setdefault(i + 1, []).append((ord(c) - 33, b == "N", b in ("G", "C")))
    got = {r.pos: tuple(r)[1:] for r in stats.collect()}
    assert got == {p: (len(x), sum(s for s, _, _ in x) / len(x), min(x)[0], max(x)[0], sum(n for _, n, _ in x), sum(g for _, _, g in x)) for p, x in want.items()}
    assert "Generate" not in plan(stats)


def test_each_haplotype_is_looked_for_in_a_step_of_its_own(spark):
    """Offsets are columns behind steps of their own, so no expression holds those of all genes; results are those of ``gene_of``."""
    reads = spark.createDataFrame([(k, "".join(random.Random(k).choice("ACGT") for _ in range(44)) + s + "ACGTACGT", True) for k in range(40) for s in ("AGTCCA", "TAGTCC", "GTCAAT", "TTTTTT")], "k int, insert_seq string, id_ok boolean")
    routed = trim.route(reads, queries.FACTORS)
    target, shifted = gene_of(F.col("insert_seq"), queries.FACTORS.genes, queries.FACTORS.sort_match, queries.FACTORS.others)
    assert sorted(map(tuple, routed.collect())) == sorted(map(tuple, reads.withColumns({"target": target, "shifted": shifted}).collect()))
    assert plan(routed).count("Generate inline(") >= 1 + len(queries.FACTORS.genes)
