"""Reads of many samples in one plan, against running each sample by itself."""

import pytest
from pyspark.sql import functions as F

from readkin import queries, synth
from readkin.operators import consensus, designs, mutations, trim
from readkin.params import parse_factors
from readkin.plans import families

REFS = [(synth.LOCI[0], synth.REF_A), ("LOCA.others", synth.REF_A), (synth.LOCI[1], synth.REF_B)]


def made(spark, n=400):
    events = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"))
    return synth.raw_reads(events).withColumn("title", F.concat(F.lit("S"), F.col("event_id") % 3))


def rows(df):
    return sorted(map(repr, df.collect()))


def test_every_sample_as_by_itself(spark):
    reads = made(spark)
    got = designs.route(designs.split_barcodes(reads, designs.design_table(spark, queries.SAMPLES)))
    columns = [c for c in got.columns if c not in designs.COLUMNS]
    alone = [trim.route(trim.split_barcodes(reads.where(F.col("title") == f.sample), f), f).select(columns) for f in queries.SAMPLES]
    for f, one in zip(queries.SAMPLES, alone):
        mine = got.where(F.col("title") == f.sample).select(columns)
        assert rows(mine) == rows(one) and mine.select("target").distinct().count() == len(f.genes) + 1, f.sample


def test_consensus_of_samples(spark):
    reads, refs = made(spark).drop("event_id"), spark.createDataFrame(REFS, "target string, ref string")
    table, regions = designs.design_table(spark, queries.SAMPLES), designs.region_table(spark, queries.SAMPLES)
    got = consensus.rendered(families.consensus_of_samples(families.alignments_of_samples(reads, refs, table), refs, table, regions))
    want = []
    for f in queries.SAMPLES:
        own = reads.where(F.col("title") == f.sample)
        want += rows(consensus.rendered(families.consensus_of(families.alignments_of(own, refs, f), refs, f)).select(got.columns))
    assert rows(got) == sorted(want) and want


def test_plan_does_not_grow_with_samples(spark):
    """A thousand samples are rows of a table, not branches of a plan."""
    reads = made(spark, 10)
    sizes = []
    for n in (3, 1000):
        many = [parse_factors({"sample": f"S{k}", "size_f": "4", "size_r": "0"}) for k in range(n)]
        routed = designs.route(designs.split_barcodes(reads, designs.design_table(spark, many)))
        assert routed.count() == 10
        sizes.append(len(routed._jdf.queryExecution().optimizedPlan().toString()))
    assert sizes[1] < 1.1 * sizes[0]


def test_unknown_and_repeated_samples(spark):
    table = designs.design_table(spark, queries.SAMPLES[:2])
    with pytest.raises(Exception, match="no factors for sample S2"):
        designs.split_barcodes(made(spark), table).collect()
    with pytest.raises(Exception, match="no factors for sample null"):
        designs.split_barcodes(made(spark, 3).withColumn("title", F.lit(None).cast("string")), table).collect()
    with pytest.raises(ValueError, match="several rows"):
        designs.design_table(spark, [queries.SAMPLES[0]] * 2)
    with pytest.raises(ValueError, match="already have"):
        designs.with_design(made(spark, 3).withColumn("Genes", F.lit(1)), table)
    assert designs.split_barcodes(made(spark, 0), table).count() == 0


def test_short_and_missing_reads(spark):
    """Reads that are shorter than their barcodes, empty or null get the same as under their design alone."""
    reads = spark.createDataFrame([("S0", "@a", "ACG", "III"), ("S0", "@b", "", ""), ("S2", "@c", "ACGTAC", "IIII#I"), ("S0", "@d", None, None)], "title string, header string, seq string, qual string")
    got = designs.split_barcodes(reads, designs.design_table(spark, queries.SAMPLES)).select("header", "bc5", "bc3", "insert_seq", "id_ok")
    alone = [trim.split_barcodes(reads.where(F.col("title") == f.sample), f).select(got.columns) for f in queries.SAMPLES]
    assert rows(got) == sorted(x for a in alone for x in rows(a))


def test_regions_by_bins(spark):
    """Regions that lie across bins, touch, overlap, repeat, are empty or null."""
    regions = [("T", 60, 200), ("T", 64, 64), ("T", 64, 64), ("T", 1, 1), ("T", 9, 8), ("T", None, 4), ("U", 5, 5), ("U", 128, None)]
    table = spark.createDataFrame(regions, "target string, start int, stop int")
    bins = {r.target: r.roi for r in mutations.region_bins(table).collect()}
    for target in "TU":
        for place in range(1, 300):
            want = any(t == target and a and b and a <= place <= b for t, a, b in regions)
            assert any(r.start <= place <= r.stop for r in bins[target].get(place // 64, ())) == want
    aln = spark.createDataFrame([(t, "f", "b", 0, 0, "4M", "TTTT", "IIII") for t in "TUV"], "target string, bc5 string, bc3 string, flag int, pos0 int, cigar string, seq string, qual string")
    refs = spark.createDataFrame([(t, "ACGT") for t in "TUV"], "target string, ref string")
    called = mutations.call(aln, refs, spark.createDataFrame([("T", 1, 2), ("U", 3, 9)], "target string, start int, stop int"))
    assert {r.target: [m.allele for m in r.muts] for r in called.collect()} == {"T": ["1AT", "2CT"], "U": ["3GT"], "V": ["WT"]} and "__roi" not in called.columns


def test_excluded_by_sample(spark):
    table = spark.createDataFrame([(["1AT"], ["1AT", "2CT"]), (["2CT"], ["1AT"]), (["WT"], []), (["1AT"], None)], "a array<string>, excluded array<string>")
    reads = table.select(F.transform("a", lambda x: F.struct(x.alias("allele"))).alias("muts"), "excluded")
    assert [r.muts[0].allele for r in mutations.eligible(reads, "excluded").collect()] == ["2CT", "WT", "1AT"]
