"""Files and logs of one pass; counts of micro-batches against families of all reads at once."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_hot_families import NUMBERS, SCHEMA, made

from readkin import synth
from readkin.operators import consensus, family, mutations, trim
from readkin.params import RunParams
from readkin.plans import families
from readkin.sources import readers, writers
from readkin.streaming import ingest
from readkin.synth import FACTORS

REFS = [(synth.LOCI[0], synth.REF_A), (FACTORS.others, synth.REF_A), (synth.LOCI[1], synth.REF_B)]


def raw(spark, n):
    events = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"))
    return synth.raw_reads(events).select(F.lit("S").alias("title"), "header", "seq", "qual")


def rows(df):
    return sorted(map(repr, df.collect()))


def test_one_pass(spark, tmp_path):
    trimmed = trim.split_barcodes(raw(spark, 600), FACTORS)
    routed = trim.route(trimmed, FACTORS).cache()
    spark.sparkContext.setJobGroup("one pass", "")
    log = writers.write_sorted(trim.sort_all(trimmed, FACTORS), str(tmp_path / "out"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one pass")
    spark.sparkContext.setJobGroup("rest", "")
    assert len(jobs) == 1
    want = trim.trim_log(trimmed).first()
    assert (log["wrong_identifier"], log["total"], log["percent"], log["with_indels"]) == (*want, trim.with_indels(routed).count()) and min(log.values()) > 0
    read = lambda sink: readers.read_fastq(spark, f"{tmp_path}/out/sink={sink}/title=S/target=*").select("header", "seq", "qual")
    named = lambda df: df.select("new_header", "insert_seq", "insert_qual").toDF("header", "seq", "qual")
    assert rows(read("ok")) == rows(named(routed)) and rows(read("withIndels")) == rows(named(trim.with_indels(routed)))
    assert rows(read("wrongId")) == rows(trim.wrong_identifiers(trimmed).select("header", "seq", "qual"))
    assert sorted(os.path.basename(x.path) for x in os.scandir(tmp_path / "out/sink=ok/title=S")) == sorted(f"target={r.target}" for r in routed.select("target").distinct().collect())


def test_one_pass_of_nothing(spark, tmp_path):
    none = trim.sort_all(trim.split_barcodes(raw(spark, 5).limit(0), FACTORS), FACTORS)
    assert writers.write_sorted(none, str(tmp_path / "out")) == {"total": 0, "wrong_identifier": 0, "with_indels": 0, "percent": None}


def test_header_only_with_rows(spark, tmp_path):
    some, none = spark.createDataFrame([("a", 1)], "k string, n int"), spark.createDataFrame([], "k string, n int")
    text = lambda p: "".join(open(f"{tmp_path}/{p}/{f}").read() for f in sorted(os.listdir(tmp_path / p)) if f.startswith("part-"))
    for name, table, lazy in (("a", some.coalesce(1), True), ("b", none, True), ("c", none, False)):
        writers.write_table(table, str(tmp_path / name), lazy_header=lazy)
    assert text("a") == "k\tn\na\t1\n" and text("b") == "" and readers.checked_table(spark, str(tmp_path / "a"), "k string, n int").count() == 1


@pytest.mark.parametrize("least", [1, 3])
def test_counts_of_parts_add_up(spark, least):
    """Reads dealt to parts at random, counted apart and added, give the numbers of all reads."""
    data = made(900, 5)
    out = ("1Cs", "2As")
    reads = spark.createDataFrame(data, SCHEMA)
    want = family.family_support(mutations.eligible(reads, out, least)).select(*mutations.FAMILY, "allele", "mutation_freq", *NUMBERS)
    rng, parts = random.Random(1), [[], [], [], []]
    for r in data:
        parts[rng.randrange(3)].append(r)  # the fourth part is empty
    counts = {}
    for p in parts:
        for name, c in family.partial_counts(spark.createDataFrame(p, SCHEMA), out).items():
            counts[name] = counts[name].union(c) if name in counts else c
    got = family.support_of_counts(**counts, bc3_min_reads=least).select(want.columns)
    assert rows(got) == rows(want) and want.count() > 100


def test_stream_of_reads_to_consensus(spark, tmp_path):
    """Batches of any order, one run again, and a stream that goes on later: the rows of all reads at once."""
    refs = spark.createDataFrame(REFS, "target string, ref string")
    reads = raw(spark, 240).orderBy(F.rand(1))
    whole = reads.collect()
    out, check = str(tmp_path / "counts"), str(tmp_path / "check")

    def arrive(part):
        spark.createDataFrame(part, ingest.SCHEMA).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.count_reads(ingest.read_drop_folder(spark, str(tmp_path / "in"), 1), refs, FACTORS, out, check).awaitTermination()

    arrive(whole[:100])
    last = str(tmp_path / "check/commits/1")
    for x in (last, str(tmp_path / "check/commits/.1.crc")):
        if os.path.exists(x):
            os.remove(x)  # as if the driver was lost before the second batch was noted as done
    arrive(whole[100:])
    params = RunParams()
    want = consensus.rendered(families.consensus_of(families.alignments_of(reads, refs, FACTORS), refs, FACTORS))
    assert rows(consensus.rendered(ingest.consensus_so_far(spark, out, params)).select(want.columns)) == rows(want)
    assert len(os.listdir(tmp_path / "counts/hits")) >= 4
