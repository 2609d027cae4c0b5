"""The worked cases of the barcode-family engine, one by one."""

import gzip

import pytest
from pyspark.sql import functions as F

from readkin.functions import sequence as q
from readkin.operators import adapters, align, consensus, family, mutations, qc, tables, trim
from readkin.operators import mates as mating
from readkin.params import Factors, Grid, full_grid, parse_factors
from readkin.plans import families
from readkin.sources import readers, writers
from readkin.streaming import ingest
from readkin.synth import FACTORS

REF = "ACGTACGTAC"
ALL = ((1, 10),)


def calls(spark, rows, roi=ALL, ref=REF):
    """``rows``: (family, barcode, sequence, quality[, cigar])."""
    data = [("S", "G", r[0], r[1], f"r{i}", 0, 0, 60, r[4] if len(r) > 4 else f"{len(r[2])}M", r[2], r[3]) for i, r in enumerate(rows)]
    aln = spark.createDataFrame(data, "title string, target string, bc5 string, bc3 string, qname string, flag int, pos0 int, mapq int, cigar string, seq string, qual string")
    return mutations.call(aln, spark.createDataFrame([("G", ref)], "target string, ref string"), roi)


HI = "I" * 10
F1 = [("F1", "AA", "ACGTACGTAC", HI), ("F1", "AA", "ACTTACGTAC", HI), ("F1", "CC", "ACTTACGTAC", HI), ("F1", "CC", "ACTTACGTAC", "II=IIIIIII"), ("F1", "GG", "ACGTACGTCC", "IIIIIIII<I")]
F2 = [("F2", b, "ACGTACGTAC", HI) for b in ("AA", "AA", "CC", "CC")] + [("F2", "AA", "ACTTACGTAC", HI)]
F3 = [("F3", "AA", s, HI) for s in ["ACATACGTAC"] * 3 + ["ACTTACGTAC"] * 3 + [REF] * 4]


def table_of(spark, rows):
    return family.family_table(mutations.eligible(calls(spark, rows)))


def test_family_table(spark):
    got = {r.allele: r for r in table_of(spark, F1).collect()}
    m, low, wt = got["3GT"], got["9AC"], got["WT"]
    pairs = lambda x: [(y.bc3, y.n) for y in x]
    assert (m.mutation_count, m.hq_count, m.total_count, m.hq_total_count, m.mutation_freq) == (3, 3, 5, 4, 0.75)
    assert pairs(m.bc3_hq) == [("AA", 1), ("CC", 2)] and (m.bc3_existing, m.bc3_missing) == (2, 0)
    assert pairs(m.bc3_all) == [("AA", 2), ("CC", 2), ("GG", 1)] and pairs(m.bc3_wt) == [("AA", 1), ("CC", 0), ("GG", 1)] and (m.bc3_wt_existing, m.bc3_wt_missing) == (2, 0)
    assert (low.mutation_count, low.hq_count, low.hq_total_count, low.mutation_freq, low.bc3_wt) == (1, 0, 4, 0.0, None)
    assert (wt.hq_count, wt.hq_total_count, wt.mutation_freq, wt.bc3_existing) == (1, 5, 0.2, 1)


def test_consensus_row(spark):
    r = consensus.rendered(consensus.consensus(table_of(spark, F1))).first()
    assert (r.consensus, r.mutation_freqs, r.mutation_counts, r.total_count, r.positions) == ("3GT;9AC", "0.750000;0.000000", "3;0", 5, 2)
    assert (r.wt_freqs, r.bc3_existing, r.bc3_mut_above1, r.bc3_wt_above1, r.bc3_all_wt_count, r.unmutated, r.unmutated_freq) == ("0.250000;1.000000", "2;0", "1;0", "0;0", "2;NA", 1, 0.2)


@pytest.mark.parametrize(
    "f, count, b, mode, want",
    [(0.7, 4, 2, 0, "3GT"), (0.8, 4, 0, 0, "3N"), (0.2, 0, 3, 0, "3N"), (0.0, 0, 0, 0, "3GT;9AC"), (0.7, 10, 0, 0, None), (0.7, 4, 2, 1, "3N")],
)
def test_cutoffs(spark, f, count, b, mode, want):
    grid = Grid((f,), (count,), (b,), *((2, 3) if mode else (0, 0)))
    got = consensus.at_count(consensus.apply_cutoffs(consensus.consensus(table_of(spark, F1)), grid), count).collect()
    assert [r.consensus for r in got] == ([want] if want else [])


def test_rejected_mutation_is_wild_type(spark):
    r = consensus.apply_cutoffs(consensus.consensus(table_of(spark, F2)), Grid((0.5,), (4,), (1,), 0, 0)).first()
    assert (r.consensus, r.freqs, r.counts, r.positions) == ("WT", "0.800000", "4", 0)


def test_ambiguous_place(spark):
    cons = consensus.consensus(table_of(spark, F3))
    r = consensus.apply_cutoffs(cons, Grid((0.5,), (0,), (0,), 0, 0)).first()
    assert (r.consensus, r.counts, r.freqs, r.positions) == ("3N", "6", "0.600000", 1)
    assert consensus.apply_cutoffs(cons, Grid((0.3,), (0,), (0,), 0, 0)).first().consensus == "3GA;3GT"


def test_twelve_digits(spark):
    rows = [("F", "AA", "ACTTACGTAC", HI)] * 9 + [("F", "AA", REF, HI)]
    assert consensus.consensus(table_of(spark, rows)).first().muts[0].wt_freq == 0.1


def test_family_without_evidence_is_skipped(spark):
    assert consensus.consensus(table_of(spark, [("F", "AA", "ACTTACGTAC", "II<IIIIIII")])).collect() == []


def test_every_cutoff_counts_every_family(spark):
    grid = full_grid()
    cons = consensus.consensus(table_of(spark, F1 + F2 + F3))
    got = families.haplotypes_of(cons, grid)
    sums = got.groupBy("min_freq", "min_count", "min_bc3").agg(F.sum("barcodes_count").alias("n"), F.count_if(F.col("consensus").startswith("rejected.")).alias("k")).collect()
    assert len(sums) == 858 and all((r.n, r.k) == (3, 3) for r in sums)


def test_insertion_deletion_clip(spark):
    rows = [("A", "x", "ACGTGGACGAAC", "ABCDEFGHIJKL", "4M2I6M"), ("B", "x", "ACGTGTAC", "I" * 8, "4M2D4M"), ("C", "x", "ACGTACGTTT", HI, "8M2S"), ("D", "x", "ACGTACGT", "I" * 8, "8M")]
    got = {r.bc5: [(m.allele, m.phred) for m in r.muts] for r in calls(spark, rows).collect()}
    # the second allele's quality is that of the second difference, base 5 of the read
    assert got["A"] == [("4-GG", ord("E") - 33), ("8TA", ord("F") - 33)]
    assert got["B"] == [("5A-", None), ("6C-", None)] and [a for a, _ in got["C"]] == ["8-TT", "9A-", "10C-"] and [a for a, _ in got["D"]] == ["9A-", "10C-"]
    fixed = q.alleles(q.differences(F.lit("ACGT--ACGTAC"), F.lit("ACGTGGACGAAC"), ALL), F.lit("ABCDEFGHIJKL"), 28, fix_insertion_quality=True)
    assert [m.phred for m in spark.range(1).select(fixed.alias("m")).first().m] == [ord("E") - 33, ord("J") - 33]


def test_read_list_and_exclusion(spark):
    called = calls(spark, F1)
    got = mutations.read_list(called).collect()
    assert len(got) == 5 and {r.bc5_count for r in got} == {5}
    assert sorted((r.pos, r["from"], r["to"]) for r in got if r.allele != "WT") == [(3, "G", "T")] * 3 + [(9, "A", "C")]
    assert mutations.eligible(called, ("3GT",)).count() == 2 and mutations.eligible(called, bc3_min_reads=2).count() == 4


def test_trim(spark):
    good = "A" * 9 + "CCATG" + "G" * 40 + "TACTTTTT"
    rows = [("@r", good, "I" * len(good)), ("@s", good.replace("TAC", "TGC"), "5" * len(good)), ("@t", good, "4" + "I" * (len(good) - 1))]
    f = parse_factors({"sample": "x", "size_f": "12", "size_r": "8", "read_seq": "CCATG|CCTTG,TAC", "read_pos": "10|10,-6", "read_action": "include,include"})
    reads = spark.createDataFrame(rows, "header string, seq string, qual string")
    a, b, c = trim.split_barcodes(reads, f).orderBy("header").collect()
    assert (a.id_ok, a.bc5, a.insert_seq[:3], a.bc3, a.new_header) == (True, "AAAAAAAAACCA", "TGG", "TACTTTTT", "@AAAAAAAAACCAxTACTTTTT_r")
    assert (b.id_ok, "N" in b.bc5, c.bc5[:2]) == (False, False, "NA")
    log = trim.trim_log(trim.split_barcodes(reads, f)).first()
    assert (log.wrong_identifier, log.total) == (1, 3) and trim.trim_log(trim.split_barcodes(reads.limit(0), f)).first().percent is None
    other = parse_factors({"sample": "x", "read_seq": "CCATG", "read_pos": "10", "read_action": "exclude"})
    assert not trim.split_barcodes(reads, other).first().id_ok


@pytest.mark.parametrize("body, shift, target, moved", [("AGTCCA", 0, "LOCA", False), ("GTCAAT", 0, "LOCB", False), ("AGTCCC", 0, "LOCA", False), ("AGTAAA", 0, "LOCA.others", False), ("AGTCCA", -2, "LOCA", True)])
def test_paralog_sort(spark, body, shift, target, moved):
    seq = "G" * (44 + shift) + body + "G" * 20
    t, s = q.gene_of(F.lit(seq), FACTORS.genes, FACTORS.sort_match, FACTORS.others)
    assert tuple(spark.range(1).select(t, s).first()) == (target, moved)


def test_slices_wrap_like_one_base_slices(spark):
    s = "ABCDE"
    for at in range(-7, 7):
        assert spark.range(1).select(q.base_at(F.lit(s), F.lit(at)).alias("x")).first().x == (s[at : at + 1] if -5 <= at else "")


def test_rekey(spark):
    names = [("AAxCC_M1:1",), ("AAx_M1:1",), ("xCC_M1:1",), ("ANxCC_M1:1",), ("AAxCC_run_7:1",)]
    got = mutations.rekey(spark.createDataFrame([(*n, 60) for n in names] + [("AAxCC_M1:1", 0)], "qname string, mapq int")).select("bc5", "bc3").collect()
    assert [tuple(r) for r in got] == [("AA", "CC"), ("AA", "BC3_missing"), ("BC5_missing", "CC"), ("AA", "CC_run")]


def test_full_merge(spark):
    x = spark.createDataFrame([("x", 1, 2), ("y", 3, 4), ("z", 5, 6)], "k string, a int, b int")
    y = spark.createDataFrame([("z", 11, 21, 61), ("x", 31, 41, 21), ("w", 51, 51, 11), ("q", 1, 31, 11)], "k string, c int, d int, e int")
    assert {tuple(r) for r in tables.full_merge(x, y, "k").collect()} == {("x", 1, 2, 31, 41, 21), ("y", 3, 4, 0, 0, 0), ("z", 5, 6, 11, 21, 61), ("w", 0, 0, 51, 51, 11), ("q", 0, 0, 1, 31, 11)}


def test_factors():
    assert FACTORS.roi == ((12, 12), (36, 98)) and FACTORS.excluded == ("12-T",) and FACTORS.targets == (("LOCA.others", "LOCA"), ("LOCA", "LOCA"), ("LOCB", "LOCB"))
    for bad in ({"sample": "x"}, {"x": "1", "sample": "2"}, {"sample": "x", "sort_match": "2"}, {"sample": "x", "limit_starts": "1,2", "limit_ends": "3"}, {"sample": "x", "1a": ""}):
        with pytest.raises(ValueError):
            parse_factors(bad)
    assert isinstance(parse_factors({"sample": "x", "own": "7"}).extra["own"], str)


def test_design(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("#c\n\npair\tsample\tfile\n1\tB\tb1\n1\tB\tb2\n1\tA\ta1\n")
    (tmp_path / "f.tsv").write_text("sample\tsize_f\nA\t18\nC\t9\n")
    samples = readers.read_samples(spark, str(tmp_path / "s.tsv"))
    got = {r["sample"]: r for r in tables.samples_by_pair(samples).collect()}
    assert (got["A"].ok, got["A"].ordinal, got["B"].ok, got["B"].ordinal) == (False, 0, True, 1)
    factors = readers.read_factors(spark, str(tmp_path / "f.tsv"))
    assert [f.size_f for f in factors] == [18, 9]
    only = tables.unmatched_samples(samples, spark.createDataFrame([(f.sample,) for f in factors], "sample string"))
    assert {tuple(r) for r in only.collect()} == {("B", "factors"), ("C", "samples")}
    assert tables.targets(samples, FACTORS).count() == 9 and tables.repeated_files(samples).count() == 0


def test_files(spark, tmp_path):
    record = "@a 1\nACGT\n+\nIIII\n"
    (tmp_path / "x.fq").write_text("\n" + record + record)
    with gzip.open(tmp_path / "y.fq.gz", "wt") as f:
        f.write(record)
    got = readers.read_fastq(spark, [str(tmp_path / "x.fq"), str(tmp_path / "y.fq.gz")], blank_tolerant=True)
    assert got.count() == 3 and got.agg(F.max("pos_in_file")).first()[0] == 1
    with pytest.raises(Exception, match="broken record"):
        readers.read_fastq(spark, str(tmp_path / "x.fq")).collect()
    (tmp_path / "r.fa").write_text(">one first\nAC\nGT\n>two\nTT\n")
    assert [(r.name, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "r.fa")).orderBy("ordinal").collect()] == [("one", "ACGT"), ("two", "TT")]
    called = calls(spark, F1)
    writers.sam_text(called, 10).orderBy("k").select("value").coalesce(1).write.text(str(tmp_path / "sam"))
    back = readers.read_sam(spark, str(tmp_path / "sam"))
    assert {(r.bc5, r.bc3, r.pos0, r.cigar) for r in back.collect()} == {("F1", b, 0, "10M") for b in ("AA", "CC", "GG")}
    writers.write_fastq(called.withColumn("new_header", F.concat(F.lit("@"), "qname")), str(tmp_path / "fq"), seq="seq", qual="qual")
    assert readers.read_fastq(spark, str(tmp_path / "fq/title=S/target=G")).count() == 5
    writers.write_table(mutations.read_list(called), str(tmp_path / "t"))
    assert readers.checked_table(spark, str(tmp_path / "t"), mutations.read_list(called).schema.simpleString()[7:-1].replace(":", " ")).count() == 5
    refs = spark.createDataFrame([("G", REF)], "target string, ref string")
    assert writers.dummy_genome(called, refs).count() == 1 and writers.dummy_genome(called, refs, compat=True).count() == 0


def test_qc(spark):
    reads = spark.createDataFrame([("a", "ACGTACGTAC", "IIIIII####"), ("b", "ACG", "III"), ("c", "ACGTNNACGT", HI)], "header string, seq string, qual string")
    got = {r.header: r.seq for r in qc.sliding_window_trim(reads, least=3).collect()}
    assert got == {"a": "ACGT", "b": "ACG", "c": "ACGTNNACGT"}
    stats = {r.pos: r for r in qc.position_stats(reads).collect()}
    assert (stats[1].reads, stats[5].n_bases, stats[7].least) == (3, 1, 2)
    assert qc.sample_reads(reads, 2).count() == 2 and qc.length_histogram(reads).count() == 2
    cut = {r.header: r.seq for r in adapters.trim_adapters(spark.createDataFrame([("a", "TTTTTTTTTTAGATCGGAAG", "I" * 20), ("b", "TTTTTTTTTTAGATCGCAAG", "I" * 20), ("c", "T" * 20, "I" * 20)], "header string, seq string, qual string"), ["AGATCGGAAG"]).collect()}
    assert cut == {"a": "T" * 10, "b": "T" * 10, "c": "T" * 20}
    whole = "ACGTTGCAAGCTTGACCATGTTGCAGGTCA"
    turned = whole[10:].translate(str.maketrans("ACGT", "TGCA"))[::-1]
    mates = [spark.createDataFrame([(h, s, "I" * 20)], "header string, seq string, qual string") for h, s in (("@m/1", whole[:20]), ("@m/2", turned))]
    assert [r.seq for r in mating.merge_mates(*mates, least=8).collect()] == [whole]


def test_aligner(spark):
    ref = "TGTACGATCGGATTACAGCATTGCACCATGGTACCATTGACGGATCCAGT"
    cases = {ref: (0, "50M"), ref[:20] + ref[22:]: (0, "20M2D28M"), ref[:25] + "GG" + ref[25:]: (0, "25M2I25M"), ref[3:]: (3, "47M"), ref[:40] + "AAAAAAAAAA": (0, "40M10S"), "A" * 50: (-1, "*"), ref[:10] + "A" + ref[11:]: (0, "50M")}
    df = spark.createDataFrame([(str(k), "G", s) for k, s in enumerate(cases)] * 2, "id string, target string, seq string")
    got = align.align(df, spark.createDataFrame([("G", ref)], "target string, ref string")).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        start, cigar = cases[r.seq]
        if "D" in cigar or "I" in cigar:  # a gap may stand anywhere in a run of equal bases
            assert r.pos0 == 0 and sum(c in r.cigar for c in "DI") == 1 and "S" not in r.cigar
        else:
            assert (r.pos0, r.cigar) == (start, cigar)


def test_stream(spark, tmp_path):
    from readkin.synth import raw_reads

    events = spark.range(200).select(F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"))
    reads = raw_reads(events).select(F.lit("S").alias("title"), "header", "seq", "qual")
    reads.write.parquet(str(tmp_path / "in"))
    ingest.append_routed(ingest.read_drop_folder(spark, str(tmp_path / "in")), FACTORS, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    batch = trim.route(trim.split_barcodes(reads, FACTORS), FACTORS)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("target").count().orderBy("target").collect() == batch.groupBy("target").count().orderBy("target").collect()


def test_cutoff_row_tells_all(spark):
    """Every column of a selected, a merged and a rejected family."""
    grid = Grid((0.7,), (0,), (0,), 0, 0)
    r = consensus.apply_cutoffs(consensus.consensus(table_of(spark, F1)), grid).first()
    assert (r.consensus_tss, r.wt_freqs, r.bc3_existing, r.bc3_mut_above1, r.bc3_wt_above1, r.bc3_above1, r.bc3_all_wt_count) == ("3GT", "0.250000", "2", "1", "0", "2", "2")
    r = consensus.apply_cutoffs(consensus.consensus(table_of(spark, F3)), Grid((0.5,), (0,), (0,), 0, 0)).first()
    assert (r.consensus_tss, r.wt_freqs, r.bc3_existing, r.bc3_above1) == ("3N", "0.800000", "2", "2")
    r = consensus.apply_cutoffs(consensus.consensus(table_of(spark, F2)), Grid((0.5,), (4,), (1,), 0, 0)).first()
    assert (r.consensus_tss, r.wt_freqs, r.bc3_existing, r.bc3_above1, r.bc3_wt_above1, r.bc3_all_wt_count) == ("WT", "NA", "2", "NA", "2", "2")


def test_files_in_many_splits(spark, tmp_path):
    """Records that lie across splits are framed like others."""
    records = [(f"@r{k}", "ACGT" * (1 + k % 7), "IIII" * (1 + k % 7)) for k in range(3000)]
    (tmp_path / "x.fq").write_text("".join(f"{h}\n{s}\n+\n{q}\n" for h, s, q in records))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = readers.read_fastq(spark, str(tmp_path / "x.fq")).orderBy("pos_in_file").collect()
        assert [(r.header, r.seq, r.qual) for r in got] == records and [r.pos_in_file for r in got] == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_nothing_present_is_an_error(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("#c\n")
    with pytest.raises(ValueError):
        readers.present(spark, "s.tsv", readers.read_samples(spark, str(tmp_path / "s.tsv")))


def test_haplotypes_in_order(spark):
    got = [r.barcodes_count for r in consensus.ordered(families.haplotypes_of(consensus.consensus(table_of(spark, F1 + F2)), Grid((0.5,), (0,), (0,), 0, 0))).collect()]
    assert got == sorted(got, reverse=True)
