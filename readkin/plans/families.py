"""From reads to haplotype counts in one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import align, consensus, designs, family, mutations, trim
from ..operators.tables import once, sent_whole
from ..params import Factors, Grid, RunParams


def alignments_of(reads: DataFrame, refs: DataFrame, factors: Factors, params: RunParams = RunParams()) -> DataFrame:
    """Raw ``reads(title, header, seq, qual)`` to alignments keyed by barcodes.

    Barcodes with an N go before the alignment, which they do not depend on.
    """
    return _aligned(trim.route(trim.split_barcodes(reads, factors, params.barcode_min_phred), factors), refs)


def alignments_of_samples(reads: DataFrame, refs: DataFrame, table: DataFrame, params: RunParams = RunParams()) -> DataFrame:
    """The same for reads of many samples, each under its own row of ``table`` (``designs.design_table``)."""
    return _aligned(designs.route(designs.split_barcodes(reads, table, params.barcode_min_phred)), refs)


def _aligned(routed: DataFrame, refs: DataFrame) -> DataFrame:
    good = once(routed, "bc5", "bc3").where(~F.col("bc5").contains("N") & ~F.col("bc3").contains("N"))
    named = good.select("title", "target", F.when(F.col("bc5") == "", "BC5_missing").otherwise(F.col("bc5")).alias("bc5"), F.when(F.col("bc3") == "", "BC3_missing").otherwise(F.col("bc3")).alias("bc3"), F.regexp_replace("header", "^@", "").alias("qname"), F.col("insert_seq").alias("seq"), F.col("insert_qual").alias("qual"))
    return align.align(named, refs).where("mapq > 0")


def consensus_of(aln: DataFrame, refs: DataFrame, factors: Factors, params: RunParams = RunParams(), bc3: str = "") -> DataFrame:
    """Alignments to one row a family."""
    called = mutations.call(mutations.usable(aln, bc3), refs, factors.roi, params.min_phred)
    return consensus.consensus(family.family_support(mutations.eligible(called, factors.excluded, params.bc3_min_reads)))


def consensus_of_samples(aln: DataFrame, refs: DataFrame, table: DataFrame, regions: DataFrame, params: RunParams = RunParams(), bc3: str = "") -> DataFrame:
    """Alignments of many samples to one row a family, with each sample's excluded alleles and ``regions`` (by ``title``, ``target`` or both)."""
    called = mutations.call(mutations.usable(aln, bc3), refs, regions, params.min_phred).join(sent_whole(table.select("title", "excluded")), "title")
    return consensus.consensus(family.family_support(mutations.eligible(called, "excluded", params.bc3_min_reads)))


def haplotypes_of(cons: DataFrame, grid: Grid) -> DataFrame:
    """Families to counts of haplotypes under every cutoff."""
    return consensus.interval_counts(cons, grid)
