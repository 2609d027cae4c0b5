"""From alignments to alleles: filters, calls, the per-read list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import BIN, alleles, cigar_ops, differences, gapped, position_quality
from .tables import once, sent_whole

#: The columns that name a read family.
FAMILY = ("title", "target", "bc5")


def rekey(sam: DataFrame) -> DataFrame:
    """Take barcodes from names ``<bc5>x<bc3>_<rest>``; reads with an N in them or MAPQ 0 go.

    The name is split greedily at the last underscore before the first character that is not a word's.
    """
    both = F.regexp_extract("qname", r"^(\w+)_(.*)", 1)
    out = sam.withColumn("__b", both).where((F.col("__b") != "") & ~F.col("__b").contains("N") & (F.col("mapq") > 0))
    bc5, bc3 = F.regexp_extract("__b", r"^([^x]*)", 1), F.regexp_extract("__b", r"^[^x]*x(.*)$", 1)
    out = out.withColumns({"bc5": F.when(bc5 == "", "BC5_missing").otherwise(bc5), "bc3": F.when(bc3 == "", "BC3_missing").otherwise(bc3), "read_name": F.regexp_extract("qname", r"^(\w+)_(.*)", 2)})
    return out.drop("__b")


def _lead_soft():
    return F.coalesce(F.regexp_extract("cigar", r"^(?:\d+H)?(\d+)S", 1).try_cast("int"), F.lit(0))


def usable(aln: DataFrame, bc3: str = "", start_at_0: bool = True) -> DataFrame:
    """Mapped reads that start at the first base of the reference and of the read; of one secondary barcode if given."""
    ok = (F.col("flag").bitwiseAND(4) == 0) & (F.col("pos0") == 0)
    if start_at_0:
        ok = ok & (_lead_soft() == 0)
    return aln.where(ok & (F.col("bc3") == bc3) if bc3 else ok)


def filter_log(aln: DataFrame, by: tuple[str, ...] = ("title", "target")) -> DataFrame:
    """Counts of reads that each filter takes."""
    unmapped, ref, query = F.col("flag").bitwiseAND(4) != 0, F.col("pos0") != 0, _lead_soft() != 0
    return aln.groupBy(*by).agg(
        F.count_if(unmapped).alias("unmapped"), F.count_if(ref).alias("ref_start_ne0"), F.count_if(query).alias("query_start_ne0"), F.count_if(ref | query).alias("start_ne0"), F.count("*").alias("total"),
        F.count_if(~unmapped & ~ref & ~query).alias("used"),
    )


def region_bins(regions: DataFrame) -> DataFrame:
    """Regions as a lookup by place: a row for every value of the other columns, with ``roi``, a map of bins of ``BIN`` places to the regions that meet them.

    ``regions`` has ``start`` and ``stop`` (1-based, both inside) and ``title``, ``target`` or both.  A region is in as many bins as it
    is long, so the rows grow with the places of a reference, not with the reads; a null place or ``stop`` before ``start`` is no region.
    """
    by = [c for c in regions.columns if c not in ("start", "stop")]
    bins = regions.where("start <= stop").select(*by, F.explode(F.sequence(F.floor(F.col("start") / BIN).cast("int"), F.floor(F.col("stop") / BIN).cast("int"))).alias("bin"), F.struct(F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop")).alias("r"))
    lists = bins.groupBy(*by, "bin").agg(F.collect_set("r").alias("rs"))
    return lists.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "rs"))).alias("roi"))


def call(aln: DataFrame, refs: DataFrame, roi: tuple[tuple[int, int], ...] | DataFrame, min_phred: int = 28, fix_insertion_quality: bool = False) -> DataFrame:
    """``aln`` with ``muts`` and ``hqpos``; ``refs(target, ref)`` is one row a target, broadcast when its rows are few.

    ``roi`` are regions for all reads, or a table of regions by ``title``, ``target`` or both, which is looked up by bins of places; a read
    without regions has no differences.  Nothing is shuffled: gaps, differences and alleles are expressions over the read's row.
    """
    if isinstance(roi, DataFrame):
        by, bins = [c for c in roi.columns if c not in ("start", "stop")], region_bins(roi)
        aln, roi = aln.join(sent_whole(bins).withColumnRenamed("roi", "__roi"), by, "left"), F.col("__roi")
    out = aln.join(sent_whole(refs), "target").withColumn("__a", gapped(cigar_ops(F.col("cigar")), F.col("ref"), F.col("seq")))
    out = out.withColumn("__d", differences(F.col("__a.t"), F.col("__a.q"), roi))
    return out.withColumns({"muts": alleles(F.col("__d"), F.col("qual"), min_phred, fix_insertion_quality), "hqpos": position_quality(F.col("__a.t"), F.col("__a.q"), F.col("qual"), min_phred)}).drop("__a", "__d", "__roi")


def with_group_size(reads: DataFrame, by: tuple[str, ...], column: str) -> DataFrame:
    """``reads`` with the number of reads that have the same ``by``, nulls alike.

    The groups are counted with partial sums and joined back, so that a group that holds a large part of
    all reads is one row on one side, and can be split on the other; a window would sort it in one task.
    """
    counts = reads.groupBy(*by).agg(F.count("*").alias(column)).toDF(*[f"__{c}" for c in by], column)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    return reads.join(counts, same).drop(*[f"__{c}" for c in by])


def read_list(called: DataFrame) -> DataFrame:
    """A row for every allele of every read, with the reads of its family; WT has no place and quality."""
    rows = with_group_size(called, FAMILY, "bc5_count").select(*FAMILY, "bc3", F.col("qname").alias("read_name"), "bc5_count", F.explode("muts").alias("m"))
    part = lambda k: F.when(F.col("m.kind") != "wt", F.regexp_extract("m.allele", r"^(\d+)(-|\w+?)(\w+|-)$", k))
    return rows.select(*FAMILY, "bc3", "read_name", "bc5_count", F.col("m.phred").alias("quality"), part(1).cast("int").alias("pos"), part(2).alias("from"), part(3).alias("to"), F.col("m.allele").alias("allele"))


def excluded_by(excluded: tuple[str, ...] | str) -> Column:
    """Whether a read has an excluded allele; ``excluded`` are alleles, or the name of a column with a list of the read's own."""
    if isinstance(excluded, str):
        return F.coalesce(F.arrays_overlap(F.transform("muts", lambda m: m["allele"]), F.col(excluded)), F.lit(False))
    return F.exists("muts", lambda m: m["allele"].isin(*excluded)) if excluded else F.lit(False)


def eligible(called: DataFrame, excluded: tuple[str, ...] | str = (), bc3_min_reads: int = 1) -> DataFrame:
    """Reads of large enough (family, secondary barcode) groups, counted first, without the excluded alleles."""
    out = called
    if bc3_min_reads > 1:
        out = with_group_size(out, (*FAMILY, "bc3"), "__n")
        out = out.where(F.when(F.col("bc3") == "X", 1).otherwise(F.col("__n")) >= bc3_min_reads).drop("__n")
    if excluded:
        out = once(out, "muts").where(~excluded_by(excluded))  # or the alleles are called a second time, in the filter
    return out
