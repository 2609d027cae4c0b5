"""The per-family table of alleles with secondary-barcode support."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import scratch
from .mutations import FAMILY, excluded_by

MISSING = "BC3_missing"


def _counted(reads: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The reads, their alleles counted by barcode, and the reads counted by barcode: rows, written once where calling or exploding would be repeated; reads that are written already are not written again."""
    f = list(FAMILY)
    if "scratch_path" not in vars(reads):
        reads = scratch(reads.select(*f, "bc3", "muts", "hqpos"), "called")
    hits = scratch(reads.select(*f, "bc3", F.explode("muts").alias("m")).groupBy(*f, "bc3", "m.allele", "m.pos", "m.kind").agg(F.count("*").alias("n"), F.count_if("m.hq").alias("hq")), "hits")
    return reads, hits, reads.groupBy(*f, "bc3").agg(F.count("*").alias("n"))


def _placed(hits: DataFrame, barcodes: DataFrame, strict: bool) -> DataFrame:
    """``family, pos, bc3, n, hq, left``: reads of each barcode that has a high-quality allele at a place, and how many are left to the wild type."""
    f = list(FAMILY)
    rows = hits.where("pos is not null and hq > 0").groupBy(*f, "pos", "bc3").agg(F.sum("hq").alias("hq")).join(barcodes, [*f, "bc3"])
    left = F.col("n") - F.col("hq")
    none = F.raise_error(F.lit("more alleles than reads of a barcode")).cast("long") if strict else F.lit(0).cast("long")
    return rows.withColumn("left", F.when(left < 0, none).otherwise(left))


def _good(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """``family, pos, hq_reads``: high-quality reads at the places where a family has a substitution, at most a reference's length of places."""
    f = list(FAMILY)
    places = hits.where("kind = 'sub'").groupBy(*f).agg(F.collect_set("pos").alias("places"))
    return reads.join(places, f).select(*f, "hqpos", F.explode("places").alias("pos")).groupBy(*f, "pos").agg(F.sum(F.substring("hqpos", F.col("pos"), F.lit(1)).cast("int")).alias("hq_reads"))


def _support(hits: DataFrame, barcodes: DataFrame, good: DataFrame, strict: bool) -> DataFrame:
    f = list(FAMILY)
    known = F.col("bc3") != MISSING
    per = hits.groupBy(*f, "allele", "pos", "kind").agg(
        F.sum("n").alias("mutation_count"), F.sum("hq").alias("hq_count"), F.count_if((F.col("hq") > 0) & known).alias("bc3_existing"), F.count_if((F.col("hq") > 0) & ~known).alias("bc3_missing"), F.count_if(F.col("hq") > 1).alias("mut_above")
    )
    family = barcodes.groupBy(*f).agg(F.sum("n").alias("total_count"), F.count_if(F.col("n") > 1).alias("above_all"), F.count_if(known).alias("__known"), F.count_if(~known).alias("__missing"))
    # Barcodes without an allele at a place keep all their reads there, so only the others are looked at.
    lost = _placed(hits, barcodes, strict).groupBy(*f, "pos").agg(
        F.count_if((F.col("left") == 0) & known).alias("__lost"), F.count_if((F.col("left") == 0) & ~known).alias("__lost_missing"), F.count_if((F.col("n") > 1) & (F.col("left") <= 1)).alias("__lost_above"),
    )
    out = per.join(family, f).join(lost, [*f, "pos"], "left").join(good, [*f, "pos"], "left")
    hq_total = F.when(F.col("kind") == "sub", F.col("hq_reads")).otherwise(F.col("total_count"))
    return out.select(
        *f, "allele", "pos", "kind", "mutation_count", "hq_count", "total_count", hq_total.alias("hq_total_count"), F.coalesce(F.try_divide(F.col("hq_count").cast("double"), hq_total.cast("double")), F.lit(0.0)).alias("mutation_freq"),
        "bc3_existing", "bc3_missing", (F.col("__known") - F.col("__lost")).alias("bc3_wt_existing"), (F.col("__missing") - F.col("__lost_missing")).alias("bc3_wt_missing"),
        "mut_above", F.coalesce(F.col("above_all") - F.col("__lost_above"), F.lit(0)).cast("long").alias("wt_above"), "above_all",
    )


def family_support(reads: DataFrame, strict: bool = False) -> DataFrame:
    """One row for every allele of every family of ``reads(title, target, bc5, bc3, muts, hqpos)``, with numbers of reads and barcodes.

    All are sums over rows of (family, allele, barcode), (family, place, barcode) and (family, barcode),
    so no list of a family's barcodes is made, however many it has.  ``mut_above``, ``wt_above`` and
    ``above_all`` are the barcodes with two reads or more of the allele, of the wild type at its place and of all.  ``strict``
    fails where several alleles of reads at one place exceed a barcode's reads; else the rest is 0.
    """
    reads, hits, barcodes = _counted(reads)
    return _support(hits, barcodes, _good(reads, hits), strict)


def partial_counts(called: DataFrame, excluded: tuple[str, ...] | str = ()) -> dict[str, DataFrame]:
    """Counts of some of the reads, from which those of all are sums: ``hits`` of (family, barcode, allele), ``barcodes`` of (family, barcode) and ``lows`` of (family, barcode, digits of all places).

    ``barcodes`` has all reads (``n_all``) and those without an ``excluded`` allele (``n``); the others
    count only the latter.  ``lows`` are the reads with a base that is not of high quality: at most a row a read and not one for each such base, as only few
    places are asked for in the end.
    """
    f = [*FAMILY, "bc3"]
    marked = called.select(*f, "muts", "hqpos", excluded_by(excluded).alias("out"))
    kept = marked.where(~F.col("out"))
    return {
        "hits": kept.select(*f, F.explode("muts").alias("m")).groupBy(*f, "m.allele", "m.pos", "m.kind").agg(F.count("*").alias("n"), F.count_if("m.hq").alias("hq")),
        "barcodes": marked.groupBy(*f).agg(F.count("*").alias("n_all"), F.count_if(~F.col("out")).alias("n")),
        "lows": kept.where(F.contains("hqpos", F.lit("0"))).groupBy(*f, "hqpos").agg(F.count("*").alias("n")),
    }


def support_of_counts(hits: DataFrame, barcodes: DataFrame, lows: DataFrame, bc3_min_reads: int = 1, strict: bool = False) -> DataFrame:
    """``family_support`` of reads of which only ``partial_counts`` are known, of any number of parts put under each other.

    Groups of a barcode with fewer than ``bc3_min_reads`` reads in all parts together go, as in ``mutations.eligible``.
    """
    f, g = list(FAMILY), [*FAMILY, "bc3"]
    barcodes = barcodes.groupBy(*g).agg(F.sum("n_all").alias("n_all"), F.sum("n").alias("n"))
    if bc3_min_reads > 1:
        barcodes = barcodes.where(F.when(F.col("bc3") == "X", 1).otherwise(F.col("n_all")) >= bc3_min_reads)
        hits, lows = (x.join(barcodes.select(*g), g, "left_semi") for x in (hits, lows))
    barcodes = barcodes.where("n > 0").drop("n_all")
    hits = scratch(hits.groupBy(*g, "allele", "pos", "kind").agg(F.sum("n").alias("n"), F.sum("hq").alias("hq")), "hits")
    places = hits.where("kind = 'sub'").groupBy(*f).agg(F.collect_set("pos").alias("places"))
    sizes = barcodes.groupBy(*f).agg(F.sum("n").alias("n"))
    at = lows.join(places, f).select(*f, "n", F.explode(F.filter("places", lambda p: F.substring("hqpos", p, F.lit(1)) == "0")).alias("pos"))
    low = at.groupBy(*f, "pos").agg(F.sum("n").alias("low"))
    good = places.join(sizes, f).select(*f, "n", F.explode("places").alias("pos")).join(low, [*f, "pos"], "left").select(*f, "pos", (F.col("n") - F.coalesce("low", F.lit(0))).alias("hq_reads"))
    return _support(hits, barcodes, good, strict)


def family_table(reads: DataFrame, strict: bool = False) -> DataFrame:
    """``family_support`` with the barcodes themselves as lists, as the table of families is written.

    The lists are made last; none is looked into.  One of a place's wild type has all barcodes of its family.
    """
    f = list(FAMILY)
    reads, hits, barcodes = _counted(reads)
    listed = lambda n: F.array_sort(F.collect_list(F.struct("bc3", F.col(n).alias("n"))))
    support = _support(hits, barcodes, _good(reads, hits), strict)
    alleles = hits.where("hq > 0").groupBy(*f, "allele").agg(listed("hq").alias("bc3_hq"))
    all_ = barcodes.groupBy(*f).agg(listed("n").alias("bc3_all"))
    placed = _placed(hits, barcodes, strict).select(*f, "pos", "bc3", "left")
    wild = placed.select(*f, "pos").distinct().join(barcodes, f).join(placed, [*f, "pos", "bc3"], "left").withColumn("n", F.coalesce("left", "n"))
    wild = wild.groupBy(*f, "pos").agg(listed("n").alias("bc3_wt"))
    out = support.join(alleles, [*f, "allele"], "left").join(all_, f).join(wild, [*f, "pos"], "left")
    hq = F.coalesce("bc3_hq", F.array().cast("array<struct<bc3:string,n:bigint>>"))
    part = F.transform(hq, lambda x: F.coalesce(F.try_divide(x["n"].cast("double"), F.col("hq_total_count").cast("double")), F.lit(0.0)))
    return out.select(*support.columns, hq.alias("bc3_hq"), part.alias("bc3_hq_freq"), "bc3_all", "bc3_wt")
