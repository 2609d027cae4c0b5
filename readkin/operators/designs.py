"""Reads of many samples, each under its own row of the factors table, in one plan.

The rows of the factors table become a table of designs that is joined to the reads by ``title``, and
all that differs between samples (sizes, signatures, genes, excluded alleles, regions) is
data on the read's row: the plan does not grow with the samples, and none is run by itself.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import base_at, has_any_of_each
from ..params import Factors
from .tables import sent_whole
from .trim import cut_barcodes

_PLACE = "struct<text:string,pos:int>"
SCHEMA = (
    f"title string, size_f int, size_r int, signatures array<array<{_PLACE}>>, genes array<struct<name:string,haplotypes:array<array<{_PLACE}>>>>, "
    "sort_match double, others string, excluded array<string>"
)
#: The columns that ``with_design`` adds.
COLUMNS = ("size_f", "size_r", "signatures", "genes", "sort_match", "others", "excluded")
OFFSETS = (0, -1, 1, -2, 2, -3, 3)


def design_table(spark: SparkSession, factors: Iterable[Factors]) -> DataFrame:
    """A row for each sample; a sample given twice is an error."""
    rows = [
        (
            f.sample, f.size_f, f.size_r, [list(s.alternatives) if s.action == "include" else [] for s in f.signatures],
            [(g.name, [[(base, pos) for pos, base in h] for h in g.haplotypes]) for g in f.genes], float(f.sort_match), f.others, list(f.excluded),
        )
        for f in factors
    ]
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError("a sample has several rows of factors")
    return spark.createDataFrame(rows, SCHEMA)


def region_table(spark: SparkSession, factors: Iterable[Factors]) -> DataFrame:
    """``title, start, stop``: the regions of interest of every sample, for ``mutations.call``."""
    return spark.createDataFrame([(f.sample, a, b) for f in factors for a, b in f.roi], "title string, start int, stop int")


def with_design(reads: DataFrame, designs: DataFrame) -> DataFrame:
    """``reads(title, ..)`` with ``COLUMNS``; a read whose sample has no design is an error when it is reached."""
    if clash := {c.lower() for c in COLUMNS} & {c.lower() for c in reads.columns}:
        raise ValueError(f"the reads already have columns {sorted(clash)}")
    out = reads.join(sent_whole(designs), "title", "left")
    unknown = F.raise_error(F.concat(F.lit("no factors for sample "), F.coalesce("title", F.lit("null")))).cast("int")
    return out.withColumn("size_f", F.when(F.col("signatures").isNull(), unknown).otherwise(F.col("size_f")))


def split_barcodes(reads: DataFrame, designs: DataFrame, min_phred: int = 20) -> DataFrame:
    """``trim.split_barcodes`` with each sample's own sizes and signatures; the design's columns stay for ``route``."""
    out = with_design(reads, designs)
    return cut_barcodes(out, F.col("size_f"), F.col("size_r"), has_any_of_each(F.col("seq"), F.col("signatures")), min_phred)


def _offset(seq: Column, haplotype: Column, match: Column) -> Column:
    """First offset at which the share of a haplotype's matching bases reaches ``match``, else null."""
    hits = lambda o: F.size(F.filter(haplotype, lambda x: base_at(seq, x["pos"] - 1 + o) == x["text"]))
    return F.try_element_at(F.filter(F.array(*map(F.lit, OFFSETS)), lambda o: hits(o) / F.size(haplotype).cast("double") >= match), F.lit(1))


def route(trimmed: DataFrame, seq: str = "insert_seq") -> DataFrame:
    """``trim.route`` for reads with their designs: the only gene of their sample of which all haplotypes match, else the sample's rest."""
    offsets = F.transform("genes", lambda g: F.struct(g["name"].alias("name"), F.transform(g["haplotypes"], lambda h: _offset(F.col(seq), h, F.col("sort_match"))).alias("at")))
    found = F.filter(offsets, lambda g: F.forall(g["at"], lambda o: o.isNotNull()))
    rows = trimmed.where("id_ok").withColumn("__found", found)
    one = F.size("__found") == 1
    first = F.try_element_at("__found", F.lit(1))
    shifted = one & F.coalesce(F.exists(first["at"], lambda o: o != 0), F.lit(False))
    return rows.withColumns({"target": F.when(one, first["name"]).otherwise(F.col("others")), "shifted": shifted}).drop("__found")
