"""Barcode split, quality mask, signature route, paralog sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import gene_at, has_signatures, haplotype_offset, masked
from ..params import Factors
from .tables import once


def split_barcodes(reads: DataFrame, factors: Factors, min_phred: int = 20) -> DataFrame:
    """``reads(header, seq, qual, ..)`` with raw and masked barcodes, insert, rewritten header and ``id_ok``.

    The primary barcode is the first ``size_f`` bases, the secondary one the last ``size_r``.
    """
    return cut_barcodes(reads, F.lit(factors.size_f), F.lit(factors.size_r), has_signatures(F.col("seq"), factors.signatures), min_phred)


def cut_barcodes(reads: DataFrame, f: Column, r: Column, id_ok: Column, min_phred: int) -> DataFrame:
    """``split_barcodes`` with the sizes and the verdict on signatures as columns."""
    reads, n = once(reads.withColumn("id_ok", id_ok), "id_ok"), F.char_length("seq")
    left, right = lambda c: F.substring(F.col(c), F.lit(1), f), lambda c: F.substring(F.col(c), n - r + 1, r)
    mid = lambda c: F.substring(F.col(c), f + 1, n - f - r)
    out = reads.select(
        "*", left("seq").alias("bc5_raw"), right("seq").alias("bc3_raw"), masked(left("seq"), left("qual"), min_phred).alias("bc5"), masked(right("seq"), right("qual"), min_phred).alias("bc3"),
        mid("seq").alias("insert_seq"), mid("qual").alias("insert_qual"),
    )
    out = out.select(*[c for c in out.columns if c != "id_ok"], "id_ok")
    return out.withColumn("new_header", F.concat(F.lit("@"), "bc5", F.lit("x"), "bc3", F.lit("_"), F.regexp_replace("header", "^@", "")))


def trim_log(trimmed: DataFrame) -> DataFrame:
    """``wrong_identifier, total, percent``; the percentage of nothing is null."""
    return trimmed.agg(F.count_if(~F.col("id_ok")).alias("wrong_identifier"), F.count("*").alias("total")).withColumn("percent", F.try_divide(F.col("wrong_identifier") * 100.0, F.col("total")))


def wrong_identifiers(trimmed: DataFrame) -> DataFrame:
    """The reads that ``route`` leaves out, whole, to be written apart."""
    return trimmed.where(~F.col("id_ok"))


def with_indels(routed: DataFrame) -> DataFrame:
    """Routed reads whose signature was found at another place, to be written beside their target."""
    return routed.where("shifted")


def _sorted(reads: DataFrame, factors: Factors, seq: str) -> DataFrame:
    """``reads`` with ``target`` and ``shifted``.

    The offset of each haplotype is a column of its own, computed once a read and behind a step of its own: all of them in
    one expression, which names each several times, make generated code that is too long to be compiled.
    """
    names = [[f"__at{i}_{j}" for j in range(len(g.haplotypes))] for i, g in enumerate(factors.genes)]
    out = reads
    for g, own in zip(factors.genes, names):
        for h, c in zip(g.haplotypes, own):
            out = once(out.withColumn(c, haplotype_offset(F.col(seq), h, factors.sort_match)), c)
    target, shifted = gene_at([[F.col(c) for c in own] for own in names], factors.genes, factors.others)
    return out.withColumns({"target": target, "shifted": shifted}).drop(*[c for own in names for c in own])


def route(trimmed: DataFrame, factors: Factors, seq: str = "insert_seq") -> DataFrame:
    """Reads with a right identifier, with their ``target`` and ``shifted``."""
    return once(_sorted(trimmed.where("id_ok"), factors, seq), "target", "shifted")


def route_log(routed: DataFrame) -> DataFrame:
    """Reads and shifted reads of every target."""
    return routed.groupBy("target").agg(F.count("*").alias("reads"), F.count_if("shifted").alias("with_indels"))


def sort_all(trimmed: DataFrame, factors: Factors, seq: str = "insert_seq") -> DataFrame:
    """``route`` that keeps the reads without the identifier, with a null target and never ``shifted``: all that is written of a run, in one table."""
    ok = F.col("id_ok")
    return _sorted(trimmed, factors, seq).withColumns({"target": F.when(ok, F.col("target")), "shifted": F.coalesce(ok & F.col("shifted"), F.lit(False))})
