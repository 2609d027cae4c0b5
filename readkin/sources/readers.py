"""Readers of FASTQ, FASTA, SAM and design tables; all take paths and globs that Spark can list."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..params import Factors, parse_factors
from .store import scratch


def read_fastq(spark: SparkSession, path: str | list[str], blank_tolerant: bool = False) -> DataFrame:
    """``file, pos_in_file, header, seq, qual`` of FASTQ files of any size, gz too (a gz file is one stream of lines).

    A record is four lines.  Files are read in splits, whose lines are counted first (this runs
    a job), so every line has its number in its file.  Records inside a split are framed
    where they lie; only the lines of records that lie across splits, at most six a split, are
    shuffled.  Broken frames are errors; ``blank_tolerant`` skips empty lines first.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    if blank_tolerant:
        lines = lines.where("value <> ''")
    lines = lines.withColumn("id", F.monotonically_increasing_id())  # successive inside a split
    counts = lines.groupBy("file", "split").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = scratch(counts.withColumn("skipped", F.coalesce(F.sum("n").over(before), F.lit(0))), "splits")  # a row a split
    own = F.col("id") - F.col("first")
    moved = F.raise_error(F.lit("the splits are not those that were counted")).cast("long")
    numbered = lines.join(F.broadcast(splits), ["file", "split"], "left").withColumn("at", F.when(own.between(0, F.col("n") - 1), own + F.col("skipped")).otherwise(moved))
    # From the first record that begins in the split to the last one that ends in it.
    inside = F.col("at").between(F.ceil(F.col("skipped") / 4) * 4, F.floor((F.col("skipped") + F.col("n")) / 4) * 4 - 1)
    framed = numbered.where(inside).select("file", "at", "value").mapInArrow(_every_four, "file string, pos_in_file long, header string, seq string, plus string, qual string")
    part = lambda k: F.max(F.when(F.col("at") % 4 == k, F.col("value")))
    across = numbered.where(~inside).groupBy("file", F.floor(F.col("at") / 4).alias("pos_in_file")).agg(part(0).alias("header"), part(1).alias("seq"), part(2).alias("plus"), part(3).alias("qual"))
    good = F.coalesce(F.col("header").startswith("@") & F.col("plus").startswith("+") & (F.char_length("seq") == F.char_length("qual")), F.lit(False))
    broken = F.raise_error(F.concat("file", F.lit(": broken record "), F.col("pos_in_file").cast("string"))).cast("string")
    return framed.union(across).select("file", "pos_in_file", F.when(good, F.col("header")).otherwise(broken).alias("header"), "seq", "qual")


def _every_four(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Successive lines of whole records, four to a row; at most three lines wait for the next batch."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        whole = len(table) // 4 * 4
        rest = table.slice(whole)
        if whole:
            first = pa.array(range(0, whole, 4), pa.int64())
            names = table.column("file").take(first), pc.divide(table.column("at").take(first), 4)
            texts = [table.column("value").take(pc.add(first, k)) for k in range(4)]
            yield from pa.table([*names, *texts], ["file", "pos_in_file", "header", "seq", "plus", "qual"]).combine_chunks().to_batches()


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, ordinal, name, seq`` of FASTA records, letters as they are."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.filter(F.split("value", r"(?:^|\n)>"), lambda x: F.trim(x) != "")).alias("ordinal", "r"))
    return text.select("file", "ordinal", F.regexp_extract("r", r"^(\S*)", 1).alias("name"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*\n?", ""), r"\s", "").alias("seq"))


def read_sam(spark: SparkSession, path: str | list[str], names: str = "") -> DataFrame:
    """Alignments of SAM text keyed by primary barcode: reference name is ``bc5``, tag ``XB:Z`` is ``bc3``.

    ``names`` is a pattern of the file's path with two groups, which become ``title`` and ``target``.
    """
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    of_path = [F.regexp_extract("_metadata.file_path", names, k).alias(c) for k, c in ((1, "title"), (2, "target"))] if names else []
    return rows.select(
        *of_path, f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("bc5"), (f[3].cast("int") - 1).alias("pos0"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"),
        F.nullif(F.regexp_extract("value", r"\tXB:Z:([^\t]*)", 1), F.lit("")).alias("bc3"),
    )


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """``pair, sample, file`` of a samples table; comments, lines that begin with a tab and blank lines are skipped."""
    f = F.split("value", "\t")
    return spark.read.text(path).where(~F.col("value").rlike(r"^(#|\t|\s*$)") & ~F.col("value").startswith("pair\t")).select(F.trim(f[0]).alias("pair"), F.trim(f[1]).alias("sample"), F.trim(f[2]).alias("file"))


def read_factors(spark: SparkSession, path: str) -> list[Factors]:
    """The parsed factors table; a row a sample, which becomes parameters of plans."""
    lines = [r.value for r in spark.read.text(path).where(~F.col("value").rlike(r"^(#|\t|\s*$)")).collect()]
    header = lines[0].split("\t")
    return [parse_factors(dict(zip(header, x.split("\t")))) for x in lines[1:]]


def present(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows``, which were read from ``path``; none at all is an error."""
    if rows.isEmpty():
        raise ValueError(f"{path} holds no rows")
    return rows


def checked_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated table whose header must have the names of ``schema`` in their order."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=False)
