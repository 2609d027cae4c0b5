"""Writers: FASTQ by target, tab-separated tables, SAM text, dummy genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.mutations import FAMILY
from ..operators.tables import sent_whole


def write_fastq(reads: DataFrame, path: str, by: tuple[str, ...] = ("title", "target"), header: str = "new_header", seq: str = "insert_seq", qual: str = "insert_qual") -> None:
    """FASTQ text in a folder for each value of ``by``."""
    text = F.concat_ws("\n", F.col(header), F.col(seq), F.lit("+"), F.col(qual))
    reads.select(*by, text.alias("value")).write.partitionBy(*by).text(path)


def write_sorted(sorted_reads: DataFrame, path: str) -> dict:
    """All read files of a run and its logs in one pass over ``sorted_reads`` (``trim.sort_all``).

    FASTQ text goes to ``path/sink=../title=../target=..``: ``ok`` for every read with a right identifier, ``withIndels`` again for
    those found at an offset, ``wrongId`` for whole reads without the identifier (with an empty target).  The logs are observed on the
    rows as they are written, so reads are neither split nor routed again to be counted: ``total``, ``wrong_identifier``, ``percent`` (null
    for no reads), ``with_indels``.  No shuffle stands between the observation and the write, so a task that is run again counts once.
    """
    log = Observation()
    rows = sorted_reads.observe(log, F.count("*").alias("total"), F.count_if(~F.col("id_ok")).alias("wrong_identifier"), F.count_if(F.col("id_ok") & F.col("shifted")).alias("with_indels"))
    sinks = F.when(~F.col("id_ok"), F.array(F.lit("wrongId"))).when(F.col("shifted"), F.array(F.lit("ok"), F.lit("withIndels"))).otherwise(F.array(F.lit("ok")))
    pick = lambda good, whole: F.when(F.col("id_ok"), F.col(good)).otherwise(F.col(whole))
    text = F.concat_ws("\n", pick("new_header", "header"), pick("insert_seq", "seq"), F.lit("+"), pick("insert_qual", "qual"))
    out = rows.select("title", F.when(F.col("id_ok"), F.col("target")).alias("target"), text.alias("value"), F.explode(sinks).alias("sink"))
    out.write.partitionBy("sink", "title", "target").text(path)
    got = log.get
    return {**got, "percent": got["wrong_identifier"] * 100.0 / got["total"] if got["total"] else None}


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = (), lazy_header: bool = False) -> None:
    """A tab-separated table with a header in every file, null as NA; with ``lazy_header`` a table of no rows has no header either."""
    if lazy_header and df.isEmpty():
        return df.sparkSession.createDataFrame([], "value string").write.text(path)
    writer = df.write.option("sep", "\t").option("header", True).option("nullValue", "NA").option("emptyValue", "")
    (writer.partitionBy(*by) if by else writer).csv(path)


def sam_text(aln: DataFrame, reference_size: int, by: tuple[str, ...] = ()) -> DataFrame:
    """``by, k, value``: header lines (k = 0), one a primary barcode, and alignments (k = 1)."""
    head = aln.select(*by, "bc5").distinct().select(*by, F.lit(0).alias("k"), F.concat(F.lit("@SQ\tSN:"), "bc5", F.lit(f"\tLN:{reference_size}")).alias("value"))
    rows = aln.select(*by, F.lit(1).alias("k"), F.concat_ws("\t", "qname", F.col("flag").cast("string"), "bc5", (F.col("pos0") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", F.concat(F.lit("XB:Z:"), "bc3")).alias("value"))
    return head.union(rows)


def dummy_genome(aln: DataFrame, refs: DataFrame, compat: bool = False) -> DataFrame:
    """``title, target, bc5, seq``: the reference under the name of every primary barcode; ``compat`` leaves out the first of each target."""
    names = aln.select(*FAMILY).distinct()
    if compat:
        first = names.groupBy("title", "target").agg(F.min("bc5").alias("bc5"))
        names = names.join(first, list(FAMILY), "left_anti")
    return names.join(sent_whole(refs), "target").select(*FAMILY, F.col("ref").alias("seq"))
