"""A stream of raw reads: split and routed as they arrive, and counted by family up to consensus rows.

A family is complete only when its last read has come, which no stream can tell.  So what is kept of
each micro-batch are counts whose sums give the family table: they can be added in any order, none is held in memory between
batches, and the table of all reads so far is a batch query over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import consensus, family, mutations, trim
from ..params import Factors, RunParams
from ..plans import families
from ..sources.store import discard, scratch

SCHEMA = "title string, header string, seq string, qual string"


def read_drop_folder(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Reads of Parquet files that appear in a folder."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def routed_stream(reads: DataFrame, factors: Factors, min_phred: int = 20) -> DataFrame:
    """Split, mask and route a stream; a row in is at most a row out, so there is no state."""
    return trim.route(trim.split_barcodes(reads, factors, min_phred), factors)


def append_routed(reads: DataFrame, factors: Factors, out: str, checkpoint: str) -> StreamingQuery:
    """Append routed reads as Parquet by target until the folder's present files are done."""
    stream = routed_stream(reads, factors).writeStream.partitionBy("title", "target").option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).format("parquet").start(out)


COUNTS = {
    "hits": "title string, target string, bc5 string, bc3 string, allele string, pos int, kind string, n long, hq long, batch long",
    "barcodes": "title string, target string, bc5 string, bc3 string, n_all long, n long, batch long",
    "lows": "title string, target string, bc5 string, bc3 string, hqpos string, n long, batch long",
}


def _keep(called: DataFrame, excluded: tuple[str, ...], out: str, batch: int) -> None:
    """Write a batch's counts into folders of its own, so that a batch that is run again replaces them."""
    called = scratch(called.select(*mutations.FAMILY, "bc3", "muts", "hqpos"), "batch")  # called once, counted three times
    try:
        for name, rows in family.partial_counts(called, excluded).items():
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch}")
    finally:
        discard(called)


def count_alignments(alignments: DataFrame, refs: DataFrame, factors: Factors, out: str, checkpoint: str, params: RunParams = RunParams()) -> StreamingQuery:
    """Count a stream of alignments by family into the folder ``out``, until what is there now is done; a later call goes on from ``checkpoint``."""

    def add(batch: DataFrame, number: int) -> None:
        called = mutations.call(mutations.usable(batch), refs, factors.roi, params.min_phred)
        _keep(called, factors.excluded, out, number)

    return alignments.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def count_reads(reads: DataFrame, refs: DataFrame, factors: Factors, out: str, checkpoint: str, params: RunParams = RunParams()) -> StreamingQuery:
    """The same for a stream of raw reads, which are split, routed and aligned first."""

    def add(batch: DataFrame, number: int) -> None:
        aligned = families.alignments_of(batch, refs, factors, params)
        called = mutations.call(mutations.usable(aligned), refs, factors.roi, params.min_phred)
        _keep(called, factors.excluded, out, number)

    return reads.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def consensus_so_far(spark: SparkSession, out: str, params: RunParams = RunParams()) -> DataFrame:
    """Consensus rows of all reads counted into ``out`` so far: those that ``families.consensus_of`` gives for the same reads at once."""
    counts = {name: spark.read.schema(schema).parquet(f"{out}/{name}").drop("batch") for name, schema in COUNTS.items()}
    return consensus.consensus(family.support_of_counts(**counts, bc3_min_reads=params.bc3_min_reads))
