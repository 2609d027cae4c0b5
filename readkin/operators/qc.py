"""Read quality control: statistics, quality trim, exact adapters, sampling."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import scratch
from .batches import appended
from .tables import once


def position_stats(reads: DataFrame) -> DataFrame:
    """``pos, reads, mean, least, most, n_bases, gc`` for each place in the reads; a read without scores has none.

    Sums, a row a place, are made of 1,000 reads at a time, so no row is made for a letter.
    """
    sums = reads.select("seq", "qual").mapInArrow(_place_sums, "pos int, reads long, total long, least int, most int, n_bases long, gc long").groupBy("pos")
    out = sums.agg(F.sum("reads").alias("reads"), F.sum("total").alias("total"), *[f(c).alias(c) for c, f in (("least", F.min), ("most", F.max), ("n_bases", F.sum), ("gc", F.sum))])
    return out.select("pos", "reads", (F.col("total") / F.col("reads")).alias("mean"), "least", "most", "n_bases", "gc")


def _letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one behind the other, and the length of each."""
    texts = [t or "" for t in texts]
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64), np.fromiter(map(len, texts), np.int64, len(texts))


def _place_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["pos", "reads", "total", "least", "most", "n_bases", "gc"]
    for batch in (whole.slice(s, 1000) for whole in batches for s in range(0, whole.num_rows, 1000)):
        (base, of_seq), (score, of_qual) = (_letters(batch.column(k).to_pylist()) for k in (0, 1))
        if not len(score):
            continue
        score, row = score - 33, np.repeat(np.arange(len(of_qual)), of_qual)
        at = np.arange(len(score)) - (np.cumsum(of_qual) - of_qual)[row]
        has = at < of_seq[row]  # a base stands beside the score
        own = np.zeros(len(score), np.int64)
        own[has] = base[(np.cumsum(of_seq) - of_seq)[row[has]] + at[has]]
        n = int(of_qual.max())
        count = lambda which: np.bincount(at[which], minlength=n)
        reads, total = np.bincount(at), np.zeros(n, np.int64)
        least, most = np.full(n, 1 << 30), np.full(n, -(1 << 30))
        np.add.at(total, at, score)
        np.minimum.at(least, at, score)
        np.maximum.at(most, at, score)
        columns = [np.arange(1, n + 1, dtype=np.int32), reads, total, least.astype(np.int32), most.astype(np.int32), count(own == ord("N")), count((own == ord("G")) | (own == ord("C")))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def base_composition(reads: DataFrame) -> DataFrame:
    """``pos, base, reads``: how many reads have each letter at each place."""
    rows = reads.select(F.posexplode(F.split("seq", "")).alias("at", "base"))
    return rows.where("base <> ''").groupBy((F.col("at") + 1).alias("pos"), "base").agg(F.count("*").alias("reads"))


def quality_percentiles(reads: DataFrame, shares: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """``pos, p10, p25, ..``: for each place the least score that the share of its reads does not exceed.

    Exact: a score has fewer than a hundred values, so reads are counted by (place, score) first, and running
    sums are made of these counts, which do not grow with the reads.
    """
    counts = reads.select(F.posexplode(F.split("qual", "")).alias("at", "q")).where("q <> ''").groupBy((F.col("at") + 1).alias("pos"), (F.ascii("q") - 33).alias("score")).agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("pos").orderBy("score")  # under a hundred rows
    rows = counts.withColumns({"below": F.sum("n").over(up_to), "all": F.sum("n").over(Window.partitionBy("pos"))})
    return rows.groupBy("pos").agg(*[F.min(F.when(F.col("below") >= p * F.col("all"), F.col("score"))).alias(f"p{round(p * 100)}") for p in shares])


def gc_per_read(reads: DataFrame) -> DataFrame:
    """``gc, reads``: reads by their whole percentage of G and C; an empty read has none."""
    gc = F.char_length("seq") - F.char_length(F.translate("seq", "GC", ""))
    return reads.where("seq <> ''").groupBy(F.floor(100 * gc / F.char_length("seq")).cast("int").alias("gc")).agg(F.count("*").alias("reads"))


def overrepresented(reads: DataFrame, share: float = 0.001, buckets: int = 1 << 16) -> DataFrame:
    """``seq, reads, percent`` of every sequence that makes up ``share`` of all reads or more, counted exactly.

    Reads are counted by buckets of their hash first.  A sequence cannot be frequent
    if its bucket is not, and at most ``1 / share`` buckets are, so these are sent to all tasks, and only reads
    in them are shuffled to be counted by sequence.  Runs a job for the number of reads.
    """
    keyed = once(reads.select("seq"), "seq").where("seq is not null").select("seq", F.pmod(F.xxhash64("seq"), F.lit(buckets)).alias("bucket"))
    sizes = scratch(keyed.groupBy("bucket").agg(F.count("*").alias("n")), "buckets")  # at most so many rows as buckets, counted once
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    least = share * total
    heavy = sizes.where(F.col("n") >= least).select("bucket")
    found = keyed.join(F.broadcast(heavy), "bucket", "left_semi").groupBy("seq").agg(F.count("*").alias("reads")).where(F.col("reads") >= least)
    return found.select("seq", "reads", (F.col("reads") * 100.0 / F.lit(max(total, 1))).alias("percent"))


def head_reads(reads: DataFrame, n: int = 10_000, order: tuple[str, ...] = ("file", "pos_in_file")) -> DataFrame:
    """The first ``n`` reads in the order of their files."""
    return reads.orderBy(*order).limit(n)


def duplication(reads: DataFrame) -> DataFrame:
    """``copies, sequences``: how many sequences occur how often."""
    return reads.groupBy("seq").agg(F.count("*").alias("copies")).groupBy("copies").agg(F.count("*").alias("sequences"))


def length_histogram(reads: DataFrame) -> DataFrame:
    return reads.groupBy(F.char_length("seq").alias("length")).agg(F.count("*").alias("reads"))


def sliding_window_trim(reads: DataFrame, window: int = 3, mean: int = 30, least: int = 80) -> DataFrame:
    """Cut each read at the first window whose mean score is under ``mean``; reads left shorter than ``least`` go.  Reads shorter than a window are kept whole."""

    def start():
        def first_bad(quals: list) -> list[list]:
            """Letters before the first bad window of each read: windows of all reads of a batch at once, as differences of running sums."""
            size = np.fromiter((len(q or "") for q in quals), np.int64, len(quals))
            sums = np.concatenate(([0], np.cumsum(np.frombuffer("".join(q or "" for q in quals).encode("utf-32-le"), np.uint32).astype(np.int64) - 33)))
            bad = np.append(np.flatnonzero(sums[window:] - sums[:-window] < mean * window), len(sums) + window)  # the last is in no read
            stop = np.cumsum(size)
            begin = stop - size
            first = bad[np.searchsorted(bad, begin)]
            return [[int(k) if ok else None for k, ok in zip(first - begin, first + window <= stop)]]

        return first_bad

    cut = F.coalesce("__bad", F.char_length("seq"))
    out = appended(reads, ["qual"], "__bad int", start).withColumn("__cut", cut).drop("__bad").where(F.col("__cut") >= least)
    return out.withColumns({"seq": F.left("seq", F.col("__cut")), "qual": F.left("qual", F.col("__cut"))}).drop("__cut")


def sample_reads(reads: DataFrame, n: int = 10_000, seed: int = 100, key: str = "header") -> DataFrame:
    """``n`` reads in the order of a seeded hash of their name; the same each time."""
    return reads.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary")), key).limit(n)


def strip_exact_adapter(reads: DataFrame, adapter: str) -> DataFrame:
    """Cut the reads at the first exact occurrence of an adapter, N free; an expression, no Python."""
    at = F.regexp_instr("seq", F.lit(re.sub("N", "[ACGTN]", adapter)))
    keep = F.when(at > 0, at - 1).otherwise(F.char_length("seq"))
    return reads.withColumns({"seq": F.left("seq", keep), "qual": F.left("qual", keep)})
