"""Small table operators: merge with fill, sample checks, target expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..params import Factors

#: Rows of a table of references or the like that may be held by every task.
FEW = 10_000


def few_rows(df: DataFrame, most: int = FEW) -> list[Row]:
    """All rows of a small table; over ``most`` of them are an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows in a table that every task would hold")
    return rows


def sent_whole(df: DataFrame, most: int = FEW) -> DataFrame:
    """``df`` to be broadcast if it has at most ``most`` rows, which are counted; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: Rows of a task where each row costs much work.
ROWS = 50_000


def spread(df: DataFrame, rows: int = ROWS) -> DataFrame:
    """``df`` in as many partitions as there are cores, and in more if these would have over ``rows`` rows each; as it is, without a shuffle, if its files give as many.

    For narrow rows of which each costs much work, as a file of one row group is read by one task and a file of
    narrow rows by few.  The rows are counted, so a task's work does not grow with the table.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def once(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` computed where they stand, once a row.

    A filter on them is not pushed below this step; else the optimizer puts their whole expressions, and those
    they are made of, into a filter at the source, where they are computed again for every use and in as many tasks as files give.
    """
    kept = df.withColumn("__once", F.struct(*columns)).drop(*columns)
    return kept.select("*", F.inline(F.array("__once"))).drop("__once").select(*df.columns)


def full_merge(x: DataFrame, y: DataFrame, key: str, fill: int = 0) -> DataFrame:
    """Full outer join on ``key`` with ``fill`` in the place of missing numbers; an empty left side with a filled right one is an error of the caller and gives the right rows here."""
    out = x.join(y, key, "full")
    return out.select(key, *[F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in out.columns if c != key])


def samples_by_pair(samples: DataFrame, single_end: bool = False) -> DataFrame:
    """``sample, pair, files, ok, ordinal``: lists of files, whether their number is right, the rank of the sample's name from 0."""
    grouped = samples.groupBy("sample", "pair").agg(F.array_sort(F.collect_list("file")).alias("files"))
    names = samples.select("sample").distinct().withColumn("ordinal", F.row_number().over(Window.orderBy("sample")) - 1)  # a row a sample
    ok = (F.size("files") == (1 if single_end else 2)) & (F.size(F.array_distinct("files")) == F.size("files"))
    return grouped.withColumn("ok", ok).join(F.broadcast(names), "sample")


#: The extensions of read files.
EXTENSIONS = r"\.((?:fastq|fq)(?:\.gz)?)$"


def lane_parts(samples: DataFrame) -> DataFrame:
    """``sample, mate, files, extension, ok`` of samples whose mates come in several files: the n-th files of all pairs are parts of mate n.

    The parts of a sample must all have one known extension, or they cannot be
    put behind each other: if not, ``ok`` is false and ``extension`` null.  Every pair must have as many files.
    """
    place = Window.partitionBy("sample", "pair").orderBy("file")  # the files of one pair
    rows = samples.withColumns({"mate": F.row_number().over(place), "extension": F.regexp_extract("file", EXTENSIONS, 1)})
    parts = rows.groupBy("sample", "mate").agg(F.array_sort(F.collect_list("file")).alias("files"))
    whole = rows.groupBy("sample").agg(F.min("extension").alias("a"), F.max("extension").alias("b"), F.count("*").alias("n"), F.max("mate").alias("mates"), F.count_distinct("pair").alias("pairs"))
    ok = (F.col("a") == F.col("b")) & (F.col("a") != "") & (F.col("n") == F.col("mates") * F.col("pairs"))
    return parts.join(whole, "sample").select("sample", "mate", "files", F.when(F.col("a") == F.col("b"), F.nullif("a", F.lit(""))).alias("extension"), ok.alias("ok"))


def repeated_files(samples: DataFrame) -> DataFrame:
    return samples.groupBy("file").agg(F.count("*").alias("n")).where("n > 1")


def unmatched_samples(samples: DataFrame, factors: DataFrame) -> DataFrame:
    """``sample, missing_in`` of samples that only one of the tables names."""
    a, b = samples.select("sample").distinct(), factors.select("sample").distinct()
    return a.join(b, "sample", "left_anti").select("sample", F.lit("factors").alias("missing_in")).union(b.join(a, "sample", "left_anti").select("sample", F.lit("samples").alias("missing_in")))


def targets(samples: DataFrame, factors: Factors) -> DataFrame:
    """Every sample with every target and the reference it is aligned to."""
    return samples.withColumn("t", F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.lit(r).alias("ref_gene")) for t, r in factors.targets]))).select("*", "t.target", "t.ref_gene").drop("t")
