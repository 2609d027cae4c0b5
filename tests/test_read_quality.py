"""Read reports against plain counting."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from readkin.operators import qc

SCHEMA = "header string, seq string, qual string"


def reads(n=300):
    rng = random.Random(7)
    rows = [("".join(rng.choice("ACGTN") for _ in range(rng.randrange(0, 12)))) for _ in range(n)] + ["ACGT"] * 40 + ["GG"] * 10
    return [(f"@{k}", s, "".join(chr(33 + rng.randrange(42)) for _ in s)) for k, s in enumerate(rows)] + [("@null", None, None)]


def test_reports_equal_plain_counts(spark):
    rows = reads()
    df = spark.createDataFrame(rows, SCHEMA)
    whole = [(s, q) for _, s, q in rows if s]
    assert {(r.pos, r.base): r.reads for r in qc.base_composition(df).collect()} == Counter((i + 1, c) for s, _ in whole for i, c in enumerate(s))
    assert {r.gc: r.reads for r in qc.gc_per_read(df).collect()} == Counter(100 * sum(c in "GC" for c in s) // len(s) for s, _ in whole)
    for r in qc.quality_percentiles(df, (0.1, 0.5, 0.9)).collect():
        at = sorted(ord(q[r.pos - 1]) - 33 for _, q in whole if len(q) >= r.pos)
        assert (r.p10, r.p50, r.p90) == tuple(at[max(0, math.ceil(p * len(at)) - 1)] for p in (0.1, 0.5, 0.9))


def test_frequent_sequences_are_exact(spark):
    rows = reads()
    df = spark.createDataFrame(rows, SCHEMA)
    counts = Counter(s for _, s, _ in rows if s is not None)
    total = sum(counts.values())
    for share in (0.02, 0.1, 0.9, 0.001):
        for buckets in (1, 3, 1 << 16):  # sequences that share a bucket with a frequent one are told apart
            got = {r.seq: (r.reads, round(r.percent, 9)) for r in qc.overrepresented(df, share, buckets).collect()}
            assert got == {s: (n, round(100 * n / total, 9)) for s, n in counts.items() if n >= share * total}
    assert qc.overrepresented(df.limit(0)).collect() == []


def test_first_reads(spark):
    df = spark.range(50).select((F.col("id") % 2).cast("string").alias("file"), (49 - F.col("id")).alias("pos_in_file"), F.col("id").cast("string").alias("header"))
    assert [(r.file, r.pos_in_file) for r in qc.head_reads(df, 3).collect()] == [("0", 1), ("0", 3), ("0", 5)]
