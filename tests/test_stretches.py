"""Differences and place qualities of aligned reads against a loop over the letters."""

import random

from pyspark.sql import functions as F

from readkin.functions import sequence

REGIONS = ((1, 40), (44, 60), (70, 200))


def plain(t, q, qual, over):
    """Differences inside the regions, and a digit for each base of the reference."""
    pos, read, found, digits = 0, 0, [], ""
    for k, (a, b) in enumerate(zip(t, q)):
        pos, read = pos + (a != "-"), read + (b != "-")
        if a != b and any(x <= pos <= y for x, y in REGIONS):
            found.append((pos, a, b, read - 1))
        if a != "-":
            score = ord(qual[read - 1]) - 33 if qual and 0 < read <= len(qual) else -1
            digits += "1" if b == "-" or score > over else "0"
    return found, digits


def test_letters_one_by_one(spark):
    rng, rows = random.Random(11), []
    for k in range(1500):
        n = rng.choice([0, 1, 5, 31, 32, 33, 64, 100, 1000 if k % 50 == 0 else 130])
        t = "".join(rng.choice("ACGT" + "-" * rng.choice([0, 0, 1])) for _ in range(n))
        q = "".join(c if rng.random() < 0.93 else rng.choice("ACGTN-") for c in t) + "A" * rng.choice([0, 0, 0, 1, 3, 40])
        n_read = max(0, len(q.replace("-", "")) + rng.choice([0, 0, 0, -2, 2]))
        rows.append((k, t, q, "".join(chr(rng.randint(33, 74)) for _ in range(n_read))))
    df = spark.createDataFrame(rows, "k int, t string, q string, qual string")
    got = df.select("k", sequence.differences(F.col("t"), F.col("q"), REGIONS).alias("d"), sequence.position_quality(F.col("t"), F.col("q"), F.col("qual"), 27).alias("p")).collect()
    found = {r.k: ([tuple(x) for x in r.d], r.p) for r in got}
    assert sum(len(d) for d, _ in found.values()) > 2000
    for k, t, q, qual in rows:
        d, p = plain(t, q, qual, 27)
        assert found[k] == (d, p), (t, q, qual)
