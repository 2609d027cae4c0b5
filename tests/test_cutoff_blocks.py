"""Haplotype counts from blocks of cutoffs against every family under every cutoff."""

import random

import pytest

from readkin.operators import consensus
from readkin.operators.consensus import MUT
from readkin.params import Grid, full_grid

SCHEMA = f"title string, target string, bc5 string, mutated boolean, muts array<{MUT}>, total_count bigint, above_all bigint, unmutated bigint, unmutated_freq double, wt_existing bigint"


def families(spark, n, seed):
    rng, rows = random.Random(seed), []
    for k in range(n):
        muts = []
        for _ in range(rng.randrange(0, 4)):
            pos, freq = rng.randrange(36, 40), rng.choice([0.0, 0.1, 0.2, 0.25, 0.5, 0.7, 0.9, 1.0, 0.3000000001])
            muts.append((pos, f"{pos}{rng.choice(['AC', 'AG', '-T'])}", freq, rng.randrange(0, 6), rng.choice([1 - freq, 0.0, 0.1, 0.5]), rng.randrange(0, 7), rng.randrange(0, 4), rng.randrange(0, 4), rng.randrange(0, 4), rng.choice([None, 0, 1, 3, 9])))
        rows.append(("S", "T", str(k), bool(muts), sorted(set(muts), key=lambda m: m[:2]), rng.choice([0, 1, 3, 4, 10, 30, 49, 50, 99]), rng.randrange(0, 4), rng.randrange(0, 9), rng.choice([0.0, 0.4, 1.0]), rng.randrange(0, 8)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("grid", [full_grid(strict=True), full_grid(strict=False), full_grid(with_bc3=False), Grid((0.7,), (4,), (2,), 2, 3), Grid((0.5, 0.1), (7, 0), (3, 0), 1, 2)])
def test_counts_equal_those_of_every_cutoff(spark, grid):
    cons = families(spark, 120, len(grid.freqs))
    want = consensus.haplotype_counts(consensus.apply_cutoffs(cons, grid), grid)
    got = consensus.interval_counts(cons, grid)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_blocks_do_not_grow_with_the_cutoffs(spark):
    """Rows of families are bounded by their own alleles, at 11 cutoffs as at 2,001."""
    cons = families(spark, 80, 5)
    few, many = (consensus.outcomes(cons, Grid(tuple(k / n for k in range(n + 1)), (0,), tuple(range(12)), 2, 3)).count() for n in (10, 2000))
    bound = sum((2 * len(r.muts) + 1) ** 2 + 2 for r in cons.collect())
    assert few <= many <= bound < 80 * 2001


def test_blocks_cover_the_grid_once(spark):
    grid = full_grid()
    for r in consensus.outcomes(families(spark, 30, 9), grid).groupBy("total_count").agg({"f_from": "min", "f_to": "max", "b_to": "max"}).collect():
        assert (r["min(f_from)"], r["max(f_to)"], r["max(b_to)"]) == (0, 11, 6)
    one = families(spark, 1, 3)
    cells = [(f, b) for r in consensus.outcomes(one, grid).collect() for f in range(r.f_from, r.f_to) for b in range(r.b_from, r.b_to)]
    assert sorted(cells) == [(f, b) for f in range(11) for b in range(6)]


def test_no_families(spark):
    grid = Grid((0.0, 0.5), (0, 4), (0,), 0, 0)
    got = consensus.interval_counts(families(spark, 1, 1).limit(0), grid).collect()
    assert len(got) == 12 and {r.barcodes_count for r in got} == {0}
