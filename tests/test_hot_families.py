"""Families of any size: barcodes as rows, group sizes without windows, against plain counting."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from readkin.operators import consensus, family, mutations

SCHEMA = "title string, target string, bc5 string, bc3 string, qname string, muts array<struct<allele:string,pos:int,kind:string,phred:int,hq:boolean>>, hqpos string"


def made(n, seed):
    """Reads of which one family has a third, with thousands of barcodes."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        fam = "HOT" if k % 3 == 0 else f"F{rng.randrange(n // 12)}"
        bc3 = rng.choice(["BC3_missing", f"B{rng.randrange(n // 2 if fam == 'HOT' else 4)}"])
        muts = []
        for _ in range(rng.choice([0, 0, 1, 2])):
            pos, kind = rng.randrange(1, 5), rng.choice(["sub", "del", "ins"])
            muts.append((f"{pos}{rng.choice('AC')}{kind[0]}", pos, kind, 30, rng.random() < 0.7))
        muts = list(dict(((m[0]), m) for m in muts).values()) or [("WT", None, "wt", None, True)]
        rows.append(("S", "T", fam, bc3, f"r{k}", muts, "".join(rng.choice("01") for _ in range(6))))
    return rows


def plain(rows):
    """All numbers and lists of the table by loops."""
    of = defaultdict(list)
    for r in rows:
        of[r[:3]].append(r)
    out = {}
    for fam, reads in of.items():
        all_ = Counter(r[3] for r in reads)
        hits, hq, about = Counter(), defaultdict(Counter), {}
        at = defaultdict(Counter)
        for r in reads:
            for a, pos, kind, _, good in r[5]:
                about[a] = (pos, kind)
                hits[a] += 1
                hq[a][r[3]] += good
                if pos is not None and good:
                    at[pos][r[3]] += 1
        for a, (pos, kind) in about.items():
            own = {b: n for b, n in hq[a].items() if n}
            total = sum(r[6][pos - 1] == "1" for r in reads) if kind == "sub" else len(reads)
            wild = {b: max(0, n - at[pos][b]) for b, n in all_.items()} if pos in at else None
            size = lambda c, test: None if c is None else sum(test(b, n) for b, n in c.items())
            out[(*fam, a)] = (
                hits[a], sum(own.values()), len(reads), total, sum(own.values()) / total if total else 0.0, size(own, lambda b, n: b != "BC3_missing"), size(own, lambda b, n: b == "BC3_missing"),
                size(wild, lambda b, n: n > 0 and b != "BC3_missing"), size(wild, lambda b, n: n > 0 and b == "BC3_missing"), size(own, lambda b, n: n > 1), size(wild, lambda b, n: n > 1) or 0, size(all_, lambda b, n: n > 1),
                sorted(own.items()), sorted(all_.items()), None if wild is None else sorted(wild.items()),
            )
    return out


NUMBERS = ["mutation_count", "hq_count", "total_count", "hq_total_count", "mutation_freq", "bc3_existing", "bc3_missing", "bc3_wt_existing", "bc3_wt_missing", "mut_above", "wt_above", "above_all"]


def test_table_equals_plain_counts(spark):
    rows = made(1500, 4)
    want = plain(rows)
    got = family.family_table(spark.createDataFrame(rows, SCHEMA)).collect()
    pairs = lambda x: None if x is None else [(p.bc3, p.n) for p in x]
    assert {(r.title, r.target, r.bc5, r.allele): (*[r[c] for c in NUMBERS], pairs(r.bc3_hq), pairs(r.bc3_all), pairs(r.bc3_wt)) for r in got} == want and len(got) == len(want)


def test_numbers_need_no_list_of_barcodes(spark):
    """The support of a family with a third of all reads is made of sums alone."""
    rows = made(1500, 8)
    df = family.family_support(spark.createDataFrame(rows, SCHEMA))
    want = plain(rows)
    assert {(r.title, r.target, r.bc5, r.allele): tuple(r[c] for c in NUMBERS) for r in df.collect()} == {k: v[:12] for k, v in want.items()}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("collect_set(pos") >= 1 and "Window" not in plan
    cons = consensus.consensus(df)
    assert cons.where("bc5 = 'HOT'").count() == 1


def test_strict_support(spark):
    two = [("2A", 2, "ins", 30, True), ("2C", 2, "sub", 30, True)]
    df = spark.createDataFrame([("S", "T", "F", "B", "r", two, "111111")], SCHEMA)
    assert family.family_support(df).where("wt_above = 0 and bc3_wt_existing = 0").count() == 2
    with pytest.raises(Exception, match="more alleles"):
        family.family_support(df, strict=True).collect()


def test_group_sizes_without_windows(spark):
    rows = [(*r[:5], r[5], r[6]) for r in made(300, 2)] + [("S", None, None, "X", "n1", [("WT", None, "wt", None, True)], ""), ("S", None, None, "X", "n2", [("WT", None, "wt", None, True)], "")]
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = Counter(r[:3] for r in rows)
    listed = mutations.read_list(df)
    assert "Window" not in listed._jdf.queryExecution().optimizedPlan().toString()
    got = listed.collect()
    assert all(r.bc5_count == sizes[r.title, r.target, r.bc5] for r in got) and len(got) == sum(len(r[5]) for r in rows)
    large = mutations.eligible(df, bc3_min_reads=3)
    assert "Window" not in large._jdf.queryExecution().optimizedPlan().toString()
    by = Counter(r[:4] for r in rows)
    assert sorted(r.qname for r in large.select("qname").collect()) == sorted(r[4] for r in rows if r[3] != "X" and by[r[:4]] >= 3)


def test_no_reads(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert family.family_table(df).collect() == [] and family.family_support(df).collect() == [] and mutations.read_list(df).collect() == []
    assert consensus.consensus(family.family_support(df)).where(F.lit(True)).collect() == []
