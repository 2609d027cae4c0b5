"""One row for every family, the cutoff grid over families, and haplotype counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import digits12, let
from ..params import Grid
from ..sources.store import scratch
from .mutations import FAMILY
from .tables import once, spread

#: An allele in a consensus row.
MUT = "struct<pos:int,allele:string,freq:double,n:bigint,wt_freq:double,existing:bigint,mut_above:bigint,wt_above:bigint,above:bigint,wt_existing:bigint>"


def consensus(table: DataFrame) -> DataFrame:
    """One row for every family of ``family_support`` with high-quality evidence.

    A family with a high-quality allele is mutated and lists all its alleles by
    (pos, allele); else one with unmutated reads is ``WT``; others have no row.
    The frequency of the wild type at an allele's place is 1 less all alleles
    there.  Frequencies keep 12 digits.
    """
    f = list(FAMILY)
    wt = F.col("kind") == "wt"
    rows = table.withColumn("freq", digits12(F.col("mutation_freq")))
    m = F.struct("pos", "allele", "freq", F.col("hq_count").alias("n"), F.lit(None).cast("double").alias("wt_freq"), F.col("bc3_existing").alias("existing"), "mut_above", "wt_above", F.col("above_all").alias("above"), F.col("bc3_wt_existing").alias("wt_existing"))
    got = rows.groupBy(*f).agg(
        F.array_sort(F.collect_list(F.when(~wt, m))).alias("m"), F.coalesce(F.sum(F.when(~wt, F.col("hq_count"))), F.lit(0)).alias("hq"), F.max("total_count").alias("total_count"), F.max("above_all").alias("above_all"),
        F.max(F.when(wt, F.struct(F.col("hq_count").alias("n"), "freq", F.col("bc3_existing").alias("existing")))).alias("w"),
    )

    def with_wild(m: Column) -> Column:
        at = lambda x: F.aggregate(F.filter(m, lambda y: y["pos"] == x["pos"]), F.lit(0.0), lambda a, y: a + y["freq"])
        return F.transform(m, lambda x: x.withField("wt_freq", digits12(1 - at(x))))

    muts = let(with_wild, m=F.col("m"))
    mutated = F.col("hq") > 0
    got = got.where(mutated | F.col("w").isNotNull())
    return got.select(
        *f, mutated.alias("mutated"), F.when(mutated, muts).otherwise(F.array().cast(f"array<{MUT}>")).alias("muts"), "total_count", F.col("above_all"),
        F.coalesce(F.col("w.n"), F.lit(0)).cast("long").alias("unmutated"), F.coalesce(F.col("w.freq"), F.lit(0.0)).alias("unmutated_freq"), F.coalesce(F.col("w.existing"), F.lit(0)).cast("long").alias("wt_existing"),
    )


def _from_start(allele: Column, pos: Column, tss: int) -> Column:
    """An allele's name with its place counted from the transcription start, ``d`` for a deletion and ``i`` for an insertion."""
    shift = F.when(pos - tss + 1 > 0, (pos - tss + 1).cast("string")).otherwise(F.raise_error(F.lit("a mutation lies before the transcription start")).cast("string"))
    return F.concat(shift, F.regexp_replace(F.regexp_replace(F.regexp_replace(allele, r"^\d+", ""), "-$", "d"), "^-", "i"))


def rendered(cons: DataFrame, tss: int = 1) -> DataFrame:
    """The text form of consensus rows, places also counted from the transcription start."""
    join = lambda g: F.array_join(F.transform("muts", g), ";")
    or_wt = lambda c, w: F.when(F.col("mutated"), c).otherwise(w)
    return cons.select(
        *FAMILY, or_wt(join(lambda x: x["allele"]), "WT").alias("consensus"), or_wt(join(lambda x: _from_start(x["allele"], x["pos"], tss)), "WT").alias("consensus_tss"),
        or_wt(join(lambda x: F.format_string("%.6f", x["freq"])), "0").alias("mutation_freqs"), or_wt(join(lambda x: x["n"].cast("string")), "0").alias("mutation_counts"), "total_count",
        F.size("muts").alias("positions"), or_wt(join(lambda x: F.format_string("%.6f", x["wt_freq"])), F.format_string("%.6f", "unmutated_freq")).alias("wt_freqs"),
        or_wt(join(lambda x: x["existing"].cast("string")), F.col("wt_existing").cast("string")).alias("bc3_existing"), or_wt(join(lambda x: x["mut_above"].cast("string")), "NA").alias("bc3_mut_above1"),
        or_wt(join(lambda x: x["wt_above"].cast("string")), F.col("above_all").cast("string")).alias("bc3_wt_above1"), or_wt(join(lambda x: x["above"].cast("string")), F.col("above_all").cast("string")).alias("bc3_above1"), or_wt(join(lambda x: F.coalesce(x["wt_existing"].cast("string"), F.lit("NA"))), F.col("wt_existing").cast("string")).alias("bc3_all_wt_count"),
        "unmutated", "unmutated_freq",
    )


def grid_frame(spark: SparkSession, grid: Grid) -> DataFrame:
    """``freq, bc3``: the cutoffs on which the choice of alleles depends."""
    return spark.createDataFrame([(float(x), int(b)) for x in grid.freqs for b in grid.bc3s], "min_freq double, min_bc3 int")


#: What is known of a selected allele; of those that fall together it is summed.
_NUMBERS = ("freq", "n", "wt_freq", "existing", "mut_above", "wt_above", "above", "wt_existing")


def _selected(grid: Grid, tss: int) -> Column:
    """Alleles that a (frequency, barcode) cutoff leaves, an ambiguous place as ``<pos>N``.

    An allele is taken if it passes; if neither it nor the wild type at its place
    passes, and no other allele there does, the place is ambiguous.  Neighbouring
    ambiguous alleles of one place are one, with their numbers summed.
    """
    big = F.lit(2147483647).cast("long")  # an unknown number of barcodes passes every cutoff
    f, b = F.col("min_freq"), F.col("min_bc3")
    ok = lambda x: (x["freq"] >= f) & (x["existing"] >= b) & ((x["mut_above"] >= grid.above) | (x["existing"] >= grid.instead))
    wt_n = lambda x: F.coalesce(x["wt_existing"], big)
    wt_ok = lambda x: (x["wt_freq"] >= f) & (wt_n(x) >= b) & ((x["wt_above"] >= grid.above) | (wt_n(x) >= grid.instead))
    keep = F.filter("muts", lambda x: ok(x) | (~wt_ok(x) & ~F.exists("muts", lambda y: ok(y) & (y["pos"] == x["pos"]))))

    def fold(acc: Column, x: Column) -> Column:
        name = F.when(ok(x), x["allele"]).otherwise(F.concat(x["pos"].cast("string"), F.lit("N")))
        tss_name = F.when(ok(x), _from_start(x["allele"], x["pos"], tss)).otherwise(F.concat((x["pos"] - tss + 1).cast("string"), F.lit("N")))
        last = F.try_element_at(acc, F.lit(-1))
        row = lambda of: F.struct(name.alias("allele"), tss_name.alias("tss"), *[of(k).alias(k) for k in _NUMBERS])
        again = (F.size(acc) > 0) & ~ok(x) & (last["allele"] == name)
        return F.when(again, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(row(lambda k: last[k] + x[k])))).otherwise(F.concat(acc, F.array(row(lambda k: x[k]))))

    kinds = ",".join(f"{k}:{'double' if 'freq' in k else 'bigint'}" for k in _NUMBERS)
    return F.aggregate(keep, F.array().cast(f"array<struct<allele:string,tss:string,{kinds}>>"), fold)


def _status(grid: Grid) -> Column:
    wt_ok = (F.col("wt_existing") >= F.col("min_bc3")) & ((F.col("above_all") >= grid.above) | (F.col("wt_existing") >= grid.instead))
    return F.when(F.col("mutated") | wt_ok, "kept").otherwise("from_WThaplotype")


def apply_cutoffs(cons: DataFrame, grid: Grid, tss: int = 1) -> DataFrame:
    """Every family under every (frequency, barcode) cutoff: status, consensus and all that a consensus row tells of its alleles.

    Where all alleles are rejected for the wild type, the row is the family's as it was, with the
    numbers of its unmutated reads and the barcodes of the wild type.

    The read-count cutoff is only a filter on ``total_count`` and is left to
    ``at_count`` and ``haplotype_counts``, so 66 choices stand for 858.  Alleles are chosen and written
    once for each block of cutoffs (``_in_blocks``), whose row is then given to every cutoff of the block.
    """
    out = _in_blocks(cons, grid, tss)
    status = _status(grid)
    some = F.col("mutated") & (F.size("picked") > 0)
    text = lambda g: F.array_join(F.transform("picked", g), ";")
    number = lambda c: lambda x: F.coalesce(x[c].cast("string"), F.lit("NA"))
    gone = lambda c: F.array_join(F.transform("muts", number(c)), ";")
    of = lambda c, wild, rejected: F.when(some, text(number(c))).when(F.col("mutated"), rejected).otherwise(wild)
    wt, above = F.col("wt_existing").cast("string"), F.col("above_all").cast("string")
    rows = out.select(
        *FAMILY, "__f", "__b", "total_count", status.alias("status"), F.when(some, text(lambda x: x["allele"])).otherwise("WT").alias("consensus"),
        F.when(some, text(lambda x: F.format_string("%.6f", x["freq"]))).otherwise(F.format_string("%.6f", "unmutated_freq")).alias("freqs"), F.when(some, text(lambda x: x["n"].cast("string"))).otherwise(F.col("unmutated").cast("string")).alias("counts"),
        F.when(some, F.size("picked")).when(F.col("mutated"), 0).otherwise(1).alias("positions"), F.when(some, text(lambda x: x["tss"])).otherwise("WT").alias("consensus_tss"),
        F.when(some, text(lambda x: F.format_string("%.6f", x["wt_freq"]))).otherwise("NA").alias("wt_freqs"), of("existing", wt, gone("wt_existing")).alias("bc3_existing"),
        of("mut_above", F.lit("NA"), gone("mut_above")).alias("bc3_mut_above1"), of("wt_above", above, gone("wt_above")).alias("bc3_wt_above1"), of("above", F.lit("NA"), F.lit("NA")).alias("bc3_above1"), of("wt_existing", wt, gone("wt_existing")).alias("bc3_all_wt_count"),
    )
    held = lambda axis, values: F.explode(F.slice(F.array(*map(F.lit, values)), F.col(axis)["start"] + 1, F.col(axis)["stop"] - F.col(axis)["start"]))
    filled = rows.withColumn("min_freq", held("__f", _cutoffs(grid.freqs, float))).withColumn("min_bc3", held("__b", _cutoffs(grid.bc3s, int)))
    return filled.select(*FAMILY, "min_freq", "min_bc3", *[c for c in rows.columns if c not in (*FAMILY, "__f", "__b")])


def _cutoffs(values: Iterable, kind: type) -> list:
    return sorted({kind(x) for x in values})


#: Families of a task that puts them under cutoffs: each is many rows there.
FAMILIES = 2_000


def _in_blocks(cons: DataFrame, grid: Grid, tss: int) -> DataFrame:
    """``cons`` with a row for each block of cutoffs, ``__f`` and ``__b``, its first cutoffs ``min_freq`` and ``min_bc3``, and the alleles ``picked`` under them.

    What a family becomes changes only at its own frequencies and barcode counts, so there is a row for
    every block between them and not for every cutoff.  Blocks are places in the sorted cutoffs, ``start`` and ``stop``, the latter
    excluded; blocks without a cutoff are left out.  Families are written first and dealt by their number: they are narrow
    rows, which would lie in few tasks.
    """
    freqs, bc3s = _cutoffs(grid.freqs, float), _cutoffs(grid.bc3s, int)
    big = F.lit(2147483647).cast("long")

    def blocks(values: Column, cutoffs: list) -> Column:
        # A value passes the cutoffs up to it: the first one over it begins a new block.
        passed = F.transform(values, lambda v: F.size(F.filter(F.array(*[F.lit(c) for c in cutoffs]), lambda c: c <= v)))
        starts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), F.filter(passed, lambda k: k < len(cutoffs)))))
        return let(lambda a: F.transform(a, lambda k, i: F.struct(k.alias("start"), F.coalesce(F.try_element_at(a, i + 2), F.lit(len(cutoffs))).alias("stop"))), a=starts)

    f = blocks(F.flatten(F.transform("muts", lambda m: F.array(m["freq"], m["wt_freq"]))), freqs)
    b = blocks(F.concat(F.flatten(F.transform("muts", lambda m: F.array(m["existing"], F.coalesce(m["wt_existing"], big)))), F.when(F.col("mutated"), F.array().cast("array<bigint>")).otherwise(F.array("wt_existing"))), bc3s)
    out = spread(scratch(cons, "families"), FAMILIES).withColumn("__f", F.explode(f)).withColumn("__b", F.explode(b))
    at = lambda values, place, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col(place) + 1)
    out = out.withColumns({"min_freq": at(freqs, "__f.start", "double"), "min_bc3": at(bc3s, "__b.start", "int")})
    return once(out.withColumn("picked", _selected(grid, tss)), "picked")


def outcomes(cons: DataFrame, grid: Grid, tss: int = 1) -> DataFrame:
    """``f_from, f_to, b_from, b_to, total_count, status, consensus``: what becomes of each family in each block of cutoffs.

    Blocks (``_in_blocks``) are given as places in the sorted cutoffs, the second one excluded.
    """
    out = _in_blocks(cons, grid, tss)
    some = F.col("mutated") & (F.size("picked") > 0)
    return out.select("__f.start", "__f.stop", "__b.start", "__b.stop", "total_count", _status(grid).alias("status"), F.when(some, F.array_join(F.transform("picked", lambda x: x["allele"]), ";")).otherwise("WT").alias("consensus")).toDF(
        "f_from", "f_to", "b_from", "b_to", "total_count", "status", "consensus"
    )


def _filled(events: DataFrame, axis: str, size: int, names: list[str]) -> DataFrame:
    """Running sums of ``n`` along an axis, a row for every place where they are not zero."""
    w = Window.partitionBy(*names).orderBy(axis)  # at most one row a place of the axis
    rows = events.withColumns({"__n": F.sum("n").over(w), "__next": F.coalesce(F.lead(axis).over(w), F.lit(size))}).where((F.col("__n") != 0) & (F.col(axis) < F.col("__next")))
    return rows.select(*names, F.explode(F.sequence(F.col(axis), F.col("__next") - 1)).alias(axis), F.col("__n").alias("n"))


def interval_counts(cons: DataFrame, grid: Grid) -> DataFrame:
    """The rows of ``haplotype_counts`` from blocks of cutoffs.

    Equal outcomes of equal blocks are counted first; a block then adds its number where it begins and takes it
    away where it ends, along all three axes, and running sums of these fill the grid.  So the
    work on families does not grow with the number of cutoffs.
    """
    spark = cons.sparkSession
    freqs, counts, bc3s = sorted(set(grid.freqs)), sorted(set(grid.counts)), sorted(set(grid.bc3s))
    reached = F.size(F.filter(F.array(*[F.lit(int(c)) for c in counts]), lambda c: c <= F.col("total_count")))
    kept = F.when(F.col("status") == "kept", F.col("consensus")).otherwise("rejected.from_WThaplotype")
    found = outcomes(cons, grid).groupBy("f_from", "f_to", "b_from", "b_to", reached.alias("c_to"), kept.alias("consensus")).agg(F.count("*").alias("n"))
    corner = lambda name, f, b, c, sign: F.struct(name.alias("consensus"), f.alias("f"), b.alias("b"), c.alias("c"), (sign * F.col("n")).alias("n"))
    ends = [corner(F.col("consensus"), F.col(f), F.col(b), c, x * y * z) for f, x in (("f_from", 1), ("f_to", -1)) for b, y in (("b_from", 1), ("b_to", -1)) for c, z in ((F.lit(0), 1), (F.col("c_to"), -1))]
    # A family has one first block; its read counts beyond those reached are rejected under all other cutoffs.
    low = [corner(F.lit("rejected.low_count"), F.lit(f), F.lit(b), F.col("c_to"), sign) for f, b, sign in ((0, 0, 1), (len(freqs), 0, -1), (0, len(bc3s), -1), (len(freqs), len(bc3s), 1))]
    first = (F.col("f_from") == 0) & (F.col("b_from") == 0)
    events = found.select(F.explode(F.when(first, F.array(*ends, *low)).otherwise(F.array(*ends))).alias("e")).select("e.*")
    events = events.groupBy("consensus", "f", "b", "c").agg(F.sum("n").alias("n")).where("n <> 0")
    cells = _filled(_filled(_filled(events, "f", len(freqs), ["consensus", "b", "c"]), "b", len(bc3s), ["consensus", "f", "c"]), "c", len(counts), ["consensus", "f", "b"])
    at = lambda values, place, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col(place) + 1)
    cells = cells.select(at(freqs, "f", "double").alias("min_freq"), at(counts, "c", "int").alias("min_count"), at(bc3s, "b", "int").alias("min_bc3"), "consensus", F.col("n").alias("barcodes_count"))
    return _with_rejected(cells, spark, grid)


def at_count(applied: DataFrame, min_count: int) -> DataFrame:
    """The families of one read-count cutoff."""
    return applied.where((F.col("total_count") >= min_count) & (F.col("status") == "kept"))


def ordered(counts: DataFrame) -> DataFrame:
    """Haplotype counts as they are written: by cutoff, the most frequent first."""
    return counts.orderBy("min_freq", "min_count", "min_bc3", F.col("barcodes_count").desc(), "consensus")


def haplotype_counts(applied: DataFrame, grid: Grid) -> DataFrame:
    """``min_freq, min_count, min_bc3, consensus, barcodes_count`` for every cutoff of the grid.

    Families are counted per (frequency, barcode, consensus, total) first, so the
    read counts multiply counts, not families; totals beyond the greatest cutoff
    are one.  The rejected are rows of their own, zeros included.
    """
    spark = applied.sparkSession
    top = max(grid.counts)
    small = applied.groupBy("min_freq", "min_bc3", "status", "consensus", F.least("total_count", F.lit(top)).alias("t")).agg(F.count("*").alias("n"))
    counts = F.broadcast(spark.createDataFrame([(int(c),) for c in grid.counts], "min_count int"))
    many = small.crossJoin(counts)
    name = F.when(F.col("t") < F.col("min_count"), "rejected.low_count").when(F.col("status") == "kept", F.col("consensus")).otherwise("rejected.from_WThaplotype")
    found = many.groupBy("min_freq", "min_count", "min_bc3", name.alias("consensus")).agg(F.sum("n").alias("barcodes_count"))
    return _with_rejected(found, spark, grid)


def _with_rejected(found: DataFrame, spark: SparkSession, grid: Grid) -> DataFrame:
    """Rows of the rejected for every cutoff, zeros included."""
    counts = F.broadcast(spark.createDataFrame([(int(c),) for c in grid.counts], "min_count int"))
    rejected = spark.createDataFrame([(x,) for x in ("rejected.low_count", "rejected.from_WThaplotype", "rejected.other")], "consensus string")
    none = grid_frame(spark, grid).crossJoin(counts).crossJoin(F.broadcast(rejected)).select("min_freq", "min_count", "min_bc3", "consensus", F.lit(0).cast("long").alias("barcodes_count"))
    return found.unionByName(none).groupBy("min_freq", "min_count", "min_bc3", "consensus").agg(F.sum("barcodes_count").alias("barcodes_count"))
