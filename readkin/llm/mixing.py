"""Mixing sources to target weights by Sainte-Lague apportionment, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import digest, plain, word_count

_SUB = 1024


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with a non-null source key, the size, and the seeded order and its sub-range."""
    h = digest(F.lit(seed), F.col("doc_id"), F.coalesce("text", F.lit("")))
    return docs.select(
        "*", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("__key"), word_count(F.col("text")).alias("__size"), h.alias("__h"), F.shiftright(h, 50).cast("int").alias("__sub")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``sizes(key, size)`` with ``ord, weight, total, target``.

    Sources take the weights in turn by code point of the name, the null source
    (key ``''``) last.  Targets share the total by weight; none is above ``cap``
    times the source's size, and what is cut off is shared by the rest: with
    sources sorted by the level at which they fill up, the common level is that
    of the first source that is not full.  One row a source, so the ordered
    windows here hold a small table.
    """
    by_name = Window.orderBy(F.col("key") == "", "key")
    everything = Window.partitionBy()
    s = sizes.select("key", "size", F.row_number().over(by_name).alias("ord"), F.sum("size").over(everything).alias("total"))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("ord") - 1, F.lit(len(weights))).cast("int") + 1))
    s = s.withColumn("full", F.col("size") * cap / F.col("weight"))
    by_level = Window.orderBy("full", "ord")
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum(F.col("size") * cap).over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "ord", "level"))).over(everything)["level"])
    target = F.when(F.col("full") <= F.col("level"), F.col("size") * F.lit(float(cap))).otherwise(F.col("weight") * F.col("level"))
    return s.select("key", "size", "ord", "weight", "total", F.coalesce(target, F.lit(0.0)).alias("target"))


def quotas(goals: DataFrame, shards: int = 16, blocks_per_shard: int = 1 << 16) -> DataFrame:
    """Whole blocks of every source for every shard: ``key, shard, blocks, block``.

    ``block`` is the tokens of a block, equal for all sources; all shards together
    get ``total / block`` blocks by highest quotients ``target / (2 k + 1)``.
    The method never takes a seat back when the house grows, so a shard's quota
    is what the house up to it has beyond the house before it.  At the extreme
    divisors only ``2 n`` quotients of ``n`` sources are open; all others are
    granted or lost without being listed.
    """
    g = goals.where("target > 0").withColumn("block", F.greatest(F.lit(1), F.ceil(F.col("total") / (shards * blocks_per_shard))))
    g = g.select("*", F.sum("target").over(Window.partitionBy()).alias("t"), F.count("*").over(Window.partitionBy()).alias("n"))
    g = g.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    house = F.floor(F.round(F.col("total") / F.col("block")) * (F.col("shard") + 1) / shards)
    at = lambda seats: F.floor(F.col("target") * F.greatest(seats, F.lit(0.0)) / F.col("t") + 0.5)
    g = g.select("key", "ord", "target", "block", "shard", house.alias("house"), at(house - F.col("n") / 2).alias("low"), (at(house + F.col("n") / 2) + 1).alias("high"))
    g = g.withColumn("free", F.col("house") - F.sum("low").over(Window.partitionBy("shard")))
    open_ = g.select("*", F.explode(F.sequence("low", F.col("high") - 1)).alias("k"))
    first = Window.partitionBy("shard").orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "ord", "k")
    won = open_.withColumn("won", (F.row_number().over(first) <= F.col("free")).cast("long"))
    upto = won.groupBy("key", "shard", "block").agg((F.max("low") + F.sum("won")).alias("upto"))
    last = F.coalesce(F.lag("upto").over(Window.partitionBy("key").orderBy("shard")), F.lit(0))
    return upto.select("key", "shard", "block", (F.col("upto") - last).alias("blocks"))


def _covered(start: Column, size: Column, length: Column, origin: Column, around: Column) -> Column:
    """Tokens of ``[start, start + size)`` on a ring of ``around`` that ``length`` tokens from ``origin`` on cover, turns counted."""
    turns = F.floor(length / around)
    rest, rel = length - turns * around, F.pmod(start - origin, around)
    direct = F.greatest(F.lit(0), F.least(rel + size, rest) - F.least(rel, rest))
    wrapped = F.greatest(F.lit(0), F.least(rel + size - around, rest))
    return turns * size + direct + wrapped


def _portions(goals: DataFrame, granted: DataFrame, cap: int, seed: int) -> DataFrame:
    """``key, portions``: for every shard the stretch of the source's ring that is its own, how many tokens it takes there and from where on.

    Stretches are in proportion to the shards' quotas, so each is gone round about as
    often as the others, and at most ``cap`` times.
    """
    by_shard = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("key")
    g = granted.join(goals.select("key", "size", "target"), "key").withColumns({"upto": F.sum("blocks").over(by_shard), "all": F.sum("blocks").over(whole)})
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    end = lambda seats: F.floor(wide("size") * seats / F.greatest(F.col("all"), F.lit(1))).cast("long")
    g = g.withColumns({"lo": end(F.col("upto") - F.col("blocks")), "hi": end(F.col("upto"))}).withColumn("around", F.col("hi") - F.col("lo"))
    # The quota up to rounding; all together take exactly what is granted.
    take = lambda c: F.floor(wide("tokens") * F.col(c) / F.greatest(F.col("size"), F.lit(1))).cast("long")
    g = g.withColumn("tokens", F.when(F.col("target") >= cap * F.col("size"), cap * F.col("size")).otherwise(F.least(F.col("all") * F.col("block"), cap * F.col("size"))))
    length = take("hi") - take("lo")
    origin = (F.pmod(digest(F.lit(seed), F.col("key"), F.col("shard")), F.greatest(F.lit(1), F.ceil(F.col("around") / F.col("block")))) * F.col("block")).cast("long")
    return g.where("around > 0").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("shard", "lo", "hi", length.alias("length"), origin.alias("origin")))).alias("portions"))


def _mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 17, shards: int = 16, blocks_per_shard: int = 1 << 16) -> DataFrame:
    """``mix`` of rows whose columns do not begin with two underscores."""
    rows = _keyed(docs, seed)
    subs = rows.groupBy("__key", "__sub").agg(F.sum("__size").alias("words"))
    goals = targets(subs.groupBy(F.col("__key").alias("key")).agg(F.sum("words").alias("size")), weights, cap)
    portions = _portions(goals, quotas(goals, shards, blocks_per_shard), cap, seed)
    plan = goals.join(portions, "key", "left").select(F.col("key").alias("__key"), F.col("size").alias("__source_size"), F.col("target").alias("__target"), F.col("portions").alias("__portions"))
    before = Window.partitionBy("__key").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    plan = subs.select("__key", "__sub", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("__base")).join(plan, "__key")
    inside = Window.partitionBy("__key", "__sub").orderBy("__h", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__start", F.coalesce(F.sum("__size").over(inside), F.lit(0))).join(plan, ["__key", "__sub"])
    start = F.col("__base") + F.col("__start")
    end = start + F.col("__size")

    def of(p: Column) -> Column:
        first = F.greatest(start, p["lo"])
        return _covered(first - p["lo"], F.least(end, p["hi"]) - first, p["length"], p["origin"], p["hi"] - p["lo"]).cast("long")

    mine = F.filter("__portions", lambda p: (p["lo"] < end) & (p["hi"] > start))
    taken = F.when(F.col("__size") > 0, F.aggregate(mine, F.lit(0).cast("long"), lambda a, p: a + of(p)))
    shard = F.when(F.col("__size") > 0, F.try_element_at(mine, F.lit(1))["shard"])
    return placed.select(*docs.columns, "__size", "__source_size", "__target", F.coalesce(taken, F.lit(0).cast("long")).alias("__taken"), shard.alias("__shard"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``__size, __source_size, __target, __taken, __shard`` of every row.

    The words of a source stand on a ring in a seeded order of its documents,
    cut into equal blocks.  Every shard has a stretch of the ring, as long as its quota
    bids, and takes as many blocks there as its quota grants, from a seeded one on; going
    round takes the same words again, at
    most ``cap`` times.  ``__taken`` is what the shards take of the document, ``__shard``
    the first of those whose stretch it is in.

    Running positions are two-level: totals of 1,024 hash ranges of each source,
    then a window inside a range, so a source with a third of all rows is spread
    over 1,024 groups.  A null text has no words and takes none; a null source
    is a source of its own, last in order; ties of the seeded hash fall to
    doc_id, and equal rows are interchangeable; an empty table gives no row; other
    columns pass through; one that has a name of the result is an error.
    """
    added = ("__size", "__source_size", "__target", "__taken", "__shard")
    if clash := set(added) & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    return _mix(plain(docs, "doc_id", "text", "source"), **options).toDF(*docs.columns, *added)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as mixed, in its own columns: a row comes as often as its taken words fill its text, rounded.

    Documents without words take no part in the mix and stay once.
    """
    out = _mix(plain(docs, "doc_id", "text", "source"), **options)
    copies = F.when(F.col("__size") == 0, 1).otherwise(F.floor(F.col("__taken") / F.col("__size") + 0.5).cast("int"))
    out = out.withColumn("__copies", copies).where("__copies > 0")
    names = [c for c in out.columns if not c.startswith("__")]
    return out.select(*names, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__n")).drop("__n").toDF(*docs.columns)
