"""URL filters: dated list entries as validity intervals, joined as of each capture's fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch

#: Kinds of entries, the more specific later.
KINDS = ("domain", "host", "prefix")

_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-cased host of an absolute URL, without user, port and a dot at the end; '' if there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.+$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of an absolute URL with single slashes and none at the end."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(F.regexp_extract(url, _PATH, 1), "/+", "/"), "/$", ""), F.lit(""))


def _seed(kind: int) -> Column:
    """What the hashes of a kind of entries begin with."""
    return F.lit(kind).cast("long")


def _running(first: Column, parts: Column) -> Column:
    """Hashes of ``first`` and of every beginning of ``parts`` after it, each made from the one before."""
    return F.aggregate(parts, F.array(first), lambda done, part: F.array_append(done, F.xxhash64(part, F.element_at(done, -1))))


def keys_of(host: Column, path: Column, labels: int, parts: int) -> Column:
    """``array<struct<kind, key>>``: hashes of all entries that could match: domains of up to ``labels`` labels, the host, prefixes of up to ``parts`` parts."""
    key = lambda kind, hashes: F.transform(hashes, lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("key")))
    domains = F.slice(_running(_seed(1), F.slice(F.reverse(F.split(host, r"\.")), 1, labels)), 2, labels + 1)
    prefixes = F.slice(_running(F.xxhash64(host, _seed(3)), F.slice(F.split(F.substring(path, 2, 1 << 30), "/"), 1, parts)), 2, parts + 1)
    none = F.array().cast("array<struct<kind:string,key:bigint>>")
    return F.when(host == "", none).otherwise(F.concat(key("domain", domains), key("host", F.array(F.xxhash64(host, _seed(2)))), F.when(path == "", none).otherwise(key("prefix", prefixes))))


def _keyed(held: DataFrame) -> DataFrame:
    """Entries with ``key``, their hash as in ``keys_of``, and ``depth``, their labels or parts (null for a host)."""
    labels, parts = F.split("pattern", r"\."), F.split("pattern", "/")
    domain, prefix = F.col("kind") == "domain", F.col("kind") == "prefix"
    rest = F.slice(parts, 2, 1 << 30)
    key = F.when(domain, F.element_at(_running(_seed(1), F.reverse(labels)), -1)).when(prefix, F.element_at(_running(F.xxhash64(parts[0], _seed(3)), rest), -1))
    return held.withColumn("key", F.coalesce(key, F.xxhash64("pattern", _seed(2)))).withColumn("depth", F.when(domain, F.size(labels)).when(prefix, F.size(rest)))


def _fits(url: Column) -> Column:
    """Whether the entry (``kind``, ``pattern``) is one of the URL's: equal hashes are looked through once more."""
    host, path, pattern = host_of(url), path_of(url), F.col("pattern")
    domain = (host == pattern) | F.endswith(host, F.concat(F.lit("."), pattern))
    prefix = (F.length(pattern) > F.length(host)) & F.startswith(F.concat(host, path, F.lit("/")), F.concat(pattern, F.lit("/")))
    return F.when(F.col("kind") == "domain", domain).when(F.col("kind") == "prefix", prefix).otherwise(host == pattern)


def intervals(events: DataFrame) -> DataFrame:
    """``list, verdict, kind, pattern, valid_from, valid_to`` from ``events(list, verdict, kind, pattern, action, at)``.

    An ``add`` holds from its time up to the entry's next event, without end if
    there is none; a ``remove`` ends it.  Of events of an entry at one time a
    removal comes last.  Windows are per entry of a list, not per host.
    """
    after = Window.partitionBy("list", "kind", "pattern").orderBy("at", F.col("action") == "remove", "verdict")
    held = events.where("at is not null and pattern is not null").distinct().withColumn("valid_to", F.lead("at").over(after))
    return held.where((F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at")))).select("list", "verdict", "kind", "pattern", F.col("at").alias("valid_from"), "valid_to")


def _salted(keyed: DataFrame, held: DataFrame, hot: int, broadcast_rows: int) -> tuple[DataFrame, DataFrame]:
    """``keyed`` and the entries ``held`` with a further column ``part``: keys of over ``hot`` captures are dealt to parts of about that many.

    The entries of such a key are repeated for every part; captures whose crowded key has no
    entry (``com``, say) are left out here, before they are shuffled.  Keys are counted with
    partial sums.
    """
    by = ["kind", "key"]
    many = keyed.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > hot)
    listed = held.select(*by).distinct().withColumn("listed", F.lit(True))
    crowded = scratch(many.join(listed, by, "left").select(*by, F.when(F.col("listed"), F.ceil(F.col("n") / hot)).otherwise(0).cast("int").alias("parts")), "crowded")
    n = crowded.count()
    if not n:
        return keyed.withColumn("part", F.lit(0)), held.withColumn("part", F.lit(0))
    some = F.broadcast(crowded) if n <= broadcast_rows else crowded  # a plan's choice only
    parts = F.coalesce("parts", F.lit(1))
    keyed = keyed.join(some, by, "left").where(parts > 0).withColumn("part", F.pmod(F.xxhash64("u", "t"), parts).cast("int"))
    held = held.join(some, by, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return keyed.drop("parts"), held.drop("parts")


def judge(captures: DataFrame, events: DataFrame, url: str = "url", at: str = "fetched_at", hot: int = 1_000_000, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``captures`` with ``verdict, list, kind, pattern, valid_from`` of the entry that decides at its fetch time.

    Of the entries in force the most specific decides: a prefix before a host
    before a domain, then the longer pattern, then ``allow`` before ``block``, then
    the list's name.  Without one the verdict is ``none`` and the rest is null.

    The join works on different (url, time) pairs with an equi-join on a hash of the entry's
    pattern; the interval and the pattern itself are further conditions.  A URL has a row for
    each of its domains and prefixes that are no deeper than the deepest entry (one small job
    over the entries finds that), however many parts it has; keys of over ``hot`` captures are
    dealt to parts, or dropped where no entry has them, before the shuffle.  A null or relative URL
    and a null time match nothing; repeated captures are judged alike; an
    empty list judges all ``none``; an empty table gives no row; other columns pass
    through, unless they have the names of the result, which is an error.
    """
    added = ("verdict", "list", "kind", "pattern", "valid_from")
    if clash := set(added) & {c.lower() for c in captures.columns}:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    asked = captures.select(F.col(f"`{url}`").alias("u"), F.col(f"`{at}`").alias("t")).where("u is not null and t is not null").distinct()
    entries = scratch(_keyed(intervals(events)), "entries")
    deepest = entries.agg(*[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("depth"))), F.lit(0)).alias(k) for k in ("domain", "prefix")]).first()
    keys = keys_of(host_of(F.col("u")), path_of(F.col("u")), deepest["domain"], deepest["prefix"])
    keyed = asked.select("u", "t", F.explode(keys).alias("k")).select("u", "t", "k.kind", "k.key")
    keyed, held = _salted(keyed, entries.drop("depth"), hot, broadcast_rows)
    in_force = (F.col("t") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to")))
    hits = keyed.join(held, ["kind", "key", "part"]).where(in_force & _fits(F.col("u")))
    rank = F.struct((F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))).alias("rank"), F.length("pattern").alias("size"), (F.col("verdict") == "allow").alias("allow"), *[F.col(c) for c in ("list", "verdict", "kind", "pattern", "valid_from")])
    best = hits.groupBy("u", "t").agg(F.max(rank).alias("best"))
    out = captures.join(best, (F.col(f"`{url}`") == F.col("u")) & (F.col(f"`{at}`") == F.col("t")), "left")
    return out.select(*[F.col(f"`{c}`") for c in captures.columns], F.coalesce("best.verdict", F.lit("none")).alias("verdict"), *[F.col(f"best.{c}").alias(c) for c in added[1:]])
