"""Helpers shared by the operators: scratch tables, text access, components."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.store import discard, scratch  # noqa: F401  (the operators take them from here)

#: The word pattern of the digests: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def utf8(column: pa.Array, lower: bool = False) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes, null as empty; ``lower`` folds all letters, a final sigma to the other."""
    if lower:
        column = pc.replace_substring(pc.utf8_lower(column), "ς", "σ")
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def plain(df: DataFrame, *keep: str) -> DataFrame:
    """``df`` with its columns named by position (``_c0``, ..) but for those of ``keep``, so that added names clash with none; ``toDF`` turns it back."""
    return df.toDF(*[c if c in keep else f"_c{i}" for i, c in enumerate(df.columns)])


def widened(df: DataFrame, more: str) -> StructType:
    """The schema of ``df`` with the columns of the DDL text ``more`` behind its own."""
    added = StructType.fromDDL(more)
    if clash := {f.name.lower() for f in added} & {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    return StructType([*df.schema.fields, *added.fields])


def mapped(df: DataFrame, run, more: str = "") -> DataFrame:
    """``df.mapInArrow(run)`` whose result has the columns of ``df`` and then those of ``more``; columns may have any names.

    Batches name the columns of ``df`` by position (``c0``, ``c1``, ..).
    """
    schema = widened(df, more) if more else df.schema
    plain = [f"c{i}" for i in range(len(df.columns))]
    fields = [StructField(plain[i] if i < len(plain) else f.name, f.dataType) for i, f in enumerate(schema.fields)]
    return df.toDF(*plain).mapInArrow(run, StructType(fields)).toDF(*schema.names)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def digest(*parts: Column) -> Column:
    """A number of 60 bits from the MD5 of the parts, joined by ``|`` without nulls: an order that any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary")), 1, 15), 16, 10).cast("long")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star rounds.

    ``edges(a long, b long)`` may hold loops and repeats.  Returns
    ``(node, root)`` for every node with an edge to another one; ``root`` is the
    smallest node of the component.  A round is a map-side-combined minimum per
    node and one equi-join, so no neighbourhood is gathered in a task, and each
    round is a written table, so its lineage is one scan long.
    """

    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
        else:
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = e.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = e.join(low, e.a == low.n)
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = scratch(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        now = scratch(stars(stars(now, True), False), "edges")
        after = mark(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
