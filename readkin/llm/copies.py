"""Near copies by the exact overlap of their shingles: candidates of SimHash and MinHash, then every link verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, plain, scratch, utf8
from .simhash import linked, simhash

#: 20 bands of 5 minima: a pair with an overlap of 0.8 shares a band with probability 1 - (1 - 0.8**5)**20 = 0.9996.
BANDS, ROWS = 20, 5
_MIX = np.random.default_rng(23).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def _stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(words: list[bytes], n: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the different runs of ``n`` words; fewer words are one run."""
    seen: dict[bytes, int] = {}
    at = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    h = np.fromiter((xxhash.xxh64_intdigest(w, 3) for w in seen), np.uint64, len(seen))[at]
    n = min(n, len(words))
    out = np.zeros(max(1, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = out * _FOLD + h[k : k + len(out)]
    return np.unique(_stir(out))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of a set of hashes: equal where all minima of the band are."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(hashes), 4096):
        least = np.minimum(least, ((hashes[s : s + 4096, None] ^ _MIX[0]) * _MIX[1]).min(axis=0))
    out = np.arange(BANDS, dtype=np.uint64)
    for column in _stir(least).reshape(BANDS, ROWS).T:
        out = _stir(out * _FOLD + column)
    return out


class Sets:
    """Sets of hashes whose overlaps are counted, one with many at a time."""

    def __init__(self, texts: list[bytes]):
        sets = [shingles(t.lower().split()) for t in texts]
        self.size = np.fromiter(map(len, sets), np.int64, len(sets))
        values, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.end = np.cumsum(self.size)
        self.mark = np.zeros(len(values), bool)

    def of(self, i: int) -> np.ndarray:
        return self.flat[self.end[i] - self.size[i] : self.end[i]]

    def near(self, i: int, some: np.ndarray, flat: np.ndarray, overlap: float) -> np.ndarray:
        """Which of ``some`` (``flat`` are their members in a row) overlap with ``i`` enough."""
        self.mark[self.of(i)] = True
        size = self.size[some]
        common = np.add.reduceat(self.mark[flat], np.cumsum(size) - size, dtype=np.int64)
        self.mark[self.of(i)] = False
        return common >= overlap * (self.size[i] + size - common) - 1e-9


def _all_links(texts: list[bytes], overlap: float) -> list[tuple[int, int]]:
    """A spanning forest of all pairs that overlap enough: whoever is reached is compared with those who are not."""
    sets, out = Sets(texts), []
    left = np.arange(len(texts))
    flat = sets.flat
    while len(left) > 1:
        reached = [int(left[0])]
        flat, left = flat[sets.size[left[0]] :], left[1:]
        while reached and len(left):
            i = reached.pop()
            near = sets.near(i, left, flat, overlap)
            if near.any():
                new = left[near].tolist()
                out += [(i, j) for j in new]
                reached += new
                flat, left = flat[np.repeat(~near, sets.size[left])], left[~near]
    return out


def _cross_links(texts: list[bytes], home: np.ndarray, overlap: float) -> list[tuple[int, int]]:
    """Links that connect what the pairs of a home and another do."""
    sets, out = Sets(texts), []
    others = np.nonzero(~home)[0]
    flat = np.concatenate([sets.of(i) for i in others])
    label = np.arange(len(texts))
    for i in np.nonzero(home)[0].tolist():
        for j in others[sets.near(i, others, flat, overlap)].tolist():
            if label[i] != label[j]:
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def _digests(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, content, fp, bands`` of every row; ``content`` is equal for equal words, A-Z lower-cased."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            content, fp, keys = np.empty(n, np.uint64), np.empty(n, np.uint64), np.empty((n, BANDS), np.uint64)
            for k, text in enumerate(utf8(batch.column(2))):
                words = text.lower().split()
                content[k], fp[k], keys[k] = xxhash.xxh64_intdigest(b" ".join(words), 9), simhash(text), bands(shingles(words))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(content.view(np.int64)), pa.array(fp.view(np.int64)), lists], names=["doc_id", "text_hash", "content", "fp", "bands"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, f"doc_id {kind}, text_hash long, content long, fp long, bands array<long>")


def _overlapping(members: DataFrame, texts: DataFrame, overlap: float, tile: int) -> DataFrame:
    """Edges ``a, b`` that connect the nodes of each group of ``members(key, c, node)`` as all its pairs that overlap enough do.

    A group of over ``tile`` nodes is first compared block by block.  Then all
    of its nodes outside the component that is the largest in the group are
    compared with the whole group: what they cannot reach is not linked.
    """
    edge = "a long, b long"
    block = F.pmod(F.xxhash64("node", F.lit(5)), F.ceil(F.col("c") / tile))

    def edges(table: pa.Table, links: list[tuple[int, int]]) -> pa.Table:
        node = table.column("node").to_numpy()
        return pa.table({"a": pa.array([int(node[i]) for i, _ in links], pa.int64()), "b": pa.array([int(node[j]) for _, j in links], pa.int64())})

    def inside(table: pa.Table) -> pa.Table:
        return edges(table, _all_links(utf8(table.column("text").combine_chunks()), overlap) if table.num_rows > 1 else [])

    def across(table: pa.Table) -> pa.Table:
        home = table.column("home").to_numpy()
        return edges(table, _cross_links(utf8(table.column("text").combine_chunks()), home, overlap) if 0 < home.sum() < len(home) else [])

    first = scratch(members.withColumn("block", block).join(texts, "node").select("key", "block", "node", "text").groupBy("key", "block").applyInArrow(inside, edge), "inside")
    large = members.where(F.col("c") > tile)
    if large.isEmpty():
        return first
    roots = connected_components(first).select("node", "root")
    large = scratch(large.withColumn("block", block).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "large")
    most = large.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("most"))
    rest = large.join(most, "key").where("root <> most")
    chunks = rest.groupBy("key").agg(F.ceil(F.count("*") / tile).alias("chunks"))
    chunk = F.pmod(F.xxhash64("node", F.lit(6)), F.col("chunks"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    homes = rest.join(chunks, "key").select("key", chunk.alias("i"), upto(F.ceil(F.col("c") / tile)).alias("j"), "node", F.lit(True).alias("home"))
    asks = large.join(chunks, "key").select("key", upto(F.col("chunks")).alias("i"), F.col("block").alias("j"), "node", F.lit(False).alias("home"))
    return first.union(homes.union(asks).join(texts, "node").groupBy("key", "i", "j").applyInArrow(across, edge))


def components(docs: DataFrame, overlap: float = 0.8, radius: int = 3, tile: int = 2048) -> DataFrame:
    """``doc_id, text_hash, root``, a row for each row of ``docs(doc_id, text)``; near copies have one root.

    Texts link if at least ``overlap`` of the five-word shingles of both are shared
    (A-Z lower-cased; the exact Jaccard index of their sets).  Pairs are looked for
    in the components of fingerprints within ``radius`` bits and among the texts
    that share a MinHash band; groups of the same texts are looked through once.
    """
    base = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    table = scratch(_digests(base), "digests")
    points = table.groupBy("content").agg(F.min(F.struct(F.col("text_hash").alias("node"), "doc_id", "fp", "bands")).alias("p"))
    points = scratch(points.select("content", "p.*"), "points")
    alike = connected_components(linked(points.select("fp").distinct(), radius)).select(F.col("node").alias("fp"), "root")
    keyed = scratch(points.join(alike, "fp", "left").select("node", F.array_append("bands", F.xxhash64(F.coalesce("root", "fp"), F.lit(1))).alias("keys")), "keys")
    entries = keyed.select("node", F.explode("keys").alias("key"))
    groups = entries.groupBy("key").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("s")).where("c > 1")
    members = scratch(entries.join(groups.groupBy("c", "s").agg(F.min("key").alias("key")), "key").select("key", "c", "node"), "members")
    asked = points.join(members.select("node").distinct(), "node", "left_semi").select(F.xxhash64("doc_id", "node").alias("row"))
    found = base.select(F.xxhash64("doc_id", "text_hash").alias("row"), F.col("text_hash").alias("node"), F.coalesce("text", F.lit("")).alias("text")).join(asked, "row", "left_semi")
    texts = scratch(found.dropDuplicates(["row"]).select("node", "text"), "texts")
    roots = connected_components(_overlapping(members, texts, overlap, tile)).select("node", "root")
    named = scratch(points.join(roots, "node", "left").select("content", F.coalesce("root", "node").alias("root")), "rooted")
    return table.join(named, "content").select("doc_id", "text_hash", "root")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near copies: of each of the ``components`` stays one row, that of the least (doc_id, text).

    All columns are kept as they are; equal rows count as copies of each other;
    a null doc_id comes before all others.
    """
    first = components(docs, **options).groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("w"))
    keep = scratch(first.select(F.xxhash64("w.doc_id", "w.text_hash").alias("__row")), "keep")
    # One key for the join and for equal rows, so that texts are shuffled once.
    marked = plain(docs, "doc_id", "text").withColumn("__row", F.xxhash64("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))))
    return marked.join(keep, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row").toDF(*docs.columns)
