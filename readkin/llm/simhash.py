"""Near-duplicate documents: SimHash fingerprints linked through vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, mapped, plain, scratch, utf8

_LANES = np.uint64(0x0101010101010101)


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit fingerprint of a text: bit i is 1 if over half of the shingle hashes have it.

    Shingles are ``shingle`` successive words (A-Z lower-cased, joined by a
    space, repeats counted); a text of fewer words is one shingle, a text
    without words has fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    h = np.fromiter((digest(flat[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())), np.uint64, n)
    # Eight byte lanes are added at once; 255 rows cannot overflow a lane.
    h = np.concatenate((h, np.zeros(-n % 255, np.uint64)))
    counts = np.empty(64, np.int64)
    for k in range(8):
        lanes = ((h >> np.uint64(k)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[k::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text as a signed long in ``column``."""

    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((simhash(t) for t in utf8(batch.column(at))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))], names=[*batch.schema.names, column])

    return mapped(docs, run, f"{column} long")


class VantageTree:
    """A vantage-point tree over one half of the fingerprints.

    Two fingerprints at most ``radius`` bits apart have a half in which they
    differ by at most ``radius // 2`` bits, so a tree per half, searched with that
    smaller radius, finds every pair; the triangle bound then sends only points
    within ``radius // 2`` of a ball's surface to both sides.
    """

    def __init__(self, sample: np.ndarray, shift: int, radius: int, depth: int, seed: int = 7):
        self.shift, self.radius = shift, radius
        self.nodes: list[tuple] = []
        self.leaves = 0
        self._rng = np.random.default_rng(seed)
        self._grow(np.unique(self.half(sample)), depth)

    def half(self, fp: np.ndarray) -> np.ndarray:
        return ((fp >> np.uint64(self.shift)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def _grow(self, points: np.ndarray, depth: int) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        best = None
        if depth and len(points) >= 8:
            for v in self._rng.choice(points, min(24, len(points)), replace=False):
                n = np.bincount(np.bitwise_count(points ^ v), minlength=34)
                inside = np.cumsum(n)
                for mu in range(0, 32):
                    low = min(inside[mu], len(points) - inside[mu])
                    both = n[max(0, mu - self.radius + 1) : mu + self.radius + 1].sum()
                    if low * 4 >= len(points) and (best is None or low - both > best[0]):
                        best = (low - both, v, mu)
        if best is None:
            self.nodes[me] = (None, self.leaves, 0, 0)
            self.leaves += 1
            return me
        _, v, mu = best
        inside = np.bitwise_count(points ^ v) <= mu
        left, right = self._grow(points[inside], depth - 1), self._grow(points[~inside], depth - 1)
        self.nodes[me] = (v, mu, left, right)
        return me

    def route(self, fp: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each leaf: its number, the points that live there, the points that only visit it."""
        half = self.half(fp)
        stack = [(0, np.arange(len(fp)), np.empty(0, np.int64))]
        while stack:
            node, home, guest = stack.pop()
            v, mu, left, right = self.nodes[node]
            if v is None:
                yield mu, home, guest
                continue
            dh, dg = np.bitwise_count(half[home] ^ v).astype(np.int16), np.bitwise_count(half[guest] ^ v).astype(np.int16)
            r = self.radius
            for child, mine, near, gnear in (
                (left, dh <= mu, (dh > mu) & (dh <= mu + r), dg <= mu + r),
                (right, dh > mu, (dh <= mu) & (dh > mu - r), dg > mu - r),
            ):
                h, g = home[mine], np.concatenate((home[near], guest[gnear]))
                if len(h) or len(g):
                    stack.append((child, h, g))


def _link(homes: np.ndarray, asks: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``asks`` and ``homes``."""
    points, at = np.unique(np.concatenate((homes, asks)), return_inverse=True)
    ah, aq = at[: len(homes)], at[len(homes) :]
    parent = np.arange(len(points))
    step = max(1, (1 << 20) // max(1, len(homes)))
    for s in range(0, len(asks), step):
        near = np.bitwise_count(asks[s : s + step, None] ^ homes[None, :]) <= radius
        q, h = np.nonzero(near)
        pairs = np.stack((parent[aq[s : s + step][q]], parent[ah[h]]))
        pairs = pairs[:, pairs[0] != pairs[1]]
        if not pairs.shape[1]:
            continue
        for a, b in np.unique(pairs, axis=1).T.tolist():
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    child = np.nonzero(parent != np.arange(len(points)))[0]
    return list(zip(points[child].view(np.int64).tolist(), points[parent[child]].view(np.int64).tolist()))


def linked(points: DataFrame, radius: int = 3, leaf_size: int = 512, max_depth: int = 16, tile: int = 8192, sample: int = 16384) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints ``fp`` linked by chains of pairs within ``radius`` bits.

    ``points(fp long)`` holds distinct fingerprints.  Two vantage-point trees of
    at most ``2**max_depth`` leaves are fitted on about ``sample`` points, or four a
    leaf if that is more, and sent
    to the tasks (their size is bounded by these parameters); every point is
    then stored in one leaf of each tree and visits the leaves its ball overlaps.
    A leaf with more than ``tile`` points or visitors is compared in a grid of
    blocks, so no task holds more than two tiles.  A block returns a spanning
    forest of its links, never all pairs.
    """
    n = points.count()
    if n < 2:
        return points.sparkSession.createDataFrame([], "a long, b long")
    depth = int(np.clip(np.ceil(np.log2(n / leaf_size)), 0, max_depth))
    picked = points.where(F.pmod(F.xxhash64("fp", F.lit(11)), F.lit(n)) < max(sample, 4 << depth)).collect()
    some = np.array([r.fp for r in picked], np.int64).view(np.uint64)
    trees = [VantageTree(some, shift, radius // 2, depth) for shift in (0, 32)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            fp = np.concatenate(held).view(np.uint64)
            for k, tree in enumerate(trees):
                for leaf, home, guest in tree.route(fp):
                    if len(home) + len(guest):
                        who = fp[np.concatenate((home, guest))].view(np.int64)
                        yield pa.RecordBatch.from_pydict({"leaf": pa.array(np.full(len(who), 2 * leaf + k, np.int32)), "fp": pa.array(who), "home": pa.array(np.arange(len(who)) < len(home))})

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= 200_000:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def compare(table: pa.Table) -> pa.Table:
        fp, home = table.column("fp").to_numpy().view(np.uint64), table.column("home").to_numpy()
        out = _link(fp[home], fp[~home], radius)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    routed = scratch(points.select("fp").mapInArrow(route, "leaf int, fp long, home boolean"), "routed")
    sizes = routed.groupBy("leaf").agg(F.ceil(F.sum(F.col("home").cast("long")) / tile).alias("th"), F.ceil(F.count("*") / tile).alias("tq"))
    # One row a leaf of a tree: at most 2 * 2**max_depth rows.
    rows = routed.join(F.broadcast(sizes), "leaf").where("th > 0")
    hash_ = F.xxhash64("fp", F.lit(5))
    asks = rows.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("th") - 1)).alias("i"), F.pmod(hash_, "tq").alias("j"), "fp", F.lit(False).alias("home"))
    homes = rows.where("home").select("leaf", F.pmod(hash_, "th").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tq") - 1)).alias("j"), "fp", "home")
    return asks.union(homes).groupBy("leaf", "i", "j").applyInArrow(compare, "a long, b long")


def components(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fingerprint, component_id)``, one row for each row of ``docs(doc_id, text)``.

    Fingerprints at most ``radius`` bits apart are linked; ``component_id`` is the
    smallest doc_id reachable over links (null only if the component has no
    doc_id but null).  A null text counts as empty, and texts without words share
    fingerprint zero, which links like any other.  Repeated rows are returned as
    often as they come; an empty table gives no row.
    """
    base = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    table = scratch(fingerprints(base).drop("text"), "fingerprints")
    points = scratch(table.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least_id")), "points")
    roots = connected_components(linked(points.select("fp"), radius))
    rooted = scratch(points.join(roots, points.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return table.join(named, table.fingerprint == named.fp).select("doc_id", "text_hash", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``docs`` without near copies: of each component stays one row, that of the least (doc_id, text).

    All columns are kept as they are; equal rows count as copies of each other;
    a null doc_id comes before all others.
    """
    found = scratch(components(docs, radius), "components")
    first = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("g")).agg(F.min(F.struct("doc_id", "text_hash")).alias("w"))
    keep = first.select(F.col("w.doc_id").alias("__keep_id"), F.col("w.text_hash").alias("__keep_hash")).distinct()
    marked = plain(docs, "doc_id", "text").withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    held = marked.join(keep, F.col("doc_id").eqNullSafe(F.col("__keep_id")) & (F.col("__hash") == F.col("__keep_hash")), "left_semi")
    return held.dropDuplicates(["doc_id", "__hash"]).drop("__hash").toDF(*docs.columns)
