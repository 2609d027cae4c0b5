"""Maximal repetitions of words, found by comparing bit planes of word ids with themselves, shifted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, utf8


def _planes(values: np.ndarray, bits: int, stride: int) -> int:
    """One integer of ``bits`` planes, ``stride`` bits each (a multiple of 8): bit i of plane b is bit b of value i."""
    flat = np.zeros((bits, stride), np.uint8)
    for b in range(bits):
        flat[b, : len(values)] = values >> b & 1
    return int.from_bytes(np.packbits(flat, axis=1, bitorder="little").tobytes(), "little")


def _equal(a: int, b: int, planes: int, stride: int, upto: int) -> int:
    """Bit i is 1 where all planes of ``a`` and ``b`` agree at i; ``planes`` is a power of two."""
    x = a ^ b
    while planes > 1:  # or the upper half of the planes onto the lower
        planes //= 2
        x |= x >> planes * stride
    return ~x & (1 << upto) - 1


def _stretches(z: int, length: int) -> int:
    """Bit i stays 1 if the ``length`` bits from i on are all 1."""
    have = 1
    while have < length and z:
        step = min(have, length - have)
        z &= z >> step
        have += step
    return z


class _Level:
    """Samples of 8-bit hashes of word ids, each ``step``-th position, as planes for every remainder."""

    def __init__(self, hashes: np.ndarray, step: int):
        self.step, n = step, len(hashes)
        self.stride = (-(-n // step) + 7) // 8 * 8
        padded = np.zeros(self.stride * step, np.uint8)
        padded[:n] = hashes
        bits = np.unpackbits(padded[:, None], axis=1, bitorder="little").reshape(self.stride, step, 8)
        packed = np.packbits(bits.transpose(1, 2, 0), axis=2, bitorder="little")
        self.of = [int.from_bytes(row.tobytes(), "little") for row in packed]

    def equal(self, lag: int, upto: int) -> int:
        return _equal(self.of[0], self.of[lag % self.step] >> lag // self.step, 8, self.stride, upto)


def find_runs(ids: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs by start, then period.

    A run is a stretch with smallest period q, of at least ``max(least, times * q)``
    words, that no neighbour extends; ``times`` is 3 or more, so by the theorem of Fine and Wilf a
    stretch with periods p and q has their greatest common divisor as one too.

    For a lag q, the planes of the ids are XORed with themselves shifted by q and ORed
    into mismatches; a run shows as ``max(least - q, (times - 1) * q)`` zeros in a
    row.  Before whole planes are compared, a lag is tried on every s-th
    position, s an eighth or less of that length: as many zeros in a row hold several samples, so lags
    that fail there have no run.  That makes a text without repetitions cost O(n log n) bits.
    """
    n, found, known = len(ids), [], set()
    bits = 1
    while 1 << bits < int(ids.max(initial=0)) + 1:
        bits *= 2
    stride, planes = (n + 7) // 8 * 8, None
    hashes = (ids.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
    level, of_period = None, {}
    for q in range(1, n // times + 1):
        need = max(least - q, (times - 1) * q)
        if need + q > n:
            continue
        step = 1 << max(0, (need // 8).bit_length() - 1)
        if level is None or level.step != step:
            level = _Level(hashes, step)
        in_row = need // step
        maybe = _stretches(level.equal(q, -(-(n - q) // step)), in_row)
        if not maybe:
            continue
        # Inside a run whose period divides q, equal words at lag q say nothing new.
        for p, runs in of_period.items():
            for start, length in runs if q % p == 0 else ():
                low, high = -(-start // step), -(-(start + length - q) // step) - 1
                if low <= high:
                    low = max(0, low - in_row + 1)
                    maybe &= ~((1 << high - low + 1) - 1 << low)
        if not maybe:
            continue
        if planes is None:
            planes = _planes(ids, bits, stride)
        zeros = _stretches(_equal(planes, planes >> q, bits, stride, n - q), need)
        edges = np.diff(np.unpackbits(np.frombuffer(zeros.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little").astype(np.int8), prepend=0, append=0)
        for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            run = (a, b - a - 1 + need + q)
            if run not in known:  # else a smaller period of the same stretch was found before
                known.add(run)
                of_period.setdefault(q, []).append(run)
                found.append((*run, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs(docs: DataFrame, text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed`` for every whole text.

    ``runs`` is ``array<struct<start, length, period>>``, words numbered from 0;
    ``collapsed`` is the text with only the first period of each run, its words joined by
    one space.  A word is dropped if any run holds it behind the run's first period.

    Null and empty texts have no words, no runs and an empty collapsed text; repeated
    rows are judged one by one, an empty table gives no row, other columns are
    kept, but a column named like an added one is an error.  Memory is a batch of texts and, for
    one text of n words, a few n-bit integers a plane.
    """
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            sizes, lists, texts = [], [], []
            for t in utf8(batch.column(at)):
                words, number = t.split(), {}
                ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
                got = find_runs(ids, least, times)
                if got:
                    keep = np.ones(len(words), bool)
                    for start, length, period in got:
                        keep[start + period : start + length] = False
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                sizes.append(len(ids))
                lists.append([{"start": a, "length": n, "period": q} for a, n, q in got])
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(lists, kind), pa.array(texts, pa.string())], names=[*batch.schema.names, "n_words", "runs", "collapsed"])

    return mapped(docs, run, "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
