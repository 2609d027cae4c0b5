"""Adapters cut off reads with errors: bit-parallel edit distance over a whole batch of reads."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import appended

_ONE, _ALL, _TOP = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(63)


def masks(adapter: str) -> np.ndarray:
    """For every byte, at which places of the adapter it fits: rows of 64-place words; N fits all, and all fit an N."""
    words = -(-len(adapter) // 64)
    fits = np.zeros((256, words * 64), bool)
    for i, c in enumerate(adapter.encode()):
        fits[c, i] = True
        if c == ord("N"):
            fits[:, i] = True
    fits[ord("N"), : len(adapter)] = True
    return np.packbits(fits, axis=1, bitorder="little").view(np.uint64)


def distances(reads: np.ndarray, sizes: np.ndarray, adapter: str) -> tuple[np.ndarray, np.ndarray]:
    """Edit distances of the adapter to what ends at each place of the reads, and of its beginnings to what ends at a read's end.

    The first is ``(reads, places + 1)``, the second ``(reads, adapter + 1)``; each is the least
    over all places where the stretch may begin.  A column of the table of edit distances is held as two bits a
    letter of the adapter, whether the distance grows or falls there, and is moved on by one letter of
    all reads with a few operations on words of 64 bits.
    """
    count, m = len(reads), len(adapter)
    peq = masks(adapter)
    words = peq.shape[1]
    up = [np.full(count, _ALL) for _ in range(words)]
    down = [np.zeros(count, np.uint64) for _ in range(words)]
    whole = np.full((count, reads.shape[1] + 1), m, np.int32)
    last = np.zeros((count, m + 1), np.int32)
    score = np.full(count, m, np.int32)
    end = np.uint64((m - 1) % 64)

    def keep(at: int) -> None:
        which = np.flatnonzero(sizes == at)
        if len(which):
            deltas = [np.unpackbits(np.stack([x[which] for x in side], axis=1).view(np.uint8), axis=1, bitorder="little")[:, :m].astype(np.int32) for side in (up, down)]
            last[which, 1:] = np.cumsum(deltas[0] - deltas[1], axis=1)

    keep(0)
    for j in range(1, reads.shape[1] + 1):
        grows = np.zeros(count, np.uint64)  # of the row above: no cost to begin anywhere
        falls = np.zeros(count, np.uint64)
        for w in range(words):
            eq = peq[reads[:, j - 1], w]
            p, n = up[w], down[w]
            sure = eq | n
            eq = eq | falls
            same = (((eq & p) + p) ^ p) | eq
            plus, minus = n | ~(same | p), p & same
            if w == words - 1:
                score = score + (plus >> end & _ONE).astype(np.int32) - (minus >> end & _ONE).astype(np.int32)
            out_grows, out_falls = plus >> _TOP, minus >> _TOP
            plus, minus = plus << _ONE | grows, minus << _ONE | falls
            up[w], down[w] = minus | ~(sure | plus), plus & sure
            grows, falls = out_grows, out_falls
        whole[:, j] = score
        keep(j)
    return whole, last


def _begin(texts: list[str], ends: np.ndarray, patterns: list[str], errors: np.ndarray) -> np.ndarray:
    """Where the stretches that end at ``ends`` begin: of those at the given distance the length nearest to the pattern's, of two the longer.

    Bands of edit distances of all rows at once, from the ends backwards.
    """
    out = ends - np.array([len(p) for p in patterns])
    rows = np.flatnonzero(errors > 0)
    if not len(rows):
        return out
    e = int(errors[rows].max())
    longest = max(len(patterns[k]) for k in rows)
    width, far = 2 * e + 1, 1 << 20
    p = np.zeros((len(rows), longest), np.uint8)
    t = np.zeros((len(rows), longest + 2 * e + 1), np.uint8)
    for r, k in enumerate(rows):
        x, y = patterns[k][::-1].encode(), texts[k][: ends[k]][::-1].encode()[: t.shape[1]]
        p[r, : len(x)], t[r, : len(y)] = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    sizes, ends_, wild = np.array([len(patterns[k]) for k in rows]), ends[rows], ord("N")
    shift = np.arange(-e, e + 1)
    d = np.where(shift >= 0, shift, far)[None, :].repeat(len(rows), 0)
    d = np.where(shift[None, :] > ends_[:, None], far, d)
    final = d.copy()
    for i in range(1, longest + 1):
        at = i + shift  # letters of the text used
        ok = (at[None, :] >= 0) & (at[None, :] <= ends_[:, None])
        letter = np.where(at[None, :] >= 1, t[:, np.clip(at - 1, 0, t.shape[1] - 1)], 0)
        fit = (letter == p[:, i - 1, None]) | (letter == wild) | (p[:, i - 1, None] == wild)
        now = np.where(at[None, :] >= 1, d + ~fit, far)
        now[:, :-1] = np.minimum(now[:, :-1], d[:, 1:] + 1)  # a letter of the pattern alone
        now = np.where(ok, now, far)
        for k in range(1, width):  # letters of the text alone
            now[:, k] = np.where(ok[:, k], np.minimum(now[:, k], now[:, k - 1] + 1), far)
        d = now
        final[sizes == i] = d[sizes == i]
    order = np.argsort(np.abs(shift) * 2 - (shift > 0), kind="stable")  # 0, +1, -1, +2, ..
    hit = (final == errors[rows, None])[:, order]
    out[rows] = ends_ - (sizes + shift[order[hit.argmax(axis=1)]])
    return out


def find(seqs: list[str], adapters: list[str], rate: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the best adapter in each read, -1 where there is none.

    An adapter may stand whole in the read, with its beginning at the read's end or
    with its end at the read's beginning, ``least`` letters of it or more, and with at most ``rate`` errors
    a letter used.  Best is most letters less errors, then fewest errors, the first
    adapter, and the stretch that ends first.
    """
    count = len(seqs)
    sizes = np.array([len(s) for s in seqs])
    width = int(sizes.max(initial=0))
    start, stop = np.full(count, -1), np.full(count, -1)
    flat = lambda turn: np.frombuffer(b"".join(s[::turn].encode("ascii", "replace").ljust(width, b"\0") for s in seqs), np.uint8).reshape(count, width)
    forward, backward = flat(1), flat(-1)
    best = np.full((count, 4), -(1 << 20))  # letters less errors, -errors, -adapter, -stop
    for a, adapter in enumerate(adapters):
        m = len(adapter)
        allowed = np.floor(rate * np.arange(m + 1) + 1e-9).astype(np.int64)
        used = np.arange(m + 1)
        whole, beginning = distances(forward, sizes, adapter)
        _, ending = distances(backward, sizes, adapter[::-1])
        whole = np.where(np.arange(width + 1)[None, :] <= sizes[:, None], whole, m + 1)
        tries = []  # letters used, errors, stop (or -1: told from the start)
        at = whole.argmin(axis=1)
        tries.append((np.full(count, m), whole[np.arange(count), at], at))
        for part, ends in ((beginning, sizes), (ending, np.full(count, -1))):
            value = np.where((part <= allowed[None, :]) & (used >= least)[None, :] & (used < m)[None, :], (used[None, :] - part) * (m + 1) - part, -(1 << 20))
            n = value.argmax(axis=1)
            tries.append((n, np.where(value[np.arange(count), n] > -(1 << 20), part[np.arange(count), n], m + 1), ends))
        for kind, (n, errors, ends) in enumerate(tries):
            rows = np.flatnonzero((errors <= allowed[n]) & (n >= least) & (sizes > 0))
            if not len(rows):
                continue
            texts, n, errors = [seqs[k] for k in rows], n[rows], errors[rows]
            if kind == 2:  # the end of the adapter from the read's first letter on
                turned = _begin([t[::-1] for t in texts], sizes[rows], [adapter[m - x :][::-1] for x in n], errors)
                s, e = np.zeros(len(rows), np.int64), sizes[rows] - turned
            else:
                e = ends[rows]
                s = _begin(texts, e, [adapter[:x] for x in n], errors)
            value = np.stack((n - errors, -errors, np.full(len(rows), -a), -e), axis=1)
            old = best[rows]
            differ = value != old
            first = differ.argmax(axis=1)
            better = differ.any(axis=1) & (value[np.arange(len(rows)), first] > old[np.arange(len(rows)), first])
            best[rows[better]], start[rows[better]], stop[rows[better]] = value[better], s[better], e[better]
    return start, stop


def kept(seqs: list[str], adapters: list[str], times: int, rate: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """What stays of each read: a match at its start goes, any other goes with all behind it, ``times`` times."""
    left, right = np.zeros(len(seqs), np.int64), np.array([len(s) for s in seqs], np.int64)
    live = np.flatnonzero(right > 0)
    for _ in range(times):
        if not len(live):
            break
        start, stop = find([seqs[k][left[k] : right[k]] for k in live], adapters, rate, least)
        found = start >= 0
        live, start, stop = live[found], start[found], stop[found]
        front = start == 0
        base = left[live]
        left[live] = np.where(front, base + stop, base)
        right[live] = np.where(front, right[live], base + start)
        live = live[right[live] > left[live]]
    return left, right


def trim_adapters(reads: DataFrame, adapters: list[str], times: int = 2, rate: float = 0.1, least: int = 3) -> DataFrame:
    """``reads(seq, qual, ..)`` without adapters, which may have substituted, inserted and missing letters (``find``).

    N in an adapter or a read fits any letter.  Equal reads of a batch are looked at once; nothing is
    shuffled.  A null sequence stays null.
    """
    if any(not a for a in adapters):
        raise ValueError("an adapter is empty")

    def cut(seqs: list) -> tuple:
        texts = [s or "" for s in seqs]
        distinct = {t: k for k, t in enumerate(sorted(set(texts)))}
        left, right = kept(list(distinct), adapters, times, rate, least)
        at = [distinct[t] for t in texts]
        return (left[at] + 1).tolist(), (right - left)[at].tolist()

    out = appended(reads, ["seq"], "__first int, __n int", lambda: cut)
    return out.withColumns({c: F.substring(F.col(c), F.col("__first"), F.col("__n")) for c in ("seq", "qual")}).drop("__first", "__n")
