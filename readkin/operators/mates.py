"""Mates merged into one read where they overlap."""

from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import appended


def least_matches(longest: int, chance: float) -> list[int]:
    """For overlaps of 0, 1, .. ``longest`` letters, the fewest matches whose probability among random letters is at most ``chance``; one more than the letters if none is."""
    out, bound = [], Fraction(chance)
    for n in range(longest + 1):
        tail, k = Fraction(0), n
        while k >= 0 and tail + Fraction(comb(n, k) * 3 ** (n - k), 4**n) <= bound:
            tail += Fraction(comb(n, k) * 3 ** (n - k), 4**n)
            k -= 1
        out.append(k + 1)
    return out


def _rows(texts: list[str], width: int, behind: bytes) -> np.ndarray:
    return np.frombuffer(b"".join(t.encode("ascii", "replace").ljust(width, behind) for t in texts), np.uint8).reshape(len(texts), width)


def best_places(a: list[str], qa: list[str], b: list[str], qb: list[str], least: int, rate: float, enough: list[int]) -> np.ndarray:
    """Where in the forward read the turned mate begins (it may be before it), or a very small number.

    All places are scored, each for the whole batch at once: a match adds the lower of the
    two scores of its letters and a mismatch takes it away, N matches nothing.  A place counts with ``least``
    letters of overlap, at most ``rate`` mismatches a letter, and as many matches as ``enough`` asks.
    Of equal scores the longer overlap is taken, then the first place.
    """
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    wa, wb = int(la.max(initial=0)), int(lb.max(initial=0))
    xa, xb = _rows(a, wa, b"\0"), _rows(b, wb, b"\1")
    pa, pb = (np.maximum(_rows(q, w, b"!").astype(np.int32) - 33, 0) for q, w in ((qa, wa), (qb, wb)))
    xa = np.where(xa == ord("N"), 2, xa)
    need = np.array(enough)
    none = -(1 << 30)
    best, long_, place = np.full(len(a), none, np.int64), np.zeros(len(a), np.int64), np.full(len(a), none, np.int64)
    for at in range(least - wb, wa - least + 1):
        lo, hi = max(0, at), min(wa, at + wb)
        n = np.minimum(la, at + lb) - lo
        some = n >= least
        if not some.any():
            continue
        same = xa[:, lo:hi] == xb[:, lo - at : hi - at]
        weight = np.minimum(pa[:, lo:hi], pb[:, lo - at : hi - at])
        inside = np.arange(hi - lo)[None, :] < n[:, None]
        matches = (same & inside).sum(axis=1)
        score = np.where(inside, np.where(same, weight, -weight), 0).sum(axis=1)
        ok = some & (n - matches <= rate * n) & (matches >= need[np.clip(n, 0, len(need) - 1)])
        better = ok & ((score > best) | ((score == best) & (n > long_)))
        best, long_, place = np.where(better, score, best), np.where(better, n, long_), np.where(better, at, place)
    return place


def joined(a: str, qa: str, b: str, qb: str, at: int) -> tuple[str, str]:
    """The fragment from the forward read's first letter to the mate's, overlapping letters from the better score, the forward one of equals."""
    end = at + len(b)
    if at < 0:
        b, qb, at = b[-at:], qb[-at:], 0
    lap = min(len(a), end) - at
    pairs = [(x, p) if p >= q else (y, q) for x, p, y, q in zip(a[at : at + lap], qa[at : at + lap], b[:lap], qb[:lap])]
    return a[:at] + "".join(x for x, _ in pairs) + b[lap:], qa[:at] + "".join(p for _, p in pairs) + qb[lap:]


def mate_name(header: str = "header"):
    """What the headers of two mates share: up to the first blank, without ``/1`` or ``/2``."""
    return F.regexp_extract(header, r"^(\S+?)(?:/[12])?(?:\s|$)", 1)


def merge_mates(forward: DataFrame, reverse: DataFrame, least: int = 10, rate: float = 0.1, chance: float = 1e-4) -> DataFrame:
    """``header, seq, qual`` of mates that overlap, joined by the header up to the first blank.

    A mate may also begin before the forward read does, when the fragment is shorter than
    the reads; what reaches over the fragment is left out.  ``chance`` bounds the probability that
    random letters match as well at a given place; overlaps of over 64 letters are asked for as many matches as
    one of 64, which the rate exceeds.  Pairs that do not overlap and reads
    without a mate give no row; null sequences count as empty.  Sequence and quality must be equally long.
    """
    side = lambda df, s, q: df.select(mate_name().alias("header"), F.coalesce("seq", F.lit("")).alias(s), F.coalesce("qual", F.lit("")).alias(q))
    pairs = side(forward, "a", "qa").join(side(reverse, "b", "qb"), "header")
    pairs = pairs.withColumns({"b": F.reverse(F.translate("b", "ACGTN", "TGCAN")), "qb": F.reverse("qb")})
    enough = least_matches(64, chance)

    def merge(*parts: list) -> tuple:
        rows = list(zip(*parts))
        if any(len(x) != len(p) or len(y) != len(q) for x, p, y, q in rows):
            raise ValueError("sequence and quality differ in length")
        place = best_places(*parts, least, rate, enough).tolist()
        return tuple(zip(*[joined(*r, at) if at > -(1 << 30) else (None, None) for r, at in zip(rows, place)])) or ((), ())

    return appended(pairs, ["a", "qa", "b", "qb"], "seq string, merged string", lambda: merge).where("seq is not null").select("header", "seq", F.col("merged").alias("qual"))
