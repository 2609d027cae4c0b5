"""Alignment of short inserts to one short reference each, on the read's own row."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import appended
from .tables import few_rows

LOW = -(1 << 20)
UNMAPPED = (4, -1, 0, "*")
_COMPLEMENT = str.maketrans("ACGTN", "TGCAN")
#: Kinds of moves through the table.
_STOP, _BOTH, _READ, _REF = 0, 1, 2, 3


@dataclass(frozen=True)
class Scoring:
    """A gap of n costs ``gap_open + n * gap_extend``; a clipped end costs ``clip``; alignments under ``least`` count as none."""

    match: int = 1
    mismatch: int = -4
    gap_open: int = -6
    gap_extend: int = -1
    clip: int = -5
    least: int = 30

    @property
    def word(self) -> int:
        """Length of the words that are counted before a table is filled (see ``shared_words``)."""
        return -self.mismatch // self.match + 1


def letters(seqs: list[str], width: int) -> np.ndarray:
    """Sequences as rows of bytes, zeros behind them; N is 0 too and equals nothing."""
    flat = np.frombuffer(b"".join(s.encode("ascii", "replace")[:width].ljust(width, b"\0") for s in seqs), np.uint8).reshape(len(seqs), width)
    return np.where(flat == ord("N"), 0, flat)


def shared_words(reads: np.ndarray, ref: np.ndarray, k: int) -> np.ndarray:
    """For each read, at how many places stands a word of ``k`` bases that the reference has.

    An alignment of M matches and e errors, each of which costs at least ``k - 1``
    matches, keeps at least ``M - (k - 1) * (e + 1)`` such words, so its score is at
    most ``match * (words + k - 1)``: fewer words rule the table out.
    """
    code = np.full(256, -1, np.int64)
    code[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
    if reads.shape[1] < k or len(ref) < k:
        return np.zeros(len(reads), np.int64)

    def words(x: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(code[x], k, axis=-1)
        return np.where((view < 0).any(axis=-1), -1, (view * 4 ** np.arange(k)).sum(axis=-1))

    own = words(ref)
    return np.isin(words(reads), own[own >= 0]).sum(axis=1)


def fill(reads: np.ndarray, sizes: np.ndarray, ref: np.ndarray, s: Scoring) -> tuple[np.ndarray, ...]:
    """Affine tables of a batch of reads against one reference, a row of all tables at a time.

    Returns the best score of each read, its last base and reference place, the best score of an
    alignment of the same last base over half a read away, and the moves.  Gaps in the read are a running maximum along the row, so no
    cell is visited by itself.  Of equal moves a pair of bases is preferred to a clipped start, both to an
    inserted base, all to a missing one; of equal ends the last base, then the first place.
    """
    count, width = len(reads), len(ref) + 1
    step = s.gap_extend * np.arange(width, dtype=np.int32)
    h = np.zeros((count, width), np.int32)
    f = np.full((count, width), LOW, np.int32)
    moves = np.zeros((reads.shape[1] + 1, count, width), np.uint8)
    best = np.full(count, LOW, np.int32)
    last, place = np.zeros(count, np.int64), np.zeros(count, np.int64)
    ends = np.full((count, width), LOW, np.int32)
    for i in range(1, reads.shape[1] + 1):
        base = reads[:, i - 1, None]
        opened = h + s.gap_open
        f_open = opened >= f
        f = np.maximum(opened, f) + s.gap_extend
        row = np.full((count, width), s.clip, np.int32)
        pair = h[:, :-1] + np.where((base == ref[None, :]) & (base > 0), s.match, s.mismatch).astype(np.int32)
        move = np.zeros((count, width), np.uint8)
        move[:, 1:] = pair >= row[:, 1:]
        np.maximum(row[:, 1:], pair, out=row[:, 1:])
        move[f > row] = _READ
        np.maximum(row, f, out=row)
        e = np.full((count, width), LOW, np.int32)
        e[:, 1:] = np.maximum.accumulate(row - step, axis=1)[:, :-1] + s.gap_open + step[1:]
        move[e > row] = _REF
        np.maximum(row, e, out=row)
        e_open = np.zeros((count, width), bool)
        e_open[:, 1:] = row[:, :-1] + s.gap_open >= e[:, :-1]
        moves[i] = move | f_open << 2 | e_open << 3
        h = row
        stop = h + np.where(sizes == i, 0, s.clip).astype(np.int32)[:, None]
        stop[sizes < i] = LOW
        at = stop.argmax(axis=1)
        score = stop[np.arange(count), at]
        better = score >= best
        best, last, place = np.where(better, score, best), np.where(better, i, last), np.where(better, at, place)
        ends[better] = stop[better]
    far = np.abs(np.arange(width)[None, :] - place[:, None]) > (sizes // 2)[:, None]
    return best, last, place, np.where(far, ends, LOW).max(axis=1, initial=LOW), moves


def walk_back(moves: np.ndarray, last: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Start places and CIGAR texts of the best paths, one step of all reads at a time."""
    count = len(last)
    who, i, j, gap = np.arange(count), last.copy(), place.copy(), np.zeros(count, np.uint8)
    steps, going = [], np.ones(count, bool)
    while True:
        here = moves[i, who, j]
        kind = np.where(gap > 0, gap, here & 3)
        going = going & (i > 0) & (kind != _STOP)
        if not going.any():
            break
        steps.append(np.where(going, kind, 0).astype(np.uint8))
        opens = np.where(kind == _READ, here >> 2 & 1, here >> 3 & 1) > 0
        gap = np.where(going & (kind != _BOTH) & ~opens, kind, 0).astype(np.uint8)
        i = i - (going & (kind != _REF))
        j = j - (going & (kind != _READ))
    path = np.stack(steps[::-1]).T.tobytes() if steps else b""
    names, out = {_BOTH: "M", _READ: "I", _REF: "D"}, []
    for b in range(count):
        ops = path[b * len(steps) : (b + 1) * len(steps)].lstrip(b"\0")
        middle = "".join(f"{m.end() - m.start()}{names[ops[m.start()]]}" for m in re.finditer(rb"(?s)(.)\1*", ops))
        front, back = int(i[b]), int(sizes[b] - last[b])
        out.append(f"{front}S" * (front > 0) + middle + f"{back}S" * (back > 0))
    return j, out


def align_batch(seqs: list[str], ref: str, s: Scoring = Scoring(), cells: int = 1 << 24) -> list[tuple[int, int, int, str, int]]:
    """``(flag, 0-based start, mapq, CIGAR, score)`` of sequences against a reference, both strands looked at.

    A sequence without an alignment of ``least`` is ``(4, -1, 0, "*", 0)``.  The strand with
    the higher score is taken, the forward one of equals.  The second score is
    that of the other strand or of an alignment with the same last base whose place is over half
    the read away; with none of ``least``, mapq is 60, else ``60 * (best - second) // best``.
    Tables are filled for as many reads at a time as ``cells`` of moves allow, shorter reads first.
    """
    if -(s.gap_open + s.gap_extend) < -s.mismatch:
        raise ValueError("a gap must cost a mismatch or more")
    got: list[list] = [[] for _ in seqs]
    code = letters([ref], len(ref))[0]
    tries = [(k, turned, t) for k, x in enumerate(seqs) if x and ref for turned, t in ((0, x), (16, x[::-1].translate(_COMPLEMENT)))]
    tries.sort(key=lambda t: len(t[2]))
    at = 0
    while at < len(tries):
        n = 1
        while at + n < len(tries) and (n + 1) * (len(tries[at + n][2]) + 1) * (len(ref) + 1) <= cells:
            n += 1
        part, at = tries[at : at + n], at + n
        rows = letters([t for *_, t in part], len(part[-1][2]))
        some = np.flatnonzero(s.match * (shared_words(rows, code, s.word) + s.word - 1) >= s.least)
        if not len(some):
            continue
        part, rows = [part[k] for k in some], rows[some]
        sizes = np.array([len(t) for *_, t in part])
        best, last, place, second, moves = fill(rows, sizes, code, s)
        start, cigars = walk_back(moves, last, place, sizes)
        for b, (k, turned, _) in enumerate(part):
            if best[b] >= s.least:
                got[k].append((int(best[b]), turned, int(start[b]), cigars[b], int(second[b])))
    out = []
    for found in got:
        if not found:
            out.append((*UNMAPPED, 0))
            continue
        found.sort(key=lambda x: (-x[0], x[1]))
        score, flag, start, cigar, second = found[0]
        second = max(second, found[1][0] if len(found) > 1 else LOW)
        out.append((flag, start, 60 if second < s.least else 60 * (score - second) // score, cigar, score))
    return out


def align(reads: DataFrame, refs: DataFrame, scoring: Scoring = Scoring(), remembered: int = 1 << 16) -> DataFrame:
    """``reads(target, seq, qual, ..)`` with ``flag, pos0, mapq, cigar`` against ``refs(target, ref)``, a row a gene.

    Every read is aligned on its own row, so nothing is shuffled; equal sequences of a batch are
    aligned once, and a task remembers the last ones (at most ``remembered``, twice at times).  A read on
    the other strand (flag 16) has ``seq`` and ``qual`` turned, as SAM asks.  Reads of unknown targets go;
    a null or empty sequence is unmapped; letters other than A, C, G and T match nothing.
    """
    known = {r.target: r.ref or "" for r in few_rows(refs.select("target", "ref"))}

    def start():
        done: dict = {}
        older: dict = {}

        def run(targets: list, seqs: list) -> tuple:
            nonlocal done, older
            if len(done) >= remembered:
                done, older = {}, done
            new: dict[str, set[str]] = {}
            for t, x in set(zip(targets, seqs)):
                if (t, x) not in done:
                    if (t, x) in older:
                        done[t, x] = older[t, x]
                    else:
                        new.setdefault(t, set()).add(x)
            for t, some in new.items():
                if t not in known:
                    done.update({(t, x): (None,) * 4 for x in some})
                    continue
                ordered = sorted(x for x in some if x)
                for x, r in zip(ordered, align_batch(ordered, known[t], scoring)):
                    done[t, x] = r[:4]
                for x in some - set(ordered):
                    done[t, x] = UNMAPPED
            return tuple(zip(*[done[key] for key in zip(targets, seqs)])) or ((),) * 4

        return run

    # Unknown targets go after the step: a filter before it would repeat all that the target is computed from.
    out = appended(reads, ["target", "seq"], "flag int, pos0 int, mapq int, cigar string", start).where("flag is not null")
    back = F.col("flag") == 16
    turned = {"seq": F.when(back, F.reverse(F.translate("seq", "ACGTN", "TGCAN"))).otherwise(F.col("seq"))}
    if "qual" in reads.columns:
        turned["qual"] = F.when(back, F.reverse("qual")).otherwise(F.col("qual"))
    return out.withColumns(turned)


def family_names(aln: DataFrame) -> DataFrame:
    """The primary barcodes, as reference names of an alignment header."""
    return aln.select("bc5").distinct()
