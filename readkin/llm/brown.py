"""Language-model scoring by Brown classes: exchange clustering, class transitions, word emissions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import discard, scratch, utf8
from .linear import summed

#: The token at the end of every text; no word is empty.
END = b""


@dataclass(frozen=True)
class Rules:
    classes: int = 128
    own_unit: float = 1e-5  # share of all tokens from which on a word, or an ending of other words, is a unit that moves in every round; all other words move once
    in_task: float = 1e-6  # share of all tokens from which on a word's count and class are at hand in every task: at most 1 / in_task words; all others are rows
    sweeps: int = 3  # exchange rounds in which every unit may move
    smoothing: float = 5.0  # weight of the class frequencies in a transition


def tokens(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased, and the end."""
    words = text.lower().split()
    words.append(END)
    return words


def ending(word: bytes) -> bytes:
    """The last two letters of a word."""
    return word[-2:] if word.isascii() else word.decode(errors="replace")[-2:].encode()


class Units:
    """Frequent words and the endings of all others, which are exchanged in rounds, and further words that are at hand in every task.

    Unit 0 is for words whose ending is rare, unit 1 for the end of a text; ``words`` and ``middle`` give counts, ``strange`` are words that
    are frequent only where nothing is learned.  Middle words are units of their own number, but go with their ending in the rounds.
    """

    def __init__(self, ends: int, words: dict[bytes, int], endings: list[bytes], strange: list[bytes], middle: dict[bytes, int]):
        self.words = {END: 1} | {w: k for k, w in enumerate(words, 2)}
        self.endings = {e: k for k, e in enumerate(endings, 2 + len(words))}
        self.exchanged = 2 + len(words) + len(endings)
        apart = [*strange, *middle]
        self.at_hand = self.words | {w: k for k, w in enumerate(apart, self.exchanged)}
        self.middle = self.exchanged + len(strange)  # number of the first middle word
        #: Training count of a unit that is a word; -1 for units of many words.
        self.count = np.array([-1, ends, *words.values(), *[-1] * len(endings), *[0] * len(strange), *middle.values()], np.int64)
        #: The unit that stands for a unit in the rounds.
        self.stand_in = np.concatenate((np.arange(self.exchanged), np.fromiter(map(self.of_ending, apart), np.int64, len(apart))))

    def of(self, word: bytes) -> int:
        k = self.at_hand.get(word)
        return self.of_ending(word) if k is None else k

    def of_ending(self, word: bytes) -> int:
        return self.endings.get(ending(word), 0)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all tokens of the first column, a text; a task sends each word once for about 250,000 different ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in utf8(batch.column(0)):
                seen.update(tokens(text))
                if len(seen) > 250_000:
                    yield pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.binary()), "n": pa.array(seen.values(), pa.int64())})
                    seen = Counter()
        yield pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.binary()), "n": pa.array(seen.values(), pa.int64())})

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def coded(table: DataFrame, units: Units) -> DataFrame:
    """``table`` (first column a text) as ``unit``, the units of its tokens, ``rare``, the words among them that are not at hand, and the other columns."""
    rest = table.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(s, 500) for whole in batches for s in range(0, whole.num_rows, 500)):
            local: dict[bytes, int] = {}
            ids = [np.fromiter((local.setdefault(w, len(local)) for w in tokens(t)), np.int32) for t in utf8(batch.column(0))]
            unit = np.fromiter(map(units.of, local), np.int32, len(local))
            starts = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
            ids = np.concatenate(ids)
            holes = np.flatnonzero(units.count[unit[ids]] < 0)
            rare = pa.array(local.keys(), pa.binary()).take(pa.array(ids[holes]))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(unit[ids])), pa.ListArray.from_arrays(pa.array(np.searchsorted(holes, starts), pa.int32()), rare), *batch.columns[1:]],
                names=["unit", "rare", *rest],
            )

    schema = StructType.fromDDL("unit array<int>, rare array<binary>")
    return table.mapInArrow(run, StructType([*schema.fields, *table.schema.fields[1:]]))


def unit_pairs(texts: DataFrame, units: Units, flush: int = 1_000_000) -> DataFrame:
    """``a, b, n``: how often unit b follows unit a in the column ``unit``; a text begins behind an end."""
    n_units, stand_in = units.exchanged, units.stand_in

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out():
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"a": pa.array(code // n_units, pa.int32()), "b": pa.array(code % n_units, pa.int32()), "n": pa.array(n, pa.int64())})

        for batch in (whole.slice(s, 1000) for whole in batches for s in range(0, whole.num_rows, 1000)):
            flat = stand_in[batch.column(0).flatten().to_numpy(zero_copy_only=False)]
            held.append(np.concatenate(([1], flat[:-1])) * n_units + flat)  # every text ends with unit 1
            size += len(flat)
            if size >= flush:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return texts.select("unit").mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def likelihood(t: np.ndarray) -> float:
    """The part of the training log-likelihood that depends on the classes."""
    return float(_phi(t).sum() - _phi(t.sum(0)).sum() - _phi(t.sum(1)).sum())


def best_class(left: np.ndarray, right: np.ndarray, own: float, a: int, t: np.ndarray) -> tuple[int, float]:
    """The class into which moving a unit of class ``a`` raises the likelihood most, and by how much.

    ``left`` and ``right`` count the classes before and behind it, itself left
    out; ``own`` counts itself behind itself; ``t`` are all class pairs.
    """
    t = t.copy()
    t[:, a] -= left
    t[a, :] -= right
    t[a, a] -= own
    col, row = t.sum(0) + right, t.sum(1) + left  # its neighbours stay
    gain = (_phi(t + left[:, None]) - _phi(t)).sum(0) + (_phi(t + right[None, :]) - _phi(t)).sum(1)
    d = np.diag(t)
    gain += _phi(d + left + right + own) - _phi(d + left) - _phi(d + right) + _phi(d)
    gain -= _phi(col + left.sum() + own) - _phi(col) + _phi(row + right.sum() + own) - _phi(row)
    b = int(np.argmax(gain))
    return b, float(gain[b] - gain[a])


class Moves:
    """``best_class`` of many words at once, by the same sums; a word next to itself counts as a neighbour that stays."""

    SMALL = 8  # counts up to which differences are looked up

    def __init__(self, t: np.ndarray, cost: float = 0.0):
        self.t, self.cost = t, max(cost, 1e-6)  # a move must raise the likelihood by more than its cost
        steps = np.arange(1, self.SMALL + 1)[:, None]
        self.sides = [(m, _phi(m + steps[:, :, None]) - _phi(m)) for m in (t, np.ascontiguousarray(t.T))]
        self.sums = [(x, _phi(x + steps) - _phi(x)) for x in (t.sum(0), t.sum(1))]

    def best(self, left: np.ndarray, right: np.ndarray, a: np.ndarray) -> np.ndarray:
        """The class of every word; rows of ``left`` and ``right`` count the classes before and behind it, ``a`` is its class."""
        if len(a) > 1024:
            return np.concatenate([self.best(left[s : s + 1024], right[s : s + 1024], a[s : s + 1024]) for s in range(0, len(a), 1024)])
        rows, n = np.arange(len(a)), left.sum(1)
        gain = np.zeros(left.shape)
        for (m, known), own, other in zip(self.sides, (left, right), (right, left)):
            w, x = np.nonzero(own)
            k, home = own[w, x], a[w]
            g = np.empty((len(w), len(m)))
            quick = (k <= self.SMALL) & (x != home)
            q, s = np.flatnonzero(quick), np.flatnonzero(~quick)
            g[q] = known[k[q].astype(np.int64) - 1, x[q]]
            g[q, home[q]] = _phi(m[x[q], home[q]]) - _phi(m[x[q], home[q]] - k[q])
            cells, near = m[x[s]], x[s] == home[s]
            cells[near] -= other[w[s[near]]]
            cells[np.arange(len(s)), home[s]] -= k[s]
            g[s] = _phi(cells + k[s, None]) - _phi(cells)
            gain += np.add.reduceat(g, np.searchsorted(w, rows), axis=0)
        w, b = np.nonzero((left > 0) & (right > 0))
        x, y = left[w, b], right[w, b]
        d = self.t[b, b] - np.where(b == a[w], x + y, 0)
        gain[w, b] += _phi(d + x + y) - _phi(d + x) - _phi(d + y) + _phi(d)
        for total, known in self.sums:
            q, s = np.flatnonzero(n <= self.SMALL), np.flatnonzero(n > self.SMALL)
            gain[q] -= known[n[q].astype(np.int64) - 1]
            gain[s] -= _phi(total + n[s, None]) - _phi(total)
            here = total[a]
            gain[rows, a] += _phi(here + n) - 2 * _phi(here) + _phi(here - n)
        b = gain.argmax(1)
        return np.where(gain[rows, b] - gain[rows, a] > self.cost, b, a)


def exchange(pairs: DataFrame, n_units: int, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """Class of every unit, and the counts of class pairs.

    Every unit is a row with its neighbours' counts (at most two per unit), so a
    round is one pass over a table of bounded rows; in a round a third of the
    units, dealt by number, may move to the class that suits them best under the
    counts of the round.  Only vectors of classes come to the driver.
    """
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "n", F.lit(True).alias("behind")).union(pairs.select("b", "a", "n", F.lit(False)))
    rows = scratch(both.groupBy("u").agg(F.collect_list("v").alias("v"), F.collect_list("n").alias("n"), F.collect_list("behind").alias("behind")), "units")
    c = rules.classes
    cls = np.where(np.arange(n_units) < 2, np.arange(n_units), np.arange(n_units) % max(1, c - 2) + 2).astype(np.int16)

    def neighbours(batch: pa.RecordBatch):
        for k, u in enumerate(batch.column(0).to_pylist()):
            v, n, behind = (batch.column(i)[k].values.to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            yield u, v, n.astype(float), behind

    def matrix(cls: np.ndarray) -> np.ndarray:
        def add(batch: pa.RecordBatch) -> np.ndarray:
            t = np.zeros((c, c))
            for u, v, n, behind in neighbours(batch):
                t[cls[u]] += np.bincount(cls[v[behind]], n[behind], c)
            return t.ravel()

        return summed(rows, add, c * c).reshape(c, c)

    t = matrix(cls)
    best = (likelihood(t), cls, t)
    for k in range(3 * rules.sweeps):

        def move(batches: Iterator[pa.RecordBatch], cls=cls, t=t, k=k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                moved = []
                for u, v, n, behind in neighbours(batch):
                    if u < 2 or u % 3 != k % 3:
                        continue
                    me = v == u
                    left, right = np.bincount(cls[v[~behind & ~me]], n[~behind & ~me], c), np.bincount(cls[v[behind & ~me]], n[behind & ~me], c)
                    b, gain = best_class(left, right, float(n[behind & me].sum()), int(cls[u]), t)
                    if gain > 1e-6:
                        moved.append((u, b))
                yield pa.RecordBatch.from_pydict({"u": pa.array([m[0] for m in moved], pa.int32()), "c": pa.array([m[1] for m in moved], pa.int32())})

        cls = cls.copy()
        for r in rows.mapInArrow(move, "u int, c int").collect():  # at most one row a unit
            cls[r.u] = r.c
        t = matrix(cls)
        if likelihood(t) > best[0]:
            best = (likelihood(t), cls, t)
    discard(rows)
    return best[1], best[2]


@dataclass
class Model:
    """What a task needs to score a text, all of bounded size."""

    units: Units
    cls: np.ndarray  # class of every unit
    transition: np.ndarray  # log10 P(class | class before)
    room: np.ndarray  # log10 of a class's emission denominator
    unseen: np.ndarray  # log10 of an unseen word's numerator in a class
    discount: float
    n: int
    v: int


@dataclass
class Vocabulary:
    """All words of the training texts."""

    counts: DataFrame  # word, n
    units: Units
    discount: float
    n: int
    v: int

    def model(self, cls: np.ndarray, t: np.ndarray, kinds: np.ndarray, rules: Rules) -> Model:
        """From class pairs and the number of words of every class."""
        size = t.sum(0)
        share = (size + 1 / rules.classes) / (self.n + 1)
        transition = np.log10((t + rules.smoothing * share) / (t.sum(1, keepdims=True) + rules.smoothing))
        return Model(self.units, cls, transition, np.log10(size + 1), np.log10(self.discount * kinds + 1), self.discount, self.n, self.v)


def vocabulary(texts: DataFrame, rules: Rules, others: DataFrame | None = None) -> Vocabulary:
    """Words and units of the first column of ``texts``; words frequent in ``others``, which are scored only, are at hand too."""
    counts = scratch(word_counts(texts.select(texts.columns[0])), "words")
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"), F.coalesce(F.max(F.when(F.length("word") == 0, F.col("n"))), F.lit(0)).alias("ends")
    ).first()
    share = max(rules.own_unit, rules.in_task)
    least = max(1.0, share * total.n)
    words = F.length("word") > 0
    at_hand = {bytes(r.word): r.n for r in counts.where(words & (F.col("n") >= max(1.0, rules.in_task * total.n))).collect()}
    own = {w: k for w, k in at_hand.items() if k >= least}
    if others is not None:
        outside = scratch(word_counts(others.select(others.columns[0])), "outside")
        some = outside.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
        often = outside.where(words & (F.col("n") >= max(1.0, share * some)) & (F.col("n") > 100)).select("word")
        own |= {bytes(r.word): r.n for r in often.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n")).collect()}
        discard(outside)
    rest = counts.where((F.col("n") < least) & words).groupBy(F.substring(F.col("word").cast("string"), -2, 2).alias("e")).agg(F.sum("n").alias("n"))
    endings = sorted(r.e.encode() for r in rest.where(F.col("n") >= least).collect())
    units = Units(total.ends, {w: own[w] for w in sorted(own) if own[w]}, endings, sorted(w for w in own if not own[w]), {w: at_hand[w] for w in sorted(at_hand) if w not in own})
    discount = total.n1 / (total.n1 + 2 * total.n2) if total.n1 and total.n2 else 0.5
    return Vocabulary(counts, units, discount, total.n, total.v)


def unit_classes(texts: DataFrame, units: Units, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units and counts of class pairs, learned from the column ``unit`` of coded texts."""
    pairs = scratch(unit_pairs(texts, units), "pairs")
    cls, t = exchange(pairs, units.exchanged, rules)
    discard(pairs)
    cls = cls[units.stand_in]
    if units.middle == len(cls):
        return cls, t
    cls = middle_classes(texts, cls, t, units, rules)
    c = rules.classes

    def add(whole: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(c * c)
        for s in range(0, whole.num_rows, 1000):
            flat = cls[whole.column(0).slice(s, 1000).flatten().to_numpy(zero_copy_only=False)].astype(np.int64)
            out += np.bincount(np.concatenate(([cls[1]], flat[:-1])) * c + flat, minlength=c * c)
        return out

    return cls, summed(texts.select("unit"), add, c * c).reshape(c, c)


def middle_classes(texts: DataFrame, cls: np.ndarray, t: np.ndarray, units: Units, rules: Rules, flush: int = 2_000_000) -> np.ndarray:
    """``cls`` after every middle word has moved by itself to the class that raises the likelihood most, its neighbours staying; one number a word comes to the driver."""
    c, start = rules.classes, units.middle

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out():
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"u": pa.array(code // (2 * c), pa.int32()), "cell": pa.array(code % (2 * c), pa.int32()), "n": pa.array(n, pa.int32())})

        for batch in (whole.slice(s, 500) for whole in batches for s in range(0, whole.num_rows, 500)):
            unit = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            k, at = cls[unit].astype(np.int64), np.flatnonzero(unit >= start)
            code = (unit[at] - start).astype(np.int64) * (2 * c)
            held += [code + np.concatenate(([cls[1]], k[:-1]))[at], code + c + k[np.minimum(at + 1, len(k) - 1)]]  # an end is no middle word
            size += 2 * len(at)
            if size >= flush:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def other_unit(batch: pa.RecordBatch, last: pa.RecordBatch | None) -> np.ndarray:
        u = batch.column(0).to_numpy()
        return np.concatenate(([last is None or last.column(0)[0].as_py() != u[0]], u[1:] != u[:-1]))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = Moves(t, float(np.log(c)))
        for batch in _whole(batches, other_unit):
            u, row = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            both = np.bincount(row * (2 * c) + batch.column(1).to_numpy(), batch.column(2).to_numpy(), len(u) * 2 * c).reshape(-1, 2, c)
            now = moves.best(both[:, 0], both[:, 1], cls[u + start].astype(np.int64))
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int32()), "c": pa.array(now, pa.int32())})

    out = cls.copy()
    found = texts.select("unit").mapInArrow(cells, "u int, cell int, n int").repartition("u").sortWithinPartitions("u").mapInArrow(choose, "u int, c int")
    for r in found.collect():  # a row a middle word
        out[r.u + start] = r.c
    return out


def fit(texts: DataFrame, rules: Rules = Rules()) -> tuple[Model, DataFrame]:
    """The model of the first column of ``texts`` in which a word that is not at hand has the class of its ending, and the table ``word, n`` of all its words.

    ``score`` starts from these classes and puts every word into a class of its own choice.
    """
    known = vocabulary(texts, rules)
    units = known.units
    cls, t = unit_classes(scratch(coded(texts.select(texts.columns[0]), units), "coded"), units, rules)

    def types(batch: pa.RecordBatch) -> np.ndarray:
        return np.bincount(cls[np.fromiter(map(units.of, batch.column(0).to_pylist()), np.int64, batch.num_rows)], minlength=rules.classes).astype(float)

    return known.model(cls, t, summed(known.counts, types, rules.classes), rules), known.counts


def _whole(batches: Iterator[pa.RecordBatch], begins) -> Iterator[pa.RecordBatch]:
    """Batches that are cut only where a group begins; ``begins(batch, last)`` marks such rows, ``last`` is the row before the batch, if any."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = np.flatnonzero(begins(batch, held[-1].slice(held[-1].num_rows - 1) if held else None))
        if len(cut):
            if before := [b for b in (*held, batch.slice(0, cut[-1])) if b.num_rows]:
                yield pa.concat_batches(before)
            held, batch = [], batch.slice(cut[-1])
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def rare_classes(texts: DataFrame, cls: np.ndarray, t: np.ndarray, units: Units, rules: Rules) -> DataFrame:
    """``rid, pos, value`` for every token that is not at hand: its row and place, and ``(count * classes + class) * 2``, plus 1 at one place of every training word.

    ``texts`` are coded, with ``rid`` and ``learn``.  Every word, however rare, moves by itself from the class of its ending to the one
    that raises the likelihood most, given the classes at hand of its neighbours in the training texts and all class pairs ``t``.  A word
    that occurs in no training text keeps the class of its ending.  All places of a word are in one task, at most an ``in_task`` of the training tokens and an ``own_unit`` of the others.
    """
    c = rules.classes

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(s, 500) for whole in batches for s in range(0, whole.num_rows, 500)):
            unit, length = _flat(batch.column(0))
            holes = np.flatnonzero(units.count[unit] < 0)
            row = np.repeat(np.arange(len(length)), length)[holes]
            pos = holes - (np.cumsum(length) - length)[row]
            k = cls[unit].astype(np.int64)
            around = (k[holes] * c + np.concatenate(([cls[1]], k[:-1]))[holes]) * c + k[np.minimum(holes + 1, len(k) - 1)]  # an end is no hole
            learn, rid = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(1).flatten(), pa.array(rid[row]), pa.array(pos * 2 + learn[row]), pa.array(around)], names=["word", "rid", "place", "around"])

    def other_word(batch: pa.RecordBatch, last: pa.RecordBatch | None) -> np.ndarray:
        word = batch.column(0)
        new = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate(([last is None or last.column(0)[0] != word[0]], new))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = Moves(t, float(np.log(c)))
        for batch in _whole(batches, other_word):
            begins = other_word(batch, None)
            word = np.cumsum(begins) - 1
            rid, place, around = (batch.column(i).to_numpy() for i in (1, 2, 3))
            own = around[begins] // (c * c)
            at = np.flatnonzero(place & 1)  # in training texts
            seen, first, w, n = np.unique(word[at], return_index=True, return_inverse=True, return_counts=True)
            count, now = np.zeros(len(own), np.int64), own.copy()
            count[seen] = n
            if len(seen):
                left, right = (np.bincount(w * c + x, minlength=len(seen) * c).reshape(-1, c).astype(float) for x in (around[at] // c % c, around[at] % c))
                now[seen] = moves.best(left, right, own[seen])
            value = ((count * c + now) * 2)[word]
            value[at[first]] += 1
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(place >> 1), pa.array(value)], names=["rid", "pos", "value"])

    found = texts.select("unit", "rare", "learn", "rid").mapInArrow(places, "word binary, rid long, place long, around long")
    return found.repartition("word").sortWithinPartitions("word").mapInArrow(choose, "rid long, pos long, value long")


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the length of every row."""
    return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def _bytes(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Class numbers of a binary column and their number in every row."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).astype(np.int64), np.fromiter((len(x) // kind.itemsize for x in rows), np.int64, len(rows))


def _binary(values: np.ndarray, length: np.ndarray, kind: np.dtype) -> pa.Array:
    data, ends = values.astype(kind).tobytes(), np.cumsum(length) * kind.itemsize
    return pa.array([data[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])), ends)], pa.binary())


def class_texts(texts: DataFrame, cls: np.ndarray, t: np.ndarray, known: Vocabulary, rules: Rules) -> DataFrame:
    """Coded texts as ``doc_id, learn, n_known, base, emitted`` and, as bytes, the classes of all tokens, of tokens of unseen words, and of training words at one place each."""
    c, count, discount = rules.classes, known.units.count, known.discount
    kind = np.min_scalar_type(c - 1)
    doc_id = texts.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {doc_id}, learn boolean, n_known long, base double, emitted double, cls binary, unseen binary"
    names = ["doc_id", "learn", "n_known", "base", "emitted", "cls", "unseen"]

    def sums(n: np.ndarray, row: np.ndarray, rows: int) -> list[np.ndarray]:
        return [np.bincount(row, x, rows) for x in (n > 0, np.where(n > 0, np.log10(np.maximum(n, 0) + 1.0), 0.0), np.where(n > 0, np.log10(np.maximum(n - discount, 1e-9)), 0.0))]

    def at_hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(s, 500) for whole in batches for s in range(0, whole.num_rows, 500)):
            unit, length = _flat(batch.column(0))
            n, row = count[unit], np.repeat(np.arange(len(length)), length)
            k, base, emitted = sums(n, row, len(length))
            unseen = _binary(cls[unit][n == 0], np.bincount(row[n == 0], minlength=len(length)), kind)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array(k.astype(np.int64)), pa.array(base), pa.array(emitted), _binary(cls[unit], length, kind), unseen], names=["rid", *names])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole(batches, lambda b, last: b.column(1).to_numpy() < 0):
            pos = batch.column(1).to_numpy()
            docs = batch.column(3).filter(pa.array(pos < 0))
            doc_id, learn, n_known, base, emitted, all_, unseen = (docs.field(name) for name in names)
            hole = pos >= 0
            row, pos, value = (np.cumsum(~hole) - 1)[hole], pos[hole], batch.column(2).to_numpy()[hole]
            k, n, first = (value >> 1) % c, (value >> 1) // c, value & 1 > 0
            flat, length = _bytes(all_, kind)
            flat[(np.cumsum(length) - length)[row] + pos] = k
            old, old_length = _bytes(unseen, kind)
            at = np.concatenate((np.repeat(np.arange(len(docs)), old_length), row[n == 0]))
            unseen = _binary(np.concatenate((old, k[n == 0]))[np.argsort(at, kind="stable")], np.bincount(at, minlength=len(docs)), kind)
            more = [pa.array(old.to_numpy() + x.astype(old.type.to_pandas_dtype())) for old, x in zip((n_known, base, emitted), sums(n, row, len(docs)))]
            yield pa.RecordBatch.from_arrays([doc_id, learn, *more, _binary(flat, length, kind), unseen, _binary(k[first], np.bincount(row[first], minlength=len(docs)), kind)], names=[*names, "first"])

    docs = texts.select("unit", "rid", "doc_id", "learn").mapInArrow(at_hand, f"rid long, {fields}").select("rid", F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("value"), F.struct(*names).alias("doc"))
    rare = rare_classes(texts, cls, t, known.units, rules).withColumn("doc", F.lit(None).cast(docs.schema["doc"].dataType))
    return docs.union(rare).repartition("rid").sortWithinPartitions("rid", "pos").mapInArrow(filled, f"{fields}, first binary")


def score(docs: DataFrame, learn: Column, rules: Rules = Rules()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, a row for each row of ``docs(doc_id, text)``.

    ``score`` is the log10 probability of the whole text with its end: a word is
    emitted by its class, a class by the class before.  Frequent words and endings are
    exchanged first, in rounds; then every other training word moves by itself, once,
    if that raises the log-likelihood by more than stating its class takes, log(classes):
    those at hand by their counts (``middle_classes``), then all others, whose places
    are rows (``rare_classes``).  Only words of no training text have the
    class of their ending.  Emissions are discounted absolutely, and what is
    saved in a class is the probability of its unseen words; probabilities of all
    words and one unseen word for every class sum to 1.  ``base_score`` is the
    add-one unigram model.  Both learn from rows where ``learn`` (of ``doc_id``)
    holds, or is null.

    Texts are coded once; words that are not at hand meet at their word, then at their
    text.  A null or empty text is just an end; repeated rows get equal scores; with
    nothing to learn from every word is unseen; an empty table gives no row; other
    columns are not read.
    """
    table = docs.select("text", "doc_id", F.coalesce(learn, F.lit(True)).alias("learn"))
    known = vocabulary(table.where("learn").select("text"), rules, table.where("not learn").select("text"))
    texts = scratch(coded(table, known.units).withColumn("rid", F.monotonically_increasing_id()), "coded")
    cls, t = unit_classes(texts.where("learn"), known.units, rules)
    parts = scratch(class_texts(texts, cls, t, known, rules), "classes")
    discard(texts)
    discard(known.counts)

    c, kind, end = rules.classes, np.min_scalar_type(rules.classes - 1), cls[1]
    own = cls[known.units.count > 0]

    def statistics(whole: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(c * c + c)
        for batch in (whole.slice(s, 1000) for s in range(0, whole.num_rows, 1000)):
            flat, _ = _bytes(batch.column(0), kind)
            out[: c * c] += np.bincount(np.concatenate(([end], flat[:-1])) * c + flat, minlength=c * c)  # every text ends with the end
            out[c * c :] += np.bincount(_bytes(batch.column(1), kind)[0], minlength=c)
        return out

    found = summed(parts.where("learn").select("cls", "first"), statistics, c * c + c)
    m = known.model(cls, found[: c * c].reshape(c, c), found[c * c :] + np.bincount(own, minlength=c), rules)
    room = float(np.log10(m.n + m.v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(s, 1000) for whole in batches for s in range(0, whole.num_rows, 1000)):
            (flat, length), (new, some) = _bytes(batch.column(5), kind), _bytes(batch.column(6), kind)
            rows = np.arange(batch.num_rows)
            total = np.bincount(np.repeat(rows, length), m.transition[np.concatenate(([end], flat[:-1])), flat] - m.room[flat], len(rows))
            total += batch.column(4).to_numpy() + np.bincount(np.repeat(rows, some), m.unseen[new], len(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.invert(batch.column(1)), pa.array(length), batch.column(2), pa.array(np.full(len(rows), m.n)), pa.array(batch.column(3).to_numpy() - length * room), pa.array(total)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return parts.mapInArrow(run, f"doc_id {doc_id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
