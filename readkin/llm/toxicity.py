"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, plain, scratch, utf8
from .linear import fit, sigmoid, summed

#: ASCII other than letters and digits separates words.
_BLANK = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))

#: General insults that vote before any label is seen.
SEED_LEXICON = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
    "imbecile", "bastard", "filth", "vermin", "hate", "kill", "shut", "ugly", "fool", "jerk", "freak",
    "idiota", "imbécil", "estúpido", "basura", "asqueroso", "idiote", "imbécile", "stupide", "connard", "ordure", "dummkopf", "arschloch", "abschaum", "trottel",
)


@dataclass(frozen=True)
class Rules:
    sample: int = 20_000  # most labelled rows that the lexicon is learned from
    words: int = 24  # most learned words; each is a voter
    stems: int = 24  # most learned stems; each is a voter
    least_share: float = 0.02  # of toxic sample texts that hold a learned word or stem
    least_lift: float = 8.0  # its share among toxic texts over that among others
    rounds: int = 12  # of the label model


#: Lengths of stems in letters.
STEMS = range(3, 9)


def _marks(text: bytes) -> set[str]:
    """The words of a text, and as ``stem*`` the stems that two or more different words share."""
    kinds = {w.decode(errors="replace") for w in set(text.translate(_BLANK).split())}
    stems = Counter(w[:k] for w in kinds for k in STEMS if len(w) > k)
    return kinds | {s + "*" for s, n in stems.items() if n > 1}


def learned_marks(docs: DataFrame, labels: DataFrame, rules: Rules) -> tuple[list[str], list[str], float]:
    """The words and the stems that mark toxic texts best, and the share of toxic rows, on a bounded sample of labelled rows.

    The sample is that of the least hashed doc_ids, at most ``rules.sample`` rows,
    which bounds the broadcast.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(rules.sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        total = [0, 0]
        for batch in batches:
            for text, toxic in zip(utf8(batch.column(0), lower=True), batch.column(1).to_pylist()):
                seen[toxic > 0].update(_marks(text))
                total[toxic > 0] += 1
        seen[0][""], seen[1][""] = total  # the empty mark carries the number of texts
        marks = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_pydict({"mark": pa.array(marks, pa.string()), "clean": pa.array([seen[0][w] for w in marks], pa.int64()), "toxic": pa.array([seen[1][w] for w in marks], pa.int64())})

    counts = scratch(texts.mapInArrow(count, "mark string, clean long, toxic long").groupBy("mark").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "lexicon")
    total = counts.where("mark = ''").first()
    if not total or not total.toxic:
        return [], [], 0.0
    n1, n0 = total.toxic, total.clean
    share1, share0 = F.col("toxic") / n1, (F.col("clean") + 0.5) / (n0 + 1)
    gain = F.col("toxic") * F.log(share1 / share0)
    good = counts.where((F.col("mark") != "") & (F.col("toxic") >= 3) & (share1 >= rules.least_share) & (share1 >= rules.least_lift * share0))
    stem = F.col("mark").endswith("*")
    best = lambda which, n: [r.mark for r in good.where(which).orderBy(gain.desc(), F.length("mark").desc(), "mark").limit(n).collect()]
    stems: list[str] = []
    for s in (m[:-1] for m in best(stem, 16 * rules.stems)):
        if len(stems) < rules.stems and not any(s.startswith(t) or t.startswith(s) for t in stems):
            stems.append(s)
    words = [w for w in best(~stem, 4 * rules.words) if not w.startswith(tuple(stems))]
    return words[: rules.words], stems, (n1 + 1) / (n0 + n1 + 2)


class Voters:
    """Binary voters over a whole text; a vote is a bit of a mask.

    One voter for every learned word and stem, one for the seed lexicon, and
    patterns: counts and density of different marked words and their absence,
    shouting, runs of exclamation marks, symbols, very short or repetitive texts.
    """

    def __init__(self, words: list[str], stems: list[str]):
        self.words = {w.encode(): k for k, w in enumerate(words)}
        self.stems = tuple(s.encode() for s in stems)
        self.seed = frozenset(w.encode() for w in SEED_LEXICON)
        self.known = self.seed | set(self.words)
        self.first_flag = len(words) + len(stems)
        self.n = self.first_flag + 11

    def mask(self, raw: bytes, lower: bytes) -> int:
        words = lower.translate(_BLANK).split()
        kinds = set(words)
        hit = kinds & self.known
        marked = [w for w in kinds if w.startswith(self.stems)] if self.stems else []
        out = 0
        for w in hit:
            if (k := self.words.get(w)) is not None:
                out |= 1 << k
        if len(marked) > 1:
            for k, s in enumerate(self.stems, len(self.words)):
                out |= (sum(w.startswith(s) for w in marked) > 1) << k
        n = len(hit.union(marked))
        letters = sum(map(raw.count, (b"A", b"E", b"I", b"O", b"T", b"N", b"S", b"R")))
        small = sum(map(raw.count, (b"a", b"e", b"i", b"o", b"t", b"n", b"s", b"r")))
        flags = (
            bool(hit & self.seed), not n, n >= 2, n >= 3, n >= 5, n * 50 >= len(kinds) > 0,
            letters > small, b"!!" in raw, sum(map(raw.count, (b"#", b"$", b"%", b"&", b"*"))) * 20 > len(raw), len(words) < 5, len(kinds) * 4 < len(words),
        )
        for k, flag in enumerate(flags, self.first_flag):
            out |= flag << k
        return out


def bits(mask: np.ndarray, n: int) -> np.ndarray:
    return ((mask.astype(np.uint64)[:, None] >> np.arange(n, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)


@dataclass
class LabelModel:
    """Class-conditional firing rates of the voters, a class prior, and a weight of each voter against correlation."""

    prior: float
    rate: np.ndarray  # (2, voters)
    weight: np.ndarray

    def linear(self) -> np.ndarray:
        """The log-odds as a linear function of the votes and 1."""
        on, off = np.log(self.rate[1] / self.rate[0]), np.log((1 - self.rate[1]) / (1 - self.rate[0]))
        return np.append(self.weight * (on - off), np.log(self.prior / (1 - self.prior)) + (self.weight * off).sum())

    def posterior(self, v: np.ndarray) -> np.ndarray:
        w = self.linear()
        return sigmoid(v @ w[:-1] + w[-1])


def label_model(patterns: DataFrame, marked: DataFrame, n: int, prior: float, rounds: int) -> LabelModel:
    """Fit by expectation-maximisation on ``patterns(mask, count)`` of all learning rows.

    ``marked(mask, toxic, count)`` anchors the classes.  Correlations of the
    voters inside a class are estimated from the same expectations, and the vote
    of each voter is divided by one plus its squared correlations with the others.
    """
    pairs = n * n

    def anchor(batch: pa.RecordBatch) -> np.ndarray:
        v, c = bits(batch.column(0).to_numpy(), n), batch.column(2).to_numpy().astype(float)
        y = batch.column(1).to_numpy() > 0
        return np.concatenate([x for k in (~y, y) for x in (v.T @ (c * k), [(c * k).sum()])])

    fixed = summed(marked, anchor, 2 * n + 2).reshape(2, n + 1)
    rate = (fixed[:, :n] + 0.5) / (fixed[:, n:] + 1)
    model = LabelModel(prior, rate, np.ones(n))
    for r in range(rounds + 1):

        def expect(batch: pa.RecordBatch, model=model, last=r == rounds) -> np.ndarray:
            v, c = bits(batch.column(0).to_numpy(), n), batch.column(1).to_numpy().astype(float)
            q = model.posterior(v)
            out = []
            for k in (1 - q, q):
                out += [v.T @ (c * k), [(c * k).sum()], ((v * (c * k)[:, None]).T @ v).ravel() if last else np.zeros(pairs)]
            return np.concatenate(out)

        got = summed(patterns, expect, 2 * (n + 1 + pairs)).reshape(2, -1)
        if r < rounds:
            rate = (got[:, :n] + fixed[:, :n] + 0.5) / (got[:, n : n + 1] + fixed[:, n:] + 1)
            # voters are correlated, so each round trusts a voter less the more company it has
            model = LabelModel(prior, rate, np.full(n, 1 / np.sqrt(n)) if r == 0 else model.weight)
            continue
        linked = np.zeros((n, n))
        for k in (0, 1):
            total = max(got[k, n], 1e-9)
            mean = got[k, :n] / total
            cov = got[k, n + 1 :].reshape(n, n) / total - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            linked = np.maximum(linked, np.where(np.outer(sd, sd) > 1e-9, np.abs(cov) / np.outer(sd, sd), 0))
        np.fill_diagonal(linked, 0)
        model = LabelModel(prior, rate, 1 / (1 + np.where(linked > 0.3, linked**2, 0).sum(axis=1)))
    return model


def scores(docs: DataFrame, labels: DataFrame, learn: Column | None = None, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) of every row's whole text.

    ``learn`` (of ``doc_id``) says which rows may be learned from.  Labels give
    the learned lexicon (from a bounded sample) and anchor the label model; the
    label model takes the vote patterns of all learning rows, and the linear
    classifier is trained on its posteriors.  Nothing but the text enters a score.

    A null text is scored as an empty one; repeated rows get equal scores; labels
    that are null, or of no document, are not used, and a doc_id that is labelled
    twice counts as toxic if one label says so; without labels the seed lexicon
    alone decides; an empty table gives no row.
    """
    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    words, stems, prior = learned_marks(docs.where(learn), labels.where(learn), rules)
    voters = Voters(words, stems)
    n = voters.n

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [voters.mask(a, b) for a, b in zip(utf8(batch.column(0)), utf8(batch.column(0), lower=True))]
            yield pa.RecordBatch.from_arrays([pa.array(masks, pa.int64()), *batch.columns[1:]], names=["mask", *batch.schema.names[1:]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    votes = scratch(docs.select("text", F.col("doc_id").alias("__id"), learn.alias("__learn")).mapInArrow(vote, f"mask long, __id {kind}, __learn boolean"), "votes")
    patterns = scratch(votes.where("__learn").groupBy("mask").agg(F.count("*").alias("count")), "patterns")
    if prior:
        marks = labels.where(learn).where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        marked = votes.where("__learn").join(marks, F.col("__id") == F.col("doc_id")).groupBy("mask", "toxic").agg(F.count("*").alias("count"))
        model = label_model(patterns, scratch(marked, "marked"), n, prior, rules.rounds)
    else:
        seed = np.array([0.9, 0.1, *[0.5] * (n - 2)])
        model = LabelModel(0.1, np.stack((np.where(seed == 0.5, 0.5, 1 - seed), seed)), np.ones(n))

    def read(batch: pa.RecordBatch):
        v, c = bits(batch.column(0).to_numpy(), n), batch.column(1).to_numpy().astype(float)
        return np.column_stack((v, np.ones(len(v)))), model.posterior(v), c

    beta = fit(patterns, read, n + 1) if prior else model.linear()
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            masks = np.array([voters.mask(a, b) for a, b in zip(utf8(column), utf8(column, lower=True))], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(bits(masks, n) @ beta[:-1] + beta[-1]))], names=[*batch.schema.names, "toxicity"])

    return mapped(docs, score, "toxicity double")


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs``, in all its columns, without the rows that score ``threshold`` or more."""
    return scores(plain(docs, "doc_id", "text"), labels, **options).where(F.col("toxicity") < threshold).drop("toxicity").toDF(*docs.columns)
