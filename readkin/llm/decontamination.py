"""Benchmark decontamination: block-max pruned BM25 retrieval of test items, then overlap checks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import mapped, scratch, utf8

#: ASCII other than letters and digits separates words.
_BLANK = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class Rules:
    """Parameters of retrieval and verification."""

    passage: int = 128  # words of a training passage
    stride: int = 64
    part: int = 64  # longest indexed part of an item, in words
    threshold: float = 0.6  # BM25 score of a passage over the part's score of itself
    k1: float = 1.2
    b: float = 0.75
    block: int = 16  # parts of a posting block
    shingle: int = 5
    overlap: float = 0.8  # share of shingles that verifies
    index_bytes: int = 4 << 20  # most item text of one index, about


def words_of(text: bytes) -> list[bytes]:
    """Words of a lower-cased UTF-8 text."""
    return text.translate(_BLANK).split()


def _shingles(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def _question_answer(text: bytes) -> tuple[bytes, bytes]:
    """An item's last sentence or line is its answer; an item of one sentence is all question."""
    body = text.rstrip(b" \n\t\r.?!")
    cut = max(body.rfind(x) for x in (b". ", b"? ", b"! ", b"\n")) + 1
    return (text[:cut], text[cut:]) if cut > 0 else (text, b"")


class ImpactIndex:
    """BM25 impacts of item parts, each divided by the part's score of itself.

    Parts are stored in the order of their length, in blocks of ``rules.block``;
    every term knows its largest impact overall and in each of its blocks.
    """

    def __init__(self, items: list[tuple[int, bytes]], df: dict[bytes, int], n_parts: int, mean_length: float, rules: Rules):
        self.rules = rules
        self.items = []  # id and text; words and shingles of an item are made when it is verified
        parts = []
        for item_id, text in items:
            w = words_of(text)
            if not w:
                continue
            self.items.append((item_id, text))
            parts += [(len(self.items) - 1, p) for p in item_parts(w, rules.part)]
        parts.sort(key=lambda p: len(p[1]))
        self.owner = np.array([i for i, _ in parts], np.int64)
        self.ids: dict[bytes, int] = {}
        terms, owners, impacts = [], [], []
        for k, (_, w) in enumerate(parts):
            tf = Counter(w)
            norm = rules.k1 * (1 - rules.b + rules.b * len(w) / mean_length)
            w8 = {t: np.log(1 + (n_parts - df[t] + 0.5) / (df[t] + 0.5)) * c * (rules.k1 + 1) / (c + norm) for t, c in tf.items()}
            whole = sum(w8.values())
            for t, x in w8.items():
                terms.append(self.ids.setdefault(t, len(self.ids)))
                owners.append(k)
                impacts.append(x / whole)
        self.n_terms, self.n_parts = len(self.ids), len(parts)
        term, part, impact = np.array(terms, np.int64), np.array(owners, np.int64), np.array(impacts)
        by_term = np.lexsort((part, term))
        self.post_part, self.post_at = part[by_term], np.searchsorted(term[by_term], np.arange(self.n_terms + 1))
        self.bound = np.zeros(self.n_terms + 1)  # the last entry: words of no item
        np.maximum.at(self.bound, term, impact)
        # postings by part, for exact scores
        by_part = np.lexsort((term, part))
        self.part_term, self.part_impact, self.part_at = term[by_part], impact[by_part], np.searchsorted(part[by_part], np.arange(self.n_parts + 1))
        # the largest impact of a term in a block, keyed by term and block
        self.n_blocks = -(-self.n_parts // rules.block)
        self.block_key, inverse = np.unique(term * self.n_blocks + part // rules.block, return_inverse=True)
        self.block_max = np.zeros(len(self.block_key))
        np.maximum.at(self.block_max, inverse, impact)

    def retrieve(self, texts: list[list[bytes]]) -> set[tuple[int, int, int]]:
        """``(text, first word, item)`` of every passage and item part whose score reaches the threshold."""
        r, none = self.rules, self.n_terms
        get = self.ids.get
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ids = np.fromiter((get(w, none) for t in texts for w in t), np.int64, int(lengths.sum()))
        upto = np.concatenate(([0.0], np.cumsum(self.bound[ids])))
        begin = np.cumsum(lengths) - lengths
        n_win = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - r.passage) // r.stride)), 0)
        owner = np.repeat(np.arange(len(texts)), n_win)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
        lo = begin[owner] + k * r.stride
        hi = np.minimum(lo + r.passage, begin[owner] + lengths[owner])
        # Repeats only raise this sum, so it bounds the score of any part.
        hot = np.nonzero(upto[hi] - upto[lo] >= r.threshold - 1e-9)[0]
        found: set[tuple[int, int, int]] = set()
        for s in range(0, len(hot), 4096):
            some = hot[s : s + 4096]
            found |= self._score(ids, owner[some], lo[some], hi[some], lo[some] - begin[owner[some]])
        return found

    def _score(self, ids, owner, lo, hi, first) -> set[tuple[int, int, int]]:
        r, n = self.rules, hi - lo
        win = np.repeat(np.arange(len(lo)), n)
        term = ids[np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)]
        known = term < self.n_terms
        code = np.unique(win[known] * (self.n_terms + 1) + term[known])  # distinct terms of each passage
        win, term = code // (self.n_terms + 1), code % (self.n_terms + 1)
        # The pivot: in descending bound, terms from which on all others together stay below the threshold
        # cannot lift a part alone, so candidates come from the postings of the terms before it.
        order = np.lexsort((-self.bound[term], win))
        w, b = win[order], self.bound[term[order]]
        total = np.bincount(w, b, len(lo))
        before = np.cumsum(b) - b
        start = np.searchsorted(w, np.arange(len(lo)))
        before -= before[np.minimum(start, len(w) - 1)][w] if len(w) else 0
        essential = total[w] - before >= r.threshold - 1e-9
        w, t = w[essential], term[order][essential]
        count = self.post_at[t + 1] - self.post_at[t]
        at = np.repeat(self.post_at[t] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        pairs = np.unique(np.repeat(w, count) * self.n_parts + self.post_part[at])
        pw, pp = pairs // self.n_parts, pairs % self.n_parts
        # Block-max: the sum over the passage's terms of their largest impact in the part's block.
        cells, cell = np.unique(pw * self.n_blocks + pp // r.block, return_inverse=True)
        cw, cb = cells // self.n_blocks, cells % self.n_blocks
        size = np.bincount(win, minlength=len(lo))
        first_term = np.cumsum(size) - size
        bound = np.zeros(len(cells))
        for c in range(0, len(cells), 8192):
            m = size[cw[c : c + 8192]]
            tt = term[np.repeat(first_term[cw[c : c + 8192]] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
            key = tt * self.n_blocks + np.repeat(cb[c : c + 8192], m)
            i = np.minimum(np.searchsorted(self.block_key, key), len(self.block_key) - 1)
            bound[c : c + 8192] = np.bincount(np.repeat(np.arange(len(m)), m), np.where(self.block_key[i] == key, self.block_max[i], 0.0), len(m))
        live = bound[cell] >= r.threshold - 1e-9
        pw, pp = pw[live], pp[live]
        # Exact scores of the candidates that are left, term by term of the part.
        found: set[tuple[int, int, int]] = set()
        for c in range(0, len(pw), 16384):
            w, p = pw[c : c + 16384], pp[c : c + 16384]
            m = self.part_at[p + 1] - self.part_at[p]
            j = np.repeat(self.part_at[p] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            want = np.repeat(w, m) * (self.n_terms + 1) + self.part_term[j]
            i = np.minimum(np.searchsorted(code, want), len(code) - 1)
            score = np.bincount(np.repeat(np.arange(len(p)), m), np.where(code[i] == want, self.part_impact[j], 0.0), len(p))
            for x in np.nonzero(score >= r.threshold - 1e-9)[0].tolist():
                found.add((int(owner[w[x]]), int(first[w[x]]), int(self.owner[p[x]])))
        return found

    def verify(self, words: list[bytes], first: int, item: int) -> tuple[float, float, float]:
        """Overlap of the item, its question and its answer with the passage and an item's length around it."""
        w, whole, question, answer = _shingled(self.items[item][1], self.rules.shingle)
        near = words[max(0, first - len(w)) : first + self.rules.passage + len(w)]
        share = lambda s: sum(_within(near, x) if len(x) < self.rules.shingle else x in seen for x in s) / len(s) if s else 1.0
        seen = _shingles(near, self.rules.shingle)
        return share(whole), share(question), share(answer)


@lru_cache(maxsize=1024)
def _shingled(text: bytes, n: int) -> tuple[list[bytes], set, set, set]:
    """Words of an item, and shingles of all of it, its question and its answer."""
    q, a = _question_answer(text)
    w = words_of(text)
    return w, _shingles(w, n), _shingles(words_of(q), n), _shingles(words_of(a), n)


def _within(words: list[bytes], run: tuple[bytes, ...]) -> bool:
    return any(tuple(words[i : i + len(run)]) == run for i in range(len(words) - len(run) + 1))


def item_parts(words: list[bytes], longest: int) -> list[list[bytes]]:
    """An item in equal parts of at most ``longest`` words."""
    n = -(-len(words) // longest)
    return [words[i * len(words) // n : (i + 1) * len(words) // n] for i in range(n)]


def _part_words(items: DataFrame, rules: Rules) -> DataFrame:
    """``word, df, length``: in how many parts of items a word is, and how many words they have; the empty word stands for any part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            df: Counter[bytes] = Counter()
            length = 0
            for text in utf8(batch.column(0), lower=True):
                for part in item_parts(words_of(text), rules.part):
                    df.update({b"", *part})
                    length += len(part)
            yield pa.RecordBatch.from_pydict({"word": pa.array(df.keys(), pa.binary()), "df": pa.array(df.values(), pa.int64()), "length": pa.array([length * (w == b"") for w in df], pa.int64())})

    return items.select("text").mapInArrow(run, "word binary, df long, length long").groupBy("word").agg(F.sum("df").alias("df"), F.sum("length").alias("length"))


def indexes(benchmark: DataFrame, rules: Rules) -> Iterator[ImpactIndex]:
    """Indexes over all items of ``benchmark(item_id, text)``, one at a time, each over about ``rules.index_bytes`` of text at most.

    Document frequencies and lengths are those of the whole benchmark, counted by
    Spark.  Items are dealt by a hash of id and text.  Of the benchmark, the driver holds the items and the
    frequencies of one index, a bounded object that then goes to the tasks.
    """
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).where("text <> ''").distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    n = max(1, -(-2 * size // rules.index_bytes)) if size > rules.index_bytes else 1
    counts = scratch(_part_words(items, rules), "part-words") if n > 1 else _part_words(items, rules)
    for i in range(n):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        df = {bytes(r.word): r for r in (counts.join(_part_words(some, rules).select("word"), "word", "left_semi") if n > 1 else counts).collect()}
        if any_part := df.get(b""):
            rows = some.orderBy("item_id", "text").toArrow()
            held = list(zip(rows.column(0).to_pylist(), utf8(rows.column(1).combine_chunks(), lower=True)))
            yield ImpactIndex(held, {w: r.df for w, r in df.items()}, any_part.df, any_part.length / any_part.df, rules)


def _hits(texts: list[bytes], index: ImpactIndex) -> Iterator[tuple[int, int, float, float, float]]:
    """``(text, item number, overlaps)``: for each text and verified item, the passage that overlaps most of those that verify."""
    rules = index.rules
    for s in range(0, len(texts), 256):
        words = [words_of(t) for t in texts[s : s + 256]]
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for doc, first, item in index.retrieve(words):
            got = index.verify(words[doc], first, item)
            if got[0] >= rules.overlap or min(got[1:]) >= rules.overlap:
                best[doc, item] = max(got, best.get((doc, item), got))
        for (doc, item), (whole, q, a) in sorted(best.items()):
            yield s + doc, item, whole, q, a


def leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id, item_id, overlap, question_overlap, answer_overlap`` of every leak of an item into a document.

    Documents are cut into overlapping passages; every passage queries a BM25
    index of the items and retrieves all parts whose score reaches
    ``rules.threshold`` of the part's own; a retrieved item is a leak if at least
    ``rules.overlap`` of its five-word shingles, or of those of both its question
    and its answer, stand around the passage.

    Null and empty texts leak nothing and are not leaked; an item given twice is
    reported once under each item_id; repeated documents are reported as often
    as they come; empty tables give no row; other columns are not read.
    """
    kinds = [docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, overlap double, question_overlap double, answer_overlap double"
    out = None
    for index in indexes(benchmark, rules):
        if out is not None:
            out = scratch(out, "leaks")  # so that no plan holds more than one index

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = list(_hits(utf8(batch.column(1), lower=True), index))
                ids = [batch.column(0).take(pa.array([h[0] for h in hits], pa.int64())), pa.array([index.items[h[1]][0] for h in hits], to_arrow_type(kinds[1]))]
                yield pa.RecordBatch.from_arrays([*ids, *(pa.array([h[k] for h in hits], pa.float64()) for k in (2, 3, 4))], names=["doc_id", "item_id", "overlap", "question_overlap", "answer_overlap"])

        found = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs``, in all its columns, without the rows into whose text an item leaked."""
    at = docs.columns.index("text")
    for k, index in enumerate(indexes(benchmark, rules)):
        if k:
            docs = scratch(docs, "unleaked")

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in _hits(utf8(batch.column(at), lower=True), index)]] = False
                yield batch.filter(pa.array(keep))

        docs = mapped(docs, run)
    return docs
