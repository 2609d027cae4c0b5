"""Quality rules: text statistics and minimum-covariance-determinant outliers per language and source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, scratch, utf8, widened

_SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
#: White space of the word pattern; ``bytes.split`` also knows no other.
_LETTERS = bytes(range(65, 91))

STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_lines long"

#: The transformed vector, name by name.
VECTOR = ("length", "word_length", "symbols", "repeats", "upper")


def repeated_words(ids: np.ndarray, window: int = 5) -> int:
    """Words that lie in a window of ``window`` words found twice or more among ``ids``."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code = ids[:n].astype(np.int64)
    for k in range(1, window):
        wide = int(ids.max()) + 1
        if int(code.max()) >= (1 << 62) // wide:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        code = code * wide + ids[k : k + n]
    _, at, count = np.unique(code, return_inverse=True, return_counts=True)
    hit = count[at] > 1
    if not hit.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    where = np.nonzero(hit)[0]
    np.add.at(edge, where, 1)
    np.add.at(edge, where + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics_of(text: bytes) -> tuple[int, ...]:
    """The numbers of ``STATISTICS`` for one whole UTF-8 text."""
    words = text.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    joined = b"".join(words)
    chars = len(joined) - sum(map(joined.count, _CONTINUED)) if not joined.isascii() else len(joined)
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper = len(joined) - len(joined.translate(None, _LETTERS))
    return len(words), chars, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(ids), upper, len(lines)


_CONTINUED = [bytes([c]) for c in range(128, 192)]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``STATISTICS`` over each whole text; a null text is an empty one."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics_of(t) for t in utf8(batch.column(at))], np.int64).reshape(-1, 7)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[:, k]) for k in range(7))], names=[*batch.schema.names, *(f.split()[0] for f in STATISTICS.split(", "))])

    return mapped(docs, run, STATISTICS)


def vector() -> list[Column]:
    """Statistics as near-normal numbers: logarithms of counts, log-odds-like ratios shrunk towards usual values in short texts."""
    n = F.greatest("n_words", F.lit(1)).cast("double")
    return [
        F.log(n),
        F.log((F.col("word_chars") + 120) / (n + 20)),
        F.log((F.col("n_symbols") + 0.01 * n + 1) / n) * 0.5,
        F.log((F.col("n_repeat_words") + 0.2 * n + 1) / n),
        F.log((F.col("n_upper") + 0.05 * n + 4) / (n + 20)),
    ]


def _moments(d: int, weight: Column | None = None) -> list[Column]:
    """Count, sums and sums of products of x0..x(d-1)."""
    on = (lambda c: c) if weight is None else (lambda c: F.when(weight, c))
    out = [F.count(on(F.lit(1))).cast("double").alias("m")]
    out += [F.coalesce(F.sum(on(F.col(f"x{i}"))), F.lit(0.0)).alias(f"s{i}") for i in range(d)]
    out += [F.coalesce(F.sum(on(F.col(f"x{i}") * F.col(f"x{j}"))), F.lit(0.0)).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    return out


def _estimates(moments: DataFrame, keys: list[str], d: int, ridge: float) -> DataFrame:
    """``keys, c0.., w0_0..``: centre and inverse covariance of every group, from its moments; a row a group."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            m = np.maximum(col("m"), 1)
            c = np.stack([col(f"s{i}") / m for i in range(d)], axis=1).reshape(-1, d)
            s = np.empty((len(m), d, d))
            for i in range(d):
                for j in range(i, d):
                    s[:, i, j] = s[:, j, i] = col(f"p{i}_{j}") / m - c[:, i] * c[:, j]
            s += np.eye(d) * ridge
            w = np.linalg.inv(s) if len(m) else s
            cols = [c[:, i] for i in range(d)] + [w[:, i, j] for i in range(d) for j in range(i, d)] + [np.linalg.slogdet(s)[1] if len(m) else m]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in keys), *map(pa.array, cols)], names=[*keys, *(f"c{i}" for i in range(d)), *(f"w{i}_{j}" for i in range(d) for j in range(i, d)), "logdet"])

    more = ", ".join([f"c{i} double" for i in range(d)] + [f"w{i}_{j} double" for i in range(d) for j in range(i, d)] + ["logdet double"])
    return moments.mapInArrow(invert, widened(moments.select(*keys), more))


def _distance(d: int) -> Column:
    """Squared Mahalanobis distance of x to c under w."""
    dx = [F.col(f"x{i}") - F.col(f"c{i}") for i in range(d)]
    total = F.lit(0.0)
    for i in range(d):
        for j in range(i, d):
            total = total + dx[i] * dx[j] * F.col(f"w{i}_{j}") * (1 if i == j else 2)
    return total


def robust_distances(rows: DataFrame, keys: list[str], d: int, support: float = 0.75, steps: int = 6, least: int = 60, ridge: float = 0.02) -> DataFrame:
    """``rows(keys, x0..)`` with ``distance``: squared robust Mahalanobis distance inside the row's group.

    Minimum covariance determinant by concentration steps on all rows: each step
    keeps, in every group, the ``support`` share of rows nearest to the centre
    under the present estimate and estimates again, which never raises the
    determinant.  Three starts are followed in each group, and the estimate of the least
    determinant is taken.  Distances are scaled down so that their median is
    that of the chi-square law, never up: ``ridge``, added to all variances, is the
    least spread that counts.  A step is one map-side-combined aggregation and
    one join with a row a group, so a group of any share of the rows is spread
    over all tasks.  Groups of fewer than ``least`` rows are one
    group, apart from that of null keys.
    """
    x = [f"x{i}" for i in range(d)]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    small = F.coalesce(F.col("__n"), F.lit(0)) < least
    marked = _joined(rows, sizes, keys)
    rows = scratch(marked.select(*[c for c in marked.columns if c not in (*keys, "__n")], *[F.when(~small, F.col(k)).alias(k) for k in keys], small.alias("__pooled")), "vectors")
    keys = [*keys, "__pooled"]  # a group of null keys is not that of the small groups
    both = rows.select(*keys, *x)
    now = scratch(_starts(both, keys, d, ridge), "starts")
    for _ in range(steps):
        measured = _joined(both, now, keys).select(*keys, "__start", *x, _distance(d).alias("distance"))
        cuts = scratch(measured.groupBy(*keys, "__start").agg(F.percentile_approx("distance", support, 1000).alias("__cut")), "cuts")
        inside = _joined(measured, cuts, [*keys, "__start"])
        now = scratch(_estimates(inside.groupBy(*keys, "__start").agg(*_moments(d, F.col("distance") <= F.col("__cut"))), [*keys, "__start"], d, ridge), "estimates")
    numbers = [c for c in now.columns if c not in (*keys, "__start")]
    least_det = now.groupBy(*keys).agg(F.min(F.struct("logdet", "__start", *[c for c in numbers if c != "logdet"])).alias("b"))
    now = scratch(least_det.select(*keys, *[F.col(f"b.{c}").alias(c) for c in numbers]), "least")
    measured = _joined(rows, now, keys).select(*rows.columns, _distance(d).alias("distance"))
    middle = scratch(measured.groupBy(*keys).agg(F.percentile_approx("distance", 0.5, 1000).alias("__middle")), "middles")
    chi_median = d * (1 - 2 / (9 * d)) ** 3
    scale = F.least(F.lit(1.0), chi_median / F.greatest(F.col("__middle"), F.lit(1e-9)))
    return _joined(measured, middle, keys).withColumn("distance", F.col("distance") * scale).drop("__middle", "__pooled")


def _starts(both: DataFrame, keys: list[str], d: int, ridge: float) -> DataFrame:
    """``keys, __start, c0.., w0_0.., logdet``: three first estimates of every group.

    The centre of all is the coordinate-wise median.  The scatter is that of the mean absolute
    deviations alone (0), of hyperbolic tangents of the rows in units of these (1),
    or of their directions (2).
    """
    median = both.groupBy(*keys).agg(*[F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"m{i}") for i in range(d)])
    spread = _joined(both, median, keys).groupBy(*keys).agg(*[F.first(f"m{i}").alias(f"m{i}") for i in range(d)], *[F.avg(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))).alias(f"d{i}") for i in range(d)])
    spread = scratch(spread, "spreads")
    width = [F.sqrt(F.pow(F.col(f"d{i}") * 1.2533, F.lit(2)) + ridge) for i in range(d)]
    units = _joined(both, spread, keys).select(*keys, *[((F.col(f"x{i}") - F.col(f"m{i}")) / width[i]).alias(f"z{i}") for i in range(d)])
    norm = F.sqrt(sum((F.pow(f"z{i}", F.lit(2)) for i in range(d)), F.lit(1e-12)) / d)
    bent = F.array(*[F.struct(F.lit(s).alias("__start"), *[c.alias(f"x{i}") for i, c in enumerate(v)]) for s, v in ((1, [F.tanh(f"z{i}") for i in range(d)]), (2, [F.col(f"z{i}") / norm for i in range(d)]))])
    turned = units.select(*keys, F.explode(bent).alias("v")).select(*keys, "v.*")
    shapes = _estimates(turned.groupBy(*keys, "__start").agg(*_moments(d)), [*keys, "__start"], d, ridge)
    w = [(i, j) for i in range(d) for j in range(i, d)]
    named, none = [F.col(f"m{i}").alias(f"c{i}") for i in range(d)], F.lit(0.0).alias("logdet")
    # The inverse covariance of x is that of the units over both widths.
    curved = _joined(shapes.select(*keys, "__start", *[f"w{i}_{j}" for i, j in w]), spread, keys).select(*keys, "__start", *named, *[(F.col(f"w{i}_{j}") / width[i] / width[j]).alias(f"w{i}_{j}") for i, j in w], none)
    straight = spread.select(*keys, F.lit(0).alias("__start"), *named, *[(1 / F.pow(width[i], F.lit(2)) if i == j else F.lit(0.0)).alias(f"w{i}_{j}") for i, j in w], none)
    return straight.union(curved)


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe left join with one row a group; Spark broadcasts ``groups`` where its size allows and else splits skewed keys."""
    named = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(named, on, "left").drop(*[f"__{k}" for k in keys])


def judge(docs: DataFrame, keys: tuple[str, str] = ("lang", "source"), cutoff: float = 100.0, support: float = 0.75, least: int = 60) -> DataFrame:
    """Statistics and verdict of every row of ``docs(doc_id, text, lang, source)``.

    ``base_failed`` are texts of fewer than 10 words, or of which over 20 % of the
    words lie in repeated five-word windows.  All other rows get a squared robust
    distance in their language and source; ``kept`` is false where it is over
    ``cutoff``.  (The tails of text statistics are heavier than normal ones, so
    the cutoff stands well above the chi-square quantile.)

    A null text counts as empty and fails; null is a language and a source like
    others; groups with fewer than ``least`` rows are measured together, as one group; repeated rows are judged alike; an empty table
    gives no row; other columns are not read.
    """
    d = len(VECTOR)
    raw = docs.select("doc_id", "text", *[F.col(k).alias(f"g{i}") for i, k in enumerate(keys)])
    base = scratch(statistics(raw).drop("text"), "statistics")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    base = base.withColumn("base_failed", failed)
    good = base.where(~F.col("base_failed")).select("*", *[v.alias(f"x{i}") for i, v in enumerate(vector())])
    out = robust_distances(good, ["g0", "g1"], d, support=support, least=least)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    kept = out.select(*names, (F.col("distance") <= cutoff).alias("kept"), "distance")
    return kept.unionByName(base.where("base_failed").select(*names, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")))
