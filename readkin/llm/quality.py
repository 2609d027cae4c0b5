"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, utf8, widened
from .linear import fit
from .outliers import statistics_of

#: Features of a text; the last is the constant.
N_FEATURES = 10


@dataclass(frozen=True)
class Rules:
    sample: int = 50_000  # most labelled rows that the document classifier learns from
    most_strength: float = 1000.0  # most prior documents a site is shrunk by
    least_strength: float = 2.0
    threshold: float = 0.5


def features(texts: list[bytes]) -> np.ndarray:
    """Transformed statistics of whole texts, the last column 1."""
    s = np.array([(*statistics_of(t), t.count(b"!!"), len(set(t.split()))) for t in texts], float).reshape(-1, 9)
    words, chars, symbols, dup_lines, repeats, upper, lines, bangs, kinds = s.T
    n = np.maximum(words, 1)
    return np.column_stack((
        np.log(n) / 4, np.log((chars + 120) / (n + 20)), np.log((symbols + 0.05 * n + 1) / (n + 20)), np.minimum(1, (dup_lines + 0.0) / np.maximum(1, lines)),
        repeats / n, np.log((upper + 0.1 * n + 1) / (n + 20)), bangs / n, kinds / n, (words < 10).astype(float), np.ones(len(n)),
    ))


def evidence(docs: DataFrame, labels: DataFrame, learn: Column | None = None, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with ``evidence``: the log-odds of quality of each whole text, from a linear classifier alone.

    The classifier learns from at most ``rules.sample`` labelled rows, those of
    the least hashed doc_ids; that also bounds the broadcast.
    """
    at = docs.columns.index("text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(utf8(batch.column(at))).astype(np.float32)
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *batch.columns[at + 1 :], rows], names=[*(f.name for i, f in enumerate(batch.schema) if i != at), "__features"])

    base = docs.drop("text")
    table = scratch(docs.mapInArrow(measure, widened(base, "__features array<float>")), "features")
    marks = labels.where("doc_id is not null and quality is not null")
    marks = marks if learn is None else marks.where(F.coalesce(learn, F.lit(False)))
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(rules.sample)
    known = scratch(table.select("doc_id", "__features").join(F.broadcast(marks), "doc_id").select("__features", F.col("quality").cast("double").alias("quality")), "labelled")

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, N_FEATURES)

    def read(batch: pa.RecordBatch):
        return matrix(batch.column(0)), np.clip(batch.column(1).to_numpy(), 0, 1), np.ones(batch.num_rows)

    beta = fit(known, read, N_FEATURES)
    held = table.columns.index("__features")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.clip(matrix(batch.column(held)) @ beta, -12, 12)
            yield pa.RecordBatch.from_arrays([*batch.columns[:held], *batch.columns[held + 1 :], pa.array(z)], names=[*(f.name for i, f in enumerate(batch.schema) if i != held), "evidence"])

    return table.mapInArrow(apply, widened(base, "evidence double"))


def _strength(sites: DataFrame, prior: Column, rules: Rules) -> float:
    """Prior documents of a beta law over the sites' shares, by moments, between the bounds of the rules.

    ``sites(n, good)`` with ``prior``, the mean of each site's law.  Counts are of
    documents; the excess of the spread of shares over binomial noise gives the
    strength.
    """
    p = F.col("good") / F.col("n")
    noise = prior * (1 - prior)
    got = sites.where("n > 1").agg(F.sum(F.col("n") * F.pow(p - prior, F.lit(2))).alias("spread"), F.sum(noise).alias("noise"), F.sum(F.col("n") * noise).alias("total"), F.count("*").alias("k")).first()
    if not got.k or not got.total or got.total <= got.noise:
        return rules.most_strength
    rho = (got.spread - got.noise) / (got.total - got.noise)  # correlation of two documents of a site
    return float(np.clip(1 / rho - 1, rules.least_strength, rules.most_strength)) if rho > 0 else rules.most_strength


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", learn: Column | None = None, rules: Rules = Rules()) -> DataFrame:
    """``doc_id, evidence, n_host, host_posterior, n_path, path_posterior, score, kept`` of every row of ``docs``.

    A hierarchy of beta laws: all documents, hosts, and paths in a host.  Every
    document counts in its site with the classifier's probability; a host's
    share is shrunk towards the global share by a strength estimated from the
    spread of the hosts, a path's share towards its host's posterior likewise.
    The score moves the document's own log-odds by those of its path against the
    global prior, the site's own document left out.

    Site tables come from map-side-combined sums and are joined back by site, so a
    host of any share of the rows is only a few partial sums a task; Spark
    broadcasts them if small and else splits skewed hosts.

    A null text counts as empty; null hosts and paths are sites of their own;
    labels that are null or of no document are not used, of several labels of a doc_id the
    least counts; without labels all evidence is 0 and everything is kept;
    repeated rows are scored alike; an empty table gives no row; other columns are
    not read.
    """
    base = docs.select("doc_id", "text", F.coalesce(F.concat(F.lit("h"), F.col(host).cast("string")), F.lit("")).alias("host"), F.coalesce(F.concat(F.lit("p"), F.col(path).cast("string")), F.lit("")).alias("path"))
    scored = scratch(evidence(base, labels, learn, rules).withColumn("p", 1 / (1 + F.exp(-F.col("evidence")))), "evidence")
    paths = scratch(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    if not total.n:
        return scored.select("doc_id", "evidence", F.lit(0).cast("long").alias("n_host"), F.lit(0.5).alias("host_posterior"), F.lit(0).cast("long").alias("n_path"), F.lit(0.5).alias("path_posterior"), F.lit(0.5).alias("score"), F.lit(True).alias("kept"))
    prior = min(max(total.good / total.n, 1e-4), 1 - 1e-4)
    host_k = _strength(hosts, F.lit(prior), rules)
    hosts = scratch(hosts.select("host", F.col("n").alias("n_host"), ((F.col("good") + host_k * prior) / (F.col("n") + host_k)).alias("host_posterior")), "hosts")
    both = scratch(paths.join(hosts, "host"), "sites")
    path_k = _strength(both, F.col("host_posterior"), rules)
    joined = scored.join(both.withColumnsRenamed({"n": "n_path", "good": "path_good"}), ["host", "path"])
    rest = (F.greatest(F.col("path_good") - F.col("p"), F.lit(0.0)) + path_k * F.col("host_posterior")) / (F.col("n_path") - 1 + path_k)
    rest = F.least(F.greatest(rest, F.lit(1e-4)), F.lit(1 - 1e-4))
    logit = F.col("evidence") + F.log(rest / (1 - rest)) - float(np.log(prior / (1 - prior)))
    score = 1 / (1 + F.exp(-logit))
    return joined.select("doc_id", "evidence", "n_host", "host_posterior", "n_path", rest.alias("path_posterior"), score.alias("score"), (score >= rules.threshold).alias("kept"))
