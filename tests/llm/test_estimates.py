"""Estimates against plain loops: the label model, site posteriors, robust distances."""

import math
import random

import numpy as np

from readkin.llm import outliers, quality, toxicity


def test_label_model_by_loops(spark):
    rng = random.Random(1)
    n, rounds, prior = 4, 3, 0.3
    rows = [([int(rng.random() < (0.7 if y else 0.2)) for _ in range(n)], y) for y in (int(rng.random() < 0.3) for _ in range(300))]
    mask = lambda v: sum(b << k for k, b in enumerate(v))
    count, gold = {}, {}
    for k, (v, y) in enumerate(rows):
        count[mask(v)] = count.get(mask(v), 0) + 1
        if k % 5 == 0:
            gold[mask(v), y] = gold.get((mask(v), y), 0) + 1
    patterns = spark.createDataFrame(list(count.items()), "mask long, count long")
    marked = spark.createDataFrame([(m, y, c) for (m, y), c in gold.items()], "mask long, toxic int, count long")
    got = toxicity.label_model(patterns, marked, n, prior, rounds)
    known = [r for k, r in enumerate(rows) if k % 5 == 0]
    fixed = [[sum(v[i] for v, y in known if y == c) for i in range(n)] + [sum(y == c for _, y in known)] for c in (0, 1)]
    rate = [[(fixed[c][i] + 0.5) / (fixed[c][n] + 1) for i in range(n)] for c in (0, 1)]
    weight = [1.0] * n

    def posterior(v):
        z = math.log(prior / (1 - prior))
        for i in range(n):
            a, b = (rate[1][i], rate[0][i]) if v[i] else (1 - rate[1][i], 1 - rate[0][i])
            z += weight[i] * math.log(a / b)
        return 1 / (1 + math.exp(-z))

    for r in range(rounds + 1):
        q = [posterior(v) for v, _ in rows]
        w = [[1 - x for x in q], q]
        if r < rounds:
            rate = [[(sum(x * v[i] for x, (v, _) in zip(w[c], rows)) + fixed[c][i] + 0.5) / (sum(w[c]) + fixed[c][n] + 1) for i in range(n)] for c in (0, 1)]
            weight = [1 / math.sqrt(n)] * n
    weight = []
    for i in range(n):
        total = 0.0
        for j in range(n):
            best = 0.0
            for c in (0, 1):
                m = [sum(x * v[k] for x, (v, _) in zip(w[c], rows)) / sum(w[c]) for k in (i, j)]
                cov = sum(x * v[i] * v[j] for x, (v, _) in zip(w[c], rows)) / sum(w[c]) - m[0] * m[1]
                best = max(best, abs(cov) / math.sqrt(m[0] * (1 - m[0]) * m[1] * (1 - m[1])))
            total += best**2 if i != j and best > 0.3 else 0
        weight.append(1 / (1 + total))
    assert np.allclose(got.rate, rate) and np.allclose(got.weight, weight)


def test_site_posteriors_by_loops(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("alpha beta gamma delta of the and".split())
    rows, marks = [], []
    for i in range(200):
        good = rng.random() < (0.9 if i % 3 else 0.3)
        t = " ".join(word() for _ in range(40))
        rows.append((i, t if good else t.upper() + " !! !!", rng.choice(["en", None]), f"s{i % 3}"))
        marks.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.classify(docs, spark.createDataFrame(marks, "doc_id long, quality int")).collect()}
    p = {i: 1 / (1 + math.exp(-got[i].evidence)) for i in got}
    host, path = {i: r[3] for i, r in enumerate(rows)}, {i: (r[3], r[2]) for i, r in enumerate(rows)}
    gather = lambda key: {k: [p[i] for i in p if key[i] == k] for k in set(key.values())}
    hosts, paths = gather(host), gather(path)
    prior = sum(p.values()) / len(p)

    def strength(sites, mean):
        sites = [(k, v) for k, v in sites.items() if len(v) > 1]
        spread = sum(len(v) * (sum(v) / len(v) - mean(k)) ** 2 for k, v in sites)
        noise, total = sum(mean(k) * (1 - mean(k)) for k, _ in sites), sum(len(v) * mean(k) * (1 - mean(k)) for k, v in sites)
        rho = (spread - noise) / (total - noise)
        return min(max(1 / rho - 1, 2.0), 1000.0) if rho > 0 else 1000.0

    k_host = strength(hosts, lambda _: prior)
    post = {k: (sum(v) + k_host * prior) / (len(v) + k_host) for k, v in hosts.items()}
    k_path = strength(paths, lambda k: post[k[0]])
    for i, r in got.items():
        v = paths[path[i]]
        rest = min(max((max(sum(v) - p[i], 0) + k_path * post[host[i]]) / (len(v) - 1 + k_path), 1e-4), 1 - 1e-4)
        z = r.evidence + math.log(rest / (1 - rest)) - math.log(prior / (1 - prior))
        assert abs(r.host_posterior - post[host[i]]) < 1e-9 and abs(r.path_posterior - rest) < 1e-9 and abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9
        assert (r.n_host, r.n_path) == (len(hosts[host[i]]), len(v))


def test_robust_distances_by_loops(spark):
    """Concentration steps from three starts, written again with arrays of one group."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 2)) @ np.array([[1.0, 0.6], [0, 0.5]])
    x[:12] += 9
    df = spark.createDataFrame([(k, "a", *map(float, v)) for k, v in enumerate(x)] + [(1000, "b", 0.0, 0.0)], "k long, g string, x0 double, x1 double")
    got = {r.k: r.distance for r in outliers.robust_distances(df, ["g"], 2, support=0.75, steps=4, least=60, ridge=0.02).collect()}

    def quantile(v, p):
        return np.sort(v)[max(0, math.ceil(p * len(v)) - 1)]

    med = np.array([quantile(x[:, i], 0.5) for i in range(2)])
    width = np.sqrt((np.abs(x - med).mean(0) * 1.2533) ** 2 + 0.02)
    z = (x - med) / width
    covariance = lambda v: np.cov(v.T, bias=True) + 0.02 * np.eye(2)
    turned = [np.eye(2), covariance(np.tanh(z)), covariance(z / np.sqrt(((z**2).sum(1, keepdims=True) + 1e-12) / 2))]
    best = None
    for s in turned:
        c, s = med, s * np.outer(width, width)
        for _ in range(4):
            d = np.einsum("ni,ij,nj->n", x - c, np.linalg.inv(s), x - c)
            near = x[d <= quantile(d, 0.75)]
            c, s = near.mean(0), covariance(near)
        if best is None or np.linalg.slogdet(s)[1] < best[0] - 1e-12:
            best = (np.linalg.slogdet(s)[1], c, s)
    _, c, s = best
    d = np.einsum("ni,ij,nj->n", x - c, np.linalg.inv(s), x - c)
    d *= min(1.0, 2 * (1 - 2 / 18) ** 3 / quantile(d, 0.5))
    assert np.allclose([got[k] for k in range(150)], d) and min(d[:12]) > max(d[12:])
