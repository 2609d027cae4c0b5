"""Exact clusters, runs of words and merge-type pieces against plain loops and the public library."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from readkin.llm import centroids, periods, pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- clusters ---


def lloyd(rows, k, rounds, dim, scale):
    """Plain rounds over Python integers: ``{vec_id: (cluster, distance)}`` of unique ids, and the centroids."""
    whole = {i: [int(np.floor(float(np.float32(x)) * scale)) for x in v] for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)}
    first = sorted(whole, key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())[:k]
    c = [list(whole[i]) for i in first]

    def assign():
        return {i: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c)) for i, v in whole.items()}

    for _ in range(rounds):
        near = assign()
        for j in range(len(c)):
            own = [whole[i] for i, (_, at) in near.items() if at == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    return {i: (j, d) for i, (d, j) in assign().items()}, c


def check(spark, rows, k, rounds, dim, scale):
    got = centroids.clusters(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=k, rounds=rounds, dim=dim, scale=scale).collect()
    want, c = lloyd(rows, k, rounds, dim, scale)
    assert {r.vec_id: (r.cluster, r.distance) for r in got} == want and len(got) == len(want)
    for r in got:
        assert r.inertia == sum(d for _, d in want.values()) and r.cluster_inertia == sum(d for j, d in want.values() if j == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()


@pytest.mark.parametrize("spread", [1.0, 60_000.0])  # the second is over what doubles add exactly
def test_clusters_equal_plain_rounds(spark, spread):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * spread).tolist()) for i in range(300)]
    rows += [(1000, [1.0] * 5), (1001, None), (1002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1003, [float("nan")] * 6), (1004, [float("inf")] + [0.0] * 5), (1005, [])]
    check(spark, rows, k=9, rounds=4, dim=6, scale=256)


def test_clusters_of_ties_and_equal_starts(spark):
    rows = [(i, [float(i % 3), float(i % 2)]) for i in range(40)]  # six points, so starts coincide and clusters stay empty
    check(spark, rows, k=12, rounds=5, dim=2, scale=4)


def test_clusters_settle_early_and_fewer_rows_than_centroids(spark):
    check(spark, [(i, [float(i), 0.0]) for i in range(5)], k=40, rounds=5, dim=2, scale=1)


def test_clusters_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, owner string, `a.b` int, transfer int"
    df = spark.createDataFrame([(None, [1.0, 2.0], "x", 1, 1), (1, [1.0, 2.0], "x", 1, 1), (1, [1.0, 2.0], "x", 1, 1)], schema)
    got = centroids.clusters(df, k=2, dim=2).collect()
    assert len(got) == 3 and {r.distance for r in got} == {0} and {r.cluster for r in got} == {0}
    assert centroids.clusters(df.limit(0), k=2, dim=2).collect() == []
    with pytest.raises(Exception, match="over"):
        centroids.clusters(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<float>"), k=2, dim=2).collect()


def test_round_compares_changed_centroids_only():
    """An owner that stayed is told from changed centroids and the distance at hand; a wrong distance at hand shows that it is used."""
    v, c = np.array([[0, 0], [10, 0]]), np.array([[1, 0], [9, 0], [4, 0]])
    owner, distance = centroids.reassigned(v, np.array([0, 1]), np.array([1, 1]), c, np.array([False, False, True]))
    assert owner.tolist() == [0, 1] and distance.tolist() == [1, 1]
    owner, distance = centroids.reassigned(v, np.array([0, 1]), np.array([17, 1]), c, np.array([False, False, True]))
    assert owner.tolist() == [2, 1] and distance.tolist() == [16, 1]
    owner, distance = centroids.reassigned(v, np.array([2, 1]), np.array([16, 1]), np.array([[4, 0], [9, 0], [4, 0]]), np.array([True, False, False]))
    assert owner.tolist() == [0, 1]  # equally near: the smaller number


# --- runs ---


def plain_runs(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            smallest = next(p for p in range(1, q + 1) if all(w[x] == w[x + p] for x in range(i, i + n - p))) if n >= max(least, times * q) else 0
            if smallest == q:
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng):
    w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(0, 90))]
    for _ in range(rng.randrange(0, 4)):
        unit = [rng.randrange(rng.choice([1, 2, 40])) for _ in range(rng.randrange(1, 60))]
        w += (unit * 12)[: rng.randrange(1, 260)] + [rng.randrange(60) for _ in range(rng.randrange(0, 20))]
    return w


@pytest.mark.parametrize("least, times", [(24, 3), (3, 3), (10, 4), (100, 3)])
def test_runs_equal_plain_loops(least, times):
    rng = random.Random(least + times)
    some = 0
    for _ in range(150):
        w = made(rng)
        want = plain_runs(w, least, times)
        assert periods.find_runs(np.array(w, np.int64), least, times) == want
        some += len(want)
    assert some > 50


def test_runs_of_long_texts():
    n = 30_000
    assert periods.find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert periods.find_runs(np.arange(n)) == []
    unit = np.arange(7000)
    assert periods.find_runs(np.concatenate((unit, unit, unit, unit[:5]))) == [(0, 21005, 7000)]
    two = np.concatenate((np.tile(unit[:50], 100), unit[100:200], np.tile(unit[:50], 100)))
    assert periods.find_runs(two) == [(0, 5000, 50), (5100, 5000, 50)]


def test_run_columns(spark):
    rows = [(1, "x " + "a b c " * 10 + "y"), (2, None), (3, ""), (4, " \n\t "), (5, "w " * 23), (6, "w\x0b" * 24), (6, "w\x0b" * 24), (None, "é x")]
    got = periods.runs(spark.createDataFrame(rows, "doc_id long, text string").withColumn("q", F.lit(1))).collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (32, [(1, 30, 3)], "x a b c y"), (0, [], ""), (0, [], ""), (0, [], ""), (23, [], " ".join(["w"] * 23)), (24, [(0, 24, 1)], "w"), (24, [(0, 24, 1)], "w"), (1, [], "é x"),
    ]
    assert periods.runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        periods.runs(spark.createDataFrame([], "text string, runs int"))


def test_planted_stretches(spark):
    import zlib

    rows = [(i, " ".join(f"w{j}" for j in range(1 + i * 7 % 90))) for i in range(60)] + [(61, None), (None, "a b"), (62, "\n")]
    for r in queries.planted(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text = dict(rows)[r.doc_id]
        h, w = zlib.crc32(str(r.doc_id).encode()), WORDS.findall(text or "")
        if r.doc_id is not None and h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert WORDS.findall(r.text) == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        else:
            assert r.text == text


# --- pieces ---


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.read_vocabulary(MODEL))


def odd_texts():
    rng = random.Random(5)
    letters = ["a", "e", "n", "t", "s", "i", " ", " ", "  ", "\n", "\t", "é", "ß", "梦", "𠀀", "▁", "<0x0A>", "<s>", "\x00", "�", "0", "1", ".", "=", "-", "the", "ing", "́", "अ"]
    yield from ("", " ", "   ", "\n", "▁", "</s>", "a" * 3000, " " * 1001, "ab" * 700, "=" * 333, "日本語" * 50, "\U0001f600‍\U0001f525", "\x7f\x80")
    for _ in range(1500):
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(1, 60)))


def test_pieces_equal_the_library(encoder, model):
    decoder = pieces.Decoder(encoder.vocabulary)
    for text in odd_texts():
        ids = model.encode(text)
        assert encoder.encode(text) == ids, text
        assert decoder.decode(ids) == model.decode(ids), text


def test_pieces_step_back(encoder):
    """Some texts need a longest match undone; without units too, pieces are those of plain merging."""
    undone = 0
    for text in odd_texts():
        if 0 < len(text) < 200:
            unit = "▁" + text.replace(" ", "▁")
            got = encoder.split(unit)
            assert got == encoder.merge(unit)
            longest = max((p for p in encoder.shorter if unit.startswith(p)), key=len, default=unit[0])
            undone += got[0] != longest
    assert undone > 10


def test_decoding_any_ids(model, encoder):
    decoder, rng = pieces.Decoder(encoder.vocabulary), random.Random(8)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), 259, model.piece_to_id("▁")]) for _ in range(rng.randrange(0, 12))]
        assert decoder.decode(ids) == model.decode(ids), ids


def test_piece_columns(spark, model):
    rows = [(1, "Hello  wörld\n"), (2, None), (3, ""), (1, "Hello  wörld\n"), (4, "long " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a.b", F.lit(1))
    got = pieces.decode(pieces.encode(df, MODEL), MODEL).collect()
    assert [r.ids for r in got] == [model.encode(t or "") for _, t in rows]
    assert [r.decoded for r in got] == [t or "" for _, t in rows]
    assert pieces.encode(df.limit(0), MODEL).collect() == []
    assert [r.decoded for r in pieces.decode(spark.createDataFrame([(None,), ([1, 2],)], "ids array<int>"), MODEL).collect()] == [None, ""]
    with pytest.raises(ValueError):
        pieces.encode(df.withColumn("ids", F.lit(1)), MODEL)


def test_whole_query_equals_the_library(spark, model):
    rows = {r.doc_id: r for r in queries.op13_merge_pieces(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for d in docs:
        ids = model.encode(d.text or "", num_threads=1)
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_texts_of_a_column(model, encoder):
    """Lists of ids straight from an Arrow column, a slice with null and empty rows among them."""
    words = ["naïve words", None, "", "日本 ,###"]
    column = pa.array([None if w is None else encoder.encode(w) for w in ["skipped", *words]], pa.list_(pa.int32())).slice(1)
    assert pieces.Decoder(encoder.vocabulary).texts(column).to_pylist() == [None if w is None else model.decode(model.encode(w)) for w in words]
