"""Aligner, adapters, mates and FASTQ splits against plain loops over cells, stretches and places."""

import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from readkin import synth
from readkin.operators import adapters, align, mates, tables
from readkin.sources import readers

TURN = str.maketrans("ACGTN", "TGCAN")
LETTERS = "ACGT"


def turned(s):
    return s.translate(TURN)[::-1]


def bases(seed, n):
    return "".join(random.Random(seed).choices(LETTERS, k=n))


# --- aligner ---


def plain_score(seq, ref):
    """Best score by three tables, cell by cell."""
    low = -(10**6)
    m, n = len(seq), len(ref)
    h = [[0] * (n + 1)] + [[low] * (n + 1) for _ in range(m)]
    f = [[low] * (n + 1) for _ in range(m + 1)]
    e = [[low] * (n + 1) for _ in range(m + 1)]
    best = low
    for i in range(1, m + 1):
        for j in range(n + 1):
            f[i][j] = max(h[i - 1][j] - 6, f[i - 1][j]) - 1
            e[i][j] = max(h[i][j - 1] - 6, e[i][j - 1]) - 1 if j else low
            pair = h[i - 1][j - 1] + (1 if seq[i - 1] == ref[j - 1] and seq[i - 1] in LETTERS else -4) if j else low
            h[i][j] = max(-5, pair, f[i][j], e[i][j])
            best = max(best, h[i][j] - (5 if i < m else 0))
    return best


def told_score(seq, ref, start, cigar):
    """Score of a path, from its text."""
    ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDS])", cigar)]
    i, j, score = 0, start, 0
    for n, o in ops:
        if o == "M":
            score += sum(1 if x == y and x in LETTERS else -4 for x, y in zip(seq[i : i + n], ref[j : j + n]))
            i, j = i + n, j + n
        elif o == "S":
            score, i = score - 5, i + n
        else:
            score -= 6 + n
            i, j = i + n * (o == "I"), j + n * (o == "D")
    assert i == len(seq) and j <= len(ref)
    return score


def changed(rng, ref):
    x = list(ref)
    for _ in range(rng.randrange(0, 6)):
        x[rng.randrange(len(x))] = rng.choice("ACGTN")
    for _ in range(rng.randrange(0, 3)):
        k = rng.randrange(len(x))
        if rng.random() < 0.5:
            del x[k : k + rng.randrange(1, 9)]
        else:
            x[k:k] = [rng.choice(LETTERS) for _ in range(rng.randrange(1, 9))]
    s = "".join(x)[rng.randrange(0, 20) :]
    s = s + "".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 0, 12])))
    return turned(s) if rng.random() < 0.3 else s


@pytest.mark.parametrize("cells", [1 << 24, 20_000])
def test_aligner_equals_plain_tables(cells):
    rng = random.Random(11)
    ref = "".join(rng.choice(LETTERS) for _ in range(70)) + "N" + "ACAC" * 6 + "".join(rng.choice(LETTERS) for _ in range(20))
    seqs = [changed(rng, ref) for _ in range(120)] + ["", "A", "ACGT" * 30, ref, turned(ref), "ACGTNNNNNN" * 5]
    mapped = 0
    for seq, (flag, start, mapq, cigar, score) in zip(seqs, align.align_batch(seqs, ref, cells=cells)):
        both = [plain_score(s, ref) if s else -(10**6) for s in (seq, turned(seq))]
        if max(both) < 30:
            assert (flag, start, mapq, cigar) == (4, -1, 0, "*")
            continue
        mapped += 1
        assert score == max(both) and flag == (0 if both[0] >= both[1] else 16)
        assert told_score(seq if flag == 0 else turned(seq), ref, start, cigar) == score
        assert mapq <= (60 if min(both) < 30 else 60 * (score - min(both)) // score)
    assert mapped > 100


def test_word_count_rules_out_only_lost_reads():
    rng, ref = random.Random(2), bases(1, 90)
    code = align.letters([ref], len(ref))[0]
    s = align.Scoring()
    for _ in range(300):
        x = changed(rng, ref)[: rng.randrange(20, 90)]
        if not x:
            continue
        words = int(align.shared_words(align.letters([x], len(x)), code, s.word)[0])
        assert plain_score(x, ref) <= words + s.word - 1


def test_mapq_of_a_repeat():
    unit = bases(4, 60)
    assert align.align_batch([unit], unit + "ACGTACGTAA" + unit)[0][:3] == (0, 0, 0)
    assert align.align_batch([unit], unit)[0][:3] == (0, 0, 60)
    palindrome = unit + turned(unit)
    assert align.align_batch([palindrome], palindrome)[0][:3] == (0, 0, 0)


def test_align_columns(spark):
    ref, other = synth.REF_A, bases(9, 80)
    rows = [(1, "A", ref, "I" * 120), (2, "A", turned(ref)[:90], "".join(chr(40 + k % 40) for k in range(90))), (3, "B", other, "I" * 80), (4, "A", None, None), (5, "A", "", ""), (6, "gone", ref, "I" * 120), (7, None, ref, None), (1, "A", ref, "I" * 120)]
    df = spark.createDataFrame(rows, "id int, target string, seq string, qual string").withColumn("a.b", F.lit(1))
    refs = spark.createDataFrame([("A", ref), ("B", other)], "target string, ref string")
    plan = align.align(df, refs)
    got = {r.id: r for r in plan.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5] and plan.count() == 6 and plan.columns == [*df.columns, "flag", "pos0", "mapq", "cigar"]
    assert (got[2].flag, got[2].pos0, got[2].cigar) == (16, 30, "90M") and got[2].seq == ref[30:] and got[2].qual == rows[1][3][::-1]
    assert [tuple(got[i])[-4:] for i in (3, 4, 5)] == [(0, 0, 60, "80M"), (4, -1, 0, "*"), (4, -1, 0, "*")]
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert align.align(df.limit(0), refs).collect() == []
    with pytest.raises(ValueError, match="over 1 rows"):
        tables.few_rows(refs, 1)


# --- adapters ---


def fits(a, b):
    return a == b or "N" in (a, b)


def distance(p, t):
    d = list(range(len(t) + 1))
    for i, x in enumerate(p, 1):
        e = [i]
        for j, y in enumerate(t, 1):
            e.append(min(d[j - 1] + (not fits(x, y)), d[j] + 1, e[-1] + 1))
        d = e
    return d[-1]


def plain_find(seq, many, rate, least):
    """All stretches of the read against all of the adapters."""
    n, found = len(seq), {}
    for a, adapter in enumerate(many):
        m = len(adapter)
        for s in range(n + 1):
            for e in range(s, n + 1):
                whole = [(0, adapter)] if m >= least else []
                tries = whole + [(1, adapter[:k]) for k in range(least, m) if e == n] + [(2, adapter[m - k :]) for k in range(least, m) if s == 0]
                for kind, part in tries:
                    allowed = int(rate * len(part) + 1e-9)
                    if abs(e - s - len(part)) <= allowed and (d := distance(part, seq[s:e])) <= allowed:
                        near = abs(e - s - len(part)) * 2 - (e - s > len(part))
                        # at a given end the nearest length counts; at the read's start the nearest end
                        found.setdefault((len(part) - d, -d, -a, kind, 0 if kind == 2 else e), []).append((near, s, e))
    if not found:
        return -1, -1
    top = max(k[:3] for k in found)
    stop, _, start = min((min(v)[2], k[3], min(v)[1]) for k, v in found.items() if k[:3] == top)
    return start, stop


def with_adapter(rng, many):
    x = [rng.choice("ACGN" if rng.random() < 0.1 else "ACG") for _ in range(rng.randrange(0, 12))]
    if rng.random() < 0.8:
        a = list(rng.choice(many).replace("N", "A"))
        for _ in range(rng.randrange(0, 3)):
            k, what = rng.randrange(len(a)), rng.random()
            a[k : k + 1] = [rng.choice("ACG")] if what < 0.33 else [a[k], rng.choice("ACG")] if what < 0.66 or len(a) == 1 else []
        k = rng.randrange(len(x) + 1)
        x[k:k] = a
    return "".join(x)[rng.choice([0, 0, 3]) :][: rng.choice([99, 99, 9])]


@pytest.mark.parametrize("rate, least", [(0.1, 3), (0.2, 2), (0.34, 3)])
def test_adapters_equal_plain_search(rate, least):
    rng, some = random.Random(int(rate * 100)), 0
    for _ in range(60):
        many = ["".join(rng.choice("ACGTN" if rng.random() < 0.2 else "ACG") for _ in range(rng.randrange(3, 13))) for _ in range(rng.randrange(1, 3))]
        seqs = [s for s in (with_adapter(rng, many) for _ in range(6)) if s]
        got = list(zip(*(x.tolist() for x in adapters.find(seqs, many, rate, least)))) if seqs else []
        for s, g in zip(seqs, got):
            assert g == plain_find(s, many, rate, least), (s, many)
            some += g[0] >= 0
    assert some > 60


@pytest.mark.parametrize("size", [63, 64, 65, 130])
def test_long_adapters(size):
    """Adapters over one word of 64 places; a letter changed, one more and one missing."""
    rng = random.Random(size)
    a = "".join(rng.choice(LETTERS) for _ in range(size))
    wrong = a[:20] + ("A" if a[20] != "A" else "C") + a[21:]
    front = "".join(rng.choice(LETTERS) for _ in range(30))
    for x in (a, wrong, a[:40] + "T" + a[40:], a[:40] + a[41:]):
        start, stop = (int(v[0]) for v in adapters.find([front + x + front], [a], 0.1, 3))
        assert stop - start == len(x) and abs(start - 30) <= 1 and distance(a, (front + x + front)[start:stop]) <= 1
    assert adapters.find([a[size // 2 :] + front], [a], 0.1, 3)[1][0] == size - size // 2
    assert adapters.find([front + a[: size // 2]], [a], 0.1, 3)[0][0] == 30


def test_adapter_columns(spark):
    a = "AGATCGGAAGNNAC"
    rows = [(1, "TTTTTTTT" + "AGATCGGAAGTTAC" + "GG"), (2, "AGATCGGAAGTTAC" + "TTTTCTTT"), (3, "TTTTTT" + "AGATCGAAGTTAC"), (4, "TTTTTAGAT" + "AGATCGGAAGGGAC"), (5, None), (6, ""), (7, "CTCTCTCT"), (8, "AGATCGGAAGTTAC"), (9, "GGAAGTTACTTTCTTT")]
    df = spark.createDataFrame([(i, s, None if s is None else "".join(chr(40 + k) for k in range(len(s)))) for i, s in rows], "id int, seq string, qual string").withColumn("a.b", F.lit(1))
    got = {r.id: r for r in adapters.trim_adapters(df, [a]).collect()}
    assert {i: r.seq for i, r in got.items()} == {1: "TTTTTTTT", 2: "TTTTCTTT", 3: "TTTTTT", 4: "TTTTT", 5: None, 6: "", 7: "CTCTCTCT", 8: "", 9: "TTTCTTT"}
    assert got[2].qual == "".join(chr(40 + k) for k in range(14, 22)) and got[1].qual == "".join(chr(40 + k) for k in range(8))
    assert {r.id: r.seq for r in adapters.trim_adapters(df, [a], times=1).collect()}[4] == "TTTTTAGAT"
    assert adapters.trim_adapters(df.limit(0), [a]).collect() == []


# --- mates ---


def plain_place(a, qa, b, qb, least, rate, enough):
    best = None
    for at in range(least - len(b), len(a) - least + 1):
        places = [(i, i - at) for i in range(max(0, at), min(len(a), at + len(b)))]
        n = len(places)
        same = sum(a[i] == b[j] != "N" for i, j in places)
        if n >= least and n - same <= rate * n and same >= enough[min(n, len(enough) - 1)]:
            score = sum((1 if a[i] == b[j] != "N" else -1) * min(ord(qa[i]) - 33, ord(qb[j]) - 33) for i, j in places)
            best = max(best or (-(10**9), 0, 0), (score, n, -at))
    return None if best is None else -best[2]


def test_mates_equal_plain_scores():
    rng = random.Random(6)
    rows, enough = [], mates.least_matches(64, 1e-4)
    for _ in range(150):
        whole = "".join(rng.choice(LETTERS[: rng.choice([2, 4])]) for _ in range(rng.randrange(12, 90)))
        noisy = lambda s: "".join(rng.choice("ACGTN") if rng.random() < 0.04 else x for x in s)
        n = rng.randrange(10, 60)
        a, b = noisy(whole[:n] + "ACCGT" * rng.randrange(0, 2)), noisy("GGTCA" * rng.randrange(0, 2) + whole[-n:])
        rows.append((a, "".join(chr(33 + rng.randrange(41)) for _ in a), b, "".join(chr(33 + rng.randrange(41)) for _ in b)))
    rows += [("", "", "", ""), ("ACGTACGTACGT", "I" * 12, "", "")]
    got = mates.best_places(*map(list, zip(*rows)), 10, 0.1, enough).tolist()
    want = [plain_place(*r, 10, 0.1, enough) for r in rows]
    assert [None if g == -(1 << 30) else g for g in got] == want and sum(w is not None for w in want) > 30


def test_mates_merge(spark):
    rng = random.Random(3)
    whole = "".join(rng.choice(LETTERS) for _ in range(40))
    short = whole[:25]
    pairs = [("@m:1/1 x", whole[:30], "@m:1/2 y", turned(whole[10:])), ("@m:2 1", short + "GATTA", "@m:2 2", turned("CCTGG" + short)), ("@m:3/1", whole[:20], "@m:3/2", turned(whole[:3] + "T" * 17)), ("@m:4/1", None, "@m:4/2", turned(whole))]
    side = lambda k: spark.createDataFrame([(p[k], p[k + 1], None if p[k + 1] is None else "I" * len(p[k + 1])) for p in pairs], "header string, seq string, qual string")
    got = {r.header: (r.seq, r.qual) for r in mates.merge_mates(side(0), side(2)).collect()}
    assert got == {"@m:1": (whole, "I" * 40), "@m:2": (short, "I" * 25)}
    assert mates.merge_mates(side(0).limit(0), side(2)).collect() == []


def test_better_letter_stays():
    assert mates.joined("ACGT", "IIII", "CCTA", "##5J", 1) == ("ACGTA", "IIIIJ")[0:2]
    assert mates.joined("AAAA", "#I#I", "TTTT", "I#I#", 0) == ("TATA", "IIII")


def test_chance_of_matches():
    enough = mates.least_matches(20, 1e-3)
    assert enough[4] == 5 and enough[5] == 5 and all(a <= b for a, b in zip(enough, enough[1:])) and enough[20] <= 20


# --- FASTQ ---


def test_records_are_not_shuffled(spark, tmp_path):
    """Files cut into tiny splits: whole records and their numbers; only lines of records that lie across splits meet by a shuffle."""
    rng = random.Random(1)
    want = {}
    for name in ("a.fq", "b.fq"):
        records = [(f"@r{k}", "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 60)))) for k in range(800)]
        records = [(h, s, "".join(rng.choice("@+IJ") for _ in s)) for h, s in records]
        (tmp_path / name).write_text("".join(f"{h}\n{s}\n+\n{q}\n" for h, s, q in records))
        want |= {(name, k): r for k, r in enumerate(records)}
    with gzip.open(tmp_path / "c.fq.gz", "wt") as f:
        f.write("@z\nAC\n+x\nII\n")
    want["c.fq.gz", 0] = ("@z", "AC", "II")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("900", "50000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = readers.read_fastq(spark, str(tmp_path))
            got = df.collect()
            assert {(r.file.rsplit("/", 1)[-1], r.pos_in_file): (r.header, r.seq, r.qual) for r in got} == want and len(got) == len(want)
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Aggregate") == 1 and "MapInArrow" in plan  # records across splits; all else is framed in place
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("text", ["@a\nAC\n+\nI\n", "@a\nAC\n+\n", "a\nAC\n+\nII\n", "@a\nAC\nII\n+\n", "@a\nAC\n+\nII\n\n@b\nAC\n+\nII\n"])
def test_broken_records(spark, tmp_path, text):
    (tmp_path / "x.fq").write_text(text)
    with pytest.raises(Exception, match="broken record"):
        readers.read_fastq(spark, str(tmp_path / "x.fq")).collect()


def test_lane_parts(spark):
    rows = [("1", "S", "l1_1.fq.gz"), ("1", "S", "l1_2.fq.gz"), ("2", "S", "l2_1.fq.gz"), ("2", "S", "l2_2.fq.gz"), ("3", "T", "a.fq"), ("4", "T", "b.fq.gz"), ("5", "U", "a.txt"), ("6", "V", "a.fastq"), ("6", "V", "b.fastq"), ("7", "V", "c.fastq")]
    got = {(r.sample, r.mate): (r.files, r.extension, r.ok) for r in tables.lane_parts(spark.createDataFrame(rows, "pair string, sample string, file string")).collect()}
    assert got == {
        ("S", 1): (["l1_1.fq.gz", "l2_1.fq.gz"], "fq.gz", True), ("S", 2): (["l1_2.fq.gz", "l2_2.fq.gz"], "fq.gz", True), ("T", 1): (["a.fq", "b.fq.gz"], None, False),
        ("U", 1): (["a.txt"], None, False), ("V", 1): (["a.fastq", "c.fastq"], "fastq", False), ("V", 2): (["b.fastq"], "fastq", False),
    }
