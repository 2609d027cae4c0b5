"""BAM files written and read back, under splits of any size, with a plain reader beside."""

import glob
import gzip
import random
import struct

import pytest

from readkin.sources import bam

COLUMNS = "qname string, flag int, bc5 string, pos0 int, mapq int, cigar string, seq string, qual string, bc3 string"


def made(n, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        size = rng.choice([0, 1, 7, 40, 300])
        seq = "".join(rng.choices("ACGTN", k=size)) or "*"
        qual = "*" if seq == "*" or k % 5 == 0 else "".join(chr(rng.randint(33, 73)) for _ in seq)
        cigar = "*" if seq == "*" else f"{size}M" if size < 7 else f"3S{size - 5}M2I4D"[: None if size > 7 else 4] if size != 7 else "3S4M"
        bc5 = None if k % 17 == 0 else "".join(rng.choices("ACGT", k=6))
        out.append((f"r{k}", rng.choice([0, 16]) if bc5 else 4, bc5, rng.randint(0, 90) if bc5 else -1, rng.randint(0, 60), cigar, seq, qual, rng.choice([None, "", "ACCA"])))
    return out


def told(rows):
    return sorted((r[0], r[1], r[2] or "*", *r[3:]) for r in map(tuple, rows))


def plain(path):
    """Header text, reference names, and (reference, place, name) of the records of a BAM file, decompressed as any gzip file."""
    data = gzip.open(path).read()
    assert data[:4] == b"BAM\1"
    size = struct.unpack_from("<i", data, 4)[0]
    text, at = data[8 : 8 + size].decode(), 12 + size
    names, rows = [], []
    for _ in range(struct.unpack_from("<i", data, at - 4)[0]):
        n = struct.unpack_from("<i", data, at)[0]
        names.append(data[at + 4 : at + 3 + n].decode())
        at += 8 + n
    while at < len(data):
        n, ref, pos, name = struct.unpack_from("<iiiB", data, at)
        rows.append((ref, pos, data[at + 36 : at + 35 + name].decode()))
        at += 4 + n
    return text, names, rows


@pytest.fixture
def small_splits(spark):
    yield lambda n: [spark.conf.set("spark.sql.files.maxPartitionBytes", n), spark.conf.set("spark.sql.files.openCostInBytes", 1)]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split", [1 << 27, 200_000, 70_000, 30_000])
def test_written_and_read_back(spark, tmp_path, small_splits, split, monkeypatch):
    rows = made(6000)
    path = str(tmp_path / "out")
    bam.write_bam(spark.createDataFrame(rows, COLUMNS).repartition(1), path, 100, records=10_000)
    small_splits(split)
    got = bam.read_bam(spark, path + "/part=*")
    assert told(got.select("qname", "flag", "bc5", "pos0", "mapq", "cigar", "seq", "qual", "bc3").collect()) == told(rows)


def test_files_are_in_order(spark, tmp_path):
    rows = made(3000)
    path = str(tmp_path / "out")
    bam.write_bam(spark.createDataFrame(rows, COLUMNS), path, 100, records=200)
    files, seen = glob.glob(path + "/part=*/*.txt"), []
    assert len(files) >= 15
    for f in files:
        assert open(f, "rb").read().endswith(bam._EMPTY)
        text, names, own = plain(f)
        assert names == sorted(set(names)) and text.startswith("@HD\tVN:1.6\tSO:coordinate\n") and text.count("@SQ") == len(names)
        assert own == sorted(own, key=lambda r: (r[0] < 0, *r)) and len(own) <= 200
        seen += [(q, names[ref] if ref >= 0 else None, pos) for ref, pos, q in own]
    assert sorted(seen, key=str) == sorted(((r[0], r[2], r[3]) for r in rows), key=str)


def test_one_long_family_over_many_splits(spark, tmp_path, small_splits):
    """A third of the rows in one family, and records longer than a block."""
    rng = random.Random(5)
    rows = [(f"q{k}", 0, "AAAA" if k % 3 == 0 else f"B{k % 50:03d}", k, 60, f"{n}M", "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("ABCDEFGHIJ", k=n)), "AC") for k, n in enumerate([150] * 3000 + [100_000] * 3 + [150] * 300)]
    path = str(tmp_path / "out")
    bam.write_bam(spark.createDataFrame(rows, COLUMNS).coalesce(1), path, 10**6, records=10**6)
    small_splits(60_000)
    assert told(bam.read_bam(spark, path + "/part=*").select(*[c.split()[0] for c in COLUMNS.split(", ")]).collect()) == told(rows)


def test_very_many_operations(spark, tmp_path):
    rows = [("x", 0, "A", 0, 1, "1M1I" * 40_000, "A" * 80_000, "*", None)]
    bam.write_bam(spark.createDataFrame(rows, COLUMNS), str(tmp_path / "o"), 10**6)
    assert told(bam.read_bam(spark, f"{tmp_path}/o/part=*").select(*[c.split()[0] for c in COLUMNS.split(", ")]).collect()) == told(rows)


def test_nothing_written_and_broken_files(spark, tmp_path):
    head = b"BAM\1" + struct.pack("<ii", 0, 0)
    ok = tmp_path / "empty.bam"
    ok.write_bytes(bam._deflated(head) + bam._EMPTY)
    assert bam.read_bam(spark, str(ok)).collect() == []
    record = bam._encoded(-1, -1, "r", 4, 0, "*", "ACGT", "IIII", "C")
    for name, data, said in [("cut", bam._deflated(head + record[:-3]) + bam._EMPTY, "broken record"), ("noref", bam._deflated(head + bam._encoded(3, 0, "r", 0, 0, "4M", "ACGT", "IIII", "C")) + bam._EMPTY, "no reference 3"), ("other", bam._deflated(b"SAM?" + head), "not a BAM file"), ("bits", bam._deflated(head)[:-1] + b"\1" + bam._EMPTY, "checksum"), ("text", b"hello\n", "before the first block"), ("half", bam._deflated(head + record)[:-5], "not of its size")]:
        f = tmp_path / f"{name}.bam"
        f.write_bytes(data)
        with pytest.raises(Exception, match=said):
            bam.read_bam(spark, str(f)).collect()


def test_header_over_the_first_split(spark, tmp_path, small_splits):
    rng = random.Random(3)
    rows = [(f"r{k}", 0, "".join(rng.choices("ACGT", k=12)), 0, 1, "4M", "ACGT", "IIII", "C") for k in range(20_000)]
    bam.write_bam(spark.createDataFrame(rows, COLUMNS).coalesce(1), str(tmp_path / "o"), 100)
    small_splits(40_000)
    with pytest.raises(Exception, match="the header does not end in the first split"):
        bam.read_bam(spark, f"{tmp_path}/o/part=*").collect()


def test_letters_and_cigars_remembered():
    """Letters of any kind are packed as they were one by one; CIGARs are remembered within bounds."""
    seq = "=ACMGRSVTWYHKDBNacgtn.-é中x"
    data = bam._encoded(0, 3, "r", 0, 1, "5M", seq, "*", None)
    assert bam._decoded(data, 0, len(data))[6] == "".join(c if c in bam._LETTERS else "N" for c in seq.upper())
    for k in range(bam._MANY + 50):
        data = bam._encoded(0, 3, "r", 0, 1, f"{k + 1}M2D", "ACG", "*", None)
        assert bam._decoded(data, 0, len(data))[5] == f"{k + 1}M2D"
    assert 0 < len(bam._CODES) <= bam._MANY and 0 < len(bam._CIGARS) <= bam._MANY
