"""BAM files: binary alignments read in splits of any place, and written in coordinate order."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import scratch

# Fixed values of the public BAM and BGZF formats.
_MAGIC = bytes.fromhex("1f8b08040000000000ff060042430200")  # how every BGZF block begins, up to its size
_EMPTY = _MAGIC + bytes.fromhex("1b0003000000000000000000")  # the empty block that ends a file
_LETTERS = "=ACMGRSVTWYHKDBN"
_OPS = "MIDNSHP=X"
_FIXED = "<iiiBBHHHiiii"  # size, reference, place, length of name, mapq, bin, operations, flag, letters, mate's reference and place, template
_SIZE = struct.calcsize(_FIXED)
_WIDTHS = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_BINS = ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1))
_SHORT, _MANY = 256, 4096  # longest CIGAR, in letters or bytes, that a task remembers, and how many of them
_CODES, _CIGARS = {}, {}
_BLOCK = 65280  # bytes of a block before compression

_FROM_HEX = str.maketrans("0123456789abcdef", _LETTERS)
_TO_HEX = bytes(b"0123456789abcdef"[_LETTERS.find(chr(k)) % 16] for k in range(256))  # any other letter is the last one, N
_UP, _DOWN = bytes((k + 33) % 256 for k in range(256)), bytes((k - 33) % 256 for k in range(256))

#: Records that must follow each other from a place on before it is taken for the first record of a split.
SURE = 16
#: Longest record that a search for the first record waits for; longer ones are passed over to a later one, and joined at the edge.
_LONGEST = 1 << 24

_HEAD, _TAIL, _NAME, _ROW = range(4)
_ALIGNED = "qname string, flag int, ref_id int, pos0 int, mapq int, cigar string, seq string, qual string, bc3 string"
_PARSED = f"file string, split long, kind int, data binary, {_ALIGNED}"
_ROWS = f"file string, {_ALIGNED}"


def read_bam(spark: SparkSession, path: str | list[str], names: str = "") -> DataFrame:
    """Alignments of BAM files, with the columns of ``readers.read_sam``: reference name as ``bc5``, tag ``XB:Z`` as ``bc3``.

    Spark splits a file where it likes: a BGZF block is a line that ends where the next one begins.  Every split is decompressed and cut
    into records in its own task; in splits other than a file's first, the first record is the first place from which ``SURE``
    records follow each other.  The bytes before it and those after the last whole record (a few records a split) are joined with those of the neighbouring splits;
    they must be whole records again, which proves all places that were taken, one after the other from the header on.  Anything else is an error, as are
    blocks with a wrong checksum or with gzip headers of another form than the common libraries write.

    The decoded rows are written once to the shared folder.  Reference names, of which there may be one a family, are joined as
    rows.  The header must end in the first split of its file.  A file of no records gives no row; missing letters, scores, operations and references are ``*``.
    ``names`` is a pattern of the file's path with two groups, which become ``title`` and ``target``.
    """
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", _MAGIC.decode("latin-1")).text(path)
    blocks = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("block"))
    parsed = scratch(blocks.mapInArrow(_parse, _PARSED), "bam")
    at_edge = parsed.where(F.col("kind") <= _TAIL).select("file", "split", "kind", "data")
    edge = F.sum("kind").over(Window.partitionBy("file").orderBy("split", "kind"))  # tails so far; at most two rows a split
    edges = at_edge.withColumn("edge", edge).groupBy("file", "edge").agg(F.sort_array(F.collect_list(F.struct("split", "kind", "data"))).alias("parts"))
    joined = edges.select("file", F.col("parts.data").alias("parts")).mapInArrow(_join, _ROWS)
    columns = [c.split()[0] for c in _ROWS.split(", ")]
    rows = parsed.where(F.col("kind") == _ROW).select(columns).union(joined)
    refs = parsed.where(F.col("kind") == _NAME).select("file", "ref_id", F.col("qname").alias("bc5"))
    unknown = F.raise_error(F.concat("file", F.lit(": no reference "), F.col("ref_id").cast("string"))).cast("string")
    named = rows.join(refs, ["file", "ref_id"], "left").withColumn("bc5", F.when(F.col("ref_id") < 0, "*").otherwise(F.coalesce("bc5", unknown)))
    of_path = [F.regexp_extract("file", names, k).alias(c) for k, c in ((1, "title"), (2, "target"))] if names else []
    return named.select(*of_path, "qname", "flag", "bc5", "pos0", "mapq", "cigar", "seq", "qual", "bc3")


def write_bam(aln: DataFrame, path: str, reference_size: int, by: tuple[str, ...] = (), records: int = 250_000) -> None:
    """BAM files of ``aln`` in coordinate order, in a folder for each value of ``by`` and ``part``.

    Rows are dealt over tasks by ranges of (``by``, bc5, place, name), so a family of any size may lie over several files.  Every file
    has a header of its own references in their order, then at most ``records`` alignments by reference and place, those without one last;
    its compressed bytes wait in the task until all its references are known.  The text writer of Spark takes whole blocks as a
    row and an empty block, which every file must end with, as the end of a line; so names end in ``.txt``.  A null ``bc5``, ``cigar``, ``seq`` or ``qual`` is ``*``,
    a null ``bc3`` has no tag, other nulls are an error.
    """
    lost = (F.coalesce("bc5", F.lit("*")) == "*").alias("lost")
    rows = aln.select(*by, lost, "bc5", "pos0", "qname", "flag", "mapq", "cigar", "seq", "qual", "bc3")
    order = [*by, "lost", "bc5", "pos0", "qname"]
    schema = ", ".join([*[f"`{c}` {aln.schema[c].dataType.simpleString()}" for c in by], "part int", "value binary"])
    files = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_files(len(by), reference_size, records), schema)
    text = files.withColumn("value", F.col("value").cast("string"))
    text.write.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY.decode("latin-1")).partitionBy(*by, "part").text(path)


# --- in a task: blocks to records ---


def _inflated(block: bytes, file: str) -> bytes:
    """The bytes of a block, which is given from its size on."""
    if len(block) < 10 or int.from_bytes(block[:2], "little") + 1 != len(_MAGIC) + len(block):
        raise ValueError(f"{file}: a block is not of its size")
    out = zlib.decompress(block[2:-8], -15)
    if (zlib.crc32(out), len(out)) != struct.unpack("<II", block[-8:]):
        raise ValueError(f"{file}: a block does not have its checksum")
    return out


def _after(data: bytes | bytearray, at: int) -> int | None:
    """Where the record at ``at`` ends; None if its fixed part is not there yet, -1 if no record can be there."""
    if at + _SIZE > len(data):
        return None
    size, ref, pos, name, _, _, ops, _, letters, mate, mate_pos, _ = struct.unpack_from(_FIXED, data, at)
    end = at + _SIZE + name - 1
    if min(ref, pos, mate, mate_pos) < -1 or name < 1 or letters < 0 or 32 + name + 4 * ops + (letters + 1) // 2 + letters > size or (end < len(data) and data[end]):
        return -1
    return at + 4 + size


def _first_record(data: bytearray, tried: int) -> tuple[int, bool]:
    """The first place from ``tried`` on that begins ``SURE`` records, and True; or the place to go on with when there are more bytes, and False."""
    for start in range(tried, len(data)):
        at = start
        for _ in range(SURE):
            end = _after(data, at)
            if end == -1 or (end is not None and end - at > _LONGEST):
                break
            if end is None or end > len(data):
                return start, False
            at = end
        else:
            return start, True
    return len(data), False


def _header(data: bytearray, file: str) -> tuple[list[str], int] | None:
    """Names of the references and where the records begin; None if the header does not end here."""
    if data[:4] != b"BAM\1"[: len(data)]:
        raise ValueError(f"{file}: not a BAM file")
    names: list[str] = []
    try:
        at = 8 + struct.unpack_from("<i", data, 4)[0]
        n, at = struct.unpack_from("<i", data, at)[0], at + 4
        for _ in range(n):
            size = struct.unpack_from("<i", data, at)[0]
            names.append(data[at + 4 : at + 3 + size].decode())
            at += 8 + size
    except struct.error:
        return None
    return (names, at) if at <= len(data) else None


def _tags(data: bytes | bytearray, at: int, end: int) -> tuple[str | None, bytes | None]:
    """Text of the tag XB and operations of the tag CG (alignments of very many of them), null where there is none."""
    bc3 = ops = None
    while at < end:
        tag, kind, at = bytes(data[at : at + 2]), chr(data[at + 2]), at + 3
        if kind in "ZH":
            stop = data.index(0, at, end)
            if tag == b"XB" and kind == "Z":
                bc3 = data[at:stop].decode()
            at = stop + 1
        elif kind == "B":
            width, n = _WIDTHS[chr(data[at])], int.from_bytes(data[at + 1 : at + 5], "little")
            if tag == b"CG":
                ops = bytes(data[at + 5 : at + 5 + 4 * n])
            at += 5 + width * n
        else:
            at += _WIDTHS[kind]
    return bc3, ops


def _decoded(data: bytes | bytearray, at: int, end: int) -> tuple:
    """The columns of the record between two places."""
    _, ref, pos, name, mapq, _, n, flag, letters, *_ = struct.unpack_from(_FIXED, data, at)
    at += _SIZE
    qname, at = data[at : at + name - 1].decode(), at + name
    ops, at = bytes(data[at : at + 4 * n]), at + 4 * n
    half = (letters + 1) // 2
    seq, at = data[at : at + half].hex().translate(_FROM_HEX)[:letters], at + half
    scores, at = data[at : at + letters], at + letters
    bc3, more = _tags(data, at, end)
    cigar = _kept(_CIGARS, _cigar, more or ops)
    qual = "*" if not scores or scores[0] == 255 else scores.translate(_UP).decode("ascii")
    return qname, flag, ref, pos, mapq, cigar or "*", seq or "*", qual, bc3


def _cut(blocks: Iterator[bytes], file: str, first: bool) -> Iterator[tuple[int, object]]:
    """Kinds and values of a split: references (number, name), records, and the bytes at both edges."""
    data, at, known, tried = bytearray(), 0, False, 0
    for block in blocks:
        data += block
        if not known and first and len(data) >= tried:
            if found := _header(data, file):
                known, at = True, found[1]
                yield from ((_NAME, pair) for pair in enumerate(found[0]))
            tried = 2 * len(data)
        elif not known and not first:
            at, known = _first_record(data, at)
            if known:
                yield _HEAD, bytes(data[:at])
        if known:
            while (end := _after(data, at)) is not None and end <= len(data):
                if end == -1:
                    raise ValueError(f"{file}: broken record")
                yield _ROW, _decoded(data, at, end)
                at = end
            del data[:at]
            at = 0
    if first and not known:
        if not (found := _header(data, file)):
            raise ValueError(f"{file}: the header does not end in the first split; raise spark.sql.files.maxPartitionBytes")
        yield from ((_NAME, pair) for pair in enumerate(found[0]))
        known, data = True, data[found[1] :]
        while (end := _after(data, at)) is not None and -1 != end <= len(data):
            yield _ROW, _decoded(data, at, end)
            at = end
        data = data[at:]
    yield (_TAIL if known else _HEAD), bytes(data)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_PARSED`` of successive blocks; the blocks of a split come one after the other."""
    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()), *_fields()])

    def blocks() -> Iterator[tuple[tuple[str, int], bytes]]:
        for batch in batches:
            for file, split, block in zip(batch.column(0), batch.column(1), batch.column(2)):
                yield (file.as_py(), split.as_py()), block.as_py()

    rows: list[tuple] = []
    for (file, split), own in groupby(blocks(), key=lambda x: x[0]):
        pieces = (b for _, b in own)
        if split == 0 and (before := next(pieces)):
            raise ValueError(f"{file}: {len(before)} bytes before the first block")
        for kind, value in _cut((_inflated(b, file) for b in pieces), file, split == 0):
            if kind <= _TAIL:
                rows.append((file, split, kind, value, *[None] * 9))
            elif kind == _NAME:
                rows.append((file, split, kind, None, value[1], None, value[0], *[None] * 6))
            else:
                rows.append((file, split, kind, None, *value))
            if len(rows) >= 8192:
                yield _batch(rows, schema)
                rows = []
    if rows:
        yield _batch(rows, schema)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the bytes at the edges between splits, which must be whole."""
    schema = pa.schema([("file", pa.string()), *_fields()])
    for batch in batches:
        rows = []
        for file, parts in zip(batch.column(0).to_pylist(), batch.column(1)):
            data, at = b"".join(parts.as_py()), 0
            while at < len(data):
                end = _after(data, at)
                if end is None or end == -1 or end > len(data):
                    raise ValueError(f"{file}: broken record between splits")
                rows.append((file, *_decoded(data, at, end)))
                at = end
        yield _batch(rows, schema)


def _fields() -> list[tuple[str, pa.DataType]]:
    kinds = {"int": pa.int32(), "string": pa.string()}
    return [(c, kinds[k]) for c, k in (x.split() for x in _ALIGNED.split(", "))]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# --- in a task: records to blocks ---


def _deflated(data: bytes) -> bytes:
    """One whole block."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    return _MAGIC + struct.pack("<H", len(_MAGIC) + len(body) + 9) + body + struct.pack("<II", zlib.crc32(data), len(data))


def _kept(memory: dict, work, key):
    """``work(key)``, remembered for short keys."""
    out = memory.get(key)
    if out is None:
        out = work(key)
        if len(key) <= _SHORT and len(memory) < _MANY:
            memory[key] = out
    return out


def _operations(cigar: str) -> tuple[list[int], int]:
    """Codes of a CIGAR and the letters of the reference under it, 1 at least."""
    ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", "" if cigar == "*" else cigar)]
    return [n << 4 | _OPS.index(o) for n, o in ops], sum(n for n, o in ops if o in "MDN=X") or 1


def _cigar(ops: bytes) -> str:
    """The text of the operations of a record."""
    return "".join(f"{o >> 4}{_OPS[o & 15]}" for o in struct.unpack(f"<{len(ops) // 4}I", ops))


def _encoded(ref: int, pos: int, qname: str, flag: int, mapq: int, cigar: str, seq: str, qual: str, bc3: str | None) -> bytes:
    """One record."""
    codes, span = _kept(_CODES, _operations, cigar)
    tags = b"" if bc3 is None else b"XBZ" + bc3.encode() + b"\0"
    if len(codes) > 65535:
        tags += b"CGBI" + struct.pack(f"<I{len(codes)}I", len(codes), *codes)
        codes = [len(seq) << 4 | _OPS.index("S"), span << 4 | _OPS.index("N")]
    seq, name = "" if seq == "*" else seq, qname.encode() + b"\0"
    digits = seq.upper().encode("latin-1", "replace").translate(_TO_HEX).decode()
    letters = bytes.fromhex(digits + "0" * (len(digits) % 2))
    scores = b"\xff" * len(seq) if qual == "*" else qual.encode("ascii").translate(_DOWN)
    if len(scores) != len(seq):
        raise ValueError(f"{qname}: {len(scores)} scores for {len(seq)} letters")
    last = max(pos, 0) + span - 1
    bin_ = next((base + (max(pos, 0) >> k) for k, base in _BINS if max(pos, 0) >> k == last >> k), 0) if pos >= 0 else 4680
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), mapq, bin_, len(codes), flag, len(seq), -1, -1, 0) + name + struct.pack(f"<{len(codes)}I", *codes) + letters + scores + tags
    return struct.pack("<i", len(body)) + body


def _files(keys: int, reference_size: int, records: int):
    """A function of sorted batches that gives a row for every file: values of the ``keys`` first columns, number in the task, blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, packed, waiting, n, part, kinds = None, [], [], bytearray(), 0, 0, None

        def whole() -> pa.RecordBatch:
            text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{x}\tLN:{reference_size}\n" for x in names)
            refs = [x.encode() + b"\0" for x in names]
            head = b"BAM\1" + struct.pack("<i", len(text.encode())) + text.encode() + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(x)) + x + struct.pack("<i", reference_size) for x in refs)
            blocks = [_deflated(head[k : k + _BLOCK]) for k in range(0, len(head), _BLOCK)] + packed + ([_deflated(bytes(waiting))] if waiting else [])
            return pa.RecordBatch.from_arrays([*[pa.array([v], k) for v, k in zip(key, kinds)], pa.array([part], pa.int32()), pa.array([b"".join(blocks)], pa.binary())], names=[*[f"k{i}" for i in range(keys)], "part", "value"])

        for batch in batches:
            kinds = [batch.column(i).type for i in range(keys)]
            for row in zip(*[c.to_pylist() for c in batch.columns]) if batch.num_rows else ():
                own, (lost, bc5, pos, qname, flag, mapq, cigar, seq, qual, bc3) = row[:keys], row[keys:]
                if key is not None and (own != key or n == records):
                    yield whole()
                    names, packed, waiting, n, part = [], [], bytearray(), 0, part + 1
                key = own
                if not lost and (not names or names[-1] != bc5):
                    names.append(bc5)
                waiting += _encoded(-1 if lost else len(names) - 1, pos, qname, flag, mapq, cigar or "*", seq or "*", qual or "*", bc3)
                n += 1
                while len(waiting) >= _BLOCK:
                    packed.append(_deflated(bytes(waiting[:_BLOCK])))
                    del waiting[:_BLOCK]
        if key is not None:
            yield whole()

    return run
