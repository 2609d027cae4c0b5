"""Expressions over reads: quality masks, signatures, slices, CIGAR alignment, allele calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Gene, Signature

OPS = r"(\d+)([MIDNSHPX=])"


def let(body, **values: Column) -> Column:
    """``body`` of the values, each computed once; else the optimizer would put their expressions into every lambda that uses them."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), lambda x: body(*[x[k] for k in values])), 1)


def phred(qual: Column, at: Column) -> Column:
    """Phred score of the letter at a 1-based place."""
    return F.ascii(F.substring(qual, at, F.lit(1))) - 33


def masked(seq: Column, qual: Column, least: int) -> Column:
    """``seq`` with N where the score is under ``least``; lengths must agree."""

    def mask(s: Column, good: Column) -> Column:
        """Stretches of good letters, with an N between them: a step a stretch, not a letter."""
        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
        step = lambda a, x: F.struct((a["at"] + F.char_length(x) + 1).alias("at"), F.concat(a["out"], F.substring(s, a["at"], F.char_length(x)), F.lit("N")).alias("out"))
        return F.aggregate(good, start, step, lambda a: F.substring(a["out"], F.lit(1), F.char_length(s)))

    low = f"[\\x00-\\x{max(0, min(127, least + 32)):02x}]"
    return F.when(F.char_length(seq) != F.char_length(qual), F.raise_error(F.lit("sequence and quality differ in length"))).when(~F.rlike(qual, F.lit(low)), seq).otherwise(let(mask, s=seq, good=F.split(qual, low)))


def has_signatures(seq: Column, signatures: tuple[Signature, ...]) -> Column:
    """All signatures hold; a position of 0 or more is the 1-based start, a negative one counts the last base from the end."""
    out = F.lit(True)
    for s in signatures:
        any_ = F.lit(False)
        for text, pos in s.alternatives if s.action == "include" else ():
            start = F.lit(pos) if pos >= 0 else F.char_length(seq) + (pos - len(text) + 2)
            any_ = any_ | ((start >= 1) & (F.substring(seq, F.greatest(start, F.lit(1)), F.lit(len(text))) == text))
        out = out & any_
    return out


def has_any_of_each(seq: Column, signatures: Column) -> Column:
    """``has_signatures`` of signatures that are data: ``array<array<struct<text, pos>>>``, of each of which one alternative must be found."""
    start = lambda a: F.when(a["pos"] >= 0, a["pos"]).otherwise(F.char_length(seq) + a["pos"] - F.char_length(a["text"]) + 2)
    return F.forall(signatures, lambda s: F.exists(s, lambda a: (start(a) >= 1) & (F.substring(seq, F.greatest(start(a), F.lit(1)), F.char_length(a["text"])) == a["text"])))


def base_at(seq: Column, at: Column) -> Column:
    """Base at a 0-based place as a one-base slice takes it: places under -1 count from the end, -1 is empty."""
    return F.when(at >= 0, F.substring(seq, at + 1, F.lit(1))).when((at == -1) | (F.char_length(seq) + at < 0), F.lit("")).otherwise(F.substring(seq, F.greatest(F.lit(1), F.char_length(seq) + at + 1), F.lit(1)))


def haplotype_offset(seq: Column, haplotype: tuple[tuple[int, str], ...], match: float, offsets: tuple[int, ...] = (0, -1, 1, -2, 2, -3, 3)) -> Column:
    """First offset at which the share of matching bases reaches ``match``, else null."""
    found = []
    for o in offsets:
        hits = sum((F.when(base_at(seq, F.lit(p - 1 + o)) == b, 1).otherwise(0) for p, b in haplotype), F.lit(0))
        found.append(F.when(hits / float(len(haplotype)) >= match, F.lit(o)))
    return F.coalesce(*found)


def gene_of(seq: Column, genes: tuple[Gene, ...], match: float, others: str) -> tuple[Column, Column]:
    """Target and whether it was found at an offset: the only gene of which all haplotypes match, else ``others``."""
    return gene_at([[haplotype_offset(seq, h, match) for h in g.haplotypes] for g in genes], genes, others)


def gene_at(offsets_of: list[list[Column]], genes: tuple[Gene, ...], others: str) -> tuple[Column, Column]:
    """``gene_of`` with the offsets of each gene's haplotypes as columns."""
    hits, shifts = [], []
    for g, offsets in zip(genes, offsets_of):
        ok, moved = F.lit(True), F.lit(False)
        for o in offsets:
            ok, moved = ok & o.isNotNull(), moved | (F.coalesce(o, F.lit(0)) != 0)
        hits.append(F.when(ok, F.lit(g.name)))
        shifts.append(ok & moved)
    named = F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")
    one = F.size(named) == 1
    moved = F.lit(False)
    for s in shifts:
        moved = moved | s
    return F.when(one, F.element_at(named, 1)).otherwise(F.lit(others)), one & moved


def cigar_ops(cigar: Column) -> Column:
    """``array<struct<n: int, op: string>>``."""
    return F.transform(F.arrays_zip(F.regexp_extract_all(cigar, F.lit(OPS), F.lit(1)).alias("a"), F.regexp_extract_all(cigar, F.lit(OPS), F.lit(2)).alias("b")), lambda x: F.struct(x["a"].cast("int").alias("n"), x["b"].alias("op")))


def gapped(ops: Column, ref: Column, seq: Column) -> Column:
    """``struct<t, q>``: reference and read with gaps, the read padded to the reference.

    The reference gets a gap at I and S, the read at D and H; every operation
    moves on by its length, so a soft clip reads as an insertion.
    """
    put = lambda s, p, n: F.concat(F.left(s, p), F.repeat(F.lit("-"), n), F.substring(s, p + 1, F.lit(1 << 30)))

    def step(acc: Column, x: Column) -> Column:
        t = F.when(x["op"].isin("I", "S"), put(acc["t"], acc["p"], x["n"])).otherwise(acc["t"])
        q = F.when(x["op"].isin("D", "H"), put(acc["q"], acc["p"], x["n"])).otherwise(acc["q"])
        return F.struct((acc["p"] + x["n"]).alias("p"), t.alias("t"), q.alias("q"))

    start = F.struct(F.lit(0).alias("p"), ref.alias("t"), seq.alias("q"))
    pad = lambda a: F.concat(a["q"], F.repeat(F.lit("-"), F.greatest(F.lit(0), F.char_length(a["t"]) - F.char_length(a["q"]))))
    return F.aggregate(ops, start, step, lambda a: F.struct(a["t"].alias("t"), pad(a).alias("q")))


def _bases(s: Column, upto: Column) -> Column:
    return F.char_length(F.replace(F.substring(s, F.lit(1), upto), F.lit("-"), F.lit("")))


#: Letters of a stretch: stretches are compared first, letters only in those that differ.
STRETCH = 32


def _bases_before(s: Column, stretches: Column) -> Column:
    """For each stretch the number of bases before it: by one running sum if there are gaps."""
    plain = F.transform(stretches, lambda _, k: k * STRETCH)
    return F.when(F.contains(s, F.lit("-")), F.aggregate(stretches, F.array(F.lit(0)), lambda n, x: F.array_append(n, F.element_at(n, -1) + _bases(x, F.lit(STRETCH))))).otherwise(plain)


#: Places of a bin of ``region_bins``.
BIN = 64


def differences(t: Column, q: Column, roi: tuple[tuple[int, int], ...] | Column) -> Column:
    """Columns of the alignment that differ inside the regions: ``array<struct<pos, base, alt, qidx>>``.

    ``roi`` are intervals for all reads, or a column of the read's own: a map of bins of ``BIN`` places to
    the intervals that meet them (``mutations.region_bins``).

    ``pos`` is the 1-based reference place (of the base before, for an insertion);
    ``qidx`` the 0-based place in the read of the base, or of the one before a deletion.
    """
    none = F.array().cast("array<struct<pos:int,base:string,alt:string,qidx:int>>")
    return let(lambda a, b: F.when(a == b, none).otherwise(_differences(a, b, roi)), t=t, q=q)


def _differences(t: Column, q: Column, roi: tuple[tuple[int, int], ...] | Column) -> Column:
    cut = lambda s: F.regexp_extract_all(s, F.lit(f".{{1,{STRETCH}}}"), F.lit(0))
    one = F.lit(1)

    def letters(x: Column) -> Column:
        at = F.filter(F.sequence(one, F.char_length(x["a"])), lambda i: F.substring(x["a"], i, one) != F.substring(x["b"], i, one))
        return F.transform(at, lambda i: F.struct((x["m"] + _bases(x["a"], i)).alias("pos"), F.substring(x["a"], i, one).alias("base"), F.substring(x["b"], i, one).alias("alt"), (x["n"] + _bases(x["b"], i) - 1).alias("qidx")))

    def unlike(a: Column, b: Column) -> Column:
        pieces = F.arrays_zip(a.alias("a"), F.slice(b, 1, F.size(a)).alias("b"), F.slice(_bases_before(t, a), 1, F.size(a)).alias("m"), F.slice(_bases_before(q, b), 1, F.size(a)).alias("n"))
        return F.flatten(F.transform(F.filter(pieces, lambda x: x["a"] != x["b"]), letters))

    found = let(unlike, a=cut(t), b=cut(q))

    def inside(x: Column) -> Column:
        if isinstance(roi, Column):
            near = F.try_element_at(roi, F.floor(x["pos"] / BIN).cast("int"))
            return F.coalesce(F.exists(near, lambda r: x["pos"].between(r["start"], r["stop"])), F.lit(False))
        out = F.lit(False)
        for a, b in roi:
            out = out | x["pos"].between(a, b)
        return out

    return F.filter(found, inside)


def alleles(found: Column, qual: Column, least: int, fix_insertion_quality: bool = False) -> Column:
    """Alleles of a read: ``array<struct<allele, pos, kind, phred, hq>>``; ``WT`` if there is no difference.

    Neighbouring inserted bases are one allele.  The quality of the k-th allele is
    that of the k-th difference, which is another base behind a longer insertion;
    ``fix_insertion_quality`` takes the allele's own first base.
    """
    return let(lambda f, q: _alleles(f, q, least, fix_insertion_quality), f=found, q=qual)


def _alleles(found: Column, qual: Column, least: int, fix_insertion_quality: bool) -> Column:
    def join(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        more = (F.size(acc) > 0) & (last["base"] == "-") & (x["base"] == "-") & (last["qidx"] + 1 == x["qidx"])
        merged = F.struct(last["pos"].alias("pos"), last["base"].alias("base"), F.concat(last["alt"], x["alt"]).alias("alt"), x["qidx"].alias("qidx"), last["own"].alias("own"))
        alone = F.struct(x["pos"].alias("pos"), x["base"].alias("base"), x["alt"].alias("alt"), x["qidx"].alias("qidx"), x["qidx"].alias("own"))
        return F.when(more, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged))).otherwise(F.concat(acc, F.array(alone)))

    none = F.array().cast("array<struct<pos:int,base:string,alt:string,qidx:int,own:int>>")
    grouped = F.aggregate(found, none, join)

    def call(m: Column, k: Column) -> Column:
        at = m["own"] if fix_insertion_quality else F.element_at(found, k + 1)["qidx"]
        kind = F.when(m["base"] == "-", "ins").when(m["alt"] == "-", "del").otherwise("sub")
        score = F.when(m["alt"] != "-", phred(qual, at + 1))
        return F.struct(F.concat(m["pos"].cast("string"), m["base"], m["alt"]).alias("allele"), m["pos"].alias("pos"), kind.alias("kind"), score.alias("phred"), ((m["alt"] == "-") | (score >= least)).alias("hq"))

    wild = F.array(F.struct(F.lit("WT").alias("allele"), F.lit(None).cast("int").alias("pos"), F.lit("wt").alias("kind"), F.lit(None).cast("int").alias("phred"), F.lit(True).alias("hq")))
    return F.when(F.size(found) == 0, wild).otherwise(F.transform(grouped, call))


def position_quality(t: Column, q: Column, qual: Column, over: int) -> Column:
    """A digit for each reference base: 1 if the read's base there scores over ``over`` or is missing."""

    runs = lambda s: F.regexp_extract_all(s, F.lit("-+|[^-]+"), F.lit(0))

    def spread(acc: Column, run: Column) -> Column:
        """Digits of the read's bases, moved apart by its gaps, where nothing is missing."""
        n, gap = F.char_length(run), F.startswith(run, F.lit("-"))
        own = F.when(gap, F.repeat(F.lit("1"), n)).otherwise(F.rpad(F.substring(acc["left"], F.lit(1), n), n, F.lit("0")))
        return F.struct(F.when(gap, acc["left"]).otherwise(F.substring(acc["left"], n + 1, F.lit(1 << 30))).alias("left"), F.concat(acc["out"], own).alias("out"))

    def taken(acc: Column, run: Column) -> Column:
        """Those beside the reference's bases."""
        n = F.char_length(run)
        own = F.when(F.startswith(run, F.lit("-")), F.lit("")).otherwise(F.substring(acc["left"], F.lit(1), n))
        return F.struct(F.substring(acc["left"], n + 1, F.lit(1 << 30)).alias("left"), F.concat(acc["out"], own).alias("out"))

    def digits(t: Column, q: Column, qual: Column) -> Column:
        plain = F.translate(qual, scores, "".join("01"[ord(c) - 33 > over] for c in scores))
        begin = lambda s: F.struct(s.alias("left"), F.lit("").alias("out"))
        wide = F.aggregate(runs(q), begin(F.coalesce(plain, F.lit(""))), spread, lambda a: a["out"])
        general = F.aggregate(runs(t), begin(wide), taken, lambda a: a["out"])
        return F.when(F.contains(t, F.lit("-")) | F.contains(q, F.lit("-")) | (F.char_length(t) != F.char_length(qual)), general).otherwise(plain)

    scores = "".join(map(chr, range(33, 127)))
    return let(digits, t=t, q=q, qual=qual)


def digits12(x: Column) -> Column:
    """A double rounded to 12 significant digits, as the text files between stages keep it."""
    return F.format_string("%.11e", x).cast("double")
