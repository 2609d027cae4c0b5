"""Typed parameters and the grammar of the factors table."""

from __future__ import annotations

import re
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunParams:
    """Run-wide settings."""

    min_read_length: int = 80
    tss: int = 1
    single_end: bool = False
    barcode_min_phred: int = 20
    min_phred: int = 28
    bc3_min_reads: int = 1


@dataclass(frozen=True)
class Signature:
    """One check of a read: any of (sequence, position) alternatives; only ``include`` can pass."""

    alternatives: tuple[tuple[str, int], ...]
    action: str = "include"


@dataclass(frozen=True)
class Gene:
    """A gene and the haplotypes that all must match: tuples of (1-based position, base)."""

    name: str
    haplotypes: tuple[tuple[tuple[int, str], ...], ...]


@dataclass(frozen=True)
class Factors:
    """A row of the factors table, parsed."""

    sample: str
    reference_size: int = 0
    size_f: int = 0
    size_r: int = 0
    roi: tuple[tuple[int, int], ...] = ()
    excluded: tuple[str, ...] = ()  # alleles whose reads leave their family
    signatures: tuple[Signature, ...] = ()
    genes: tuple[Gene, ...] = ()
    sort_ref: str = ""
    sort_match: float = 1.0
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def others(self) -> str:
        """Target of reads that fit no gene, or several."""
        return f"{self.sort_ref}.others"

    @property
    def targets(self) -> tuple[tuple[str, str], ...]:
        """``(target, reference)``: the rest first, then the genes."""
        return ((self.others, self.sort_ref), *((g.name, g.name) for g in self.genes))


KNOWN = (
    "sample", "reference_size", "size_f", "size_r", "limit_starts", "limit_ends", "seq_pos", "seq_mut", "seq_action", "read_seq", "read_pos", "read_action",
    "sort_pos", "sort_nucl", "sort_refs", "sort_ref", "sort_match",
)


def _items(row: dict, *names: str) -> list[tuple[str, ...]]:
    """Parallel comma lists; they must be equally long."""
    lists = [[x for x in (row.get(n) or "").split(",") if x != ""] for n in names]
    if len({len(x) for x in lists}) > 1:
        raise ValueError(f"{' and '.join(names)} differ in length")
    return list(zip(*lists))


def parse_factors(row: dict[str, str]) -> Factors:
    """Parse one row: ``;`` parts genes, ``&`` haplotypes, ``,`` items and ``|`` alternatives."""
    for name in row:
        if not re.fullmatch(r"[A-Za-z]+[A-Za-z0-9_]*", name):
            raise ValueError(f"bad column name {name!r}")
    if len(row) < 2 or next(iter(row)) != "sample":
        raise ValueError("the factors table needs a first column 'sample' and one more")
    match = float(row.get("sort_match") or 1)
    if not 0 <= match <= 1:
        raise ValueError("sort_match must be between 0 and 1")
    signatures = []
    for seq, pos, action in _items(row, "read_seq", "read_pos", "read_action"):
        s, p = seq.split("|"), [int(x) for x in pos.split("|")]
        if len(s) != len(p):
            raise ValueError("read_seq and read_pos differ in alternatives")
        signatures.append(Signature(tuple(zip(s, p)), action))
    names = [x for x in (row.get("sort_refs") or "").split(";") if x]
    pos, bases = ([x for x in (row.get(c) or "").split(";") if x] for c in ("sort_pos", "sort_nucl"))
    if not len(names) == len(pos) == len(bases):
        raise ValueError("sort_refs, sort_pos and sort_nucl differ in genes")
    genes = []
    for name, p, b in zip(names, pos, bases):
        haplotypes = [tuple(zip(map(int, x.split(",")), y.split(","))) for x, y in zip(p.split("&"), b.split("&"), strict=True)]
        genes.append(Gene(name, tuple(haplotypes)))
    return Factors(
        sample=row["sample"], reference_size=int(row.get("reference_size") or 0), size_f=int(row.get("size_f") or 0), size_r=int(row.get("size_r") or 0),
        roi=tuple((int(a), int(b)) for a, b in _items(row, "limit_starts", "limit_ends")),
        excluded=tuple(p + m for p, m, a in _items(row, "seq_pos", "seq_mut", "seq_action") if a == "exclude"),
        signatures=tuple(signatures), genes=tuple(genes), sort_ref=row.get("sort_ref") or "", sort_match=match, extra={k: v for k, v in row.items() if k not in KNOWN},
    )


@dataclass(frozen=True)
class Grid:
    """Cutoffs: frequency x read count x barcodes, and the support that stands in for barcodes with several reads."""

    freqs: tuple[float, ...]
    counts: tuple[int, ...]
    bc3s: tuple[int, ...]
    above: int  # barcodes with two reads or more
    instead: int  # or so many barcodes at all


def full_grid(with_bc3: bool = True, strict: bool = True) -> Grid:
    """The 11 x 13 x 6 grid (143 without secondary barcodes); ``strict`` asks for barcode support."""
    above, instead = (2, 3) if strict and with_bc3 else (0, 0)
    return Grid(tuple(i / 10.0 for i in range(11)), (*range(11), 25, 50), tuple(range(6)) if with_bc3 else (0,), above, instead)
