"""Deterministic reads made from the ``events`` table, as one SQL text for Spark and DuckDB alike."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from .params import Factors, parse_factors

_HEX, _BASES, _QUAL = "0123456789abcdef", "ACGTACGTACGTACGT", "45<=>?@ABCDEFGHI"


#: The design of the made-up library: bases of both barcodes, of a gene, and where its paralog signature begins.
SIZE_F, SIZE_R, LENGTH, SIGNATURE_AT = 16, 10, 120, 45
LOCI = ("LOCA", "LOCB")
SIGNATURES = ("AGTCCA", "GTCAAT")
MATCH = 0.75
#: The identifier stands over the end of the primary barcode, the tail begins the secondary one.
IDENTIFIER_AT, IDENTIFIERS, TAIL = 14, ("GATTC", "GACTC"), "AGCCA"
ROI = ((12, 12), (36, 98))
EXCLUDED = "12-T"


def _reference(name: str, signature: str, length: int = LENGTH) -> str:
    """A made-up gene: the rest of the identifier, hashed bases, and the paralog signature."""
    digits = "".join(hashlib.md5(f"{name}{k}".encode()).hexdigest() for k in range(4))
    bases = (IDENTIFIERS[0][SIZE_F - IDENTIFIER_AT + 1 :] + digits.translate(str.maketrans(_HEX, _BASES)))[:length]
    return bases[: SIGNATURE_AT - 1] + signature + bases[SIGNATURE_AT + len(signature) - 1 :]


REF_A, REF_B = (_reference("locus", s) for s in SIGNATURES)
REFS = dict(zip(LOCI, (REF_A, REF_B)))

_PLACES = ",".join(str(SIGNATURE_AT + k) for k in range(len(SIGNATURES[0])))

FACTORS: Factors = parse_factors({
    "sample": "S", "reference_size": str(LENGTH), "size_f": str(SIZE_F), "size_r": str(SIZE_R),
    "limit_starts": ",".join(str(a) for a, _ in ROI), "limit_ends": ",".join(str(b) for _, b in ROI), "seq_pos": "12", "seq_mut": "-T", "seq_action": "exclude",
    "read_seq": f"{'|'.join(IDENTIFIERS)},{TAIL}", "read_pos": f"{'|'.join([str(IDENTIFIER_AT)] * 2)},{len(TAIL) - 1 - SIZE_R}", "read_action": "include,include",
    "sort_pos": f"{_PLACES};{_PLACES}", "sort_nucl": ";".join(",".join(x) for x in SIGNATURES), "sort_refs": ";".join(LOCI), "sort_ref": LOCI[0], "sort_match": str(MATCH),
})


def _d(h: str, k: int) -> str:
    return f"(instr('{_HEX}', substr({h}, {k}, 1)) - 1)"


def _bases(h: str) -> str:
    return f"translate({h}, '{_HEX}', '{_BASES}')"


_KEYED = """
e AS (
  SELECT event_id, user_id, md5(concat('r', cast(event_id AS string))) AS h, md5(concat('q', cast(event_id AS string))) AS g,
         md5(concat('p', cast(event_id AS string))) AS g2, md5(concat('f', cast(user_id AS string))) AS u
  FROM {events})"""

_QUALITY = "substr(" + "concat(" + ", ".join(f"translate({x}, '{_HEX}', '{_QUAL}')" for x in ("g", "h", "g2", "md5(g)", "md5(h)")) + ")"

#: Raw reads: barcodes, identifier (1 in 16 wrong), one of two genes (1 in 16 neither, 1 in 16 shifted).
RAW_SQL = f"""
WITH {_KEYED},
i AS (
  SELECT *, CASE WHEN {_d("h", 2)} = 0 THEN concat(substr('{REF_A}', 1, {SIGNATURE_AT - 1}), 'TTTTTT', substr('{REF_A}', {SIGNATURE_AT + 6}, {LENGTH})) WHEN {_d("h", 2)} <= 5 THEN '{REF_B}' ELSE '{REF_A}' END AS gene FROM e),
j AS (SELECT *, CASE WHEN {_d("h", 3)} = 0 THEN concat(substr(gene, 1, 29), substr(gene, 31, {LENGTH}), 'A') ELSE gene END AS body FROM i)
SELECT event_id, concat('@M1:', cast(event_id AS string)) AS header,
       concat(substr({_bases("u")}, 1, {IDENTIFIER_AT - 1}), CASE WHEN {_d("h", 1)} = 0 THEN 'GCT' ELSE 'GAT' END, body, '{TAIL}', substr({_bases("h")}, 10, {SIZE_R - len(TAIL)})) AS seq,
       {_QUALITY}, 1, {SIZE_F + LENGTH + SIZE_R}) AS qual
FROM j"""

#: Alignments: families by user, a family substitution, read errors, indels, soft clips, unmapped and shifted reads.
ALIGNED_SQL = f"""
WITH {_KEYED},
a AS (
  SELECT *, concat('S', cast({_d("u", 23)} % 2 AS string)) AS title, CASE WHEN {_d("u", 22)} < 12 THEN '{LOCI[0]}' ELSE '{LOCI[0]}.others' END AS target, substr({_bases("u")}, 1, {SIZE_F}) AS bc5,
         CASE WHEN {_d("h", 5)} = 0 THEN 'BC3_missing' ELSE substr({_bases("md5(concat('b', cast(user_id AS string), '-', cast(" + _d("h", 6) + " % 5 AS string)))")}, 1, {SIZE_R}) END AS bc3,
         38 + {_d("u", 20)} AS p1, 55 + {_d("h", 9)} AS p2 FROM e),
b AS (
  SELECT *, CASE WHEN {_d("u", 21)} < 10 AND {_d("h", 7)} < 12 THEN concat(substr('{REF_A}', 1, p1 - 1), translate(substr('{REF_A}', p1, 1), 'ACGT', 'CGTA'), substr('{REF_A}', p1 + 1, {LENGTH})) ELSE '{REF_A}' END AS s1 FROM a),
c AS (SELECT *, CASE WHEN {_d("h", 8)} = 0 THEN concat(substr(s1, 1, p2 - 1), translate(substr(s1, p2, 1), 'ACGT', 'GTAC'), substr(s1, p2 + 1, {LENGTH})) ELSE s1 END AS s2 FROM b),
d AS (
  SELECT *, CASE {_d("h", 10)} WHEN 0 THEN concat(substr(s2, 1, 62), substr(s2, 65, {LENGTH})) WHEN 1 THEN concat(substr(s2, 1, 74), 'GC', substr(s2, 75, {LENGTH})) WHEN 3 THEN concat(substr(s2, 1, 12), 'T', substr(s2, 13, {LENGTH})) ELSE s2 END AS seq,
         CASE {_d("h", 10)} WHEN 0 THEN '62M2D56M' WHEN 1 THEN '74M2I46M' WHEN 2 THEN '110M10S' WHEN 3 THEN '12M1I108M' ELSE CASE WHEN {_d("h", 15)} = 0 THEN '3S117M' ELSE '120M' END END AS cigar FROM c)
SELECT event_id, title, target, bc5, bc3, concat('M1:', cast(event_id AS string)) AS qname, CASE WHEN {_d("h", 11)} = 0 AND {_d("h", 12)} < 8 THEN 4 ELSE 0 END AS flag,
       CASE WHEN {_d("h", 13)} = 0 THEN 1 ELSE 0 END AS pos0, CASE WHEN {_d("h", 14)} = 0 THEN 0 ELSE 60 END AS mapq, cigar, seq, {_QUALITY}, 1, length(seq)) AS qual
FROM d"""


def raw_reads(events: DataFrame) -> DataFrame:
    """``event_id, header, seq, qual``."""
    return events.sparkSession.sql(RAW_SQL, events=events)


def alignments(events: DataFrame) -> DataFrame:
    """``event_id, title, target, bc5, bc3, qname, flag, pos0, mapq, cigar, seq, qual``."""
    return events.sparkSession.sql(ALIGNED_SQL, events=events)
