"""The registered queries of the barcode-family engine, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import synth
from .functions.sequence import cigar_ops, gapped
from .operators import adapters, align, consensus, designs, family, mates, mutations, qc, tables, trim
from .params import Factors, full_grid, parse_factors
from .plans import families
from .sources import bam, readers, store, writers
from .streaming import ingest

FACTORS = synth.FACTORS
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return put


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.spread(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id"))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.raw_reads(_events(spark, sf_dir))


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The made-up alignments; filters on what names and places a read stay above it, or one file's task would make all of them to filter them."""
    return tables.once(synth.alignments(_events(spark, sf_dir)), "bc5", "bc3", "flag", "pos0", "mapq", "cigar")


def _refs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(synth.LOCI[0], synth.REF_A), (FACTORS.others, synth.REF_A), (synth.LOCI[1], synth.REF_B)], "target string, ref string")


def _called(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutations.call(mutations.usable(_aligned(spark, sf_dir)), _refs(spark), FACTORS.roi)


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutations.eligible(_called(spark, sf_dir), FACTORS.excluded)


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return family.family_table(_eligible(spark, sf_dir))


def _consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus.consensus(family.family_support(_eligible(spark, sf_dir)))


# --- SQL of the same steps for DuckDB: other formulas, so that each side checks the other ---

_RAW = "raw AS (" + synth.RAW_SQL.format(events="events") + ")"
_ALN = "aln AS (" + synth.ALIGNED_SQL.format(events="events") + ")"


def _mask(seq: str, qual: str) -> str:
    return f"coalesce(list_aggregate([CASE WHEN ascii(substr({qual}, i, 1)) - 33 < 20 THEN 'N' ELSE substr({seq}, i, 1) END FOR i IN range(1, length({seq}) + 1)], 'string_agg', ''), '')"


_TRIM = f"""{_RAW},
cutup AS (SELECT *, substr(seq, 1, 16) AS bc5_raw, right(seq, 10) AS bc3_raw, substr(qual, 1, 16) AS q5, right(qual, 10) AS q3, substr(seq, 17, length(seq) - 26) AS insert_seq, substr(qual, 17, length(seq) - 26) AS insert_qual,
            substr(seq, 14, 5) IN ('GATTC', 'GACTC') AND substr(seq, length(seq) - 9, 5) = 'AGCCA' AS id_ok FROM raw),
trimmed AS (SELECT *, {_mask("bc5_raw", "q5")} AS bc5, {_mask("bc3_raw", "q3")} AS bc3 FROM cutup)"""


def _hap(gene: str) -> str:
    """Offset of the first shift that matches at 0.75, by comparing the slice as a whole."""
    tries = " ".join(f"WHEN list_sum([CASE WHEN substr(insert_seq, {45 + o} + i, 1) = substr('{gene}', i + 1, 1) THEN 1 ELSE 0 END FOR i IN range(0, 6)]) >= 4.5 THEN {o}" for o in (0, -1, 1, -2, 2, -3, 3))
    return f"CASE {tries} END"


_ROUTE = f"""{_TRIM},
haps AS (SELECT *, {_hap("AGTCCA")} AS oa, {_hap("GTCAAT")} AS ob FROM trimmed WHERE id_ok),
routed AS (SELECT *, CASE WHEN oa IS NOT NULL AND ob IS NULL THEN 'LOCA' WHEN ob IS NOT NULL AND oa IS NULL THEN 'LOCB' ELSE 'LOCA.others' END AS target,
             CASE WHEN oa IS NOT NULL AND ob IS NULL THEN oa <> 0 WHEN ob IS NOT NULL AND oa IS NULL THEN ob <> 0 ELSE false END AS shifted FROM haps)"""

_REF = f"'{synth.REF_A}'"

_GAPPED = f"""{_ALN},
ok AS (SELECT * FROM aln WHERE flag & 4 = 0 AND pos0 = 0 AND NOT regexp_matches(cigar, '^([0-9]+H)?[0-9]+S')),
ops AS (SELECT event_id, seq, k, CAST(ns[k] AS INTEGER) AS n, os[k] AS op FROM (
   SELECT event_id, seq, regexp_extract_all(cigar, '([0-9]+)[MIDS]', 1) AS ns, regexp_extract_all(cigar, '[0-9]+([MIDS])', 1) AS os, unnest(range(1, length(regexp_extract_all(cigar, '[0-9]+[MIDS]')) + 1)) AS k FROM ok)),
walk AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M', 'D') THEN n ELSE 0 END) OVER w, 0) AS tp, coalesce(sum(CASE WHEN op IN ('M', 'I', 'S') THEN n ELSE 0 END) OVER w, 0) AS qp FROM ops WINDOW w AS (PARTITION BY event_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
strs AS (SELECT event_id, string_agg(CASE WHEN op IN ('M', 'D') THEN substr({_REF}, CAST(tp AS INTEGER) + 1, n) ELSE repeat('-', n) END, '' ORDER BY k) || substr({_REF}, CAST(sum(CASE WHEN op IN ('M', 'D') THEN n ELSE 0 END) AS INTEGER) + 1, 200) AS t,
           string_agg(CASE WHEN op = 'D' THEN repeat('-', n) ELSE substr(seq, CAST(qp AS INTEGER) + 1, n) END, '' ORDER BY k) AS q0 FROM walk GROUP BY event_id),
gapd AS (SELECT event_id, t, rpad(q0, CAST(greatest(length(t), length(q0)) AS INTEGER), '-') AS q FROM strs)"""

_CALLED = f"""{_GAPPED},
colm AS (SELECT event_id, i, substr(t, i, 1) AS b, substr(q, i, 1) AS a FROM (SELECT *, unnest(range(1, length(t) + 1)) AS i FROM gapd)),
numb AS (SELECT *, CAST(sum(CASE WHEN b <> '-' THEN 1 ELSE 0 END) OVER w AS INTEGER) AS pos, CAST(sum(CASE WHEN a <> '-' THEN 1 ELSE 0 END) OVER w AS INTEGER) - 1 AS qidx FROM colm WINDOW w AS (PARTITION BY event_id ORDER BY i)),
dif AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY i) AS k FROM numb WHERE a <> b AND (pos = 12 OR pos BETWEEN 36 AND 98)),
st AS (SELECT *, CASE WHEN b = '-' AND lag(b) OVER w = '-' AND lag(qidx) OVER w + 1 = qidx THEN 0 ELSE 1 END AS fresh FROM dif WINDOW w AS (PARTITION BY event_id ORDER BY k)),
gr AS (SELECT *, sum(fresh) OVER (PARTITION BY event_id ORDER BY k) AS j FROM st),
al AS (SELECT event_id, j, min(pos) AS pos, min(b) AS b, string_agg(a, '' ORDER BY k) AS a FROM gr GROUP BY event_id, j),
muts AS (
  SELECT al.event_id, CAST(al.pos AS VARCHAR) || al.b || al.a AS allele, al.pos, CASE WHEN al.b = '-' THEN 'ins' WHEN al.a = '-' THEN 'del' ELSE 'sub' END AS kind,
         CASE WHEN al.a <> '-' THEN ascii(substr(ok.qual, d.qidx + 1, 1)) - 33 END AS phred
  FROM al JOIN dif d ON d.event_id = al.event_id AND d.k = al.j JOIN ok ON ok.event_id = al.event_id
  UNION ALL SELECT event_id, 'WT', NULL, 'wt', NULL FROM ok WHERE event_id NOT IN (SELECT event_id FROM dif)),
called AS (SELECT m.*, m.kind IN ('wt', 'del') OR m.phred >= 28 AS hq, title, target, bc5, bc3, qname FROM muts m JOIN ok USING (event_id)),
hqp AS (SELECT n.event_id, n.pos, n.a = '-' OR ascii(substr(ok.qual, n.qidx + 1, 1)) - 33 > 28 AS good FROM numb n JOIN ok USING (event_id) WHERE n.b <> '-')"""

_FAMILY = f"""{_CALLED},
gone AS (SELECT DISTINCT event_id FROM called WHERE allele = '12-T'),
rd AS (SELECT * FROM ok WHERE event_id NOT IN (SELECT event_id FROM gone)),
cl AS (SELECT * FROM called WHERE event_id NOT IN (SELECT event_id FROM gone)),
fb AS (SELECT title, target, bc5, bc3, count(*) AS n FROM rd GROUP BY ALL),
fam AS (SELECT title, target, bc5, CAST(sum(n) AS BIGINT) AS total_count, count(*) FILTER (n > 1) AS above_all, string_agg(bc3 || '=' || n, ';' ORDER BY bc3) AS bc3_all FROM fb GROUP BY ALL),
hit AS (SELECT title, target, bc5, allele, pos, kind, bc3, count(*) AS n, count(*) FILTER (hq) AS hq FROM cl GROUP BY ALL),
per AS (SELECT title, target, bc5, allele, pos, kind, CAST(sum(n) AS BIGINT) AS mutation_count, CAST(sum(hq) AS BIGINT) AS hq_count, coalesce(string_agg(bc3 || '=' || hq, ';' ORDER BY bc3) FILTER (hq > 0), '') AS bc3_hq,
          count(*) FILTER (hq > 0 AND bc3 <> 'BC3_missing') AS bc3_existing, count(*) FILTER (hq > 0 AND bc3 = 'BC3_missing') AS bc3_missing, count(*) FILTER (hq > 1) AS mut_above FROM hit GROUP BY ALL),
gd AS (SELECT title, target, bc5, h.pos, count(*) FILTER (good) AS hq_reads FROM hqp h JOIN rd USING (event_id) GROUP BY ALL),
pb AS (SELECT title, target, bc5, pos, bc3, sum(hq) AS hq FROM hit WHERE pos IS NOT NULL AND hq > 0 GROUP BY ALL),
pw AS (SELECT fb.title, fb.target, fb.bc5, p.pos, fb.bc3, greatest(fb.n - coalesce(pb.hq, 0), 0) AS n FROM (SELECT DISTINCT title, target, bc5, pos FROM pb) p JOIN fb USING (title, target, bc5)
        LEFT JOIN pb ON pb.title = fb.title AND pb.target = fb.target AND pb.bc5 = fb.bc5 AND pb.bc3 = fb.bc3 AND pb.pos = p.pos),
wt AS (SELECT title, target, bc5, pos, string_agg(bc3 || '=' || CAST(n AS BIGINT), ';' ORDER BY bc3) AS bc3_wt, count(*) FILTER (n > 0 AND bc3 <> 'BC3_missing') AS bc3_wt_existing, count(*) FILTER (n > 0 AND bc3 = 'BC3_missing') AS bc3_wt_missing, count(*) FILTER (n > 1) AS wt_above FROM pw GROUP BY ALL),
tab AS (SELECT per.*, fam.total_count, fam.above_all, fam.bc3_all, CASE WHEN kind = 'sub' THEN gd.hq_reads ELSE fam.total_count END AS hq_total_count,
          CASE WHEN (CASE WHEN kind = 'sub' THEN gd.hq_reads ELSE fam.total_count END) = 0 THEN 0.0 ELSE CAST(hq_count AS DOUBLE) / (CASE WHEN kind = 'sub' THEN gd.hq_reads ELSE fam.total_count END) END AS mutation_freq,
          wt.bc3_wt, wt.bc3_wt_existing, wt.bc3_wt_missing, wt.wt_above
        FROM per JOIN fam USING (title, target, bc5) LEFT JOIN gd USING (title, target, bc5, pos) LEFT JOIN wt USING (title, target, bc5, pos))"""

_CONS = f"""{_FAMILY},
m0 AS (SELECT *, CAST(printf('%.11e', mutation_freq) AS DOUBLE) AS freq FROM tab),
m1 AS (SELECT *, CAST(printf('%.11e', 1 - sum(freq) OVER (PARTITION BY title, target, bc5, pos ORDER BY allele ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS DOUBLE) AS wt_freq FROM m0 WHERE kind <> 'wt'),
w0 AS (SELECT title, target, bc5, hq_count AS wn, freq AS wf, bc3_existing AS we FROM m0 WHERE kind = 'wt'),
fm AS (SELECT title, target, bc5, sum(CASE WHEN kind <> 'wt' THEN hq_count ELSE 0 END) > 0 AS mutated FROM tab GROUP BY ALL),
cons AS (SELECT fm.title, fm.target, fm.bc5, mutated, total_count, above_all, coalesce(wn, 0) AS unmutated, coalesce(wf, 0.0) AS unmutated_freq, coalesce(we, 0) AS wt_existing
         FROM fm JOIN fam USING (title, target, bc5) LEFT JOIN w0 USING (title, target, bc5) WHERE mutated OR wn IS NOT NULL),
mm AS (SELECT m1.* FROM m1 JOIN cons USING (title, target, bc5) WHERE cons.mutated)"""


def _applied(above: int, instead: int) -> str:
    return f"""{_CONS},
grid AS (SELECT f / 10.0::DOUBLE AS min_freq, CAST(b AS INTEGER) AS min_bc3 FROM range(0, 11) x(f), range(0, 6) y(b)),
judged AS (SELECT mm.*, min_freq, min_bc3, freq >= min_freq AND bc3_existing >= min_bc3 AND (mut_above >= {above} OR bc3_existing >= {instead}) AS ok,
             wt_freq >= min_freq AND coalesce(bc3_wt_existing, 2147483647) >= min_bc3 AND (coalesce(wt_above, 0) >= {above} OR coalesce(bc3_wt_existing, 2147483647) >= {instead}) AS wok FROM mm, grid),
named AS (SELECT *, CASE WHEN ok THEN allele ELSE CAST(pos AS VARCHAR) || 'N' END AS nm FROM (SELECT *, max(ok) OVER (PARTITION BY title, target, bc5, min_freq, min_bc3, pos) AS any_ok FROM judged) WHERE ok OR (NOT wok AND NOT any_ok)),
merged AS (SELECT title, target, bc5, min_freq, min_bc3, pos, nm, sum(freq ORDER BY allele) AS freq, sum(hq_count) AS n,
             min(CASE WHEN ok THEN regexp_replace(regexp_replace(allele, '^([0-9]+[A-Z])-$', '\\1d'), '^([0-9]+)-', '\\1i') ELSE CAST(pos AS VARCHAR) || 'N' END) AS tss, sum(wt_freq ORDER BY allele) AS wt_freq, sum(bc3_existing) AS ex, sum(mut_above) AS ma, sum(coalesce(wt_above, 0)) AS wa, count(*) AS rows_,
             CASE WHEN bool_or(bc3_wt_existing IS NULL) THEN 'NA' ELSE CAST(CAST(sum(bc3_wt_existing) AS BIGINT) AS VARCHAR) END AS wx FROM named GROUP BY ALL),
lost AS (SELECT title, target, bc5, string_agg(coalesce(CAST(bc3_wt_existing AS VARCHAR), 'NA'), ';' ORDER BY pos, allele) AS wx, string_agg(CAST(mut_above AS VARCHAR), ';' ORDER BY pos, allele) AS ma, string_agg(CAST(coalesce(wt_above, 0) AS VARCHAR), ';' ORDER BY pos, allele) AS wa FROM mm GROUP BY ALL),
picked AS (SELECT title, target, bc5, min_freq, min_bc3, string_agg(nm, ';' ORDER BY pos, nm) AS consensus, string_agg(printf('%.6f', freq), ';' ORDER BY pos, nm) AS freqs, string_agg(CAST(CAST(n AS BIGINT) AS VARCHAR), ';' ORDER BY pos, nm) AS counts, count(*) AS k,
             string_agg(tss, ';' ORDER BY pos, nm) AS tss, string_agg(printf('%.6f', wt_freq), ';' ORDER BY pos, nm) AS wtf, string_agg(CAST(CAST(ex AS BIGINT) AS VARCHAR), ';' ORDER BY pos, nm) AS ex, string_agg(CAST(CAST(ma AS BIGINT) AS VARCHAR), ';' ORDER BY pos, nm) AS ma,
             string_agg(CAST(CAST(wa AS BIGINT) AS VARCHAR), ';' ORDER BY pos, nm) AS wa, list(rows_ ORDER BY pos, nm) AS mult, string_agg(wx, ';' ORDER BY pos, nm) AS wx FROM merged GROUP BY ALL),
applied AS (SELECT title, target, bc5, grid.min_freq, grid.min_bc3, total_count, CASE WHEN mutated OR (wt_existing >= grid.min_bc3 AND (above_all >= {above} OR wt_existing >= {instead})) THEN 'kept' ELSE 'from_WThaplotype' END AS status,
              coalesce(consensus, 'WT') AS consensus, coalesce(freqs, printf('%.6f', unmutated_freq)) AS freqs, coalesce(counts, CAST(unmutated AS VARCHAR)) AS counts, CAST(CASE WHEN k IS NOT NULL THEN k WHEN mutated THEN 0 ELSE 1 END AS INTEGER) AS positions,
              coalesce(p.tss, 'WT') AS consensus_tss, coalesce(p.wtf, 'NA') AS wt_freqs, CASE WHEN k IS NOT NULL THEN p.ex WHEN mutated THEN lost.wx ELSE CAST(wt_existing AS VARCHAR) END AS bc3_existing,
              CASE WHEN k IS NOT NULL THEN p.ma WHEN mutated THEN lost.ma ELSE 'NA' END AS bc3_mut_above1, CASE WHEN k IS NOT NULL THEN p.wa WHEN mutated THEN lost.wa ELSE CAST(above_all AS VARCHAR) END AS bc3_wt_above1,
              CASE WHEN k IS NOT NULL THEN array_to_string([CAST(m * above_all AS BIGINT) FOR m IN p.mult], ';') ELSE 'NA' END AS bc3_above1,
              CASE WHEN k IS NOT NULL THEN p.wx WHEN mutated THEN lost.wx ELSE CAST(wt_existing AS VARCHAR) END AS bc3_all_wt_count
            FROM cons CROSS JOIN grid LEFT JOIN picked p USING (title, target, bc5, min_freq, min_bc3) LEFT JOIN lost USING (title, target, bc5))"""


def _counted(above: int, instead: int) -> str:
    return f"""WITH {_applied(above, instead)},
cnt AS (SELECT CAST(c AS INTEGER) AS min_count FROM unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 25, 50]) x(c)),
rows_ AS (SELECT min_freq, min_count, min_bc3, CASE WHEN total_count < min_count THEN 'rejected.low_count' WHEN status = 'kept' THEN consensus ELSE 'rejected.from_WThaplotype' END AS consensus, 1 AS n FROM applied, cnt
          UNION ALL SELECT min_freq, min_count, min_bc3, r, 0 FROM grid, cnt, unnest(['rejected.low_count', 'rejected.from_WThaplotype', 'rejected.other']) y(r))
SELECT min_freq, min_count, min_bc3, consensus, CAST(sum(n) AS BIGINT) AS barcodes_count FROM rows_ GROUP BY ALL"""


# --- the queries ---


@query(f"WITH {_RAW} SELECT * FROM raw")
def q_synth_reads(spark, sf_dir):
    """The made-up raw reads."""
    return _raw(spark, sf_dir)


@query(f"WITH {_TRIM} SELECT event_id, bc5_raw, bc3_raw, bc5, bc3, insert_seq, insert_qual, id_ok, '@' || bc5 || 'x' || bc3 || '_' || substr(header, 2) AS new_header FROM trimmed")
def q_barcode_mask(spark, sf_dir):
    """Barcodes raw and masked, insert and rewritten header of every read."""
    return trim.split_barcodes(_raw(spark, sf_dir), FACTORS).select("event_id", "bc5_raw", "bc3_raw", "bc5", "bc3", "insert_seq", "insert_qual", "id_ok", "new_header")


@query(f"WITH {_TRIM} SELECT count(*) FILTER (NOT id_ok) AS wrong_identifier, count(*) AS total, count(*) FILTER (NOT id_ok) * 100.0::DOUBLE / count(*) AS percent FROM trimmed")
def q_trim_log(spark, sf_dir):
    return trim.trim_log(trim.split_barcodes(_raw(spark, sf_dir), FACTORS))


@query(f"WITH {_ROUTE} SELECT event_id, target, shifted FROM routed")
def q_paralog_sort(spark, sf_dir):
    """Target of every read with a right identifier."""
    return trim.route(trim.split_barcodes(_raw(spark, sf_dir), FACTORS), FACTORS).select("event_id", "target", "shifted")


@query(f"WITH {_ROUTE} SELECT target, count(*) AS reads, count(*) FILTER (shifted) AS with_indels FROM routed GROUP BY target")
def q_paralog_log(spark, sf_dir):
    return trim.route_log(trim.route(trim.split_barcodes(_raw(spark, sf_dir), FACTORS), FACTORS))


@query(f"WITH {_TRIM} SELECT event_id, header, seq, qual FROM trimmed WHERE NOT id_ok")
def q_wrong_identifiers(spark, sf_dir):
    """Reads without the identifiers, as they are written apart."""
    return trim.wrong_identifiers(trim.split_barcodes(_raw(spark, sf_dir), FACTORS)).select("event_id", "header", "seq", "qual")


@query(f"WITH {_ROUTE} SELECT event_id, target, insert_seq FROM routed WHERE shifted")
def q_with_indels(spark, sf_dir):
    """Reads routed by a signature at another place."""
    return trim.with_indels(trim.route(trim.split_barcodes(_raw(spark, sf_dir), FACTORS), FACTORS)).select("event_id", "target", "insert_seq")


@query(f"WITH {_ROUTE} SELECT target, '@' || bc5 || 'x' || bc3 || '_' || substr(header, 2) AS header, insert_seq AS seq, insert_qual AS qual FROM routed")
def q_fastq_files(spark, sf_dir):
    """Routed reads written as FASTQ by target and read back."""
    routed = trim.route(trim.split_barcodes(_raw(spark, sf_dir), FACTORS), FACTORS)
    path = store.new_path(spark, "fastq")
    writers.write_fastq(routed, path, by=("target",))
    return readers.read_fastq(spark, f"{path}/target=*").select(F.regexp_extract("file", "target=([^/]+)/", 1).alias("target"), "header", "seq", "qual")


@query(f"WITH {_ALN} SELECT title, target, bc5, bc3, qname, flag, pos0, mapq, cigar, seq, qual FROM aln")
def q_sam_files(spark, sf_dir):
    """Alignments written as SAM text by sample and target and read back with both names."""
    aln, path = _aligned(spark, sf_dir), store.new_path(spark, "sam")
    writers.sam_text(aln, synth.LENGTH, by=("title", "target")).drop("k").write.partitionBy("title", "target").text(path)
    back = readers.read_sam(spark, f"{path}/title=*/target=*", names="title=([^/]+)/target=([^/]+)/")
    return back.select("title", "target", "bc5", "bc3", "qname", "flag", "pos0", "mapq", "cigar", "seq", "qual")


@query(ORACLES["q_sam_files"])
def q_bam_files(spark, sf_dir):
    """The same alignments written as BAM in coordinate order by sample and target and read back."""
    path = store.new_path(spark, "bam")
    bam.write_bam(_aligned(spark, sf_dir), path, synth.LENGTH, by=("title", "target"))
    back = bam.read_bam(spark, f"{path}/title=*/target=*/part=*", names="title=([^/]+)/target=([^/]+)/")
    return back.select("title", "target", "bc5", "bc3", "qname", "flag", "pos0", "mapq", "cigar", "seq", "qual")


@query(f"WITH {_RAW}, n AS (SELECT user_id, 'S' || user_id AS sample FROM (SELECT DISTINCT user_id FROM events)) SELECT sample, CAST(user_id AS VARCHAR) AS pair, sample || '.fq' AS file FROM n")
def q_samples_file(spark, sf_dir):
    """A samples table written with its header and read back; users stand in for samples."""
    users = _events(spark, sf_dir).select("user_id").distinct().select(F.col("user_id").cast("string").alias("pair"), F.concat(F.lit("S"), "user_id").alias("sample"))
    path = store.new_path(spark, "samples")
    writers.write_table(users.withColumn("file", F.concat("sample", F.lit(".fq"))), path)
    return readers.present(spark, path, readers.read_samples(spark, path)).select("sample", "pair", "file")


@query(f"""WITH {_RAW}, c AS (SELECT *, coalesce(list_min([i FOR i IN range(1, length(qual) - 1) IF ascii(substr(qual, i, 1)) + ascii(substr(qual, i + 1, 1)) + ascii(substr(qual, i + 2, 1)) - 99 < 84]) - 1, length(seq)) AS n FROM raw)
SELECT event_id, left(seq, n) AS seq, left(qual, n) AS qual FROM c WHERE n >= 20""")
def q_sliding_window_trim(spark, sf_dir):
    """Reads cut at the first three bases of a mean score under 28, of at least 20 bases."""
    return qc.sliding_window_trim(_raw(spark, sf_dir), mean=28, least=20).select("event_id", "seq", "qual")


@query(f"""WITH {_RAW}, x AS (SELECT i AS pos, ascii(substr(qual, i, 1)) - 33 AS s, substr(seq, i, 1) AS b FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM raw))
SELECT CAST(pos AS INTEGER) AS pos, count(*) AS reads, avg(s) AS mean, min(s) AS least, max(s) AS most, count(*) FILTER (b = 'N') AS n_bases, count(*) FILTER (b IN ('G', 'C')) AS gc FROM x GROUP BY ALL""")
def q_quality_stats(spark, sf_dir):
    return qc.position_stats(_raw(spark, sf_dir))


@query(f"WITH {_RAW}, x AS (SELECT unnest(range(1, length(seq) + 1)) AS pos, unnest(string_split(seq, '')) AS base FROM raw) SELECT CAST(pos AS INTEGER) AS pos, base, count(*) AS reads FROM x GROUP BY ALL")
def q_base_composition(spark, sf_dir):
    """Reads with each letter at each place."""
    return qc.base_composition(_raw(spark, sf_dir))


_SHARES = (0.1, 0.25, 0.5, 0.75, 0.9)


@query(f"""WITH {_RAW}, x AS (SELECT unnest(range(1, length(qual) + 1)) AS pos, ascii(unnest(string_split(qual, ''))) - 33 AS s FROM raw)
SELECT CAST(pos AS INTEGER) AS pos, {", ".join(f"CAST(quantile_disc(s, {p}) AS INTEGER) AS p{round(100 * p)}" for p in _SHARES)} FROM x GROUP BY pos""")
def q_quality_percentiles(spark, sf_dir):
    """Percentiles of the scores at each place."""
    return qc.quality_percentiles(_raw(spark, sf_dir), _SHARES)


@query(f"WITH {_RAW} SELECT CAST(100 * length(regexp_replace(seq, '[^GC]', '', 'g')) // length(seq) AS INTEGER) AS gc, count(*) AS reads FROM raw GROUP BY ALL")
def q_read_gc(spark, sf_dir):
    return qc.gc_per_read(_raw(spark, sf_dir))


@query(f"WITH {_RAW} SELECT CAST(length(seq) AS INTEGER) AS length, count(*) AS reads FROM raw GROUP BY ALL")
def q_length_histogram(spark, sf_dir):
    return qc.length_histogram(_raw(spark, sf_dir))


@query(f"WITH {_TRIM}, t AS (SELECT count(*) AS n FROM trimmed) SELECT insert_seq AS seq, count(*) AS reads, count(*) * 100.0::DOUBLE / any_value(t.n) AS percent FROM trimmed, t GROUP BY insert_seq HAVING count(*) >= 0.02 * any_value(t.n)")
def q_overrepresented(spark, sf_dir):
    """Inserts that make up 2 % of all or more."""
    return qc.overrepresented(trim.split_barcodes(_raw(spark, sf_dir), FACTORS).select(F.col("insert_seq").alias("seq")), share=0.02)


@query(f"WITH {_RAW}, c AS (SELECT seq, count(*) AS copies FROM raw GROUP BY seq) SELECT copies, count(*) AS sequences FROM c GROUP BY copies")
def q_duplication(spark, sf_dir):
    return qc.duplication(_raw(spark, sf_dir))


@query(f"WITH {_RAW} SELECT event_id, header FROM raw ORDER BY md5('100:' || header), header LIMIT 100")
def q_sample(spark, sf_dir):
    """A seeded sample of 100 reads; the limit is the operator."""
    return qc.sample_reads(_raw(spark, sf_dir), n=100).select("event_id", "header")


@query(f"WITH {_RAW} SELECT event_id, CASE WHEN instr(seq, 'AGCCA') > 0 THEN left(seq, instr(seq, 'AGCCA') - 1) ELSE seq END AS seq FROM raw")
def q_adapter_exact(spark, sf_dir):
    return qc.strip_exact_adapter(_raw(spark, sf_dir), "AGCCA").select("event_id", "seq")


@query(f"WITH {_ALN} SELECT * FROM aln")
def q_synth_alignments(spark, sf_dir):
    """The made-up alignments."""
    return _aligned(spark, sf_dir)


@query(f"""WITH {_ALN}, s AS (SELECT event_id, mapq, CASE WHEN event_id % 7 = 0 THEN '' ELSE bc5 END AS b5, CASE WHEN event_id % 11 = 0 THEN 'N' ELSE '' END || CASE WHEN bc3 = 'BC3_missing' THEN '' ELSE bc3 END AS b3 FROM aln)
SELECT event_id, CASE WHEN b5 = '' THEN 'BC5_missing' ELSE b5 END AS bc5, CASE WHEN b3 = '' THEN 'BC3_missing' ELSE b3 END AS bc3 FROM s WHERE mapq > 0 AND b5 NOT LIKE '%N%' AND b3 NOT LIKE '%N%'""")
def q_sam_rekey(spark, sf_dir):
    """Barcodes parsed back from read names; some are empty or have an N."""
    a = _aligned(spark, sf_dir)
    name = F.concat(F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("bc5")), F.lit("x"), F.when(F.col("event_id") % 11 == 0, "N").otherwise(""), F.when(F.col("bc3") == "BC3_missing", "").otherwise(F.col("bc3")), F.lit("_"), "qname")
    return mutations.rekey(a.select("event_id", "mapq", name.alias("qname"))).select("event_id", "bc5", "bc3")


@query(f"WITH {_ALN} SELECT DISTINCT bc5 FROM aln")
def q_bc5_header(spark, sf_dir):
    return align.family_names(_aligned(spark, sf_dir))


@query(f"""WITH {_ALN}, f AS (SELECT *, flag & 4 <> 0 AS u, pos0 <> 0 AS r, regexp_matches(cigar, '^([0-9]+H)?[0-9]+S') AS s FROM aln)
SELECT title, target, count(*) FILTER (u) AS unmapped, count(*) FILTER (r) AS ref_start_ne0, count(*) FILTER (s) AS query_start_ne0, count(*) FILTER (r OR s) AS start_ne0, count(*) AS total, count(*) FILTER (NOT u AND NOT r AND NOT s) AS used FROM f GROUP BY ALL""")
def q_read_filter_log(spark, sf_dir):
    return mutations.filter_log(_aligned(spark, sf_dir))


@query(f"WITH {_GAPPED} SELECT event_id, CAST(k - 1 AS INTEGER) AS k, n, op FROM ops")
def q_cigar_ops(spark, sf_dir):
    return mutations.usable(_aligned(spark, sf_dir)).select("event_id", F.posexplode(cigar_ops(F.col("cigar"))).alias("k", "o")).select("event_id", "k", "o.n", "o.op")


@query(f"WITH {_GAPPED} SELECT event_id, t, q FROM gapd")
def q_aligned_columns(spark, sf_dir):
    """Reference and read of every usable alignment, with gaps."""
    a = mutations.usable(_aligned(spark, sf_dir)).join(tables.sent_whole(_refs(spark)), "target")
    return a.withColumn("g", gapped(cigar_ops(F.col("cigar")), F.col("ref"), F.col("seq"))).select("event_id", "g.t", "g.q")


@query(f"""WITH {_CALLED}, n AS (SELECT title, target, bc5, count(*) AS bc5_count FROM ok GROUP BY ALL)
SELECT c.title, c.target, c.bc5, c.bc3, c.qname AS read_name, bc5_count, phred AS quality, pos, CASE WHEN kind = 'ins' THEN '-' WHEN kind <> 'wt' THEN regexp_extract(allele, '^[0-9]+([A-Z])', 1) END AS "from",
       CASE WHEN kind = 'del' THEN '-' WHEN kind <> 'wt' THEN regexp_extract(allele, '([A-Z]+)$', 1) END AS "to", allele FROM called c JOIN n USING (title, target, bc5)""".replace("'^[0-9]+([A-Z])', 1)", "'^[0-9]+([A-Z])', 1)").replace("regexp_extract(allele, '([A-Z]+)$', 1) END AS \"to\"", "CASE WHEN kind = 'sub' THEN right(allele, 1) ELSE regexp_extract(allele, '([A-Z]+)$', 1) END END AS \"to\""))
def q_read_mutations(spark, sf_dir):
    """Every allele of every read."""
    return mutations.read_list(_called(spark, sf_dir))


@query(f"WITH {_FAMILY} SELECT title, target, bc5, count(*) AS reads FROM rd GROUP BY ALL")
def q_control_exclusion(spark, sf_dir):
    """Reads of every family without those of an excluded allele."""
    return _eligible(spark, sf_dir).groupBy(*mutations.FAMILY).agg(F.count("*").alias("reads"))


@query(f"WITH {_CALLED}, g AS (SELECT *, count(*) OVER (PARTITION BY title, target, bc5, bc3) AS k FROM ok) SELECT event_id FROM g WHERE k >= 9")
def q_bc3_min_group(spark, sf_dir):
    """Reads of secondary barcodes with nine reads or more in their family."""
    return mutations.eligible(_called(spark, sf_dir), bc3_min_reads=9).select("event_id")


_TEXT = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["bc3"], F.lit("="), x["n"].cast("string"))), ";")
_COLS = "title, target, bc5, allele, pos, kind, mutation_count, hq_count, total_count, hq_total_count, mutation_freq, bc3_hq, bc3_existing, bc3_missing, bc3_all, bc3_wt, bc3_wt_existing, bc3_wt_missing"


def _flat(t: DataFrame) -> DataFrame:
    return t.withColumns({c: _TEXT(c) for c in ("bc3_hq", "bc3_all", "bc3_wt")}).select(*_COLS.split(", "))


@query(f"WITH {_FAMILY} SELECT {_COLS} FROM tab")
def q_family_table(spark, sf_dir):
    """Alleles of every family with their support."""
    return _flat(_table(spark, sf_dir))


@query(f"WITH {_FAMILY.replace('AND pos0 = 0', chr(65) + 'ND pos0 = 0 AND bc3 = ' + chr(39) + 'BC3_missing' + chr(39))} SELECT {_COLS} FROM tab")
def q_family_table_bc3_missing(spark, sf_dir):
    """The same over reads without a secondary barcode."""
    reads = mutations.call(mutations.usable(_aligned(spark, sf_dir), bc3="BC3_missing"), _refs(spark), FACTORS.roi)
    return _flat(family.family_table(mutations.eligible(reads, FACTORS.excluded)))


_MISSING = _FAMILY.replace("AND pos0 = 0", "AND pos0 = 0 AND bc3 = 'BC3_missing'")


@query(f"SELECT 'all' AS run, * FROM (WITH {_FAMILY} SELECT {_COLS} FROM tab) UNION ALL SELECT 'BC3_missing', * FROM (WITH {_MISSING} SELECT {_COLS} FROM tab)")
def q_family_tables_union(spark, sf_dir):
    """The runs over all reads and over those without a secondary barcode, as one table."""
    reads = store.scratch(_eligible(spark, sf_dir).select(*mutations.FAMILY, "bc3", "muts", "hqpos"), "called")  # called once for both runs
    runs = [_flat(family.family_table(r)).select(F.lit(name).alias("run"), "*") for name, r in (("all", reads), (family.MISSING, reads.where(F.col("bc3") == family.MISSING)))]
    return runs[0].union(runs[1])


@query(f"""WITH {_CONS}, t AS (
  SELECT title, target, bc5, string_agg(allele, ';' ORDER BY pos, allele) AS consensus, string_agg(regexp_replace(regexp_replace(allele, '^([0-9]+[A-Z])-$', '\\1d'), '^([0-9]+)-', '\\1i'), ';' ORDER BY pos, allele) AS consensus_tss,
         string_agg(printf('%.6f', freq), ';' ORDER BY pos, allele) AS mutation_freqs, string_agg(CAST(hq_count AS VARCHAR), ';' ORDER BY pos, allele) AS mutation_counts, count(*) AS k, string_agg(printf('%.6f', wt_freq), ';' ORDER BY pos, allele) AS wt_freqs,
         string_agg(CAST(bc3_existing AS VARCHAR), ';' ORDER BY pos, allele) AS ex, string_agg(CAST(mut_above AS VARCHAR), ';' ORDER BY pos, allele) AS ma, string_agg(CAST(coalesce(wt_above, 0) AS VARCHAR), ';' ORDER BY pos, allele) AS wa,
         string_agg(coalesce(CAST(bc3_wt_existing AS VARCHAR), 'NA'), ';' ORDER BY pos, allele) AS wx FROM mm GROUP BY ALL)
SELECT c.title, c.target, c.bc5, coalesce(consensus, 'WT') AS consensus, coalesce(consensus_tss, 'WT') AS consensus_tss, coalesce(mutation_freqs, '0') AS mutation_freqs, coalesce(mutation_counts, '0') AS mutation_counts, total_count,
       CAST(coalesce(k, 0) AS INTEGER) AS positions, coalesce(wt_freqs, printf('%.6f', unmutated_freq)) AS wt_freqs, coalesce(ex, CAST(wt_existing AS VARCHAR)) AS bc3_existing, coalesce(ma, 'NA') AS bc3_mut_above1, coalesce(wa, CAST(above_all AS VARCHAR)) AS bc3_wt_above1, CASE WHEN k IS NULL THEN CAST(above_all AS VARCHAR) ELSE rtrim(repeat(CAST(above_all AS VARCHAR) || ';', k), ';') END AS bc3_above1,
       coalesce(wx, CAST(wt_existing AS VARCHAR)) AS bc3_all_wt_count, unmutated, unmutated_freq FROM cons c LEFT JOIN t USING (title, target, bc5)""")
def q_consensus(spark, sf_dir):
    """One row for every family."""
    return consensus.rendered(_consensus(spark, sf_dir))


def _cutoffs(spark, sf_dir, strict):
    return consensus.apply_cutoffs(_consensus(spark, sf_dir), full_grid(strict=strict))


@query(f"WITH {_applied(0, 0)} SELECT * FROM applied WHERE min_freq = 0.7 AND min_bc3 = 2 AND total_count >= 4 AND status = 'kept'")
def q_cutoff_one(spark, sf_dir):
    return consensus.at_count(_cutoffs(spark, sf_dir, False), 4).where("min_freq = 0.7D and min_bc3 = 2")


@query(f"WITH {_applied(0, 0)} SELECT * FROM applied")
def q_cutoff_grid_mode0(spark, sf_dir):
    """Families under all frequency and barcode cutoffs."""
    return _cutoffs(spark, sf_dir, False)


@query(f"WITH {_applied(2, 3)} SELECT * FROM applied")
def q_cutoff_grid_mode1(spark, sf_dir):
    """The same, asking for barcodes with two reads or three barcodes."""
    return _cutoffs(spark, sf_dir, True)


@query(f"WITH {_applied(0, 0)} SELECT * FROM applied WHERE min_bc3 = 0")
def q_cutoff_nobc3(spark, sf_dir):
    """The grid without secondary barcodes."""
    return consensus.apply_cutoffs(_consensus(spark, sf_dir), full_grid(with_bc3=False))


@query(_counted(0, 0))
def q_haplotype_counts(spark, sf_dir):
    """Families of each haplotype under each of 858 cutoffs, with the rejected."""
    return families.haplotypes_of(_consensus(spark, sf_dir), full_grid(strict=False))


@query(f"SELECT * FROM ({_counted(2, 3)}) WHERE consensus LIKE 'rejected.%'")
def q_rejections(spark, sf_dir):
    return families.haplotypes_of(_consensus(spark, sf_dir), full_grid(strict=True)).where(F.col("consensus").startswith("rejected."))


@query(f"WITH {_ALN}, n AS (SELECT DISTINCT title, target, bc5 FROM aln) SELECT title, target, bc5, {_REF} AS seq FROM n WHERE bc5 <> (SELECT min(m.bc5) FROM n m WHERE m.title = n.title AND m.target = n.target)")
def q_dummy_genome(spark, sf_dir):
    """The reference under every primary barcode but the first of each target."""
    return writers.dummy_genome(_aligned(spark, sf_dir), _refs(spark), compat=True)


@query("SELECT n_nationkey AS id, coalesce(r_regionkey, 0) AS region, coalesce(n_regionkey, 0) AS nation FROM (SELECT n_nationkey, n_regionkey FROM nation WHERE n_nationkey > 2) n FULL JOIN (SELECT r_regionkey AS id, r_regionkey FROM region) r ON n.n_nationkey = r.id WHERE n_nationkey IS NOT NULL UNION ALL SELECT r_regionkey, r_regionkey, 0 FROM region WHERE r_regionkey <= 2")
def q_full_merge(spark, sf_dir):
    """Full outer merge of two small tables with 0 for what is missing."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").where("n_nationkey > 2").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("nation"))
    r = spark.read.parquet(f"{sf_dir}/region.parquet").select(F.col("r_regionkey").alias("id"), F.col("r_regionkey").alias("region"))
    return tables.full_merge(n, r, "id").select("id", "region", "nation")


@query("SELECT n_name AS sample, CAST(n_regionkey AS VARCHAR) AS pair, n_name || '.fq' AS files, n_regionkey < 3 AS ok, CAST(row_number() OVER (ORDER BY n_name) - 1 AS INTEGER) AS ordinal FROM nation WHERE n_regionkey >= 3 UNION ALL SELECT n_name, CAST(n_regionkey AS VARCHAR), n_name || '.fq;' || n_name || '_2.fq', true, CAST((SELECT count(*) FROM nation m WHERE m.n_name < n.n_name) AS INTEGER) FROM nation n WHERE n_regionkey < 3".replace("CAST(row_number() OVER (ORDER BY n_name) - 1 AS INTEGER) AS ordinal FROM nation WHERE", "CAST((SELECT count(*) FROM nation m WHERE m.n_name < n.n_name) AS INTEGER) AS ordinal FROM nation n WHERE"))
def q_design(spark, sf_dir):
    """Samples grouped by pair with their files checked; nations stand in for samples."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("sample"), F.col("n_regionkey").cast("string").alias("pair"), "n_regionkey")
    files = n.withColumn("file", F.explode(F.when(F.col("n_regionkey") < 3, F.array(F.concat("sample", F.lit(".fq")), F.concat("sample", F.lit("_2.fq")))).otherwise(F.array(F.concat("sample", F.lit(".fq"))))))
    return tables.samples_by_pair(files.select("sample", "pair", "file")).select("sample", "pair", F.array_join("files", ";").alias("files"), "ok", "ordinal")


_LANES = "SELECT c_nationkey, c_mktsegment AS pair, 'n' || c_nationkey AS sample, 'c' || c_custkey || CASE WHEN c_nationkey % 3 = 0 AND c_custkey % 2 = 0 THEN '.fq' ELSE '.fq.gz' END AS file FROM customer"


@query(f"""WITH l AS ({_LANES}), p AS (SELECT *, row_number() OVER (PARTITION BY sample, pair ORDER BY file) AS mate, ends_with(file, '.gz') AS gz FROM l),
w AS (SELECT sample, count(DISTINCT gz) = 1 AS alike, count(*) AS n, max(mate) * count(DISTINCT pair) AS whole, bool_and(gz) AS gz FROM p GROUP BY sample)
SELECT sample, CAST(mate AS INTEGER) AS mate, string_agg(file, ';' ORDER BY file) AS files, CASE WHEN alike THEN CASE WHEN w.gz THEN 'fq.gz' ELSE 'fq' END END AS extension, alike AND n = whole AS ok FROM p JOIN w USING (sample) GROUP BY ALL""")
def q_lane_parts(spark, sf_dir):
    """Files of several lanes put together by sample and mate, mixed extensions refused; customers stand in for files."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    end = F.when((F.col("c_nationkey") % 3 == 0) & (F.col("c_custkey") % 2 == 0), ".fq").otherwise(".fq.gz")
    files = c.select(F.col("c_mktsegment").alias("pair"), F.concat(F.lit("n"), "c_nationkey").alias("sample"), F.concat(F.lit("c"), "c_custkey", end).alias("file"))
    return tables.lane_parts(files).select("sample", "mate", F.array_join("files", ";").alias("files"), "extension", "ok")


ADAPTERS = ("AGCCANNNNN", "TGCATGCAGGTC")


def _pattern(adapter: str, errors: int, more: int) -> str:
    """Texts within ``errors`` (0 or 1) of an adapter that have ``more`` letters than it, as a pattern."""
    letters = [c.replace("N", ".") for c in adapter]
    n = len(letters)
    if not errors:
        return "".join(letters)
    kinds = {0: [[*letters[:i], ".", *letters[i + 1 :]] for i in range(n)], 1: [[*letters[:i], ".", *letters[i:]] for i in range(n + 1)], -1: [[*letters[:i], *letters[i + 1 :]] for i in range(n)]}
    return "|".join(dict.fromkeys("".join(x) for x in kinds[more]))


def _stretches(source: str, rate: float = 0.1, least: int = 3) -> str:
    """Rows of all stretches of reads that are stretches of the adapters: whole ones, beginnings at a read's end, ends at its start."""
    found = []
    for a, adapter in enumerate(ADAPTERS):
        m = len(adapter)
        parts = [(0, adapter), *[(1, adapter[:n]) for n in range(least, m)], *[(2, adapter[m - n :]) for n in range(least, m)]]
        for kind, part in parts:
            for errors in range(int(rate * len(part) + 1e-9) + 1):
                for near, more in ((0, 0), (1, 1), (2, -1)) if errors else ((0, 0),):
                    size = len(part) + more
                    stop = (f"unnest(range({size}, length(seq) + 1))", "length(seq)", f"{size}")[kind]
                    found.append(
                        f"SELECT * FROM (SELECT event_id, seq, {a} AS a, {kind} AS kind, {len(part)} AS used, {errors} AS errors, {size} AS size, {near} AS near, {stop} AS stop FROM {source} WHERE length(seq) >= {size}) "
                        f"WHERE regexp_full_match(substr(seq, CAST(stop - size AS INTEGER) + 1, {size}), '{_pattern(part, errors, more)}')"
                    )
    return " UNION ALL ".join(found)


def _cut_once(source: str, to: str) -> str:
    """CTEs that cut the best adapter off every ``(event_id, seq)``."""
    return f"""
{to}_hits AS ({_stretches(source)}),
{to}_kind AS (SELECT * FROM {to}_hits QUALIFY row_number() OVER (PARTITION BY event_id, a, kind ORDER BY used - errors DESC, errors, CASE WHEN kind = 0 THEN stop ELSE 0 END, near) = 1),
{to}_best AS (SELECT * FROM {to}_kind QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY used - errors DESC, errors, a, stop, kind) = 1),
{to} AS MATERIALIZED (SELECT s.event_id, CASE WHEN b.stop IS NULL THEN s.seq WHEN b.stop = b.size THEN substr(s.seq, CAST(b.stop AS INTEGER) + 1) ELSE left(s.seq, CAST(b.stop - b.size AS INTEGER)) END AS seq FROM {source} s LEFT JOIN {to}_best b USING (event_id))"""


@query(f"WITH {_RAW.replace('raw AS (', 'raw AS MATERIALIZED (', 1)}, {_cut_once('raw', 'once')}, {_cut_once('once', 'twice')} SELECT event_id, seq FROM twice")
def q_adapter_trim(spark, sf_dir):
    """Adapters cut with errors allowed, inserted and missing letters among them."""
    return adapters.trim_adapters(_raw(spark, sf_dir), list(ADAPTERS)).select("event_id", "seq")


MATE = 90
_CHOSEN = "[CASE WHEN ascii(substr(pa, i, 1)) >= ascii(substr(pb, i, 1)) THEN substr({0}, i, 1) ELSE substr({1}, i, 1) END FOR i IN range(1, n + 1)]"


@query(f"""WITH {_RAW}, m AS (SELECT header, left(seq, {MATE}) AS a, left(qual, {MATE}) AS qa, right(seq, {MATE}) AS b, right(qual, {MATE}) AS qb FROM raw),
p AS (SELECT *, least({MATE}, at_ + {MATE}) - greatest(0, at_) AS n FROM (SELECT *, CAST(unnest(range(10 - {MATE}, {MATE} - 9)) AS INTEGER) AS at_ FROM m)),
o AS (SELECT *, substr(a, greatest(at_, 0) + 1, n) AS sa, substr(qa, greatest(at_, 0) + 1, n) AS pa, substr(b, greatest(-at_, 0) + 1, n) AS sb, substr(qb, greatest(-at_, 0) + 1, n) AS pb FROM p),
k AS (SELECT * FROM o WHERE hamming(sa, sb) <= 0.1 * n AND n - hamming(sa, sb) >= {mates.least_matches(64, 1e-4)}[least(n, 64) + 1]),
w AS (SELECT *, list_sum([CASE WHEN substr(sa, i, 1) = substr(sb, i, 1) THEN 1 ELSE -1 END * (least(ascii(substr(pa, i, 1)), ascii(substr(pb, i, 1))) - 33) FOR i IN range(1, n + 1)]) AS score FROM k),
x AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY header ORDER BY score DESC, n DESC, at_) = 1)
SELECT header, left(a, greatest(at_, 0)) || array_to_string({_CHOSEN.format("sa", "sb")}, '') || substr(b, greatest(-at_, 0) + n + 1) AS seq,
       left(qa, greatest(at_, 0)) || array_to_string({_CHOSEN.format("pa", "pb")}, '') || substr(qb, greatest(-at_, 0) + n + 1) AS qual FROM x""")
def q_pair_merge(spark, sf_dir):
    """Reads cut into overlapping mates and merged again."""
    r = _raw(spark, sf_dir)
    mate = F.translate(F.reverse(F.right("seq", F.lit(MATE))), "ACGT", "TGCA")
    return mates.merge_mates(r.select("header", F.left("seq", F.lit(MATE)).alias("seq"), F.left("qual", F.lit(MATE)).alias("qual")), r.select("header", mate.alias("seq"), F.reverse(F.right("qual", F.lit(MATE))).alias("qual")))


_REF_OF = f"CASE target WHEN '{synth.LOCI[1]}' THEN '{synth.REF_B}' ELSE {_REF} END"


def _aligning(inserts: str) -> str:
    """CTEs to ``fits(target, seq, flag, pos0, mapq, cigar)`` of the different rows of ``inserts(target, seq)``: whole tables of cells, row by row, and paths step by step."""
    return f"""
tries AS MATERIALIZED (SELECT row_number() OVER (ORDER BY target, seq, flag) AS id, *, length(s) AS m FROM (
  SELECT target, seq, {_REF_OF} AS ref, unnest([0, 16]) AS flag, unnest([seq, translate(reverse(seq), 'ACGT', 'TGCA')]) AS s FROM (SELECT DISTINCT target, seq FROM {inserts}))),
dp AS (
  SELECT id, 0 AS i, j, 0 AS h, -1000000 AS f, 0 AS move, false AS f_open, false AS e_open FROM (SELECT id, unnest(range(0, length(ref) + 1)) AS j FROM tries)
  UNION ALL
  SELECT id, i, j, greatest(e, g) AS h, f, CASE WHEN e > g THEN 3 WHEN f > g0 THEN 2 WHEN pair >= -5 THEN 1 ELSE 0 END AS move, f_open, coalesce(lag(greatest(e, g)) OVER (PARTITION BY id ORDER BY j) - 6 >= e, false) AS e_open
  FROM (SELECT *, coalesce(max(g + j) OVER (PARTITION BY id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 6 - j, -1000000) AS e
    FROM (SELECT *, greatest(pair, -5) AS g0, greatest(pair, -5, f) AS g
      FROM (SELECT d.id, i + 1 AS i, j, greatest(h - 6, f) - 1 AS f, h - 6 >= f AS f_open, coalesce(lag(h) OVER (PARTITION BY d.id ORDER BY j), -1000000) + CASE WHEN substr(s, i + 1, 1) = substr(ref, CAST(j AS INTEGER), 1) THEN 1 ELSE -4 END AS pair
        FROM dp d JOIN tries USING (id) WHERE i < m)))),
ends AS (SELECT id, i, j, m, h + CASE WHEN i < m THEN -5 ELSE 0 END AS score FROM dp JOIN tries USING (id) WHERE i > 0),
tops AS MATERIALIZED (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, i DESC, j) = 1),
far AS (SELECT t.id, max(e.score) AS score FROM tops t JOIN ends e ON e.id = t.id AND e.i = t.i AND abs(e.j - t.j) > t.m // 2 GROUP BY t.id),
codes AS MATERIALIZED (SELECT id, max(j) + 1 AS width, string_agg(chr(CAST(65 + move + CASE WHEN f_open THEN 4 ELSE 0 END + CASE WHEN e_open THEN 8 ELSE 0 END AS INTEGER)), '' ORDER BY i, j) AS moves FROM dp GROUP BY id),
steps AS (
  SELECT id, i, j, 0 AS gap, '' AS ops FROM tops
  UNION ALL
  SELECT id, CASE WHEN kind = 3 THEN i ELSE i - 1 END, CASE WHEN kind = 2 THEN j ELSE j - 1 END, CASE WHEN kind = 1 OR (here >> kind) & 1 = 1 THEN 0 ELSE kind END, ('MID'[kind]) || ops
  FROM (SELECT *, CASE WHEN gap > 0 THEN gap ELSE here & 3 END AS kind FROM (SELECT w.*, ascii(substr(moves, CAST(i * width + j + 1 AS INTEGER), 1)) - 65 AS here FROM steps w JOIN codes USING (id))) WHERE i > 0 AND kind > 0),
paths AS (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(ops) DESC) = 1),
found AS (SELECT r.target, r.seq, r.flag, t.score, f.score AS far, p.j AS start, CASE WHEN p.i > 0 THEN p.i || 'S' ELSE '' END || array_to_string(list_transform(regexp_extract_all(p.ops, 'M+|I+|D+'), lambda x: length(x) || x[1]), '') || CASE WHEN t.i < t.m THEN (t.m - t.i) || 'S' ELSE '' END AS cigar
  FROM tries r JOIN tops t USING (id) JOIN paths p USING (id) LEFT JOIN far f USING (id) WHERE t.score >= 30),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target, seq ORDER BY score DESC, flag) AS k, greatest(far, coalesce(lead(score) OVER (PARTITION BY target, seq ORDER BY score DESC, flag), -1000000)) AS second FROM found),
fits AS MATERIALIZED (SELECT DISTINCT r.target, r.seq, CAST(coalesce(k.flag, 4) AS INTEGER) AS flag, CAST(coalesce(k.start, -1) AS INTEGER) AS pos0, CAST(CASE WHEN k.score IS NULL THEN 0 WHEN coalesce(second, 0) < 30 THEN 60 ELSE 60 * (k.score - second) // k.score END AS INTEGER) AS mapq, coalesce(k.cigar, '*') AS cigar
  FROM tries r LEFT JOIN ranked k ON k.target = r.target AND k.seq = r.seq AND k.k = 1)"""


@query(f"WITH RECURSIVE {_ALN}, {_aligning('aln')} SELECT event_id, f.flag, f.pos0, f.mapq, f.cigar FROM aln a JOIN fits f ON f.target = a.target AND f.seq = a.seq")
def q_align(spark, sf_dir):
    """The made-up alignments' reads aligned anew."""
    a = _aligned(spark, sf_dir).select("event_id", "target", "seq")
    return align.align(a, _refs(spark)).select("event_id", "flag", "pos0", "mapq", "cigar")


_REALIGNED = f"""{_ROUTE}, clean AS (SELECT event_id, 'S0' AS title, target, bc5, bc3, substr(header, 2) AS qname, insert_seq AS seq, insert_qual AS qual FROM routed WHERE bc5 NOT LIKE '%N%' AND bc3 NOT LIKE '%N%'), {_aligning('clean')},
aln AS (SELECT c.*, f.flag, f.pos0, f.mapq, f.cigar FROM clean c JOIN fits f ON f.target = c.target AND f.seq = c.seq WHERE f.mapq > 0)"""
_GENES = f"FROM (SELECT w.*, {_REF_OF} AS ref FROM walk w JOIN ok USING (event_id)) GROUP BY event_id, ref"
_BEFORE, _AFTER = ORACLES["q_consensus"].removeprefix("WITH").split(_ALN)
_END_TO_END = f"WITH RECURSIVE {_BEFORE}{_REALIGNED}" + _AFTER.replace(f"substr({_REF}", "substr(ref").replace("FROM walk GROUP BY event_id", _GENES)


@query(_END_TO_END)
def q_end_to_end(spark, sf_dir):
    """Raw reads to consensus rows: split, route, align, call, collate."""
    raw = _raw(spark, sf_dir).select(F.lit("S0").alias("title"), "header", "seq", "qual")
    return consensus.rendered(families.consensus_of(families.alignments_of(raw, _refs(spark), FACTORS), _refs(spark), FACTORS))


# --- many samples at once, each under its own row of the factors table ---

#: Other designs than that of ``FACTORS``: other sizes, identifiers, shares of matches and genes; the last has no secondary barcode and no identifier.
SAMPLES: tuple[Factors, ...] = (
    parse_factors({"sample": "S0", "size_f": "16", "size_r": "10", "limit_starts": "12,36", "limit_ends": "12,98", "seq_pos": "12", "seq_mut": "-T", "seq_action": "exclude", "read_seq": "GATTC|GACTC,AGCCA", "read_pos": "14|14,-6", "read_action": "include,include",
                   "sort_pos": "45,46,47,48,49,50;45,46,47,48,49,50", "sort_nucl": "A,G,T,C,C,A;G,T,C,A,A,T", "sort_refs": "LOCA;LOCB", "sort_ref": "LOCA", "sort_match": "0.75"}),
    parse_factors({"sample": "S1", "size_f": "12", "size_r": "8", "limit_starts": "40", "limit_ends": "80", "read_seq": "GAT", "read_pos": "14", "read_action": "include", "sort_pos": "49,50,52,53;49,50,52,53", "sort_nucl": "A,G,C,C;G,T,A,A", "sort_refs": "LOCA;LOCB", "sort_ref": "LOCA", "sort_match": "1"}),
    parse_factors({"sample": "S2", "size_f": "5", "size_r": "0", "limit_starts": "1,60", "limit_ends": "20,75", "seq_pos": "62,63", "seq_mut": "A-,CT", "seq_action": "exclude,exclude", "sort_pos": "56,57,58&60,61", "sort_nucl": "A,G,T&C,A", "sort_refs": "LOCB", "sort_ref": "LOCA", "sort_match": "0.6"}),
)


def _titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The made-up reads dealt to three samples."""
    return _raw(spark, sf_dir).withColumn("title", F.concat(F.lit("S"), F.col("event_id") % 3))


def _sample_sql(f: Factors) -> str:
    """DuckDB SQL that splits and routes the reads of one sample: its design spelt out."""
    checks = [" OR ".join(f"substr(seq, {p if p >= 0 else f'length(seq) + {p - len(t) + 2}'}, {len(t)}) = '{t}'" for t, p in s.alternatives) for s in f.signatures]
    cut = f"""SELECT *, left(seq, {f.size_f}) AS b5, left(qual, {f.size_f}) AS q5, right(seq, {f.size_r}) AS b3, right(qual, {f.size_r}) AS q3, substr(seq, {f.size_f + 1}, length(seq) - {f.size_f + f.size_r}) AS insert_seq,
      {" AND ".join(f"({c})" for c in checks) or "true"} AS id_ok FROM titled WHERE title = '{f.sample}'"""
    at = lambda h, o: " + ".join(f"CAST(substr(insert_seq, {p + o}, 1) = '{b}' AS INTEGER)" for p, b in h)
    first = lambda h: "CASE " + " ".join(f"WHEN {at(h, o)} >= {f.sort_match * len(h)} THEN {o}" for o in (0, -1, 1, -2, 2, -3, 3)) + " END"
    genes = [f"CASE WHEN {' AND '.join(f'({first(h)}) IS NOT NULL' for h in g.haplotypes)} THEN {{'name': '{g.name}', 'moved': {' OR '.join(f'({first(h)}) <> 0' for h in g.haplotypes)}}} END" for g in f.genes]
    return f"""SELECT event_id, title, {_mask("b5", "q5")} AS bc5, {_mask("b3", "q3")} AS bc3, insert_seq, CASE WHEN len(g) = 1 THEN g[1].name ELSE '{f.others}' END AS target, CASE WHEN len(g) = 1 THEN g[1].moved ELSE false END AS shifted
      FROM (SELECT *, list_filter([{", ".join(genes)}], lambda x: x IS NOT NULL) AS g FROM ({cut}) WHERE id_ok)"""


@query(f"WITH {_RAW}, titled AS (SELECT *, 'S' || event_id % 3 AS title FROM raw) " + " UNION ALL ".join(_sample_sql(f) for f in SAMPLES))
def q_sample_factors(spark, sf_dir):
    """Reads of three samples split, checked and routed in one plan, each by its sample's own design."""
    split = designs.split_barcodes(_titled(spark, sf_dir), designs.design_table(spark, SAMPLES))
    return designs.route(split).select("event_id", "title", "bc5", "bc3", "insert_seq", "target", "shifted")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions by sample and target; nations stand in for them."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    target = F.when(F.col("n_regionkey") < 3, synth.LOCI[0]).otherwise(F.lit(FACTORS.others))
    return n.select(F.concat(F.lit("S"), F.col("n_nationkey") % 2).alias("title"), target.alias("target"), (5 * F.col("n_nationkey") - 3).cast("int").alias("start"), (5 * F.col("n_nationkey") + 3 * F.col("n_regionkey")).cast("int").alias("stop"))


_BY_TABLE = _CALLED.replace(
    "FROM numb WHERE a <> b AND (pos = 12 OR pos BETWEEN 36 AND 98)",
    f"FROM numb JOIN (SELECT event_id, title, target FROM ok) USING (event_id) WHERE a <> b AND EXISTS (SELECT 1 FROM nation WHERE title = 'S' || n_nationkey % 2 AND target = CASE WHEN n_regionkey < 3 THEN '{synth.LOCI[0]}' ELSE '{FACTORS.others}' END AND pos BETWEEN 5 * n_nationkey - 3 AND 5 * n_nationkey + 3 * n_regionkey)",
)


@query(f"WITH {_BY_TABLE} SELECT event_id, allele, pos, kind, phred FROM called")
def q_regions_table(spark, sf_dir):
    """Alleles inside regions that a table gives for every sample and target."""
    called = mutations.call(mutations.usable(_aligned(spark, sf_dir)), _refs(spark), _regions(spark, sf_dir))
    return called.select("event_id", F.explode("muts").alias("m")).select("event_id", "m.allele", "m.pos", "m.kind", "m.phred")


# --- one pass, and streams ---


@query(f"""WITH {_ROUTE}, files AS (
  SELECT 'ok' AS sink, target, '@' || bc5 || 'x' || bc3 || '_' || substr(header, 2) AS header, insert_seq AS seq FROM routed
  UNION ALL SELECT 'withIndels', target, '@' || bc5 || 'x' || bc3 || '_' || substr(header, 2), insert_seq FROM routed WHERE shifted
  UNION ALL SELECT 'wrongId', NULL, header, seq FROM trimmed WHERE NOT id_ok)
SELECT files.*, (SELECT count(*) FROM trimmed) AS total, (SELECT count(*) FROM trimmed WHERE NOT id_ok) AS wrong_identifier, (SELECT count(*) FROM routed WHERE shifted) AS with_indels FROM files""")
def q_one_pass(spark, sf_dir):
    """All read files of a run written in one pass and read back, with the logs observed on the way."""
    reads = _raw(spark, sf_dir).withColumn("title", F.lit("S0"))
    path = store.new_path(spark, "sorted")
    log = writers.write_sorted(trim.sort_all(trim.split_barcodes(reads, FACTORS), FACTORS), path)
    target = F.nullif(F.regexp_extract("file", "target=([^/]+)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    back = readers.read_fastq(spark, f"{path}/sink=*/title=*/target=*").select(F.regexp_extract("file", "sink=([^/]+)/", 1).alias("sink"), target.alias("target"), "header", "seq")
    return back.select("*", *[F.lit(log[c]).cast("long").alias(c) for c in ("total", "wrong_identifier", "with_indels")])


@query(ORACLES["q_consensus"])
def q_stream_consensus(spark, sf_dir):
    """Alignments that arrive as files, counted batch by batch, to one row a family."""
    path = store.new_path(spark, "arriving")
    alignments = _aligned(spark, sf_dir)
    alignments.write.parquet(f"{path}/in")
    batch = -(-alignments.rdd.getNumPartitions() // 3)  # three batches; files, and with them the tasks of a batch, do not grow with the table
    stream = spark.readStream.schema(alignments.schema).option("maxFilesPerTrigger", batch).parquet(f"{path}/in")
    ingest.count_alignments(stream, _refs(spark), FACTORS, f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    return consensus.rendered(ingest.consensus_so_far(spark, f"{path}/counts"))
