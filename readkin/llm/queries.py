"""The registered queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import let
from . import brown, centroids, decontamination, lines, mixing, outliers, periods, pieces, quality, sharding, simhash, toxicity, urls
from .common import WORD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# XXH64 as its public specification gives it, with unsigned 128-bit numbers kept below 2^64.
_P = [f"{p}::UHUGEINT" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)]
_M = f"{1 << 64}::UHUGEINT"


def _rotated(x: str, by: int) -> str:
    return f"(({x}) * {1 << by}::UHUGEINT % {_M} + ({x}) // {1 << 64 - by}::UHUGEINT)"


def _round(lane: str, word: str) -> str:
    return f"({_rotated(f'(({lane}) + ({word}) * {_P[1]}) % {_M}', 31)} * {_P[0]} % {_M})"


def _little(hex_: str, size: int) -> str:
    """Hex text as numbers of ``size`` bytes, the lowest byte first; a rest too short for one is left out."""
    turned = "".join(rf"\{k}" for k in range(size, 0, -1))
    return f"list_transform(regexp_extract_all({hex_}, '.{{{2 * size}}}'), lambda w: CAST('0x' || regexp_replace(w, '{'(..)' * size}', '{turned}') AS UHUGEINT))"


def _lane(i: int, start: int) -> str:
    return f"list_reduce([{start % (1 << 64)}::UHUGEINT] || list_slice(stripes, {i}, len(stripes), 4), lambda v, w: {_round('v', 'w')}) AS v{i}"


def _xxh64(seed: int) -> str:
    """CTEs from ``words(s)`` to ``hashed(s, h)``."""
    p1, p2 = (int(p.split(":")[0]) for p in _P[:2])
    merged = f"({' + '.join(_rotated(f'v{i}', r) for i, r in ((1, 1), (2, 7), (3, 12), (4, 18)))}) % {_M}"
    for i in range(1, 5):
        merged = f"((xor({merged}, {_round('0::UHUGEINT', f'v{i}')}) * {_P[0]} + {_P[3]}) % {_M})"
    eights = f"lambda h, w: (({_rotated(f'xor(h, {_round('0::UHUGEINT', 'w')})', 27)}) * {_P[0]} + {_P[3]}) % {_M}"
    four = f"lambda h, w: (({_rotated(f'xor(h, w * {_P[0]} % {_M})', 23)}) * {_P[1]} + {_P[2]}) % {_M}"
    ones = f"lambda h, w: (({_rotated(f'xor(h, w * {_P[4]} % {_M})', 11)}) * {_P[0]}) % {_M}"
    cut = "n // 32 * 64"
    return f"""
x0 AS (SELECT s, hex(encode(s)) AS x, strlen(s) AS n FROM words),
x1 AS (SELECT *, {_little(f"substr(x, 1, {cut})", 8)} AS stripes, substr(x, 1 + {cut}, n % 32 // 8 * 16) AS r8, substr(x, 1 + n // 8 * 16, n % 8 // 4 * 8) AS r4, substr(x, 1 + n // 4 * 8) AS r1 FROM x0),
x2 AS (SELECT *, {_lane(1, seed + p1 + p2)}, {_lane(2, seed + p2)}, {_lane(3, seed)}, {_lane(4, seed - p1)} FROM x1),
x3 AS (SELECT *, (CASE WHEN n >= 32 THEN {merged} ELSE {seed}::UHUGEINT + {_P[4]} END + n::UHUGEINT) % {_M} AS h FROM x2),
x4 AS (SELECT s, r4, r1, list_reduce([h] || {_little("r8", 8)}, {eights}) AS h FROM x3),
x5 AS (SELECT s, r1, list_reduce([h] || {_little("r4", 4)}, {four}) AS h FROM x4),
x6 AS (SELECT s, list_reduce([h] || {_little("r1", 1)}, {ones}) AS h FROM x5),
x7 AS (SELECT s, xor(h, h // {1 << 33}::UHUGEINT) * {_P[1]} % {_M} AS h FROM x6),
x8 AS (SELECT s, xor(h, h // {1 << 29}::UHUGEINT) * {_P[2]} % {_M} AS h FROM x7),
hashed AS (SELECT s, xor(h, h // {1 << 32}::UHUGEINT) AS h FROM x8)"""


def _signed(h: str) -> str:
    return f"CAST({h}::HUGEINT - CASE WHEN {h} >= {1 << 63}::UHUGEINT THEN {1 << 64}::HUGEINT ELSE 0 END AS BIGINT)"


def op10_simhash_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; linked at 3 or fewer differing bits."""
    found = simhash.components(table(spark, sf_dir, "documents"), radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 of near-equal bytes, contiguous in the order of (CRC-32, hash, doc_id)."""
    out = sharding.assign(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"))


OP10_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT row, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM d),
words AS (SELECT DISTINCT s FROM shingles),{_xxh64(42)},
halves AS MATERIALIZED (SELECT s, CAST(h // 4294967296::UHUGEINT AS BIGINT) AS hi, CAST(h % 4294967296::UHUGEINT AS BIGINT) AS lo FROM hashed),
bits AS (
  SELECT row, bit, 2 * sum((hi >> bit) & 1) > count(*) AS hi, 2 * sum((lo >> bit) & 1) > count(*) AS lo
  FROM shingles JOIN halves USING (s), (SELECT unnest(range(32)) AS bit) GROUP BY row, bit),
prints AS (SELECT row, CAST(sum(CASE WHEN hi THEN 1::BIGINT << bit ELSE 0 END) AS BIGINT) AS hi, CAST(sum(CASE WHEN lo THEN 1::BIGINT << bit ELSE 0 END) AS BIGINT) AS lo FROM bits GROUP BY row),
f AS MATERIALIZED (SELECT doc_id, coalesce(hi, 0) AS hi, coalesce(lo, 0) AS lo FROM d LEFT JOIN prints USING (row)),
nodes AS MATERIALIZED (SELECT hi, lo, min(doc_id) AS low FROM f GROUP BY hi, lo),
near AS MATERIALIZED (SELECT a.low AS a, b.low AS b FROM nodes AS a JOIN nodes AS b ON bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= 3),
reached AS (SELECT low AS a, low AS b FROM nodes UNION SELECT r.a, n.b FROM reached AS r JOIN near AS n ON r.b = n.a),
roots AS (SELECT a AS low, min(b) AS component_id FROM reached GROUP BY a)
SELECT f.doc_id, format('{{:08x}}{{:08x}}', f.hi, f.lo) AS fingerprint, component_id
FROM f JOIN nodes USING (hi, lo) JOIN roots USING (low)
"""


def _crc_steps() -> list[int]:
    """What CRC-32 folds in for each byte."""
    out = list(range(256))
    for _ in range(8):
        out = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in out]
    return out


OP6_SQL = rf"""
WITH words AS (SELECT DISTINCT coalesce(text, '') AS s FROM documents),{_xxh64(42)},
d AS (
  SELECT doc_id, strlen(s) + 1 AS size, {_signed("h")} AS h,
         xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(s)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
           lambda c, b: xor(c >> 8, {_crc_steps()}[1 + (xor(c, b) & 255)]))) AS text_crc32
  FROM documents JOIN hashed ON s = coalesce(text, '')),
r AS (
  SELECT *, sum(size) OVER () AS total, sum(size) OVER w - size AS first_byte, row_number() OVER w AS place
  FROM d WINDOW w AS (ORDER BY text_crc32, h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, least(15, first_byte * 16 // total) AS cut FROM r),
s AS (
  SELECT *, CASE WHEN sum(size) OVER g * 16 <= total * CAST(0.01 AS DOUBLE) THEN min(cut) OVER g ELSE cut END AS shard
  FROM c WINDOW g AS (PARTITION BY text_crc32, h))
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       place - min(place) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.mix(docs, weights=(1, 2, 3), cap=3)
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__taken").alias("taken"), F.col("__shard").alias("shard"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, '') AS key, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws('|', '17', CAST(doc_id AS VARCHAR), coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT *, [1, 2, 3][1 + (ord - 1) % 3] AS weight, CAST(sum(size) OVER () AS BIGINT) AS total
  FROM (SELECT key, CAST(sum(size) AS BIGINT) AS size, row_number() OVER (ORDER BY key = '', key) AS ord FROM d GROUP BY key)),
-- a source is full if the water that stands at its own brim is not more than there is
f AS (
  SELECT s.*, 3 * s.size / s.weight AS brim, (SELECT sum(least(3 * o.size, o.weight * (3 * s.size / s.weight))) FROM s AS o) <= s.total AS is_full FROM s),
t AS (
  SELECT *, CASE WHEN is_full THEN CAST(3 * size AS DOUBLE)
    ELSE weight * ((total - coalesce(sum(3 * size) FILTER (WHERE is_full) OVER (), 0)) / sum(weight) FILTER (WHERE NOT is_full) OVER ()) END AS target
  FROM f),
b AS (
  SELECT *, greatest(1, CAST(ceil(total / (16 * 65536)) AS BIGINT)) AS block, sum(target) OVER () AS wanted, count(*) OVER () AS n FROM t WHERE target > 0),
seats AS (SELECT *, CAST(round(total / block) AS BIGINT) AS house FROM b),
-- one row a seat that a source could win, ranked by quotient; shard k holds the seats from house * k / 16 on
won AS (
  SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, ord, k) AS place
  FROM (SELECT *, unnest(range(CAST(ceil(target * house / wanted) AS BIGINT) + n + 1)) AS k FROM seats)),
shards AS (SELECT unnest(range(16)) AS shard),
granted AS (
  SELECT key, size, target, block, shard, count(*) AS blocks FROM won JOIN shards ON place > house * shard // 16 AND place <= house * (shard + 1) // 16
  GROUP BY key, size, target, block, shard),
upto AS (
  SELECT *, sum(blocks) OVER (PARTITION BY key ORDER BY shard) AS upto, sum(blocks) OVER (PARTITION BY key) AS everything FROM granted),
stretch AS (
  SELECT *, size * (upto - blocks) // everything AS lo, size * upto // everything AS hi,
         CASE WHEN target >= 3 * size THEN 3 * size ELSE least(everything * block, 3 * size) END AS tokens
  FROM upto),
portions AS (
  SELECT key, shard, lo, hi, hi - lo AS around, tokens * hi // size - tokens * lo // size AS length,
         CAST('0x' || substr(md5(concat_ws('|', '17', key, CAST(shard AS VARCHAR))), 1, 15) AS BIGINT) % greatest(1, CAST(ceil((hi - lo) / block) AS BIGINT)) * block AS origin
  FROM stretch WHERE hi > lo),
placed AS (
  SELECT *, row_number() OVER () AS id, sum(size) OVER (PARTITION BY key ORDER BY h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto FROM d),
pieces AS (
  SELECT id, shard, around, length, origin, greatest(upto - size, lo) - lo AS x, least(upto, hi) - lo AS y
  FROM placed JOIN portions USING (key) WHERE size > 0 AND lo < upto AND hi > upto - size),
-- whole turns, then what the last turn covers of the piece, on the ring laid out twice
taken AS (
  SELECT id, min(shard) AS shard, sum(length // around * (y - x)
    + greatest(0, least(y, origin + length % around) - greatest(x, origin)) + greatest(0, least(y + around, origin + length % around) - greatest(x + around, origin))) AS taken
  FROM pieces GROUP BY id)
SELECT p.doc_id, p.size, t.size AS source_size, t.target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(shard AS INTEGER) AS shard
FROM placed AS p JOIN t USING (key) LEFT JOIN taken USING (id)
"""


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, links and verdict of every line of every document; lines link at up to 1 edit from 9 letters, 2 from 20."""
    return lines.classes(table(spark, sf_dir, "documents"))


def _prefix(x: str, y: str) -> str:
    """SQL for the number of letters that two texts share at their start."""
    letters = lambda t: f"regexp_extract_all({t}, '(?s).')"
    return f"(coalesce(list_position(list_transform(list_zip({letters(x)}, {letters(y)}), lambda p: p[1] IS NOT DISTINCT FROM p[2]), false) - 1, length({x})))"


# Links by the recursion of the edit distance behind the common start; eight bytes are at most two letters, so the byte distance only spares work.
OP1_SQL = rf"""
WITH RECURSIVE o AS (
  SELECT doc_id, CAST(n AS INTEGER) AS line_no, line FROM (
    SELECT doc_id, unnest(range(len(x))) AS n, trim(unnest(x), ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))
  WHERE line <> ''),
words AS (SELECT DISTINCT line AS s FROM o),{_xxh64(42)},
l AS MATERIALIZED (
  SELECT line, length(line) AS n, count(*) AS copies, min(struct_pack(d := doc_id, l := line_no)) AS first, any_value({_signed("h")}) AS id FROM o JOIN hashed ON s = line GROUP BY line),
pairs AS (
  SELECT x.id AS a, y.id AS b, x.line AS x, y.line AS y, CASE WHEN x.n >= 20 THEN 2 ELSE 1 END AS edits
  FROM l AS x JOIN (SELECT *, unnest([n, n - 1, n - 2]) AS shorter FROM l) AS y ON x.n = y.shorter
  WHERE x.n >= 9 AND (y.n > x.n OR x.id < y.id) AND levenshtein(x.line, y.line) <= 8),
started AS (
  SELECT a, b, edits, spent, substr(x, 1 + p + dx) AS x, substr(y, 1 + p + dy) AS y
  FROM (SELECT *, {_prefix("x", "y")} AS p FROM pairs), (VALUES (0, 0, 0), (1, 1, 0), (1, 0, 1), (1, 1, 1)) AS v(spent, dx, dy) WHERE spent < edits),
linked AS MATERIALIZED (
  SELECT DISTINCT a, b FROM (SELECT *, {_prefix("x", "y")} AS q FROM started)
  WHERE substr(x, 2 + q) = substr(y, 2 + q) OR substr(x, 2 + q) = substr(y, 1 + q) OR substr(x, 1 + q) = substr(y, 2 + q)),
ends AS MATERIALIZED (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (SELECT DISTINCT a AS id, a AS other FROM ends UNION SELECT r.id, k.b FROM reached AS r JOIN ends AS k ON r.other = k.a),
named AS (
  SELECT l.id, l.copies, l.first, coalesce(k.links, 0) AS links, coalesce(c.root, l.id) AS class_id FROM l
  LEFT JOIN (SELECT a AS id, count(*) AS links FROM ends GROUP BY a) AS k USING (id) LEFT JOIN (SELECT id, min(other) AS root FROM reached GROUP BY id) AS c USING (id)),
headed AS (SELECT *, min(first) OVER (PARTITION BY class_id) AS head FROM named)
SELECT o.doc_id, o.line_no, CAST(l.id AS BIGINT) AS line_id, h.copies, h.links, CAST(h.class_id AS BIGINT) AS class_id, h.head.d AS first_doc_id, h.head.l AS first_line_no,
       o.doc_id IS NOT DISTINCT FROM h.head.d AND o.line_no = h.head.l AS kept
FROM o JOIN l USING (line) JOIN headed AS h ON l.id = h.id
"""


def dated_lists(pages: DataFrame) -> DataFrame:
    """Made-up list events about the hosts of ``pages``: a rule stands in for a published list's history.

    A number from the MD5 of each domain, host and first path decides whether and when it
    is added, removed and added again.
    """
    split = pages.select(urls.host_of(F.col("url")).alias("host"), F.split(urls.path_of(F.col("url")), "/")[1].alias("first")).where("host <> ''")
    hosts = split.select("host").distinct()
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))

    def events(rows: DataFrame, list_: str, verdict: str, kind: str, pattern: Column, every: int) -> DataFrame:
        rows = rows.select(pattern.alias("pattern")).distinct().withColumn("c", F.conv(F.substring(F.md5(F.concat(F.lit(kind), "pattern").cast("binary")), 1, 7), 16, 10).cast("long")).where(F.col("c") % every == 0)
        steps = F.array(
            F.struct(F.lit("add").alias("action"), day(F.col("c") % 200).alias("at")),
            F.struct(F.lit("remove").alias("action"), day(F.col("c") % 200 + 60 + F.col("c") % 31).alias("at")),
            F.struct(F.lit("add").alias("action"), day(F.col("c") % 200 + 120 + F.col("c") % 37).alias("at")),
        )
        return rows.select(F.lit(list_).alias("list"), F.lit(verdict).alias("verdict"), F.lit(kind).alias("kind"), "pattern", F.explode(steps).alias("s")).select("list", "verdict", "kind", "pattern", "s.action", "s.at")

    domain = F.regexp_replace("host", r"^(www|m|blog)\.", "")
    return (
        events(hosts, "malware", "block", "domain", domain, 2)
        .union(events(hosts, "spam", "block", "host", F.col("host"), 3))
        .union(events(split.where("first <> ''"), "reviewed", "allow", "prefix", F.concat("host", F.lit("/"), "first"), 3))
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page by the list entries in force on the day it was fetched, a day made from its page_id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("page_id") * 7919) % 365).cast("int")))
    return urls.judge(captures, dated_lists(pages), at="fetched_on").drop("url")


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 365 AS INTEGER) AS fetched_on,
         regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', '') AS host,
         regexp_replace(regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/+', '/', 'g'), '/$', '') AS path
  FROM pages),
pats AS (
  SELECT DISTINCT 'malware' AS list, 'block' AS verdict, 'domain' AS kind, regexp_replace(host, '^(www|m|blog)\.', '') AS pattern, 2 AS every FROM p WHERE host <> ''
  UNION ALL SELECT DISTINCT 'spam', 'block', 'host', host, 3 FROM p WHERE host <> ''
  UNION ALL SELECT DISTINCT 'reviewed', 'allow', 'prefix', host || '/' || string_split(path, '/')[2], 3 FROM p WHERE host <> '' AND string_split(path, '/')[2] <> ''),
c AS (SELECT *, CAST('0x' || substr(md5(kind || pattern), 1, 7) AS BIGINT) AS c FROM pats),
e AS (
  SELECT list, verdict, kind, pattern, 'add' AS action, DATE '2024-01-01' + CAST(c % 200 AS INTEGER) AS since FROM c WHERE c % every = 0
  UNION ALL SELECT list, verdict, kind, pattern, 'remove', DATE '2024-01-01' + CAST(c % 200 + 60 + c % 31 AS INTEGER) FROM c WHERE c % every = 0
  UNION ALL SELECT list, verdict, kind, pattern, 'add', DATE '2024-01-01' + CAST(c % 200 + 120 + c % 37 AS INTEGER) FROM c WHERE c % every = 0),
v AS (
  SELECT *, CASE kind WHEN 'domain' THEN 1 WHEN 'host' THEN 2 ELSE 3 END AS r FROM (
    SELECT *, lead(since) OVER (PARTITION BY list, kind, pattern ORDER BY since, action = 'remove') AS upto FROM e)
  WHERE action = 'add'),
h AS (
  SELECT p.page_id, v.*, row_number() OVER (PARTITION BY p.page_id ORDER BY r DESC, length(pattern) DESC, verdict = 'allow' DESC, list DESC) AS k
  FROM p JOIN v ON p.fetched_on >= v.since AND (v.upto IS NULL OR p.fetched_on < v.upto) AND CASE v.kind
    WHEN 'host' THEN p.host = v.pattern
    WHEN 'domain' THEN p.host = v.pattern OR ends_with(p.host, '.' || v.pattern)
    ELSE p.host || p.path = v.pattern OR starts_with(p.host || p.path, v.pattern || '/') END)
SELECT p.page_id, p.fetched_on, coalesce(h.verdict, 'none') AS verdict, h.list, h.kind, h.pattern, h.since AS valid_from
FROM p LEFT JOIN h ON h.page_id = p.page_id AND h.k = 1
"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item into a document."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from rows outside the fold ``crc32(doc_id) % 5 = 0``."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.scores(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), learn=~held_out)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op5_brown_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned outside the fold ``crc32(doc_id) % 7 = 2``."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    return brown.score(table(spark, sf_dir, "documents").select("doc_id", "text"), learn)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its text, its source (the host) and its language there (the path)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op9_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, and whether rules and robust distance keep it."""
    return outliers.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def op11_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, squared distance and inertia of every whole vector after five rounds of 40 centroids."""
    return centroids.clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed=2)


def _nearest(r: int) -> str:
    """CTEs of the assignment ``a{r}`` to the centroids ``c{r}``, and of the next centroids."""
    return f"""
d{r} AS (SELECT x.row, c.j, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS distance FROM x JOIN c{r} AS c USING (i) GROUP BY ALL),
a{r} AS MATERIALIZED (SELECT row, min(distance) AS distance, arg_min(j, distance * 64 + j) AS j FROM d{r} GROUP BY row),
n{r} AS (SELECT a.j, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{r} AS a USING (row) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT c.j, i, CASE WHEN n IS NULL THEN c.v ELSE (s - (s % n + n) % n) // n END AS v FROM c{r} AS c LEFT JOIN n{r} USING (j, i))"""


OP11_SQL = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: isfinite(y))) = 64),
x AS MATERIALIZED (SELECT row, unnest(range(64)) AS i, unnest(list_transform(embedding, lambda y: CAST(floor(CAST(y AS DOUBLE) * 256) AS BIGINT))) AS v FROM e),
s AS (SELECT row, row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id) - 1 AS j FROM e),
c0 AS MATERIALIZED (SELECT j, i, v FROM s JOIN x USING (row) WHERE j < 40),{",".join(_nearest(r) for r in range(6))},
last AS (SELECT j, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY j)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a5 JOIN e USING (row) JOIN last USING (j)
"""


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every document whose checksum ends in 0 repeats a stretch of its words from a place on, both taken from that checksum."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(words: Column, h: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        place = (g % n).cast("int")
        return let(lambda w, a, p: F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.element_at(w, a + (i - a) % p + 1))), " "), w=words, a=place, p=(1 + F.floor((n - place) / (3 + g % 8))).cast("int"))

    some = F.regexp_instr("text", F.lit(WORD)) > 0
    return docs.select("doc_id", F.when((h % 10 == 0) & some, let(repeated, words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), h=h)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, some of which are made to repeat first; the greatest run and digests of all."""
    found = periods.runs(planted(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")

    def greater(best: Column, x: Column) -> Column:
        # length / period compared without rounding; runs come by start, then period, so the first of equals stays
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")])), "\n")
    some = F.size("runs") > 0
    out = found.withColumns({"best": F.aggregate("runs", none, greater), "lines": F.when(some, F.concat(lines, F.lit("\n"))).otherwise("")})
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _grams(k: int) -> str:
    """CTEs from the names of 2**k-word stretches to those twice as long."""
    return f"g{k + 1} AS MATERIALIZED (SELECT row, i, md5(g || lead(g, {1 << k}) OVER (PARTITION BY row ORDER BY i)) AS g FROM g{k} QUALIFY lead(g, {1 << k}) OVER (PARTITION BY row ORDER BY i) IS NOT NULL)"


_LONGEST = 18  # stretches of up to 2**18 words; runs with longer periods would need more

#: A run of smallest period q shows as the next occurrence of each of its stretches of g words q words on, for g from q to 2 * q.
OP12_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, crc32, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w
  FROM (SELECT *, xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS BIGINT)),
           lambda c, b: xor(c >> 8, {{steps}}[1 + (xor(c, b) & 255)]))) AS crc32 FROM documents)),
m AS (SELECT *, len(w) AS n, crc32 // 10 % greatest(len(w), 1) AS a FROM d),
o AS (SELECT *, 1 + (n - a) // (3 + crc32 // 10 % 8) AS p FROM m),
t AS MATERIALIZED (SELECT row, doc_id, n, unnest(range(n)) AS i, unnest(CASE WHEN crc32 % 10 = 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END) AS word FROM o WHERE n > 0),
g0 AS MATERIALIZED (SELECT row, i, md5(word) AS g FROM t),
{", ".join(_grams(k) for k in range(_LONGEST))},
next AS ({" UNION ALL ".join(f"SELECT row, i, {1 << k} AS size, lead(i) OVER (PARTITION BY row, g ORDER BY i) - i AS q FROM g{k}" for k in range(4, _LONGEST + 1))}),
fit AS (SELECT * FROM next WHERE q IS NOT NULL AND size <= greatest(24 - q, 2 * q) AND greatest(24 - q, 2 * q) < 2 * size),
island AS (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS k FROM fit),
runs AS MATERIALIZED (SELECT row, min(i) AS start, count(*) - 1 + any_value(size) + q AS length, q AS period FROM island GROUP BY row, q, k HAVING count(*) - 1 + any_value(size) + q >= greatest(24, 3 * q)),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
all_ AS (SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s FROM runs GROUP BY row),
gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS s FROM t ANTI JOIN gone USING (row, i) GROUP BY row)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(a.s, '')) AS runs_sha256, sha256(coalesce(k.s, '')) AS collapsed_sha256
FROM d LEFT JOIN all_ AS a USING (row) LEFT JOIN best USING (row) LEFT JOIN kept AS k USING (row)
""".replace("{steps}", str(_crc_steps()))


def op13_merge_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of pieces of every document, and digests of their ids and of the text that they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode(pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_url_filter, op3_decontamination, op4_toxicity, op5_brown_scoring, op6_sharding, op7_quality, op8_mixing, op9_robust_outliers, op10_simhash_vantage_trees, op11_delta_lloyd, op12_periodic_runs, op13_merge_pieces)}

ORACLES: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op2_url_filter": OP2_SQL, "op6_sharding": OP6_SQL, "op8_mixing": OP8_SQL, "op10_simhash_vantage_trees": OP10_SQL, "op11_delta_lloyd": OP11_SQL, "op12_periodic_runs": OP12_SQL}
