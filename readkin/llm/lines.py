"""Line dedup: a segment-partition edit join of lines, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, scratch

#: ``(letters, edits)``: lines of at least so many letters link at up to so many edits; the shorter of two lines decides.
BANDS = ((9, 1), (20, 2))

Bands = tuple[tuple[int, int], ...]


def occurrences(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line, line_id`` of every line with more than white space, trimmed; lines count from 0."""
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line", F.btrim("line", F.lit(" \t\r\x0b\x0c")))
    return rows.where("line <> ''").withColumn("line_id", F.xxhash64("line"))


def _cut(length: Column, i: int | Column, parts: int) -> Column:
    """Where segment ``i`` (from 0) of a line of that length starts, from 0."""
    return F.floor(length * i / parts).cast("int")


def _key(line: Column, start: Column, size: Column, i: int | Column, length: Column) -> Column:
    return F.xxhash64(F.substring(line, start + 1, size), F.lit(i), length)


def _keys(length: Column, parts: int, places: list[tuple[int, int]]) -> Column:
    """Keys of ``line`` for segments ``i`` of a line of that length, ``s`` letters further on, for all ``(i, s)``: one lambda, as spelt out they make a method too long to be compiled."""

    def key(at: Column) -> Column:
        start = _cut(length, at["i"], parts)
        return _key(F.col("line"), start + at["s"], _cut(length, at["i"] + 1, parts) - start, at["i"], length)

    return F.transform(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("s")) for i, s in places]), key)


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _checked(bands: Bands) -> list[tuple[int, int, int]]:
    """``(from, below, edits)`` of each band."""
    if any(low < (edits + 1) ** 2 for low, edits in bands):
        raise ValueError("a band must begin at (edits + 1) ** 2 letters or more, so that every probe lies inside its line")
    return [(low, bands[k + 1][0] if k + 1 < len(bands) else 1 << 30, edits) for k, (low, edits) in enumerate(bands)]


def segments(bands: Bands) -> Column:
    """Index keys of a line ``line, length``: its ``edits + 1`` segments, each with its number and the line's length."""
    n, out = F.col("length"), _none()
    for low, below, edits in _checked(bands):
        parts = edits + 1
        out = F.when((n >= low) & (n < below), _keys(n, parts, [(i, 0) for i in range(parts)])).otherwise(out)
    return out


def probes(bands: Bands) -> Column:
    """Probe keys of a line for index lines of its own length and up to ``edits`` less, but for its own index keys.

    A match at segment i has at most i edits before it and ``edits - i`` behind,
    which leaves only a few starts for each segment and length.
    """
    n, out = F.col("length"), []
    for low, below, edits in _checked(bands):
        parts = edits + 1
        for less in range(edits + 1):
            m, places = n - less, [(i, s) for i in range(parts) for s in range(-i, i + 1) if abs(s - less) <= edits - i and (s or less)]
            if places:
                out.append(F.when((m >= low) & (m < below), _keys(m, parts, places)).otherwise(_none()))
    return F.concat(*out)


#: Letters that are counted to tell lines apart before their texts are fetched.
COUNTED = "etaonihrsdlu"


def letter_counts(line: Column) -> Column:
    """How often a line has each of ``COUNTED``, modulo 16, four bits each."""
    size = F.octet_length(line)
    count = lambda c: (size - F.octet_length(F.replace(line, c, F.lit("")))).bitwiseAND(F.lit(15)).cast("long")
    return F.aggregate(F.array(*map(F.lit, COUNTED)), F.lit(0).cast("long"), lambda a, c: F.shiftleft(a, 4).bitwiseOR(count(c)))


def _near_counts(a: Column, b: Column, edits: int) -> Column:
    """False only for lines over ``edits`` edits apart: an edit changes two counts by one at most."""
    total = F.lit(0).cast("long")
    for k in range(len(COUNTED)):
        d = (F.shiftright(a, 4 * k) - F.shiftright(b, 4 * k)).bitwiseAND(F.lit(15).cast("long"))
        total = total + F.least(d, 16 - d)
    return total <= 2 * edits


def parity(letters: Column) -> Column:
    """A bit for each of 64 groups of letters: whether a line has an odd number of them; an edit changes two bits at most."""
    return F.aggregate(letters, F.lit(0).cast("long"), lambda a, c: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)))


def _near_parity(a: Column, b: Column, edits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= 2 * edits


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def bit_distance(longer: Column, shorter: Column, edits: int) -> Column:
    """Edit distance of two arrays of letters where it is at most ``edits``, else a greater number.

    Banded bit-parallel dynamic programming: one step a letter of the shorter
    line; bit ``d`` of a word stands for the cell ``d - edits`` below the main
    diagonal, so the whole band moves down one row a step and a column is a few
    word operations however long the lines are.  The distance is followed along the diagonal that ends
    in the last cell.
    """
    return _let(F.struct(longer.alias("l"), shorter.alias("s")), lambda x: _bit_distance(x["l"], x["s"], edits))


def _bit_distance(longer: Column, shorter: Column, edits: int) -> Column:
    width = 2 * edits + 1
    full = (1 << width) - 1
    lit = lambda x: F.lit(x).cast("long")
    off = F.size(longer) - F.size(shorter)
    edge = F.array_repeat(F.lit(None).cast("string"), edits)

    def matches(x: Column) -> Column:
        """For each letter of the shorter line the bits of the band in which the longer one has it."""

        def mask(c: Column, j: Column) -> Column:
            out = lit(0)
            for d in range(width):
                out = out.bitwiseOR(F.when(F.get(x, j + d) == c, lit(1 << d)).otherwise(lit(0)))
            return out

        return F.transform(shorter, mask)

    def inverse(x: Column) -> Column:
        return x.bitwiseXOR(lit(full))

    def step(acc: Column, x: Column) -> Column:
        vp, vn = acc["vp"], acc["vn"]
        moved = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(lit(full))

        def after(d0: Column) -> Column:
            hp, hn, below = vn.bitwiseOR(inverse(d0.bitwiseOR(vp))), d0.bitwiseAND(vp), F.shiftrightunsigned(d0, 1)
            return F.struct(
                hn.bitwiseOR(inverse(below.bitwiseOR(hp))).alias("vp"), below.bitwiseAND(hp).alias("vn"), (acc["cost"] + 1 - F.call_function("shiftright", d0, off + edits).bitwiseAND(lit(1))).cast("long").alias("cost")
            )

        return _let(moved, after)

    start = F.struct(lit(full & ~((1 << edits) - 1)).alias("vp"), lit(0).alias("vn"), off.cast("long").alias("cost"))
    cost = F.aggregate(_let(F.concat(edge, longer, edge), matches), start, step, lambda acc: acc["cost"])
    return F.when(off > edits, off.cast("long")).when(F.size(shorter) == 0, off.cast("long")).otherwise(cost)


def _shared(a: Column, b: Column, most: Column, behind: bool, skip: Column) -> Column:
    """Letters (at most 131,071 of ``most``) that two texts share at their start, or at their end; ``skip`` letters are their common start."""

    def same(lo: Column, s: int) -> Column:
        if behind:
            return F.substring(a, F.char_length(a) - lo - s + 1, F.lit(s)) == F.substring(b, F.char_length(b) - lo - s + 1, F.lit(s))
        return F.substring(a, lo + 1, F.lit(s)) == F.substring(b, lo + 1, F.lit(s))

    out = F.lit(0)
    for k in range(16, -1, -1):
        s = 1 << k
        out = _let(out, lambda lo, s=s: F.when((lo + s <= most - skip) & same(lo, s), lo + s).otherwise(lo))
    return out


def line_distance(a: Column, b: Column, edits: int) -> Column:
    """``bit_distance`` of two texts without the start and the end that they share, which does not change it."""

    def cut(x: Column) -> Column:
        long, short = x["long"], x["short"]
        most = F.char_length(short)

        def inner(head: Column) -> Column:
            def middle(tail: Column) -> Column:
                part = lambda t: F.substring(t, head + 1, F.char_length(t) - head - tail)
                letters = lambda t: F.when(F.char_length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, ""))
                return bit_distance(letters(part(long)), letters(part(short)), edits)

            return _let(_shared(long, short, most, True, head), middle)

        return _let(_shared(long, short, most, False, F.lit(0)), inner)

    longer = F.char_length(a) >= F.char_length(b)
    return _let(F.struct(F.when(longer, a).otherwise(b).alias("long"), F.when(longer, b).otherwise(a).alias("short")), cut)


def _within(a: Column, b: Column, bands: Bands) -> Column:
    """Whether two texts are within the edits of the shorter one's band."""
    n, allowed = F.least(F.char_length(a), F.char_length(b)), F.lit(-1)
    for low, edits in bands:
        allowed = F.when(n >= low, F.lit(edits)).otherwise(allowed)
    return line_distance(a, b, max(e for _, e in bands)) <= allowed


def keyed(lines: DataFrame, bands: Bands) -> DataFrame:
    """``lines(line_id, line, ..)`` with ``counts, own, asks``: letter counts, index keys and probe keys that are not its own."""
    out = lines.withColumn("length", F.char_length("line")).withColumns({"own": segments(bands), "asks": probes(bands), "counts": letter_counts(F.col("line"))})
    return out.withColumn("asks", F.array_except("asks", "own"))


def _meet(index: DataFrame, asks: DataFrame, edits: int) -> DataFrame:
    """Different pairs ``a > b`` of lines that meet at a key; index rows meet probe rows and each other."""

    def with_(x: DataFrame, apart: str) -> DataFrame:
        x, y = x.alias("x"), index.alias("y")
        met = x.join(y, (F.col("x.key") == F.col("y.key")) & F.expr(apart) & _near_counts(F.col("x.counts"), F.col("y.counts"), edits))
        return met.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b"))

    return with_(asks, "x.id <> y.id").union(with_(index, "x.id > y.id")).distinct()


def _fetched(lines: DataFrame, ids: DataFrame, broadcast_rows: int) -> DataFrame:
    """``line_id, line, odd`` of the lines asked for; ``lines`` may repeat them."""
    small = ids.count() <= broadcast_rows  # a plan's choice only
    found = lines.join(F.broadcast(ids) if small else ids, "line_id", "left_semi").groupBy("line_id").agg(F.first("line").alias("line"))
    return scratch(found.withColumn("odd", parity(F.split("line", ""))), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, bands: Bands) -> DataFrame:
    """The pairs that are near enough: by letter parities, then by distance; pairs of a common hot key are left out."""
    edits = max(e for _, e in bands)
    side = lambda c, cols: texts.select(F.col("line_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in cols])
    small = ["odd", *(x for x in ("hot", "hot_own") if x in texts.columns)]
    pairs = pairs.join(side("a", small), "a").join(side("b", small), "b").where(_near_parity(F.col("odd_a"), F.col("odd_b"), edits))
    if "hot" in texts.columns:
        pairs = pairs.where(~F.arrays_overlap("hot_a", "hot_own_b") & ~F.arrays_overlap("hot_b", "hot_own_a"))
    pairs = scratch(pairs.select("a", "b"), "pairs")
    return pairs.join(side("a", ["line"]), "a").join(side("b", ["line"]), "b").where(_within(F.col("line_a"), F.col("line_b"), bands)).select("a", "b")


def linked(lines: DataFrame, bands: Bands = ((20, 2),), broadcast_rows: int = 1_000_000) -> DataFrame:
    """``a, b``: all pairs of different ``lines(line_id, line)`` within the edits of their band, a > b.

    Two lines within ``edits`` edits share at least one of the ``edits + 1``
    segments of the shorter at nearly the same place.  Index rows hold a line's
    segments, probe rows the other substrings of a line that may be such segments;
    both are keyed with segment number and length.  Index rows meet probe rows,
    and each other, in equi-joins that also compare letter counts.  The texts of
    candidates alone are fetched; pairs whose letter parities agree are verified.
    The pairs of a group grow with its square; ``links`` sums them up instead.
    """
    edits = max(e for _, e in bands)
    table = scratch(keyed(lines, bands).select("line_id", "counts", "own", "asks"), "segments")
    pairs = scratch(_meet(_exploded(table, "own"), _exploded(table, "asks"), edits), "candidates")
    texts = _fetched(lines, scratch(pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct(), "asked"), broadcast_rows)
    return _verified(pairs, texts, bands)


def _exploded(table: DataFrame, keys: str) -> DataFrame:
    return table.select(F.explode(keys).alias("key"), F.col("line_id").alias("id"), "counts")


def _tiles(members: DataFrame, texts: DataFrame, tile: int, letters: int, broadcast: bool) -> DataFrame:
    """``key, kind, i, j, asks, homes``: bounded blocks of a hot key's lines, block against block.

    Index lines (``home``) of a key are dealt to blocks by a hash; a pair of them
    meets in the tile of its two blocks (kind 0).  Probe lines are dealt to
    blocks of their own and meet every block of index lines (kind 1).  A block has about
    ``tile`` lines, fewer of long lines: about ``letters`` letters in all.
    """
    rows = members.join(texts.select(F.col("line_id").alias("id"), "line", "odd", "counts", "hot", "hot_own"), "id")
    most = F.greatest(F.lit(4), F.least(F.lit(tile), F.floor(F.lit(letters) / F.max(F.char_length("line")))))
    blocks = lambda home: F.ceil(F.count_if(home) / most).cast("int")
    sizes = scratch(rows.groupBy("key").agg(blocks(F.col("home")).alias("hb"), blocks(~F.col("home")).alias("nb")), "sizes")
    block = F.pmod(F.xxhash64("id", F.lit(5)), F.when(F.col("home"), F.col("hb")).otherwise(F.col("nb"))).cast("int")
    rows = rows.join(F.broadcast(sizes) if broadcast else sizes, "key").withColumn("block", block)
    spot = lambda kind, i, j, asks: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"))
    b, upto = F.col("block"), lambda x, y: F.sequence(x, y)
    nowhere = F.array().cast("array<struct<kind:int,i:int,j:int,asks:boolean>>")
    home = F.concat(
        F.transform(upto(F.lit(0), b), lambda j: spot(0, b, j, True)), F.transform(upto(b, F.col("hb") - 1), lambda i: spot(0, i, b, False)),
        F.when(F.col("nb") > 0, F.transform(upto(F.lit(0), F.col("nb") - 1), lambda i: spot(1, i, b, False))).otherwise(nowhere),
    )
    spots = F.when(F.col("home"), home).otherwise(F.transform(upto(F.lit(0), F.col("hb") - 1), lambda j: spot(1, b, j, True)))
    line = F.struct("id", "counts", "odd", "hot", "hot_own", "line")
    dealt = rows.select("key", F.explode(spots).alias("s"), line.alias("x")).select("key", "s.*", "x")
    out = dealt.groupBy("key", "kind", "i", "j").agg(F.collect_list(F.when(F.col("asks"), F.col("x"))).alias("asks"), F.collect_list(F.when(~F.col("asks"), F.col("x"))).alias("homes"))
    return out.where("size(asks) > 0 and size(homes) > 0")


def _summed(tiles: DataFrame, bands: Bands) -> DataFrame:
    """``id, other, n``: for every linked line of a tile how many links it has there, and a line that it hangs together with.

    Never the pairs: of each probing line its first match, of each index line the
    first of those that the probing lines tie together, which connects what the pairs do.
    A pair of several hot keys counts at the least of them.
    """
    edits = max(e for _, e in bands)

    def near(p: Column, h: Column) -> Column:
        owner = F.array_min(F.concat(F.array_intersect(p["hot"], h["hot_own"]), F.array_intersect(h["hot"], p["hot_own"])))
        once = (F.col("kind") == 1) | (F.col("i") != F.col("j")) | (p["id"] > h["id"])
        return once & _near_counts(p["counts"], h["counts"], edits) & _near_parity(p["odd"], h["odd"], edits) & (owner == F.col("key")) & _within(p["line"], h["line"], bands)

    def tied(met: Column, n: Column) -> Column:
        """Of each index line the least number of those tied to it."""

        def join(label: Column, m: Column) -> Column:
            merge = lambda some: F.when(F.size(some) > 1, F.transform(label, lambda x: F.when(F.array_contains(some, x), F.array_min(some)).otherwise(x))).otherwise(label)
            return F.when(F.size(m) > 1, _let(F.array_distinct(F.transform(m, lambda x: F.get(label, x))), merge)).otherwise(label)

        return F.aggregate(met, F.sequence(F.lit(0), n - 1), join)

    def rows(t: Column) -> Column:
        met, label = t["met"], t["label"]
        row = lambda a, b, n: F.struct(a["id"].alias("id"), b["id"].alias("other"), n.cast("long").alias("n"))
        asks = F.transform(met, lambda m, k: F.when(F.size(m) > 0, row(F.get("asks", k), F.get("homes", F.get(m, F.lit(0))), F.size(m))))
        times = lambda h: F.aggregate(met, F.lit(0), lambda a, m: a + F.array_contains(m, h).cast("int"))
        homes = F.transform(label, lambda x, h: _let(times(h), lambda n: F.when(n > 0, row(F.get("homes", h), F.get("homes", x), n))))
        return F.filter(F.concat(asks, homes), lambda x: x.isNotNull())

    number = F.sequence(F.lit(0), F.size("homes") - 1)
    met = F.transform("asks", lambda p: F.filter(number, lambda h: near(p, F.get("homes", h))))
    out = tiles.select(F.explode(_let(met, lambda m: _let(F.struct(m.alias("met"), tied(m, F.size("homes")).alias("label")), rows))).alias("r"))
    return out.select("r.*")


def links(table: DataFrame, lines: DataFrame, bands: Bands = BANDS, hot: int = 64, tile: int = 256, letters: int = 1 << 18, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``id, other, n``: the links of all lines summed up; ``table`` are the ``keyed`` lines, ``lines(line_id, line)`` their texts, repeats allowed.

    The sum of ``n`` is a line's number of links, and the edges ``id, other`` connect
    exactly the lines that links connect.  Keys with more than ``hot`` index lines
    are compared in tiles that send on a row a line, so the rows of a group of n near
    copies grow with n times the number of its blocks.  Other keys are joined, with at most ``hot``
    partners a row; both ways find and count the same links.
    """
    edits = max(e for _, e in bands)
    own, asks = _exploded(table, "own"), _exploded(table, "asks")
    crowded = scratch(own.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"), "hot")
    n_hot = crowded.count()
    some = F.broadcast(crowded) if n_hot <= broadcast_rows else crowded
    pairs = scratch(_meet(own.join(some, "key", "left_anti") if n_hot else own, asks, edits), "candidates")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct()
    if not n_hot:
        sure = _verified(pairs, _fetched(lines, scratch(asked, "asked"), broadcast_rows), bands)
        return _both(sure)
    keys = F.concat(F.transform("own", lambda k: F.struct(k.alias("key"), F.lit(True).alias("home"))), F.transform("asks", lambda k: F.struct(k.alias("key"), F.lit(False).alias("home"))))
    members = table.select(F.col("line_id").alias("id"), "counts", F.explode(keys).alias("k")).select("id", "counts", "k.key", "k.home")
    members = scratch(members.join(some, "key", "left_semi"), "members")
    in_hot = members.groupBy(F.col("id").alias("line_id")).agg(F.first("counts").alias("counts"), F.collect_set("key").alias("hot"), F.collect_set(F.when(F.col("home"), F.col("key"))).alias("hot_own"))
    in_hot = scratch(in_hot, "in_hot")
    texts = _fetched(lines, scratch(asked.union(in_hot.select("line_id")).distinct(), "asked"), broadcast_rows)
    texts = texts.join(in_hot, "line_id", "left").withColumns({c: F.coalesce(c, _none()) for c in ("hot", "hot_own")})
    texts = scratch(texts, "hot_texts")
    sums = _summed(_tiles(members.select("id", "key", "home"), texts.where(F.size("hot") > 0), tile, letters, n_hot <= broadcast_rows), bands)
    return sums.union(_both(_verified(pairs, texts, bands)))


def _both(pairs: DataFrame) -> DataFrame:
    one = F.lit(1).cast("long").alias("n")
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("other"), one).union(pairs.select("b", "a", one))


def classes(docs: DataFrame, bands: Bands = BANDS, **options) -> DataFrame:
    """Every line of ``docs(doc_id, text)``: ``doc_id, line_no, line_id, copies, links, class_id, first_doc_id, first_line_no, kept``.

    Lines are trimmed; equal lines are one (known by a 64-bit hash, ``line_id``)
    with ``copies`` occurrences; different lines link at up to the edits of the
    shorter one's band, ``links`` of them; lines shorter than the first band only equal each other.
    ``class_id`` is the least line_id reachable over links, and of a class only
    the first occurrence by (doc_id, line_no) is ``kept``.

    Null texts and lines of white space give no row; a null doc_id comes
    first; a repeated doc_id with equal lines keeps as many equal rows as come
    first together; an empty table gives no row; no other column is read.
    """
    rows = occurrences(docs.select("doc_id", "text"))
    # Keys, not texts, are gathered by line.
    each = keyed(rows, bands).groupBy("line_id").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "line_no")).alias("first"), *[F.first(c).alias(c) for c in ("counts", "own", "asks")])
    lines = scratch(each, "lines")
    found = scratch(links(lines.where(F.size("own") > 0).select("line_id", "counts", "own", "asks"), rows.select("line_id", "line"), bands, **options), "links")
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    degree = found.groupBy(F.col("id").alias("line_id")).agg(F.sum("n").alias("links"))
    tied = scratch(roots.join(degree, roots.node == degree.line_id).select("line_id", "links", "root").join(lines.select("line_id", "first"), "line_id"), "tied")
    heads = tied.groupBy("root").agg(F.min("first").alias("head"))
    tied = scratch(tied.join(heads, "root").select("line_id", "links", "root", "head"), "classes")
    named = lines.select("line_id", "copies", "first").join(tied, "line_id", "left")
    named = scratch(named.select("line_id", "copies", F.coalesce("links", F.lit(0).cast("long")).alias("links"), F.coalesce("root", "line_id").alias("class_id"), F.coalesce("head", "first").alias("head")), "named")
    out = rows.select("doc_id", "line_no", "line_id").join(named, "line_id")
    first = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("line_no") == F.col("head.line_no"))
    return out.select("doc_id", "line_no", "line_id", "copies", "links", "class_id", F.col("head.doc_id").alias("first_doc_id"), F.col("head.line_no").alias("first_line_no"), first.alias("kept"))


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs``, in all its columns of any names, with the lines that ``classes`` does not keep taken out of each text.

    Rows are known by doc_id, which must be unique here; lines of white space stay.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    id_, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    gone = classes(docs, **options).where(~F.col("kept")).groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("line_no").alias("gone"))
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("gone", i))
    now = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    out = plain.join(gone, id_.eqNullSafe(F.col("of")), "left")
    return out.select(*[(now if c == "text" else F.col(f"c{i}")) for i, c in enumerate(docs.columns)]).toDF(*docs.columns)
