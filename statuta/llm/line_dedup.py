"""Fuzzy line deduplication by MinHash, with DataFrame functions only.

A line is the text between two ``\\n``.  Its shingles are all runs of
``width`` UTF-16 code units (a shorter line is one shingle); two lines are
near copies if the Jaccard similarity of their shingle sets is at least
``threshold``.  Steps:

1. Lines with equal text become one distinct line (64-bit hash).
2. One-permutation MinHash: a shingle's hash falls into one of
   ``bands * rows`` bins and each bin keeps its minimum.  A bin that stays empty
   takes, of the line's minima hashed with the bin's number, the smallest, so
   that every line has all its bands however few shingles it has.
3. A band's key joins the minima of its bins.  In a band bucket one member
   leads: the one whose own buckets hold the most lines, as the common ancestor
   of a group of copies does.  All members are compared with it by exact Jaccard.
4. Members of a bucket that links don't join yet are held against each other by
   odd sketches: each shingle of a line flips one of ``64 * WORDS`` bits, so the
   bits in which two sketches differ are never more than the shingles in which
   the lines differ.  Pairs whose sketches differ too much are no links; the
   exact Jaccard similarity decides the others.  So of any two lines that meet
   in a band it's known whether links join them, whatever the bucket's size.
5. Union-find joins the links.  Of a component's lines, over all documents, the
   first one stays: smallest doc_id (nulls first), then smallest line number.

Lines at the threshold meet in a band with probability 1 - (1 - 0.8^4)^10 = 0.99,
closer ones practically always.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import release, remove, row_key, scan_tasks, stored
from .graph import components

THRESHOLD, WIDTH, BANDS, ROWS = 0.8, 8, 10, 4

#: Rows of two numbers up to which a table is broadcast, after its rows have been counted (about 16 MB).
BROADCAST_ROWS = 500_000

#: 64-bit words of an odd sketch.
WORDS = 16

#: Removed lines up to which they are broadcast; beyond, whole texts cross one exchange, at all larger sizes alike.
BROADCAST_GONE = 20_000

#: Pairs, or lines, whose shingles a task counts.
PAIRS_A_TASK = 500

#: Shingles whose hashes are worked out in one row.
RUN = 32

#: Shingles of a line up to which a pair's sets are held as arrays, at most some MB at a time.
HELD_SHINGLES = 1 << 16


def _units(line: str, width: int) -> list[F.Column]:
    """The line as UTF-16 and its number of shingles."""
    raw = F.encode(line, "UTF-16BE")
    return [raw.alias("raw"), F.greatest(F.lit(1), F.floor(F.length(raw) / 2).cast("int") - width + 1).alias("n")]


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__doc", row_key("doc_id", "text"))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, __doc, line_no, line, h) of lines that aren't blank."""
    keyed = _with_key(docs.select("doc_id", "text"))
    lines = keyed.select("doc_id", "__doc", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(F.trim("line") != "").withColumn("h", F.xxhash64("line"))


def _band_keys(distinct: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(h, keys) with the keys of all bands of each distinct line; needs no exchange beyond that of ``distinct``.

    A band's minima are columns of one row: so many that the aggregation holds
    a group for each band, not for each bin, and so few that its loop is compiled.
    A second aggregation puts the bands of a line side by side.
    """
    each = _shingles(distinct.select("h", *_units("line", width)), width, "h")
    each = each.select("h", F.shiftrightunsigned("x", 33).alias("v"), F.expr(f"cast((x & 4294967295) % {bands * rows} as int)").alias("bin"))
    each = each.select("h", "v", F.expr(f"bin div {rows}").cast("int").alias("band"), F.expr(f"bin % {rows}").alias("row"))
    least = each.groupBy("h", "band").agg(*[F.min(F.expr(f"if(row = {k}, v, null)")).alias(f"m{k}") for k in range(rows)])
    every = [(band, k) for band in range(bands) for k in range(rows)]
    of = least.groupBy("h").agg(*[F.max(F.expr(f"if(band = {band}, m{k}, null)")).alias(f"m{band}_{k}") for band, k in every])
    m = f"array({', '.join(f'm{band}_{k}' for band, k in every)})"
    # Most lines fill all bins and need no array functions, which aren't compiled.
    full = " and ".join(f"m{band}_{k} is not null" for band, k in every)
    plain = f"array({', '.join(f'xxhash64({band}, ' + ', '.join(f'm{band}_{k}' for k in range(rows)) + ')' for band in range(bands))})"
    # An array of one item binds a name, so that what it stands for is worked out once.
    filled = f"transform(array(filter({m}, x -> x is not null)), held -> transform({m}, (x, k) -> coalesce(x, array_min(transform(held, y -> xxhash64(k, y))))))"
    keys = f"if({full}, {plain}, transform({filled}, d -> transform(sequence(0, {bands - 1}), band -> xxhash64(band, slice(d, band * {rows} + 1, {rows}))))[0])"
    return of.select("h", F.expr(keys).alias("keys"))


def _shingles(lines: DataFrame, width: int, *keys: str) -> DataFrame:
    """(*keys, x): a row with the 64-bit hash of each shingle of ``lines`` (*keys, raw, n), in compiled code.

    An inner explode would add a filter that moves below exchanges; n is 1 at least.
    """
    each = lines.select(*keys, "raw", F.explode_outer(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    return each.select(*keys, F.xxhash64(F.expr(f"substring(raw, 2 * i - 1, {2 * width})")).alias("x"))


def _verified(pairs: DataFrame, units: DataFrame, width: int, threshold: float) -> DataFrame:
    """The links among the (a, b) of ``pairs``; ``units`` has (h, raw, n).

    The shingles of a pair are counted where the exchange puts the pair, so the
    exchange's partitions are set by the pairs' number.  Pairs of lines with at
    most ``HELD_SHINGLES`` compare two arrays; for a longer line the shingles
    are rows, so that a task may spill.
    """
    spark = pairs.sparkSession
    tasks = lambda some: max(int(spark.conf.get("spark.sql.shuffle.partitions")), scan_tasks(some, PAIRS_A_TASK))
    texts = lambda some: some.join(units.toDF("a", "raw_a", "n_a"), "a").join(units.toDF("b", "raw_b", "n_b"), "b")
    held = texts(pairs).where(F.greatest("n_a", "n_b") <= HELD_SHINGLES).repartition(tasks(pairs), "a", "b")
    ends = F.array(*[F.struct(F.col(f"raw_{e}").alias("raw"), F.col(f"n_{e}").alias("n"), F.lit(e).alias("side")) for e in "ab"])
    runs = _runs(held.select("a", "b", F.explode_outer(ends).alias("end")).select("a", "b", "end.*"), width, "a", "b", "side")
    sets = runs.groupBy("a", "b").agg(*[F.flatten(F.collect_list(F.when(F.col("side") == e, F.col("run")))).alias(f"in_{e}") for e in "ab"])
    counted = sets.select("a", "b", F.size(F.array_union("in_a", "in_b")).alias("either"), F.size(F.array_intersect("in_a", "in_b")).alias("both"))
    long = units.where(F.col("n") > HELD_SHINGLES).select("h")
    if not long.isEmpty():
        ends = [pairs.join(_small(long.toDF(e)), e, "left_semi").select("a", "b") for e in "ab"]
        far = stored(ends[0].unionByName(ends[1]).distinct(), "far")
        counted = counted.unionByName(_counted(texts(_small(far)).repartition(tasks(far), "a", "b"), width))
    return stored(counted.where(F.col("both") >= threshold * F.col("either") - 1e-9).select("a", "b"), "checked")


def _runs(lines: DataFrame, width: int, *keys: str) -> DataFrame:
    """(*keys, run): the hashes of the shingles of ``lines`` (*keys, raw, n), ``RUN`` of them in an array, by compiled code.

    A line's last shingle fills up its last array, which changes no set.  (A lambda over all shingles isn't
    compiled, and a filter on what comes of it moves into joins, where each use of it works it out anew.)
    """
    each = lines.select(*keys, "raw", "n", F.explode_outer(F.expr(f"sequence(1, n, {RUN})")).alias("i"))
    return each.select(*keys, F.array(*[F.xxhash64(F.expr(f"substring(raw, 2 * least(i + {k}, n) - 1, {2 * width})")) for k in range(RUN)]).alias("run"))


def _counted(both: DataFrame, width: int) -> DataFrame:
    """(a, b, either, both) of pairs with their texts, by a row for each shingle."""
    ends = F.array(*[F.struct(F.col(f"raw_{e}").alias("raw"), F.col(f"n_{e}").alias("n"), F.lit(bit).alias("side")) for e, bit in (("a", 1), ("b", 2))])
    ends = both.select("a", "b", F.explode_outer(ends).alias("end")).select("a", "b", "end.*")
    held = _shingles(ends, width, "a", "b", "side").groupBy("a", "b", "x").agg(F.bit_or("side").alias("sides"))
    return held.groupBy("a", "b").agg(F.count("*").cast("int").alias("either"), F.count(F.when(F.col("sides") == 3, 1)).cast("int").alias("both"))


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if a count shows that it's small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _sketches(units: DataFrame, width: int) -> DataFrame:
    """(h, n, s0, s1, ...): the number of distinct shingles and the odd sketch of each line of ``units`` (h, raw, n)."""
    tasks = max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), scan_tasks(units, PAIRS_A_TASK))
    dealt = units.repartition(tasks, "h")
    held = dealt.where(F.col("n") <= HELD_SHINGLES)
    sets = _runs(held, width, "h").groupBy("h").agg(F.array_distinct(F.flatten(F.collect_list("run"))).alias("set"))
    sets = sets.select("h", F.explode_outer("set").alias("x"))
    if not units.where(F.col("n") > HELD_SHINGLES).isEmpty():
        sets = sets.unionByName(_shingles(dealt.where(F.col("n") > HELD_SHINGLES), width, "h").distinct())
    each = sets.select("h", F.expr("shiftleft(1L, cast(x & 63 as int))").alias("bit"), F.expr(f"cast(shiftrightunsigned(x, 6) % {WORDS} as int)").alias("word"))
    return each.groupBy("h").agg(F.count("*").cast("int").alias("n"), *[F.bit_xor(F.expr(f"if(word = {k}, bit, 0L)")).alias(f"s{k}") for k in range(WORDS)])


def line_links(lines: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Verified links (a, b) that join the hashes of distinct near-copy lines; ``lines`` has (h, line)."""
    links, _, others = _rounds(lines, threshold, width, bands, rows)
    return links.unionByName(others)


def line_roots(lines: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(h, root): the smallest hash of the component of each line that has links; ``lines`` has (h, line)."""
    _, root, others = _rounds(lines, threshold, width, bands, rows)
    # The second round's links join components of the first.
    ends = [root.select(F.col("h").alias(e), F.col("root").alias(f"root_{e}")) for e in "ab"]
    moved = others.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = stored(components(moved).select(F.col("id").alias("root"), F.col("component_id").alias("top")), "joined")
    first = root.join(joined, "root", "left").select("h", F.coalesce("top", "root").alias("root"))
    alone = joined.select(F.col("root").alias("h"), F.col("top").alias("root")).join(root.select("h"), "h", "left_anti")
    return first.unionByName(alone)


def _rounds(lines: DataFrame, threshold: float, width: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of the leaders, (h, root) of what they join, and links of lines that they don't join."""
    spark = lines.sparkSession
    # Dealt out first: texts are sorted once, behind the exchange, as most lines have no copy to drop before it.
    keyed = stored(_band_keys(lines.select("h", "line").repartition("h").dropDuplicates(["h"]), width, bands, rows), "bands")
    release(spark)
    # Bands cross one exchange, in which they are both counted and picked: both sides of the join need the same columns, or each has its own.
    met = keyed.select("h", F.posexplode("keys").alias("no", "band")).select("h", F.col("no").cast("byte").alias("no"), "band").repartition("band")
    met = met.where("band is not null")
    sizes = met.groupBy("band").agg(F.count("*").alias("size"), F.min("h").alias("low"), F.min("no").alias("least")).where("size > 1 and low is not null and least is not null")
    rivals = stored(met.join(sizes.hint("shuffle_hash"), "band").select("band", "no", "h", "size"), "rivals")
    remove(spark, keyed)
    release(spark)
    weight = rivals.groupBy("h").agg(F.sum("size").alias("weight"))
    leaders = rivals.join(weight, "h").groupBy("band").agg(F.min_by("h", F.struct(-F.col("weight"), F.col("h"))).alias("leader"))
    led = stored(rivals.join(leaders, "band").select("band", "no", "h", "leader", "size"), "led")
    pairs = stored(led.where("h <> leader").select(F.least("h", "leader").alias("a"), F.greatest("h", "leader").alias("b")).distinct(), "pairs")
    texts = lines.select("h", "line").join(_small(led.select("h").distinct()), "h", "left_semi").dropDuplicates(["h"])
    units = stored(texts.select("h", *_units("line", width)), "units")
    release(spark)
    links = _verified(pairs, units, width, threshold)
    root = stored(components(links).select(F.col("id").alias("h"), F.col("component_id").alias("root")), "roots")
    release(spark)
    rooted = led.where("size > 2").join(root, "h", "left").select("band", "no", "h", "leader", F.coalesce("root", "h").alias("root"))
    split = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.when(F.col("h") == F.col("leader"), F.col("root"))).alias("leads")).where("low < high")
    apart = stored(rooted.where("h <> leader").join(split.select("band", "leads"), "band"), "apart")
    few = stored(apart.select("h").distinct(), "few")
    # Two lines meet in no band but those of ``rivals``.
    own = rivals.join(_small(few), "h", "left_semi").groupBy("h").agg(*[F.max(F.expr(f"if(no = {k}, band, null)")).alias(f"k{k}") for k in range(bands)])
    sketches = stored(_sketches(units.join(_small(few), "h", "left_semi"), width).join(own, "h"), "sketches")
    full = apart.join(sketches, "h")
    sides = [full.select([F.col(c).alias(f"{c}_{e}") for c in full.columns]) for e in "ab"]
    # Each pair once: in the first band in which it meets, and from the side that isn't with the leader (of two such: the smaller).
    first = F.coalesce(*[F.when(F.col(f"k{k}_a") == F.col(f"k{k}_b"), k) for k in range(bands)]) == F.col("no_a")
    once = (F.col("root_b") == F.col("leads_b")) | (F.col("h_a") < F.col("h_b"))
    differ = sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(1, WORDS)), F.bit_count(F.col("s0_a").bitwiseXOR(F.col("s0_b"))))
    # Lines with n and m shingles of which at least the threshold is common differ in at most this many.
    near = differ <= (1 - threshold) / (1 + threshold) * (F.col("n_a") + F.col("n_b")) + 1e-6
    meet = sides[0].where("root_a <> leads_a").join(sides[1], (F.col("band_a") == F.col("band_b")) & (F.col("root_a") != F.col("root_b")) & once & first & near)
    more = stored(meet.select(F.least("h_a", "h_b").alias("a"), F.greatest("h_a", "h_b").alias("b")), "more")
    others = _verified(more, units, width, threshold)
    remove(spark, rivals, led, pairs, units, apart, few, sketches, more)
    release(spark)
    return links, root, others


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` with text that keeps one line of each component; adds n_lines and n_removed (long).

    Needs doc_id and text; other columns pass through unchanged, n_chars (if
    there) is set to the new length.  Null text stays null with 0 lines; an
    empty text has one line; blank lines are never removed and take no part.
    Rows with equal doc_id and equal text are one document: each such row gets
    the same result.  Documents that lose every line stay, with empty text.
    Columns of the input named n_lines or n_removed are replaced.
    """
    spark = docs.sparkSession
    root = stored(line_roots(_lines(docs), threshold, width, bands, rows), "roots")
    release(spark)
    seen = _lines(docs).select("doc_id", "__doc", "line_no", "h")
    rooted = stored(seen.join(root, "h", "left").select("doc_id", "__doc", "line_no", F.coalesce("root", "h").alias("root")), "rooted")
    release(spark)
    first = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "__doc", "line_no")).alias("first"), F.count("*").alias("n")).where("n > 1")
    extra = rooted.join(first.select("root", F.col("first.__doc").alias("first_doc"), F.col("first.line_no").alias("first_no")), "root")
    extra = extra.where((F.col("__doc") != F.col("first_doc")) | (F.col("line_no") != F.col("first_no")))
    gone = stored(extra.select("__doc", "line_no").distinct(), "gone")
    remove(spark, rooted)
    release(spark)
    few = gone.count() <= BROADCAST_GONE
    gone = gone.groupBy("__doc").agg(F.collect_list("line_no").alias("__gone"))
    passed = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    base = docs.select(*[F.col(c) for c in passed], row_key("doc_id", "text").alias("__doc"))
    both = base.join(F.broadcast(gone) if few else gone.hint("shuffle_hash"), "__doc", "left")
    both = both.withColumn("__parts", F.split("text", "\n"))
    stay = F.expr("array_except(sequence(0, size(__parts) - 1), __gone)")
    kept = F.array_join(F.transform(stay, lambda i: F.get("__parts", i)), "\n")
    both = both.withColumn("__text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept))
    replaced = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    counts = [F.when(F.col(c).isNull(), 0).otherwise(F.size(of)).cast("long").alias(name) for c, of, name in (("text", "__parts", "n_lines"), ("__gone", "__gone", "n_removed"))]
    return both.select(*[replaced.get(c, F.col(c)).alias(c) for c in passed], *counts)
