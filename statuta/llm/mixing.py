"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

A source's rows, in the order of an MD5 of their id, are cut into blocks of
``block_rows``.  Each source has a whole weight w; L is the sum of weights.
Block j (from 1) of a source is released at slot floor((j - 1) * L / w) and due
by slot ceil(j * L / w); at each slot, earliest deadline first picks among the
released blocks (ties: larger weight, then source name).  At slot t every source has then been
served within less than one block of t * w / L.  The windows repeat after L
slots, so one period is scheduled and all blocks take their slot from it: the
sequential part doesn't grow with the rows.  A source that runs out leaves its
slots empty; the others keep their share of one another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stored

BLOCK_ROWS, SCALE = 64, 100

#: Largest whole weight that weights with fractions are scaled to.
FRACTIONS = 1000

#: Rows of a hash bucket inside which rows are numbered; a source is numbered over many of them.
BUCKET_ROWS = 2048

#: Slots of a period (1 MB) up to which the plan is broadcast.
BROADCAST_SLOTS = 100_000


def tempered_weights(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """(source, weight): weights in proportion to the square root of a source's rows, 1 to ``scale``."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    every = counts.agg(F.collect_list(F.struct("source", "n")).alias("of")).withColumn("top", F.expr("array_max(transform(of, x -> x.n))"))
    one = every.select(F.explode("of").alias("x"), "top")
    return one.select("x.source", F.greatest(F.lit(1), F.floor(scale * F.sqrt(F.col("x.n") / F.col("top"))).cast("int")).alias("weight"))


def schedule(weights: DataFrame) -> DataFrame:
    """(source, j, slot, period, weight): one period of the earliest-deadline-first schedule.

    ``weights`` has (source, weight), so a table of as many rows as sources.
    Rows of one source are added up.  Whole weights are taken as they are; if
    any has a fraction, all are scaled to whole ones of which the largest is
    ``FRACTIONS`` (a rounding of half of its thousandth, and 1 at least).
    Non-positive and null weights are refused.  One period is scheduled slot by
    slot in one task, in time with its slots and sources.
    """
    checked = weights.select("source", F.when(F.col("weight") > 0, F.col("weight").cast("double")).otherwise(F.raise_error(F.lit("weights must be positive"))).alias("weight"))
    summed = checked.groupBy("source").agg(F.sum("weight").alias("weight"))
    every = summed.agg(F.collect_list(F.struct("source", "weight")).alias("of")).where(F.size("of") > 0)
    whole = f"if(forall(of, x -> x.weight = floor(x.weight)), 1D, {FRACTIONS}D / array_max(transform(of, x -> x.weight)))"
    # -weight first: ties go to the larger weight, then to the source's name.
    order = "sort_array(transform(of, x -> named_struct('w', -greatest(1, cast(round(x.weight * factor) as int)), 'named', x.source is not null, 'source', x.source)))"
    one = every.withColumn("factor", F.expr(whole)).select(F.expr(order).alias("s"))
    one = one.withColumn("period", F.expr("aggregate(s, 0, (a, x) -> a - x.w)"))
    # State: blocks that each source has been served, and the picks so far.
    fold = """aggregate(sequence(0, period - 1),
      named_struct('served', transform(s, x -> 0), 'picks', cast(array() as array<int>)),
      (a, t) -> transform(array(array_min(filter(transform(s, (x, i) -> named_struct(
            'due', cast(ceil((a.served[i] + 1) * cast(period as bigint) / -x.w) as int), 'i', i,
            'free', a.served[i] < -x.w and floor(a.served[i] * cast(period as bigint) / -x.w) <= t)), y -> y.free))),
          best -> named_struct('served', transform(a.served, (n, i) -> if(i = best.i, n + 1, n)), 'picks', concat(a.picks, array(best.i))))[0],
      a -> a.picks)"""
    slots = one.select("s", "period", F.posexplode(F.expr(fold)).alias("slot", "i"))
    slots = slots.select(F.expr("s[i].source").alias("source"), F.expr("-s[i].w").alias("weight"), "period", "slot")
    return slots.withColumn("j", F.row_number().over(Window.partitionBy("source").orderBy("slot")))


def _key(column: str = "source"):
    """A source's name as a key that isn't null: a null source differs from every name."""
    return F.when(F.col(column).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(column).cast("string")))


def _numbered(docs: DataFrame, buckets: int) -> DataFrame:
    """Adds __src and __rn (from 0): the row's place in its source by (MD5 of doc_id, doc_id).

    The first hex digits deal a source's rows into ``buckets`` buckets in that order;
    rows are numbered inside a bucket and the buckets' counts are summed before it,
    so no task holds a whole source.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    dealt = docs.withColumn("__src", _key()).withColumn("__md5", digest)
    dealt = dealt.withColumn("__bucket", F.expr(f"cast(cast(conv(substr(__md5, 1, 8), 16, 10) as bigint) * {buckets} div 4294967296 as int)"))
    sizes = dealt.groupBy("__src", "__bucket").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__src").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__src", "__bucket", F.coalesce(before, F.lit(0)).alias("__before"))
    placed = dealt.withColumn("__in", F.row_number().over(Window.partitionBy("__src", "__bucket").orderBy("__md5", "doc_id")))
    placed = placed.join(offsets, ["__src", "__bucket"])
    return placed.withColumn("__rn", F.col("__before") + F.col("__in") - 1).drop("__md5", "__bucket", "__before", "__in")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row of ``docs`` with block (in its source, from 0), slot and position (long).

    Sorting by position gives the mixed order: blocks by slot, and inside a
    block rows by the MD5 of their id; positions are unique and have gaps where
    a block is short or a source has run out.  Needs doc_id and source; a null
    source is a source of its own, null ids come in the order of an empty one,
    rows with equal ids follow one another in any order.  ``weights`` (default:
    tempered_weights) must name every source that occurs; one that it doesn't
    name is refused.  Columns of the input named block, slot or position are
    replaced.  No rows give no rows.
    """
    docs = docs.drop("block", "slot", "position")
    buckets = max(16, -(-docs.count() // BUCKET_ROWS))
    plan = stored(schedule(tempered_weights(docs) if weights is None else weights), "schedule")
    numbered = _numbered(docs, buckets).withColumn("block", F.floor(F.col("__rn") / block_rows))
    sources = plan.select(_key().alias("__src"), "weight", "period", "j", "slot").groupBy("__src").agg(F.first("weight").alias("__w"), F.first("period").alias("__period"), F.expr("transform(sort_array(collect_list(struct(j, slot))), x -> x.slot)").alias("__slots"))
    # The plan has one row for each slot of a period; a plan too large to send to every task is joined by key.
    small = plan.count() <= BROADCAST_SLOTS
    both = numbered.join(F.broadcast(sources) if small else sources, "__src", "left")
    both = both.withColumn("__w", F.when(F.col("__w").isNull(), F.raise_error(F.lit("a source has no weight"))).otherwise(F.col("__w")))
    slot = F.expr("(block div __w) * __period + __slots[cast(block % __w as int)]")
    both = both.withColumn("slot", slot.cast("long"))
    both = both.withColumn("position", F.col("slot") * block_rows + F.col("__rn") % block_rows)
    return both.drop("__rn", "__src", "__w", "__period", "__slots")
