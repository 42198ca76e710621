"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Every source is a stream of its documents in a shuffled order, cut into blocks of equal numbers of
words. The mix is a sequence of slots. Slot ``k`` is mapped to the point ``frac(k * golden ratio)``,
and the point through the cumulative shares of the sources to a source, so every stretch of the mix
holds the sources near their shares. The ``r``-th slot of a source takes its block ``r`` (modulo the
number of blocks: a second pass repeats the stream), the last one only up to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 1024
WORD = r"[^\x20\x09-\x0D]+"

_RANGE = 1 << 31
# The odd integer nearest to _RANGE divided by the golden ratio.
_GOLDEN = 1_327_217_885
_CELLS = 4096
_CHUNK = 1 << 16


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Target words per source from (source, source_size).

    Sources in code point order, null last, get ``WEIGHTS`` in turn and share ``BUDGET`` times all
    words. A source whose share is above ``MOST_PASSES`` times its size stops there and the excess
    is shared anew by weight. Taken in ascending order of limit per weight, the sources that stop
    are a prefix: source ``i`` stops if its limit per weight is at most what is left after those
    before it, divided by their weights and its own. One row per source, so the windows run over the
    source list, never over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (turn + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("limit_words", (F.col("source_size") * MOST_PASSES).cast("double"))
    filling = Window.orderBy(F.col("limit_words") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    told = ranked.select(
        "*",
        (F.sum("source_size").over(whole) * BUDGET).alias("budget"),
        F.coalesce(F.sum("limit_words").over(before), F.lit(0.0)).alias("limits_before"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"),
    )
    stops = told.withColumn(
        "stops", F.col("limit_words") / F.col("weight") <= (F.col("budget") - F.col("limits_before")) / F.col("weight_left")
    )
    left = F.col("budget") - F.sum(F.when(F.col("stops"), F.col("limit_words")).otherwise(0.0)).over(whole)
    weights = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("stops"), F.col("limit_words")).otherwise(left * F.col("weight") / weights)
    return stops.select("source", "source_size", target.alias("target"))


def _stream_offsets(docs: DataFrame) -> DataFrame:
    """Add ``first``, the words of the source's stream before each document.

    The shuffled order is that of the digest of the id, so reruns agree. Sums run in two levels: a
    source is dealt over 4,096 digest prefixes, a window numbers the words inside one of them, and
    their totals are summed per source. A source with most of the rows is thus never in one task.
    """
    dealt = docs.withColumn("shuffled", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    dealt = dealt.withColumn("part", F.substring("shuffled", 1, 3))
    totals = dealt.groupBy("stream", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("stream").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("stream", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("part_first"))
    inside = Window.partitionBy("stream", "part").orderBy("shuffled", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("inside_last", F.sum("size").over(inside)).join(totals, ["stream", "part"])
    return placed.withColumn("first", F.col("part_first") + F.col("inside_last") - F.col("size")).drop(
        "shuffled", "part", "part_first", "inside_last"
    )


def schedule(streams: DataFrame, slots: int) -> DataFrame:
    """(slot, stream, turn): the source of every slot and the slot's rank inside its source, from 0.

    ``streams`` has (stream, slots_needed) and ``slots`` is their sum. A point finds its source by an
    equality join on one of 4,096 cells of the unit interval and its bounds. Ranks are the count of
    the source's slots in earlier chunks plus the place in the own chunk. Slots beyond a source's
    need are left out; the few it lacks, as a finite sequence of points is not quite even, follow
    at the end.
    """
    spark = streams.sparkSession
    order = Window.orderBy("stream").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("slots_needed").over(order)
    bound = lambda c: F.floor(c.cast("double") / F.lit(float(max(slots, 1))) * _RANGE).cast("long")
    spans = streams.select("stream", "slots_needed", bound(upto - F.col("slots_needed")).alias("low"), bound(upto).alias("high"))
    width = _RANGE // _CELLS
    cells = spans.where("high > low").select(
        "stream", "slots_needed", "low", "high",
        F.explode(F.sequence((F.col("low") / width).cast("long"), ((F.col("high") - 1) / width).cast("long"))).alias("cell"),
    )
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (((F.col("id") % _RANGE) * _GOLDEN) % _RANGE).alias("point")
    )
    points = points.withColumn("cell", (F.col("point") / width).cast("long"))
    mapped = (
        points.join(cells, "cell")
        .where("point >= low and point < high")
        .select("slot", "stream", "slots_needed", F.floor(F.col("slot") / _CHUNK).cast("long").alias("chunk"))
    )
    counts = mapped.groupBy("stream", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("stream").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("stream", "chunk", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("stream", "chunk").orderBy("slot")
    ranked = (
        mapped.withColumn("place", F.row_number().over(inside))
        .join(counts.drop("n"), ["stream", "chunk"])
        .select("slot", "stream", "slots_needed", (F.col("before") + F.col("place") - 1).alias("turn"))
        .where("turn < slots_needed")
        .drop("slots_needed")
    )
    got = counts.groupBy("stream").agg(F.sum("n").alias("got"))
    lacking = (
        streams.join(got, "stream", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .where("got < slots_needed")
        .select(F.lit(slots).alias("slot"), "stream", F.explode(F.sequence("got", F.col("slots_needed") - 1)).alias("turn"))
    )
    return ranked.unionByName(lacking)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first_slot) for every row of ``docs``.

    ``size`` counts words (null: 0), ``target`` is the source's number of words in the mix and
    ``taken`` the words the mix takes from this row, repeats counted: at most twice its size, and
    over a source the rounded target exactly. ``first_slot`` is the first slot that takes from the
    row (null if none does). Empty rows take 0; a null source is a source of its own; rows with a
    null or repeated id take part as rows of their own, of which equal ones are interchangeable; an
    empty table gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    rows = cut(rows.withColumn("stream", F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source")))), "mix-sizes")
    sizes = rows.groupBy("source", "stream").agg(F.sum("size").alias("source_size"))
    planned = source_targets(sizes.select("source", "source_size"))
    need = F.least(F.round("target").cast("long"), F.col("source_size") * MOST_PASSES)
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long")
    rest = F.when(F.col("source_size") > 0, F.col("need") % F.col("source_size")).otherwise(0)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("need") / F.col("source_size"))).otherwise(0).cast("long")
    planned = (
        planned.withColumn("stream", F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source"))))
        .drop("source")
        .withColumn("need", need)
        .withColumn("blocks", blocks)
        .withColumn("rest", rest)
        .withColumn("slots_needed", passes * F.col("blocks") + F.ceil(F.col("rest") / BLOCK_WORDS).cast("long"))
    )
    planned = cut(planned, "mix-sources")
    slots = planned.agg(F.coalesce(F.sum("slots_needed"), F.lit(0))).first()[0]

    turns = schedule(planned.select("stream", "slots_needed"), slots).join(
        planned.select("stream", "blocks", "rest", "slots_needed"), "stream"
    )
    last = (F.col("turn") == F.col("slots_needed") - 1) & (F.col("rest") > 0)
    uses = (
        turns.withColumn("block", F.col("turn") % F.col("blocks"))
        .groupBy("stream", "block")
        .agg(
            F.sum(F.when(last, 0).otherwise(1)).alias("whole_uses"),
            F.max(F.when(last, F.col("rest"))).alias("upto"),
            F.min("slot").alias("slot"),
        )
    )
    # A row's words lie in one block or in several; each meets the uses of that block.
    placed = _stream_offsets(rows.where("size > 0"))
    end = F.col("first") + F.col("size")
    pieces = placed.select(
        "*",
        F.explode(F.sequence((F.col("first") / BLOCK_WORDS).cast("long"), ((end - 1) / BLOCK_WORDS).cast("long"))).alias("block"),
    )
    low = F.greatest("first", F.col("block") * BLOCK_WORDS)
    high = F.least(end, (F.col("block") + 1) * BLOCK_WORDS)
    part = F.when(F.col("upto").isNotNull(), F.greatest(F.least(high, F.col("upto")) - low, F.lit(0))).otherwise(0)
    taken = F.coalesce(F.col("whole_uses") * (high - low) + part, F.lit(0))
    joined = pieces.join(uses, ["stream", "block"], "left").withColumn("taken", taken)
    mixed = joined.groupBy("stream", "first", "doc_id", "source", "size").agg(
        F.sum("taken").alias("taken"), F.min(F.when(F.col("taken") > 0, F.col("slot"))).alias("first_slot")
    )
    empty = rows.where("size = 0").select(
        "stream", "doc_id", "source", "size", F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot")
    )
    out = mixed.drop("first").unionByName(empty).join(planned.select("stream", "source_size", "target"), "stream")
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "first_slot")
