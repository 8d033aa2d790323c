"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame functions only.

The mix is a sequence of slots of ``block`` words. Slot k belongs to the source on whose stretch of
the cumulative targets the van der Corput point of k (its bits reversed) falls, so every stretch of
the sequence holds each source in nearly its share. The stretches are whole numbers of slots, just
enough for each source's target. A slot's rank within its source is a closed form in the bits of k
and of the stretch's ends: no ordered pass over the slots of one source is needed.

Documents of a source are shuffled by a salted hash of their id and text and laid end to end on the
source's word axis, epoch after epoch; the axis is cut into blocks of ``block`` words, and the slot of
rank r joins block r. The last block of a source stops at its target. Positions come from prefix sums
in two levels (hash buckets of bounded size, then bucket totals), so a source with a third of all rows
is dealt over as many tasks as it needs. Rows that repeat one id and text are interchangeable, and if
they are very many they are dealt over buckets of their own.

Null and empty texts have size 0 and are never taken. Null is a source of its own, after all others.
Repeated rows are documents of their own; ties of the hash fall to the smaller id, then the size,
then the row. An empty table gives no rows. Input columns other than id, text and source are ignored
by ``mix`` and kept as they are by ``mixed_documents``. Sources are ordered in one task, a row each:
a source is a collection, not a host or a page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import RID, discard, materialize, n_words, stable_rows, tasks_for

BLOCK = 256  # words of a slot at most, and more than half of it unless the mix is tiny
MOST_BITS = 32  # of a slot's number: with more words than this many blocks hold, blocks grow
CHUNK = 1 << 15  # slots that one row of the schedule unfolds to
BUCKET_ROWS = 2_000  # few, so that the buckets of a source with a third of all rows spread evenly over tasks
PART_WORDS = 4 << 20  # of one task of the mixed documents
HOT_KEYS = 1000  # at most so many keys have buckets of their own


@dataclass(frozen=True)
class Mix:
    documents: DataFrame  # RID, id, size, source_size, target, sid, begin, stop (on the source's axis)
    sources: DataFrame  # sid, source, source_size, weight, target, words (whole words to take), slots, low, high
    schedule: DataFrame  # slot, sid, rank
    pieces: DataFrame  # slot, sid, rank, RID, epoch, a (the document's place on the axis), skip (its words before the piece), n_words
    block: int
    n_slots: int


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """sid, source, source_size, weight, target of each source. sizes: columns source and size.

    Sources by code point, null last, have the weights in turn and share ``share`` times all sizes; a
    target stops at ``epochs`` times its source's size and the excess goes to the others by weight.
    """
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    each = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    each = each.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1))
    each = each.withColumn("cap", epochs * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    by_fill = Window.orderBy("full_at", "sid")
    budget = share * F.sum("source_size").over(every)
    capped = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    each = each.withColumn("level", (budget - capped) / open_weight)
    # a source is open, like all that fill later, if the level the open ones would share doesn't reach its cap
    reached = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "sid", "level"))).over(every)
    level = reached["level"]
    target = F.when(level.isNull() | (level * F.col("weight") >= F.col("cap")), F.col("cap")).otherwise(level * F.col("weight"))
    return each.select("sid", "source", "source_size", "weight", target.alias("target"))


def _reverse(x: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(x), bits, "0")), 2, 10).cast("long")


def _below(n: Column, end: Column, reversed_end: Column, bits: int) -> Column:
    """How many of the numbers under n have a bit reversal under ``end``."""
    total = F.lit(0).cast("long")
    for j in range(bits):
        digit = F.shiftright(reversed_end, j).bitwiseAND(F.lit(1))
        low = reversed_end.bitwiseAND(F.lit((1 << j) - 1))
        total = total + digit * F.shiftright(n + F.lit((2 << j) - 1) - low, j + 1)
    return F.when(end >= F.lit(1 << bits), n).otherwise(total)


def _schedule(sources: DataFrame, bits: int, n_slots: int) -> DataFrame:
    ends = sources.filter("slots > 0").select("sid", "slots", "low", "high").withColumn("rev_low", _reverse(F.col("low"), bits))
    ends = ends.withColumn("rev_high", F.when(F.col("high") < (1 << bits), _reverse(F.col("high"), bits)).otherwise(F.lit(0).cast("long")))
    part = ends.withColumn("from", F.explode(F.sequence("low", F.col("high") - 1, F.lit(CHUNK).cast("long")))).repartition(tasks_for(n_slots, CHUNK), "sid", "from")
    point = part.withColumn("point", F.explode(F.sequence("from", F.least(F.col("from") + (CHUNK - 1), F.col("high") - 1))))
    slots = point.withColumn("slot", _reverse(F.col("point"), bits))
    rank = _below(F.col("slot"), F.col("high"), F.col("rev_high"), bits) - _below(F.col("slot"), F.col("low"), F.col("rev_low"), bits)
    return slots.select("slot", "sid", rank.alias("rank"))


def _buckets(base: DataFrame, n_rows: int) -> DataFrame:
    """base with ``bucket``, strings in the order of ``key``; a bucket holds about BUCKET_ROWS rows at most."""
    digits = 0
    while n_rows > BUCKET_ROWS * 16**digits:
        digits += 1
    many = max(BUCKET_ROWS, n_rows // HOT_KEYS)
    hot = base.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > many).orderBy("key").collect()  # fewer than HOT_KEYS rows
    if not hot:
        return base.withColumn("bucket", F.substring("key", 1, digits))
    keys = F.array(*(F.lit(r["key"]) for r in hot))
    parts = F.array(*(F.lit(-(-r["n"] // BUCKET_ROWS)).cast("long") for r in hot))
    below = F.size(F.filter(keys, lambda k: k < F.col("key")))
    own = F.array_contains(keys, F.col("key"))
    part = F.when(own, F.pmod(F.xxhash64(RID), F.get(parts, below))).otherwise(F.lit(0))
    label = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return base.withColumn("bucket", F.concat(F.substring("key", 1, digits), label(2 * below + own.cast("int"), 5), label(part, 12)))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, epochs: float = 2.0, block: int = BLOCK, salt: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """The schedule and what its slots hold. docs may carry RID already."""
    rows = docs if RID in docs.columns else docs.withColumn(RID, F.monotonically_increasing_id())  # written at once, below
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    key = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(id_.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))
    base = materialize(rows.select(RID, id_.alias("id"), F.col(f"`{source_col}`").alias("source"), n_words(text).alias("size"), key.alias("key")), "sizes")
    sources = materialize(source_targets(base, weights, share, epochs), "targets")
    wanted, n_rows = int((sources.agg(F.sum("target")).first()[0] or 0.0) + 0.25), base.count()  # halves and wholes, but for rounding
    bits = min(MOST_BITS, max(4, max(1, wanted // block).bit_length()))
    block = max(1, -(-wanted // (1 << bits)))

    words = F.round("target").cast("long")
    sources = sources.withColumn("words", words).withColumn("slots", F.ceil(F.col("words") / F.lit(block)).cast("long"))
    upto = F.sum("slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0))
    sources = materialize(sources.withColumn("high", upto).withColumn("low", F.col("high") - F.col("slots")), "targets")
    n_slots = int(sources.agg(F.max("high")).first()[0] or 0)
    schedule = materialize(_schedule(sources, max(1, n_slots.bit_length()), n_slots), "schedule")

    known = base.join(sources.drop("weight"), base["source"].eqNullSafe(sources["source"])).select(RID, "id", "size", "key", "sid", "source_size", "target", "words")
    known = _buckets(known, n_rows)
    order = Window.partitionBy("sid", "bucket").orderBy("key", "id", "size", RID).rowsBetween(Window.unboundedPreceding, 0)
    totals = known.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select("sid", "bucket", ahead.alias("ahead"))
    placed = known.withColumn("in_bucket", F.sum("size").over(order)).join(totals, ["sid", "bucket"])
    stop = F.col("ahead") + F.col("in_bucket")
    placed = placed.select(RID, "id", "size", "source_size", "target", "sid", "words", (stop - F.col("size")).alias("begin"), stop.alias("stop"))
    placed = materialize(placed, "axis")
    discard(base)

    turns = max(1, -int(-epochs // 1))
    turn = placed.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    shift = F.col("epoch") * F.col("source_size")
    turn = turn.withColumn("a", F.col("begin") + shift).withColumn("z", F.least(F.col("stop") + shift, F.col("words"))).filter("a < z")
    cut = turn.withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / F.lit(block)), F.floor((F.col("z") - 1) / F.lit(block)))))
    first = F.greatest("a", F.col("rank") * block)
    # both sides grow with the corpus, whatever the planner makes of their unfolded rows
    pieces = cut.join(schedule.hint("merge"), ["sid", "rank"]).select("slot", "sid", "rank", RID, "epoch", "a", (first - F.col("a")).alias("skip"), (F.least("z", (F.col("rank") + 1) * block) - first).alias("n_words"))
    return Mix(placed, sources, schedule, pieces, block, n_slots)


def taken(mixed: Mix, id_col: str = "doc_id") -> DataFrame:
    """id, size, source_size, target, taken (the words that the mix takes of each document, repeats counted), and first_slot and n_slots: where the schedule puts them.

    A document of which nothing is taken has no slots and a null first one.
    """
    sums = mixed.pieces.groupBy(RID).agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_slots"))
    out = mixed.documents.join(sums, RID, "left")
    zero = F.lit(0)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", zero).cast("long").alias("taken"), F.col("first_slot").cast("long").alias("first_slot"), F.coalesce("n_slots", zero).cast("long").alias("n_slots"))


def mixed_documents(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` as the mix takes them, in the order of the schedule: a row for each epoch in which a document is taken, at the slot where it begins.

    Documents stay whole: the one at which a source's target ends is there if at least half of it is
    taken. Rows are in order within a partition, and partitions are in order.
    """
    rows = stable_rows(docs)
    mixed = mix(rows, text_col=text_col, **how)
    parts = mixed.pieces.groupBy(RID, "epoch").agg(F.sum("n_words").alias("n"), F.min("slot").alias("slot"), F.min("a").alias("a"))
    parts = parts.join(mixed.documents.select(RID, "size"), RID).filter("2 * n >= size").select(RID, "slot", "a")
    total = materialize(parts, "parts")
    words = mixed.sources.agg(F.sum("words")).first()[0] or 0
    space = 1 << max(1, mixed.n_slots.bit_length())
    tasks = max(tasks_for(words, PART_WORDS), min(docs.sparkSession.sparkContext.defaultParallelism, mixed.n_slots + 1))
    whole = rows.select(RID, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    out = whole.join(total, RID).withColumn("part", F.floor(F.col("slot") * F.lit(tasks) / F.lit(space)).cast("int"))
    out = out.repartitionById(tasks, "part").sortWithinPartitions("slot", "a", RID)
    return out.select(*(F.col("doc")[c].alias(c) for c in docs.columns))
