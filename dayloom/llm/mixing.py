"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of slots, each as long as one block of words at most. A source's shuffled
documents are laid end to end and cut into blocks of equal length, the last one shorter; its
slots take block after block and start over at the end, until its target is met to the word:
the last slot ends there. So a source has as many slots as its target needs, also when it is
shorter than one block. Slot i has the rank (i * step) modulo the number of slots, with step
over that number close to the golden ratio; the interval of the cumulated slots of the sources
that holds the rank names the source. Ranks are a permutation, so every source gets exactly its
slots, every stretch of the sequence is close to the targets, and a document of an upsampled
source is taken evenly.

Defined results: a document without words is taken 0 times; a null source is a source, last in
order; repeated rows are documents of their own; a null document id is an id like any other;
an empty table gives no rows; further columns pass through or are ignored. Ties in the shuffle
are between equal rows. Targets, not documents, go through windows of one partition: one row
for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.llm.common import words, written

#: Slots of the schedule, about: a block has total / SLOTS words. The target is met whatever the block.
SLOTS = 1 << 20
GOLDEN = (5 ** 0.5 - 1) / 2
#: Documents of one source that share a window of the running sum.
BUCKET_DOCS = 4096
#: Ranks of a cell, by which slots meet the sources. A source in it has a rank there, so a cell holds at most as many sources.
CELL = 256


def plan_targets(per_source: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Adds rn, weight and target to source, source_size.

    Targets share the whole size by weight; none is above ``most`` times its source's size,
    and what is above goes to the others by weight.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy("_need", "rn")
    upto, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    planned = (
        per_source.withColumn("rn", F.row_number().over(by_name))
        .withColumn("weight", F.get(cycle, (F.col("rn") - 1) % len(weights)))
        .withColumn("_cap", (F.col("source_size") * most).cast("double"))
        .withColumn("_need", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("_open", F.col("_need") > F.col("_level"))
        # The first source that stays below its cap sets the level of all that follow.
        .withColumn("_at", F.min(F.when(F.col("_open"), F.struct("_need", "rn", "_level"))).over(every))
        .withColumn("target", F.when(
            F.col("_at").isNull() | (F.struct("_need", "rn") < F.struct("_at._need", "_at.rn")), F.col("_cap")
        ).otherwise(F.col("_at._level") * F.col("weight")))
    )
    return planned.select("source", "source_size", "n_docs", "rn", "weight", "target")


def planned_slots(plan: DataFrame, block: int) -> DataFrame:
    """Adds whole (rounds of all documents), rest (words of the last round), n_blocks and n_slots."""
    words_ = F.round("target").cast("long")
    blocks = lambda n: F.expr(f"({n} + {block - 1}L) div {block}L")
    rounds = plan.where("target > 0").withColumn("whole", F.floor(words_ / F.col("source_size")))
    return rounds.withColumn("rest", words_ - F.col("whole") * F.col("source_size")).withColumn(
        "n_blocks", blocks("source_size")).withColumn("n_slots", F.col("whole") * F.col("n_blocks") + blocks("rest"))


def golden_step(slots: int) -> int:
    """A number near slots over the golden ratio, without a common divisor, whose quotient by slots has a short expansion.

    The sum of the partial quotients bounds how far any stretch is from even.
    """
    def spread(step: int) -> float:
        a, b, total = slots, step, 0
        while b:
            total, a, b = total + a // b, b, a % b
        return total if a == 1 else float("inf")

    near = round(slots * GOLDEN)
    return min(range(max(1, near - 500), max(2, min(slots, near + 501))), key=lambda step: (spread(step), abs(step - near)))


def slot_schedule(plan: DataFrame, slots: int, block: int) -> DataFrame:
    """The mix in order: slot, rn (of the source), block (of the source), epoch and end (the word before which the slot ends).

    ``slots`` is the sum of ``n_slots`` over ``planned_slots``. The rank of a slot within its
    source is its rank within a stretch of 16,384 slots plus the source's slots before that
    stretch, so no source gathers all its slots in one task.
    """
    spark = plan.sparkSession
    ranks = spark.range(slots).select(
        F.col("id").alias("slot"), F.shiftright("id", 14).alias("stretch"), F.expr(f"id * {golden_step(slots)}L % {max(1, slots)}L").alias("x")
    ).withColumn("cell", F.expr(f"x div {CELL}L"))
    upto = F.sum("n_slots").over(Window.orderBy("rn").rowsBetween(Window.unboundedPreceding, 0))
    sources = planned_slots(plan, block).where("n_slots > 0").withColumn("high", upto).withColumn("low", F.col("high") - F.col("n_slots"))
    cells = sources.select(
        "rn", "low", "high", F.explode(F.sequence(F.expr(f"low div {CELL}L"), F.expr(f"(high - 1) div {CELL}L"))).alias("cell"))
    dealt = ranks.join(cells, "cell").where("x >= low and x < high").select("slot", "stretch", "rn")
    before = Window.partitionBy("rn").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("rn", "stretch").agg(F.count("*").alias("n")).select(
        "rn", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    ).join(sources.select("rn", "source_size", "whole", "rest", "n_blocks"), "rn")
    within = F.row_number().over(Window.partitionBy("rn", "stretch").orderBy("slot"))
    placed = dealt.withColumn("_rank", within).join(counts, ["rn", "stretch"]).withColumn(
        "_k", F.col("_rank") + F.col("_before") - 1
    ).withColumn("block", F.col("_k") % F.col("n_blocks")).withColumn("epoch", F.expr("_k div n_blocks"))
    last = F.when(F.col("epoch") < F.col("whole"), F.col("source_size")).otherwise(F.col("rest"))
    return placed.select("slot", "rn", "block", "epoch", F.least((F.col("block") + 1) * block, last).alias("end"))


def shuffled_offsets(sized: DataFrame) -> DataFrame:
    """Adds ``start``: the words of the documents of the same source that are laid before.

    ``sized`` has rn, n_docs, size, doc_id and place (a hash). The order is by (bucket, place);
    a source has a bucket for each 4,096 documents, so its running sum takes as many tasks as
    it needs.
    """
    cut = sized.withColumn("bucket", F.pmod(F.xxhash64("place"), F.expr(f"n_docs div {BUCKET_DOCS}") + 1))
    before = Window.partitionBy("rn").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("rn", "bucket").agg(F.sum("size").alias("n")).select(
        "rn", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset")
    )
    running = F.sum("size").over(
        Window.partitionBy("rn", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    )
    return cut.withColumn("_running", running).join(offsets, ["rn", "bucket"]).withColumn(
        "start", F.col("_offset") + F.col("_running") - F.col("size")
    ).drop("bucket", "_running", "_offset")


def place(doc_id: Column, source: Column, text: Column) -> Column:
    """The hash by which documents are shuffled."""
    return F.xxhash64(F.lit("mix"), doc_id, source, text)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, slots: int = SLOTS,
                doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, place, size, source, source_size, target, taken.

    ``place`` is the hash by which documents are shuffled. ``taken`` counts the document's
    words in the mix, at most ``most`` times its size. Over a source it sums to the target,
    rounded to whole words.
    """
    sized = written(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"),
        place(F.col(doc_id), F.col(source), F.col(text)).alias("place"),
    ), "mix-sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = written(plan_targets(per_source, weights, most), "mix-plan")
    total = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block = max(1, -(-total // slots))
    n_slots = planned_slots(plan, block).agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    times = slot_schedule(plan, n_slots, block).groupBy("rn", "block", "end").agg(F.count("*").alias("times"))

    known = plan.select(F.col("source").alias("_source"), "source_size", "n_docs", "rn", "target")
    rows = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    columns = ["doc_id", "place", "size", "source", "source_size", "target"]
    laid = shuffled_offsets(rows.where("size > 0"))
    pieces = laid.withColumn("block", F.explode(F.sequence(
        F.expr(f"start div {block}L"), F.expr(f"(start + size - 1) div {block}L")
    )))
    overlap = F.least(F.col("start") + F.col("size"), F.col("end")) - F.greatest("start", F.col("block") * block)
    # A block's slots end with the block, but for the one that meets the target.
    taken = pieces.join(times, ["rn", "block"], "left").groupBy(*columns, "start").agg(
        F.sum(F.coalesce(F.greatest(overlap, F.lit(0)) * F.col("times"), F.lit(0))).alias("taken")
    ).drop("start")
    return taken.unionByName(rows.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken")))
