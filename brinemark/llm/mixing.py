"""Mixing sources to target weights by capped water-filling.

Every source gets words in proportion to its weight, but at most ``max_epochs``
times its own; what a capped source cannot take is shared out again by weight until
no source is above its cap. A source then takes whole repetitions of its documents
and a seeded, fractional one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brinemark.llm.columns import packed, quoted, stored

SLOT_HEX = 3
OUTPUT = ("size", "source_size", "target", "repeats", "taken")


def word_count(text) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id, seed: int) -> Column:
    """A document's place in the seeded order of its source: 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def repeating_weights(sources: DataFrame, cycle: list[int], source: str = "source") -> DataFrame:
    """Weights for distinct sources by code point, NULL last, going round in ``cycle``."""
    place = F.row_number().over(W.orderBy(F.col(source).asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.select(source, F.element_at(cycle, (place % F.size(cycle) + 1).cast("int")).alias("weight"))


def water_level(sizes: DataFrame, epochs: float, max_epochs: float) -> float | None:
    """Words per unit of weight at which capped shares add up to ``epochs`` times all sizes.

    Each round clamps the sources that the present level puts above their cap and
    raises the level for the rest; one row comes to the driver per round. None:
    every source is clamped.
    """
    wanted = epochs * float(sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    level, clamped = -1.0, -1
    while True:
        over = F.col("weight") * level > F.col("size") * max_epochs
        row = sizes.agg(
            F.count(F.when(over, 1)).alias("n"), F.coalesce(F.sum(F.when(over, F.col("size"))), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if row["n"] == clamped:
            return level
        if row["weight"] <= 0:
            return None
        clamped, level = row["n"], (wanted - max_epochs * float(row["size"])) / row["weight"]


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, cycle: list[int] = (3, 1, 2), epochs: float = 1.5,
    max_epochs: float = 2.0, seed: int = 11, doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """``docs`` with ``size`` (words), the source's ``source_size`` and ``target``, and the ``repeats`` and words ``taken``.

    ``weights``: source, weight (positive), for every source; without it weights go
    round in ``cycle`` over the sorted sources. ``epochs``: words wanted, as a share
    of all. A document is repeated floor(target / source_size) times, and once more
    while its source's seeded order has not reached the target, up to the nearest document.

    NULL text has size 0; NULL is a source of its own; a source without a weight
    takes nothing. Rows that share a doc_id share their place in the order and go
    together. Documents of size 0 take 0. Input columns named like an output column
    are replaced. An empty table gives no rows. Reruns agree.

    Sizes are summed per (source, slot of the order), so a hot source is merged
    before the shuffle and no task sorts more than a slot of it. Texts are not shuffled.
    """
    slot = lambda c: F.substring(c, 1, SLOT_HEX)
    key = draw(quoted(doc_id), seed)
    sized = docs.select(quoted(source).alias("s"), slot(key).alias("slot"), word_count(quoted(text)).alias("size"))
    slots = stored(sized.groupBy("s", "slot").agg(F.sum("size").alias("size")), "mix-slots")
    sizes = slots.groupBy("s").agg(F.sum("size").alias("size"))
    if weights is None:
        weights = repeating_weights(sizes, list(cycle), "s")
    else:
        weights = weights.select(F.col(source).alias("s"), F.col("weight").cast("double").alias("weight"))
    w = weights.select(F.col("s").alias("w_s"), "weight")
    sizes = stored(
        sizes.join(w, sizes["s"].eqNullSafe(w["w_s"]), "left").select("s", "size", F.coalesce("weight", F.lit(0.0)).alias("weight")),
        "mix-sources")
    level = water_level(sizes, epochs, max_epochs)
    cap = F.col("size") * F.lit(max_epochs)
    target = F.when(F.col("weight") > 0, cap).otherwise(0.0) if level is None else F.least(cap, F.col("weight") * F.lit(level))
    targets = sizes.select("s", F.col("size").alias("source_size"), target.alias("target"))
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = stored(targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    # The slot in which the fractional repetition ends, then the document in it.
    t = targets.select(F.col("s").alias("t_s"), "rest")
    running = W.partitionBy("s").orderBy("slot")
    ends = slots.withColumn("before", F.sum("size").over(running) - F.col("size"))
    ends = ends.join(t, ends["s"].eqNullSafe(t["t_s"])).where(
        (F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") >= F.col("rest"))
    ).select(F.col("s").alias("e_s"), F.col("slot").alias("e_slot"), "before", "rest")
    ends = stored(ends, "mix-ends")
    at_end = docs.select(quoted(source).alias("s"), key.alias("key"), quoted(text).alias("text"))
    at_end = at_end.join(ends, at_end["s"].eqNullSafe(ends["e_s"]) & (slot(at_end["key"]) == ends["e_slot"]))
    at_end = at_end.groupBy("s", "key", "e_slot", "before", "rest").agg(F.sum(word_count(F.col("text"))).alias("size"))
    middle = F.col("before") + F.sum("size").over(W.partitionBy("s").orderBy("key")) - F.col("size") / 2
    last = at_end.withColumn("middle", middle).groupBy("s", "e_slot").agg(
        F.max(F.when(F.col("middle") <= F.col("rest"), F.col("key"))).alias("last"))
    # No document of the slot is in: all of the earlier slots are.
    last = last.select(F.col("s").alias("l_s"), F.coalesce("last", "e_slot").alias("last"))
    plan = stored(targets.join(last, targets["s"].eqNullSafe(last["l_s"]), "left").select(
        F.col("s").alias("p_s"), "source_size", "target", "whole", F.coalesce("last", F.lit("")).alias("last")), "mix-plan")

    rows = docs.select(packed(docs, OUTPUT), quoted(source).alias("s"), word_count(quoted(text)).alias("size"), key.alias("key"))
    joined = rows.join(plan, rows["s"].eqNullSafe(plan["p_s"]), "left")
    repeats = (F.col("whole") + (F.col("key") <= F.col("last")).cast("long")).cast("long")
    return joined.select(
        "row_.*", "size", "source_size", "target", repeats.alias("repeats"),
        (F.col("size") * repeats).alias("taken"))
