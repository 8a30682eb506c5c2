"""Exact interpolated quantiles that no single task has to hold.

Quantiles are selected in two scans, whatever the size of the input:

1. one sketch row per group: its count and, per quantile, two approximate cuts
   that bracket the wanted ranks with a margin well over the sketch's error;
2. a count of all rows in which rows between cuts keep their value and all others
   collapse map-side into "how many lie below". Only the bracketed rows, a few
   per ten thousand, are shuffled; they are then ranked in slots so that even one
   hot group is spread over many tasks.

The cuts only steer which rows are kept: ranks come from exact counts. Where a rank
falls outside its bracket, the brackets are widened and the rows counted again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, Window as W

from brinemark.session import stored

SKETCH_ACCURACY = 10_000
MARGIN = 4.0 / SKETCH_ACCURACY
WIDEN = 16
SLOTS = 1024


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    extra: Sequence[Column] = (),
    margin: float = MARGIN,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group.

    ``quantiles`` maps output column names to probabilities; ``extra`` holds more
    aggregates to compute in the same first scan. The result, one row per group, is
    computed at once and kept in the shared folder. Equal rows give equal bits
    however they are split over files. Without keys an empty input gives one row.
    NULL and NaN values have no rank and are left out.
    """
    keys, quantiles = list(keys), dict(quantiles)
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    rows = df.withColumn("_k", group).withColumn("_v", F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")))
    missed = F.lit(False)
    for name in quantiles:
        missed = missed | F.col(name).isNull()
    while True:
        steer = stored(_sketch(rows, keys, quantiles, extra, margin), "quantile-cuts")
        # Counted while the result is written, not by a job of its own.
        seen = Observation()
        found = stored(_selected(rows, steer, quantiles).observe(seen, F.count_if(missed).alias("missed")), "quantiles")
        if margin >= 1 or not seen.get["missed"]:
            break
        margin *= WIDEN
    # Groups without any value keep their row, with NULL quantiles.
    extras = [c for c in steer.columns if c not in ("_k", "_n", "_cuts")]
    return steer.join(found, "_k", "left").select(*[F.col("_k")[k].alias(k) for k in keys], *extras, *quantiles)


def _sketch(rows: DataFrame, keys, quantiles, extra, margin: float) -> DataFrame:
    """Per group: count, two cuts per quantile, and the extra aggregates."""
    probes = [p for q in quantiles.values() for p in (max(0.0, q - margin), min(1.0, q + margin))]
    sketch = rows.groupBy(*(["_k"] if keys else [])).agg(
        F.count("_v").alias("_n"), F.percentile_approx("_v", probes, SKETCH_ACCURACY).alias("_cuts"), *extra)
    if not keys:
        sketch = sketch.withColumn("_k", F.struct(F.lit(0).alias("all")))
    # Small groups keep all their rows: the margin would be under one rank.
    cuts = F.when(F.col("_n") > SKETCH_ACCURACY, F.col("_cuts")).alias("_cuts")
    return sketch.select("_k", "_n", cuts, *[c for c in sketch.columns if c not in ("_k", "_n", "_cuts")])


def _selected(rows: DataFrame, steer: DataFrame, quantiles) -> DataFrame:
    """``_k`` and the quantiles; NULL where a rank is outside its bracket."""
    spec = list(enumerate(quantiles.values()))
    cuts = steer.select("_k", "_n", "_cuts")

    def low(i):
        return F.get("_cuts", F.lit(2 * i))

    def high(i):
        return F.get("_cuts", F.lit(2 * i + 1))

    def inside(i, x):
        return F.col("_cuts").isNull() | ((x >= low(i)) & (x <= high(i)))

    kept = F.lit(False)
    for i, _ in spec:
        kept = kept | inside(i, F.col("_v"))
    below = [
        F.sum(F.when(F.col("_cuts").isNotNull() & (F.col("_v") < low(i)), 1).otherwise(0)).alias(f"_b{i}")
        for i, _ in spec
    ]
    present = rows.where(F.col("_v").isNotNull()).select("_k", "_v").join(cuts, "_k")
    reduced = (
        present.withColumn("_c", F.when(kept, F.col("_v")))
        .groupBy("_k", "_c")
        .agg(F.count(F.lit(1)).alias("_m"), *below)
    )

    # One entry per (group, quantile): a bracketed value with its multiplicity, or
    # the number of rows under the bracket (slot -1).
    def entry(i):
        held = F.col("_c").isNotNull() & inside(i, F.col("_c"))
        width = high(i) - low(i)
        slot = F.when(width > 0, F.floor((F.col("_c") - low(i)) / width * SLOTS).cast("int"))
        return F.struct(
            F.lit(i).alias("_i"),
            F.when(held, F.coalesce(slot, F.lit(0))).otherwise(F.lit(-1)).alias("_slot"),
            F.when(held, F.col("_c")).alias("_x"),
            F.when(held, F.col("_m")).otherwise(F.col(f"_b{i}")).alias("_w"),
        )

    points = stored(
        reduced.join(cuts, "_k").select("_k", "_n", F.inline(F.array(*[entry(i) for i, _ in spec]))).where("_w > 0"), "quantile-points")
    slots = points.groupBy("_k", "_i", "_slot").agg(F.sum("_w").alias("_w"))
    before = W.partitionBy("_k", "_i").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    slots = slots.select("_k", "_i", "_slot", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_start"))
    in_slot = W.partitionBy("_k", "_i", "_slot").orderBy("_x").rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        points.where("_slot >= 0")
        .join(slots, ["_k", "_i", "_slot"])
        .withColumn("_first", F.col("_start") + F.coalesce(F.sum("_w").over(in_slot), F.lit(0)))
        .withColumn("_next", F.col("_first") + F.col("_w"))
    )
    probability = F.element_at(F.array(*[F.lit(float(q)) for _, q in spec]), F.col("_i") + 1)
    ranked = ranked.withColumn("_h", probability * (F.col("_n") - 1)).withColumn("_lo", F.floor("_h"))

    def at(rank, i):
        hit = (F.col("_i") == i) & (F.col("_first") <= rank) & (rank < F.col("_next"))
        return F.max(F.when(hit, F.col("_x")))

    picks, results = [], []
    for (i, _), name in zip(spec, quantiles):
        picks += [at(F.col("_lo"), i).alias(f"_p{i}"), at(F.ceil(F.col("_h")), i).alias(f"_r{i}")]
        picks.append(F.max(F.when(F.col("_i") == i, F.col("_h") - F.col("_lo"))).alias(f"_f{i}"))
        lo, hi, part = F.col(f"_p{i}"), F.col(f"_r{i}"), F.col(f"_f{i}")
        results.append(F.when(lo == hi, lo).otherwise(lo + part * (hi - lo)).alias(name))
    found = ranked.groupBy("_k").agg(*picks).select("_k", *results)
    # A group whose brackets hold no row at all must be seen as missed, too.
    return cuts.where("_n > 0").select("_k").join(found, "_k", "left")


def running_count(counted: DataFrame, keys: Sequence[str], value: str, n: str, out: str = "n_before") -> DataFrame:
    """Per group, how many units lie at strictly smaller values.

    ``counted`` has one row per (keys, value) with its multiplicity ``n``. A group
    is cut into slots at approximate quantiles (each cut again into even steps);
    slot totals, at most a few thousand per group, are summed in order, and the
    sums inside a slot run in parallel.
    """
    cut_count, steps = 32, 64
    probes = [i / cut_count for i in range(cut_count + 1)]
    group = F.struct(*[F.col(k) for k in keys])
    rows = counted.withColumn("_k", group).withColumn("_v", F.col(value).cast("double"))
    cuts = stored(rows.groupBy("_k").agg(F.percentile_approx("_v", probes, 1000).alias("_cuts")), "count-cuts")
    placed = rows.join(cuts, "_k").withColumn("_s", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
    low = F.get("_cuts", F.col("_s") - 1)
    high = F.get("_cuts", F.col("_s"))
    step = F.when(high > low, F.floor((F.col("_v") - low) / (high - low) * steps).cast("int"))
    placed = placed.withColumn("_t", F.coalesce(step, F.lit(0))).drop("_cuts")
    totals = placed.groupBy("_k", "_s", "_t").agg(F.sum(n).alias("_w"))
    before = W.partitionBy("_k").orderBy("_s", "_t").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("_k", "_s", "_t", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_start"))
    within = W.partitionBy("_k", "_s", "_t").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    ranked = placed.join(totals, ["_k", "_s", "_t"]).withColumn(
        out, F.col("_start") + F.coalesce(F.sum(n).over(within), F.lit(0)))
    return ranked.select(*counted.columns, out)


def group_quantile(df: DataFrame, key: str, value: str, qs: Sequence[float]) -> DataFrame:
    """One column per probability: 0.05 becomes ``q05``."""
    return exact_quantiles(df, [key], value, {f"q{round(q * 100):02d}": q for q in qs})


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    return exact_quantiles(df, keys, value, {out: 0.5})
