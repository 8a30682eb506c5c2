"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a vector of ``radius`` + 1 bits. Each non-zero vector v makes
a table that keeps the positions whose vector has an odd product with v. Up to
``radius`` differing positions have a common orthogonal v, so every pair within the
radius agrees on all positions of some table: none is missed.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brinemark.llm.columns import quoted, stored
from brinemark.llm.components import connected_components

BITS, SEED = 64, 42
BUCKET = 1024
_SIGNED = "long"


def fingerprint_of(text: str | None) -> int:
    """64-bit SimHash over 3-word shingles, repeats included."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < 3:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-3])).tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (hashed(joined[s:e], SEED) for s, e in zip(starts, (ends[2:] - 1).tolist())), dtype="<u8", count=len(starts))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def simhash(text) -> Column:
    """Fingerprint of each whole text as a long (the unsigned value's bits)."""

    @F.pandas_udf(_SIGNED)
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint_of(t) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return of(text)


def covering_masks(radius: int, level: int = 0) -> list[int]:
    """2^(radius+1) - 1 masks; each level has its own assignment of vectors."""
    places = list(range(BITS))
    random.Random(level).shuffle(places)
    count = (1 << (radius + 1)) - 1
    vector = {place: 1 + k % count for k, place in enumerate(places)}
    return [
        sum(1 << p for p in range(BITS) if (vector[p] & v).bit_count() % 2) for v in range(1, count + 1)]


def _long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def forest_of(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what pairs within ``radius`` connect: at most one less than values."""
    left, links = np.ones(len(values), dtype=bool), []
    for seed in range(len(values)):
        if not left[seed]:
            continue
        left[seed], reached = False, [seed]
        while reached:
            at = reached.pop()
            near = np.flatnonzero(left & (np.bitwise_count(values ^ values[at]) <= radius))
            left[near] = False
            links += [(int(values[at]), int(values[k])) for k in near]
            reached += near.tolist()
    return links


def _bucket_links(radius: int):
    """Sorted (table, key, fp) rows to links; a bucket may run over several batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            table, key = rows["table"].to_numpy(), rows["key"].to_numpy()
            if not len(rows):
                continue
            cuts = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
            last = cuts[-1] if len(cuts) else 0
            yield _links(rows["fp"].to_numpy(), np.concatenate(([0], cuts)), last, radius)
            held = rows.iloc[last:]
        if held is not None and len(held):
            yield _links(held["fp"].to_numpy(), np.array([0, len(held)]), len(held), radius)

    return run


def _links(fps: np.ndarray, cuts: np.ndarray, until: int, radius: int) -> pd.DataFrame:
    cuts = cuts[cuts <= until]
    found = []
    for k in np.flatnonzero(np.diff(cuts) > 1):
        found += forest_of(fps[cuts[k]:cuts[k + 1]].view(np.uint64), radius)
    pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def hamming_links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links among distinct fingerprints (column ``fp``) that connect all pairs within ``radius``.

    A bucket of up to ``bucket`` fingerprints gives a spanning forest of its links,
    not all its pairs. A larger one is dealt again by a further set of masks on top
    of those it has; any pair within the radius still meets. Fingerprints are
    distinct, so a bucket shrinks as the kept positions grow and none stays large.
    """
    rows = fps.select(F.lit(0).alias("table"), F.lit(0).cast("long").alias("kept"), "fp")
    found, level = None, 0
    while True:
        masks = F.array(*[
            F.struct(F.lit(v).alias("v"), F.lit(_long(m)).alias("mask")) for v, m in enumerate(covering_masks(radius, level), 1)])
        dealt = rows.select("table", "kept", "fp", F.explode(masks).alias("m")).select(
            (F.col("table") * (1 << (radius + 1)) + F.col("m.v")).alias("table"),
            F.col("kept").bitwiseOR(F.col("m.mask")).alias("kept"), "fp")
        dealt = dealt.withColumn("key", F.col("fp").bitwiseAND(F.col("kept")))
        large = stored(dealt.groupBy("table", "key").count().where(F.col("count") > bucket).select("table", "key"), "large-buckets")
        some = not large.isEmpty()
        small = dealt.join(large, ["table", "key"], "left_anti") if some else dealt
        small = small.select("table", "key", "fp").repartition("table", "key").sortWithinPartitions("table", "key")
        links = small.mapInPandas(_bucket_links(radius), "a long, b long")
        found = links if found is None else found.union(links)
        if not some:
            return found
        rows = stored(dealt.join(large, ["table", "key"], "left_semi").select("table", "kept", "fp"), "large-rows")
        level += 1


def near_duplicates(
    docs: DataFrame, radius: int = 3, doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` (long), ``fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the
    smallest doc_id reachable. Texts of no words have fingerprint zero and link like
    any others. Rows with one doc_id are one node each by their text; a NULL doc_id
    is larger than any other, so it names a component only of NULLs. Other columns do
    not matter. An empty table gives no rows.

    Texts are read once and never shuffled: equal fingerprints merge before the
    search, and a hot one is only a row per task.
    """
    rows = stored(docs.select(quoted(doc_id).alias("doc_id"), simhash(quoted(text)).alias("fp")), "simhash")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    nodes = connected_components(hamming_links(distinct.select("fp"), radius, bucket))
    rooted = distinct.join(nodes, distinct["fp"] == nodes["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(smallest, "root").select(F.col("fp").alias("n_fp"), "component_id"), "components-named")
    return rows.join(named, rows["fp"] == named["n_fp"]).select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id.

    Rows that share that doc_id and are of its component all stay, equal or not;
    rows with a NULL doc_id stay only in components of NULLs.
    """
    verdicts = near_duplicates(docs, radius, doc_id, text).select(
        F.col("doc_id").alias("l_id"), F.col("fp").alias("l_fp"), F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays"))
    ids = stored(verdicts.groupBy("l_id").agg(
        F.bool_or("stays").alias("some"), F.bool_and("stays").alias("all")).where(~F.col("all")), "simhash-lost")
    kept = docs.join(ids, quoted(doc_id).eqNullSafe(ids["l_id"]), "left_anti")
    # A doc_id may be on several rows with different verdicts: those go by their fingerprints.
    mixed = ids.where("some").select("l_id")
    if mixed.isEmpty():
        return kept
    lost = stored(verdicts.where(~F.col("stays")).join(mixed, verdicts["l_id"].eqNullSafe(mixed["l_id"]), "left_semi").select(
        "l_id", "l_fp").distinct(), "simhash-lost-rows")
    packed = docs.join(mixed, quoted(doc_id).eqNullSafe(mixed["l_id"]), "left_semi").select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("doc_"), quoted(doc_id).alias("id_"), simhash(quoted(text)).alias("fp_"))
    rest = packed.join(lost, packed["id_"].eqNullSafe(lost["l_id"]) & (packed["fp_"] == lost["l_fp"]), "left_anti")
    return kept.union(rest.select("doc_.*"))
