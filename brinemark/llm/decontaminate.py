"""Benchmark decontamination by winnowing.

A shared span of ``window`` words holds window - k + 1 k-grams. Both sides keep the
smallest k-gram hash of every such span, so equal spans have an equal fingerprint;
where a document's fingerprint is one of the benchmark's, the spans around it are
compared word by word and the hits are joined to longer ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brinemark.llm.columns import packed, quoted, stored

# Separators become a space, A-Z become a-z; bytes from 0x80 belong to words.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPACE = 32
CHUNK = 4 << 20
BLOCK_BYTES = 8 << 20
OUTPUT = ("n_words", "hit_starts", "hit_ends", "items")
FOUND = "n_words long, hit_starts array<long>, hit_ends array<long>, items array<string>"
# Odd multipliers for the hashes over bytes and over words.
BYTE_BASE, WORD_BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(count, base, dtype=np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= MIX
    return values ^ (values >> np.uint64(29))


class Words:
    """The words of several texts in one buffer: where they are, their hashes, and whose they are."""

    def __init__(self, texts: list[bytes]):
        self.buffer = b" ".join(texts).translate(WORD_TABLE)
        raw = np.frombuffer(self.buffer, dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = raw != SPACE
        edges = np.diff(inside.view(np.int8))
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
        self.owner = np.searchsorted(ends_of_texts, self.starts, side="right")
        # Letters weigh the same in every word: by their distance from its start.
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(raw.astype(np.uint64) * _powers(BYTE_BASE, len(raw)), out=sums[1:])
        inverse = np.uint64(pow(int(BYTE_BASE), -1, 1 << 64))
        spans = (sums[self.ends] - sums[self.starts]) * _powers(inverse, len(raw) + 1)[self.starts]
        self.hashes = _mixed(spans)

    def __len__(self) -> int:
        return len(self.starts)

    def grams(self, size: int) -> np.ndarray:
        """Hashes of ``size`` consecutive words, by their first."""
        count = len(self) - size + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        total = self.hashes[:count].copy()
        for j in range(1, size):
            total = total * WORD_BASE + self.hashes[j:j + count]
        return _mixed(total)

    def minima(self, window: int, k: int) -> np.ndarray:
        """The smallest k-gram hash of every ``window`` words."""
        grams, width = self.grams(k), window - k + 1
        count = len(self) - window + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        least = grams[:count].copy()
        for j in range(1, width):
            np.minimum(least, grams[j:j + count], out=least)
        return least

    def whole(self, window: int) -> np.ndarray:
        """Whether ``window`` words from each place are of one text."""
        count = len(self) - window + 1
        return self.owner[:count] == self.owner[window - 1:] if count > 0 else np.zeros(0, dtype=bool)

    def text(self, at: int, window: int) -> bytes:
        return b" ".join(self.buffer[self.starts[at]:self.ends[at + window - 1]].split())


class WindowIndex:
    """All windows of one length of a block of items: fingerprints, hashes, words and owners."""

    def __init__(self, window: int, k: int, items: list[tuple[str, bytes]]):
        words = Words([t for _, t in items])
        whole = words.whole(window)
        places = np.flatnonzero(whole)
        hashes = words.grams(window)[places]
        order = np.argsort(hashes, kind="stable")
        places, hashes = places[order], hashes[order]
        self.window, self.k, self.words = window, k, words
        self.fingerprints = np.unique(words.minima(window, k)[whole])
        # One entry per distinct window; windows of equal hash but other words stay apart.
        runs = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1], [True]))) if len(hashes) else np.zeros(1, int)
        keep, owners, offsets = [], [], [0]
        for a, b in zip(runs[:-1].tolist(), runs[1:].tolist()):
            if b - a == 1:
                groups = [[int(places[a])]]
            else:
                by_text: dict[bytes, list[int]] = {}
                for at in places[a:b].tolist():
                    by_text.setdefault(words.text(at, window), []).append(at)
                groups = list(by_text.values())
            for group in groups:
                keep.append(group[0])
                owners += sorted({int(words.owner[at]) for at in group})
                offsets.append(len(owners))
        self.places = np.array(keep, dtype=np.int64)
        self.hashes = words.grams(window)[self.places] if len(keep) else np.zeros(0, dtype=np.uint64)
        self.owners, self.offsets = np.array(owners, dtype=np.int32), np.array(offsets, dtype=np.int64)

    def hits(self, words: Words) -> tuple[np.ndarray, list[np.ndarray]]:
        """Places in ``words`` where a window stands, and the items that have it."""
        least = words.minima(self.window, self.k)
        if not len(least) or not len(self.fingerprints):
            return np.zeros(0, dtype=np.int64), []
        # Neighbouring spans mostly share their fingerprint: look each up once.
        first = np.concatenate(([True], least[1:] != least[:-1]))
        kept = least[first]
        at = np.minimum(np.searchsorted(self.fingerprints, kept), len(self.fingerprints) - 1)
        known = (self.fingerprints[at] == kept)[np.cumsum(first) - 1]
        places = np.flatnonzero(known & words.whole(self.window))
        if not len(places):
            return places, []
        wanted = words.grams(self.window)[places]
        low, high = np.searchsorted(self.hashes, wanted), np.searchsorted(self.hashes, wanted, side="right")
        sure, items = [], []
        for place, a, b in zip(places.tolist(), low.tolist(), high.tolist()):
            if a < b:
                text = words.text(place, self.window)
                for k in range(a, b):
                    if self.words.text(int(self.places[k]), self.window) == text:
                        sure.append(place)
                        items.append(self.owners[self.offsets[k]:self.offsets[k + 1]])
        return np.array(sure, dtype=np.int64), items


class BenchmarkBlock:
    """Indexes of a block of items: one for full windows, one for each shorter item length."""

    def __init__(self, rows: list[tuple[str, str | None]], window: int, k: int):
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        self.names: dict[int, list[str]] = {}
        for name, text in rows:
            data = (text or "").encode()
            n = len(data.translate(WORD_TABLE).split())
            if n:
                by_length.setdefault(min(n, window), []).append((name, data))
        self.indexes = []
        for length, items in sorted(by_length.items()):
            # An item shorter than a window is one k-gram of its own length.
            self.indexes.append(WindowIndex(length, k if length == window else length, items))
            self.names[length] = [name for name, _ in items]

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[list], list[list], list[set]]:
        """Words, hit spans (starts, ends) and items of each text."""
        words = Words(texts)
        counts = np.bincount(words.owner, minlength=len(texts))
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        change = np.zeros(len(words) + 1, dtype=np.int64)
        items: list[set] = [set() for _ in texts]
        for index in self.indexes:
            places, owners = index.hits(words)
            np.add.at(change, places, 1)
            np.add.at(change, places + index.window, -1)
            names = self.names[index.window]
            for doc, found in zip(words.owner[places].tolist(), owners):
                items[doc].update(names[k] for k in found)
        hit = np.cumsum(change[:-1]) > 0
        new_text = np.concatenate(([True], words.owner[1:] != words.owner[:-1])) if len(words) else np.zeros(0, dtype=bool)
        before = np.concatenate(([False], hit[:-1])) if len(words) else hit
        after = np.concatenate((hit[1:], [False])) if len(words) else hit
        last_word = np.concatenate((new_text[1:], [True])) if len(words) else new_text
        opens, closes = np.flatnonzero(hit & (~before | new_text)), np.flatnonzero(hit & (~after | last_word)) + 1
        starts: list[list] = [[] for _ in texts]
        ends: list[list] = [[] for _ in texts]
        for doc, a, b in zip(words.owner[opens].tolist(), opens.tolist(), closes.tolist()):
            starts[doc].append(a - int(first[doc]))
            ends[doc].append(b - int(first[doc]))
        return counts, starts, ends, items


def _merged(a: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(a):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


def _scanner(spark, rows, window: int, k: int, again: bool):
    """A UDF over (text, hits so far) for one block of the benchmark, sent to each worker once."""
    block = spark.sparkContext.broadcast(BenchmarkBlock(rows, window, k))

    def frame(texts: pd.Series) -> pd.DataFrame:
        out, part, size = [], [], 0

        def flush():
            counts, starts, ends, items = block.value.scan(part)
            out.append(pd.DataFrame({
                "n_words": counts, "hit_starts": starts, "hit_ends": ends, "items": [sorted(i) for i in items]}))
            part.clear()

        for text in texts:
            data = (text or "").encode()
            if part and size + len(data) > CHUNK:
                flush()
                size = 0
            part.append(data)
            size += len(data) + 1
        if part:
            flush()
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
            {"n_words": [], "hit_starts": [], "hit_ends": [], "items": []})

    if not again:
        @F.pandas_udf(FOUND)
        def scan(texts: pd.Series) -> pd.DataFrame:
            return frame(texts)

        return scan

    @F.pandas_udf(FOUND)
    def scan_more(texts: pd.Series, starts: pd.Series, ends: pd.Series, items: pd.Series) -> pd.DataFrame:
        new = frame(texts)
        spans = [_merged([*zip(a, b), *zip(c, d)]) for a, b, c, d in zip(starts, ends, new["hit_starts"], new["hit_ends"])]
        return pd.DataFrame({
            "n_words": new["n_words"], "hit_starts": [[s for s, _ in x] for x in spans], "hit_ends": [[e for _, e in x] for x in spans],
            "items": [sorted({*a, *b}) for a, b in zip(items, new["items"])]})

    return scan_more


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark's items, about ``block_bytes`` of text at a time on the driver."""
    rows = benchmark.select(F.coalesce(quoted(item_id).cast("string"), F.lit("")).alias("name"), quoted(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64("name", "text"), F.lit(count))
    for k in range(count):
        yield [(r["name"], r["text"]) for r in rows.where(part == k).collect()]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, the hit spans (``hit_starts``, ``hit_ends``, in words) and the ``items`` found.

    A window is ``window`` consecutive words of an item; an item of fewer words, but
    not none, is one window. Every occurrence of a window in a text is hit, and
    touching hits are one span. ``items``: distinct ids as sorted strings (a NULL id
    is the empty string). NULL and empty texts have no words and no hits; items
    without words have no windows; an empty benchmark hits nothing. Input columns
    named like an output column are replaced; repeated rows each get their result.

    The benchmark is the query set: it is indexed in blocks of about ``block_bytes``
    of text, each sent to the workers, so what is broadcast is bounded. A benchmark
    of several blocks takes one pass over the documents each, stored between.
    Texts are scanned where they are and never shuffled.
    """
    rows, done = docs.select(packed(docs, OUTPUT), quoted(text).alias("text_")), False
    for block in blocks_of(benchmark, item_id, item_text, block_bytes):
        scan = _scanner(docs.sparkSession, block, window, k, done)
        if done:
            rows = stored(rows, "leaks")
            found = scan(F.col("text_"), F.col("hit_starts"), F.col("hit_ends"), F.col("items"))
        else:
            found = scan(F.col("text_"))
        rows = rows.select("row_", "text_", found.alias("found_")).select("row_", "text_", "found_.*")
        done = True
    return rows.select("row_.*", *OUTPUT)


def summary(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and digest of each document's hits."""
    hit = F.aggregate(
        F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda total, n: total + n)
    return found.select(
        doc_id, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold a window of the benchmark; all their columns stay."""
    rows = docs.select(packed(docs).alias("doc_"), quoted(text).alias("text_"))
    return find_leaks(rows, benchmark, text="text_", **options).where(F.size("items") == 0).select("doc_.*")
