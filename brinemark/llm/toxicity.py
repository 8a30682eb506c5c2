"""Toxicity by a linear softmax over averaged subword vectors, trained in numpy.

A text is a bag of its words, each word the sum of vectors of itself and of its
character n-grams (in a fixed number of hashed rows), however long it is. The mean of them is the input
of a softmax with two classes; vectors and softmax are trained together. A
misspelling or inflection shares most n-grams with the words it comes from.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brinemark.llm.columns import quoted, without

ROWS, WIDTH = 1 << 18, 4
GRAMS = (3, 5)
# Runs over LONG_WORD are not remembered, those over LONG_RUN are cut into n-grams in numpy, PIECE at a time.
LONG_WORD, LONG_RUN, PIECE = 40, 400, 1 << 16
STEPS, RATE, SEED, BATCH = 3000, 4.0, 7, 32
# Rows of fewer training texts stay out; every mean has so many empty subwords more.
LEAST_TEXTS, EMPTY = 3, 200
SCALE, STEEP = 100.0, 4.0
SAMPLE_PER_CLASS = 1250
MEMORY = 400_000
THRESHOLD = 0.7
OUTPUT = ("score", "predicted")
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORD.findall((text or "").lower())


def subwords(word: str) -> np.ndarray:
    """Rows of a word and of its character n-grams, all of them, with marks at both ends."""
    marked = f"<{word}>"
    if len(marked) > LONG_RUN:
        return _subwords_of_run(marked)
    grams = {marked}
    for n in range(GRAMS[0], GRAMS[1] + 1):
        grams.update(marked[i:i + n] for i in range(len(marked) - n + 1))
    return np.array([zlib.crc32(g.encode()) % ROWS for g in sorted(grams)], dtype=np.int64)


def _crc_steps() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_STEPS = _crc_steps()


def _subwords_of_run(marked: str) -> np.ndarray:
    """As the short form of ``subwords``; n-grams of equal length and CRC count as one."""
    rows = [np.array([zlib.crc32(marked.encode()) % ROWS])]
    for n in range(GRAMS[0], GRAMS[1] + 1):
        found = []
        for at in range(0, len(marked) - n + 1, PIECE):
            data = np.frombuffer(marked[at:at + PIECE + n - 1].encode(), dtype=np.uint8)
            starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            first, last = starts[:-n], starts[n:]
            crc = np.full(len(first), 0xFFFFFFFF, dtype=np.uint32)
            for k in range(int((last - first).max())):
                some = np.flatnonzero(first + k < last)
                old = crc[some]
                crc[some] = CRC_STEPS[(old ^ data[first[some] + k]) & 0xFF] ^ (old >> np.uint32(8))
            found.append(np.unique(~crc))
        rows.append((np.unique(np.concatenate(found)) % ROWS).astype(np.int64))
    return np.concatenate(rows)


@dataclass
class Model:
    """Per row the logit its vector adds, over the number of rows in the text; and the bias."""

    weight: np.ndarray
    bias: float

    def scorer(self):
        """Scores of texts; remembers the parts of up to ``MEMORY`` words."""
        known: dict[str, tuple[float, int]] = {}

        def score(text: str | None) -> float:
            total, count = 0.0, 0
            for word, times in Counter(words_of(text)).items():
                part = known.get(word)
                if part is None:
                    rows = subwords(word)
                    part = float(self.weight[rows].sum()), len(rows)
                    if len(word) <= LONG_WORD:
                        if len(known) >= MEMORY:
                            known.clear()
                        known[word] = part
                total += times * part[0]
                count += times * part[1]
            logit = self.bias + total / (count + EMPTY)
            return float(1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60))))

        return score


def _bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text as rows and their shares, one after the other, and where each starts."""
    cache: dict[str, np.ndarray] = {}
    # Grown in place: joining an array a text at the end would hold all of them twice.
    starts, indexes, shares = [0], array("i"), array("f")
    for text in texts:
        words = Counter(words_of(text))
        parts = []
        for word in words:
            part = cache.get(word)
            if part is None:
                part = subwords(word).astype(np.int32)
                if len(word) <= LONG_WORD:
                    cache[word] = part
            parts.append(part)
        rows = np.concatenate([np.zeros(0, dtype=np.int32), *parts])
        times = np.repeat(np.fromiter(words.values(), dtype=np.float64, count=len(words)), [len(x) for x in parts])
        distinct, place = np.unique(rows, return_inverse=True)
        indexes.frombytes(distinct.tobytes())
        shares.frombytes((np.bincount(place, times, len(distinct)) / (times.sum() + EMPTY)).astype(np.float32).tobytes())
        starts.append(starts[-1] + len(distinct))
    return np.array(starts), np.frombuffer(indexes, dtype=np.int32), np.frombuffer(shares, dtype=np.float32)


def train(texts: list[str | None], labels: list[int], steps: int = STEPS, rate: float = RATE, seed: int = SEED) -> Model:
    """Vectors and softmax by stochastic gradient descent, classes weighed alike.

    Labels of one class only, or none, give a model that says what share of them is 1.
    """
    y = np.asarray(labels, dtype=np.int64)
    ones = int(y.sum())
    if not ones or ones == len(y):
        share = (ones + 1) / (len(y) + 2)
        return Model(np.zeros(ROWS), float(np.log(share / (1 - share))))
    starts, index, share = _bags(texts)
    seen = np.zeros(ROWS, dtype=np.int64)
    for at in range(0, len(index), 1 << 20):
        seen += np.bincount(index[at:at + (1 << 20)], minlength=ROWS)
    known = seen >= min(LEAST_TEXTS, len(texts) // 20)
    generator = np.random.default_rng(seed)
    vectors = generator.normal(0, 0.01, (WIDTH, ROWS)).astype(np.float32)
    vectors[:, ~known] = 0
    used = known[index]
    kept = [np.count_nonzero(used[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    starts = np.concatenate(([0], np.cumsum(kept)))
    index = index[used]
    share = share[used]
    share *= np.float32(SCALE)
    softmax, bias = generator.normal(0, 0.3, (WIDTH, 2)).astype(np.float32), np.zeros(2, dtype=np.float32)
    weigh = np.where(y == 1, len(y) / (2 * ones), len(y) / (2 * (len(y) - ones))).astype(np.float32)
    batches, done = -(-len(y) // BATCH), 0
    while done < steps:
        order = generator.permutation(len(y))
        for part in np.array_split(order, batches)[:steps - done]:
            sizes = starts[part + 1] - starts[part]
            owner = np.repeat(np.arange(len(part)), sizes)
            at = np.repeat(starts[part] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            rows, shares = index[at], share[at]
            mean = np.stack([np.bincount(owner, v[rows] * shares, len(part)) for v in vectors], axis=1).astype(np.float32)
            logits = mean @ softmax + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p *= weigh[part][:, None] / len(part)
            now = np.float32(rate * (1 - done / steps))
            # A text's step is bounded whatever its length, so that training cannot diverge.
            back = p @ softmax.T / np.maximum(1, np.bincount(owner, shares * shares, len(part)) / STEEP)[:, None].astype(np.float32)
            softmax = np.clip(softmax - now * np.float32(0.1) * (mean.T @ p), -1, 1)
            bias -= now * p.sum(axis=0)
            shares *= now
            for v, step in zip(vectors, back.T):
                np.subtract.at(v, rows, shares * step[owner])
            done += 1
    return Model(SCALE * ((softmax[:, 1] - softmax[:, 0]).astype(np.float64) @ vectors), float(bias[1] - bias[0]))


def training_rows(labelled: DataFrame, per_class: int = SAMPLE_PER_CLASS, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """A seeded sample of at most ``per_class`` rows of each class, by the order of a hash of the id."""
    rows = labelled.where(quoted(label).isin(0, 1) & quoted(doc_id).isNotNull())
    order = [F.md5(quoted(doc_id).cast("string")), quoted(doc_id)]
    parts = [rows.where(quoted(label) == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return parts[0].union(parts[1])


def held_out(doc_id) -> Column:
    """Whether a row's labels are kept from training: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> Model:
    """A model from labelled documents that are not held out.

    Fitting takes at most ``per_class`` rows of each class (a documented bound on
    what the driver holds); the ids are chosen first, then their texts are fetched.
    Rows with a NULL id or a label other than 0 and 1 are not used; a repeated id
    counts with its first text and its largest label.
    """
    ids = labels.where(~held_out(quoted(doc_id))).select(
        quoted(doc_id).alias("doc_id"), quoted(label).cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    present = docs.select(quoted(doc_id).alias("d_id")).distinct()
    chosen = training_rows(ids.join(present, ids["doc_id"] == present["d_id"], "left_semi"), per_class, "doc_id", "toxic")
    # At most 2 * per_class rows: broadcast, so that the texts are not shuffled.
    texts = docs.select(quoted(doc_id).alias("t_id"), quoted(text).alias("text")).join(
        F.broadcast(chosen), F.col("t_id") == F.col("doc_id"))
    rows = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def score_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each whole text; the model (2 MB) is sent to each worker once."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Model(*sent.value).scorer()
        for batch in batches:
            yield pd.Series([of(t) for t in batch], dtype="float64")

    return scores(quoted(text))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more toxic) and ``predicted`` (1 from ``threshold`` on).

    Only the whole text counts. NULL and empty texts get the score of the bias.
    Input columns named like an output column are replaced; repeated rows score alike.
    """
    kept = [quoted(c) for c in without(docs, OUTPUT)]
    scored = docs.select(*kept, score_column(docs, model, text).alias("score"))
    return scored.select(*kept, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows of ``predicted`` 1; all their columns stay."""
    return docs.where(score_column(docs, model, text) < threshold)
