"""Token counts of a corpus, from an exact histogram of encoded lengths.

Documents are encoded once and counted by length. Sums over the histogram answer,
for every context limit, how many documents and tokens fit, how many tokens are left
after truncation, and every quantile.
"""

from __future__ import annotations

import base64
import importlib.util
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brinemark.llm.columns import quoted, stored

BLOCK = 512
TOKENIZERS = "/opt/tokenizers"


def vocabulary(folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken") -> tuple[str, bytes]:
    """Split pattern and rank file of a public byte-level BPE (under 1 MB), read on the driver."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", Path(folder) / "__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.PATTERN, (Path(folder) / name).read_bytes()


def encoded_length(text: Column, pattern: str, ranks: bytes) -> Column:
    """Tokens of each whole text; NULL has none. Special tokens in a text are ordinary text."""

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for batch in batches:
            yield pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in batch], dtype="int64")

    return lengths(text)


def length_histogram(docs: DataFrame, text: str = "text", tokenizers: str = TOKENIZERS) -> DataFrame:
    """``n_tokens``, ``n_docs``: how many documents have each encoded length."""
    pattern, ranks = vocabulary(tokenizers)
    return docs.select(encoded_length(quoted(text), pattern, ranks).alias("n_tokens")).groupBy("n_tokens").agg(
        F.count(F.lit(1)).alias("n_docs"))


def token_report(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per distinct length, as a context limit: what fits, what is cut, and the quantile it is.

    ``docs_at_most``, ``docs_over``: documents of up to, and over, ``n_tokens``.
    ``tokens_at_most``: their tokens. ``tokens_truncated``: what is left of all
    documents when each is cut at ``n_tokens``. ``quantile``: share of documents
    of up to this length. ``tokens_total``: all tokens, whatever the limit.
    An empty histogram gives no rows. Between two listed lengths, a limit truncates
    to ``tokens_at_most`` of the smaller plus the limit times its ``docs_over``.

    Lengths are summed in blocks, so that no task sorts more than ``block`` lengths
    or one row per block.
    """
    h = stored(histogram.select(
        "n_tokens", "n_docs", F.floor(F.col("n_tokens") / block).cast("long").alias("block"),
        (F.col("n_tokens") * F.col("n_docs")).alias("tokens")), "token-histogram")
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    before = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    blocks = blocks.select(
        F.col("block").alias("b"), F.coalesce(F.sum("b_docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("b_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("b_docs").over(whole).alias("docs_total"), F.sum("b_tokens").over(whole).alias("tokens_total"))
    inside = W.partitionBy("block").orderBy("n_tokens")
    counted = h.select(
        "n_tokens", "n_docs", "block", F.sum("n_docs").over(inside).alias("docs_in"), F.sum("tokens").over(inside).alias("tokens_in"))
    at_most = counted.join(blocks, counted["block"] == blocks["b"]).withColumn(
        "docs_at_most", F.col("docs_before") + F.col("docs_in")).withColumn(
        "tokens_at_most", F.col("tokens_before") + F.col("tokens_in"))
    over = F.col("docs_total") - F.col("docs_at_most")
    return at_most.select(
        "n_tokens", "n_docs", "docs_at_most", over.alias("docs_over"), "tokens_at_most",
        (F.col("tokens_at_most") + F.col("n_tokens") * over).alias("tokens_truncated"),
        (F.col("docs_at_most") / F.col("docs_total")).alias("quantile"), "tokens_total")


def count_tokens(docs: DataFrame, text: str = "text", tokenizers: str = TOKENIZERS) -> DataFrame:
    """The report over all ``docs``; NULL and empty texts have length 0, other columns do not matter."""
    return token_report(length_histogram(docs, text, tokenizers))
