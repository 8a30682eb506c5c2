"""Text statistics against plain counts; the learner on planted rules, held-out documents and hard rows."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brinemark.llm import quality_rules as qr
from brinemark.llm.queries import QUERIES
from tests.compare import duck

HARD = [
    (1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, ""), (4, "a b " * 50_000),
    (5, "same line\nsame line\n\n \n\t\nsame line \nother"), (5, "same line\nsame line\n\n \n\t\nsame line \nother"), (None, "no id"),
    (6, " \n\t\x0b\x0c\r"), (7, "é#ü|漢<字> $5 & 10%* x"), (8, "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8 9"), (9, "x " * 9), (10, "x " * 8),
    (11, "p 1 2 3 4 5 6 7 8 q 1 2 3 4 5 6 7 8 r 2 3 4 5 6 7 8 9")]


def naive(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    inside = {p for k, w in enumerate(windows) if often[w] > 1 for p in range(k, k + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
            len(set(words)), len(lines), len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text)))


def test_counts_equal_plain_ones():
    dice = random.Random(1)
    texts = [t for _, t in HARD]
    texts += ["".join(dice.choice(["a", "b", " ", " ", "\n", "c d ", "#", "Q7"]) for _ in range(dice.randrange(120))) for _ in range(400)]
    for text in texts:
        if text is None or len(text) < 10_000:
            assert qr.counts(text) == naive(text), text
    assert qr.counts("a b " * 50_000)[4] == 100_000


def test_statistics_of_hard_rows(spark):
    docs = spark.createDataFrame(HARD, "doc_id long, text string")
    got = qr.text_statistics(docs.withColumn("n_words", F.lit("mine")).withColumn("row_", F.lit("r")))
    rows = Counter((r["doc_id"], *(r[c] for c in qr.COUNTS)) for r in got.collect())
    want = Counter((i, *(naive(t) if t is None or len(t) < 10_000 else qr.counts(t))) for i, t in HARD)
    assert rows == want and "row_" in got.columns
    assert qr.text_statistics(docs.limit(0)).collect() == []


def test_query_equals_plain_counts(spark, sf_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op12_quality_rules"](spark, sf_dir).collect()}
    documents = duck(sf_dir).execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(rows) == len(documents)
    for i, text in documents:
        n = naive(text)
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        r = rows[i]
        assert tuple(r[c] for c in qr.COUNTS[:5]) == n[:5] and r["base_failed"] == failed
        assert not (failed and r["kept"])


def frame(**columns):
    return pd.DataFrame({n: np.asarray(columns.get(n, np.zeros(len(next(iter(columns.values()))))), float) for n in qr.features()})


def test_cover_finds_planted_rules():
    dice = np.random.default_rng(2)
    n = 3000
    values = frame(words=dice.integers(20, 900, n), symbols_per_word=dice.random(n), distinct_share=dice.random(n))
    poor = ((values["symbols_per_word"] > 0.7) & (values["words"] > 200)).to_numpy() | (values["distinct_share"] <= 0.1).to_numpy()
    made = qr.cover(values, poor)
    assert (made.rejects(values) == poor).mean() > 0.99
    used = {c.feature for rule in made.rules for c in rule}
    assert used == {"symbols_per_word", "words", "distinct_share"}
    assert str(qr.cover(values, poor)) == str(made)


def test_noise_makes_no_rules():
    dice = np.random.default_rng(3)
    values = frame(words=dice.random(2000), symbols_per_word=dice.random(2000))
    assert qr.cover(values, dice.random(2000) < 0.1).rules == []


def test_one_class_and_no_rows_keep_everything():
    values = frame(words=np.arange(50))
    for poor in (np.zeros(50, bool), np.ones(50, bool)):
        assert qr.cover(values, poor).rules == []
    assert qr.cover(values[:0], np.zeros(0, bool)).rules == []


def test_spark_expression_equals_the_list(spark, sf_dir):
    statistics = qr.text_statistics(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    rules = qr.DecisionList([
        (qr.Condition("symbols_per_word", True, 0.1), qr.Condition("words", True, 50.0)), (qr.Condition("distinct_share", False, 0.6),)])
    rows = qr.judge(statistics, rules).select("*", *[c.alias(f"f_{n}") for n, c in qr.features().items()]).toPandas()
    values = rows[[f"f_{n}" for n in qr.features()]].set_axis(list(qr.features()), axis=1)
    assert (rows["rule"].notna().to_numpy() == rules.rejects(values)).all() and 0 < rows["rule"].notna().sum() < len(rows)
    assert (rows["kept"] == ~rows["base_failed"] & rows["rule"].isna()).all()
    assert set(rows["rule"].dropna()) <= {"symbols_per_word > 0.1 and words > 50", "distinct_share <= 0.6"}


def test_labels_with_nulls_conflicts_and_repeats(spark):
    docs = spark.createDataFrame([(i, ("# " * 30 if i % 3 == 0 else "") + " ".join(f"w{i}x{k}" for k in range(40 + i))) for i in range(120)], "doc_id long, text string")
    labels = [(i, 0 if i % 3 == 0 else 1) for i in range(110)] + [(0, 0), (1, 0), (None, 0), (5, None), (999, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = {r["doc_id"]: r["kept"] for r in qr.quality_verdicts(docs, labels).collect()}
    assert all(kept == (i % 3 != 0) for i, kept in rows.items())
    for no_use in (labels.limit(0), labels.where("quality = 1"), labels.where("quality IS NULL")):
        judged = qr.quality_verdicts(docs, no_use)
        assert judged.where("rule IS NOT NULL").count() == 0
    assert qr.quality_verdicts(docs.limit(0), labels).collect() == []


def test_held_out_documents(spark):
    big = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    statistics = qr.text_statistics(docs.select("doc_id", "text")).cache()
    learned = qr.learn(statistics, labels.where("doc_id % 2 = 0"))
    held = qr.judge(statistics, learned).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").toPandas()
    good, poor = held[held["quality"] == 1], held[held["quality"] == 0]
    assert good["kept"].mean() > 0.99 and (~poor["kept"]).mean() > 0.95
