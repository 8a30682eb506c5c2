"""Collocations against plain counts, tiles against dictionaries, and hard rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from brinemark.llm import collocations as co


def naive(rows, least=10, longest=3, top=2000, percent=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {}
        for p, a in counts.items():
            if len(p) > 1 and a >= least:
                score, _, l, r = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found[p] = (score, a, l, r)

        def absorbed(p):
            return any(len(q) > len(p) and 100 * found[q][1] >= percent * found[p][1] and any(q[i:i + len(p)] == p for i in range(len(q)))
                       for q in found)

        kept = [p for p in found if not absorbed(p)]
        kept.sort(key=lambda p: (-found[p][0], -found[p][1], " ".join(p).encode()))
        out += [(lang, k + 1, " ".join(p), found[p][1], found[p][2], found[p][3], n[lang], found[p][0]) for k, p in enumerate(kept[:top])]
    return sorted(out)


def mined(df, **options):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in names) for r in co.mine_collocations(df, **options).collect())


@pytest.mark.parametrize("part_words", [1 << 21, 300])
def test_random_texts_of_three_and_four_words(spark, monkeypatch, part_words):
    monkeypatch.setattr(co, "PART_WORDS", part_words)
    dice = random.Random(4)
    words = ["A", "b", "cé", "D", "e f", "g\x1ch", "-", "'"]
    rows = [(dice.choice(["en", "fr", None, ""]), "".join(dice.choice(words) + dice.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r", "!x "])
             for _ in range(dice.randrange(60)))) for _ in range(300)]
    rows += [(None, None), ("en", ""), ("en", " .,;:\n"), ("de", "one two " * 3000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    want = naive(rows)
    assert mined(df) == want and len(want) > 100
    assert mined(df, least_count=5, longest=4, top=40, absorbed_percent=80) == naive(rows, 5, 4, 40, 80)
    assert mined(df, longest=2) == naive(rows, longest=2)


def test_counts_beyond_64_bits_of_products(spark):
    from pyspark.sql import functions as F
    big = spark.range(1).select(F.lit("en").alias("lang"), F.array(F.lit(1), F.lit(2)).alias("ids"), F.lit("a b").alias("phrase"), F.lit(4_000_000_000_001).alias("f"))
    parts = spark.createDataFrame([("en", [1], "a", 4_000_000_000_003), ("en", [2], "b", 5_000_000_000_009)], "lang string, ids array<long>, phrase string, f long")
    row = co.scored(big.select("lang", F.col("ids").cast("array<long>").alias("ids"), "phrase", "f").unionByName(parts)).first()
    a = 4_000_000_000_001
    assert row["score"] == 1000000 * a * a // (4_000_000_000_003 * 5_000_000_000_009)


def test_tiles_equal_a_dictionary():
    dice = np.random.default_rng(8)
    rows = np.concatenate([dice.integers(0, 300, 300_000), dice.integers(0, 5000, 50_000)])
    columns = np.concatenate([dice.integers(0, 300, 300_000), dice.integers(0, 4000, 50_000)])
    want = Counter(zip(rows.tolist(), columns.tolist()))
    a, b, n = co.count_cells(rows, columns, 5000, 4000)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == want and len(a) == len(want)
    assert (rows // co.TILE == 0).sum() > co.DENSE


def test_blocks_do_not_matter(spark, monkeypatch):
    import pyarrow as pa
    dice = random.Random(2)
    rows = [(dice.choice(["en", "fr"]), " ".join(dice.choice("abcdef") for _ in range(dice.randrange(50))) + ". x") for _ in range(80)]
    batch = pa.RecordBatch.from_pylist([{"lang": a, "text": b} for a, b in rows])

    def words(blocks):
        total = Counter()
        for b in blocks:
            for r in b.to_pylist():
                total.update({(r["lang"], w): n for w, n in zip(r["words"], r["counts"])})
        return total

    one = words(co.number_words(iter([batch])))
    monkeypatch.setattr(co, "BLOCK_WORDS", 40)
    assert words(co.number_words(iter([batch]))) == one


def test_empty_tables_and_clashing_names(spark):
    from pyspark.sql import functions as F
    none = spark.createDataFrame([], "lang string, text string")
    assert mined(none) == []
    some = spark.createDataFrame([("en", "a b c. " * 20), ("en", None)], "lang string, text string")
    wide = some.select("*", *[F.lit("mine").alias(c) for c in ("block", "id", "ids", "phrase", "n", "words", "head", "f", "salt_")])
    assert mined(wide) == mined(some) == naive([("en", "a b c. " * 20)])
