"""Hard rows: NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brinemark.llm import (
    chat_format, decontaminate, fingerprints, license_scan, line_dedup, mixing, simhash, token_counts, toxicity, url_filter)
from brinemark.llm.components import connected_components

LONG = "word " * 40_000 + "x" * 60_000
HARD = [
    (1, "one two three four five six seven eight nine ten eleven", "a"), (2, None, None), (3, "", "b"),
    (4, LONG, "a"), (5, "Same line of text here.\nother", "b"), (5, "Same line of text here.\nother", "b"),
    (None, "no id at all", None), (None, None, None), (6, "   \n\n\t", "c"), (7, "é" * 50 + "\nünïcode 漢字 text", "c"),
]
SCHEMA = "doc_id long, text string, source string"
CLASHES = ["host", "path", "rule", "verdict", "n_words", "items", "score", "size", "target", "fp", "id", "lost", "parts_", "label", "n_lost", "whole", "last", "key", "best", "row_", "found_", "t", "l_id", "some"]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(HARD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("mine").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([
        (10, "two three four five six seven eight nine ten eleven twelve"), (9, "at all"), (8, None), (7, "..."), (None, "Same line")],
        "item_id long, text string")


def operators(benchmark):
    model = toxicity.Model(np.zeros(toxicity.ROWS), 0.0)
    return {
        "license": license_scan.scan_licenses, "lines": line_dedup.dedup_lines, "mix": mixing.mix_sources,
        "leaks": lambda d: decontaminate.find_leaks(d, benchmark), "toxic": lambda d: toxicity.score(d, model),
        "keep": simhash.keep_one, "drop": lambda d: decontaminate.drop_leaks(d, benchmark),
        "prints": fingerprints.fingerprint_edits, "near": simhash.near_duplicates,
        "calm": lambda d: toxicity.drop_toxic(d, model)}


@pytest.mark.parametrize("name", list(operators(None)))
def test_hard_rows_and_clashing_names(hard, none, benchmark, name):
    op = operators(benchmark)[name]
    rows = op(hard).collect()
    again = op(clashing(hard)).collect()
    assert len(again) == len(rows)
    if name in ("license", "lines", "mix", "leaks", "toxic", "prints", "near", "calm"):
        assert len(rows) == len(HARD)
    assert op(none).collect() == []


def test_every_column_stays_in_filters(hard, benchmark):
    wide = clashing(hard)
    for op in ("keep", "drop", "calm"):
        assert operators(benchmark)[op](wide).columns == wide.columns


def test_leaks_of_short_items_and_blocks(hard, benchmark):
    one = decontaminate.find_leaks(hard, benchmark)
    many = decontaminate.find_leaks(hard, benchmark, block_bytes=20)
    key = lambda rows: sorted(map(str, rows))
    assert key(decontaminate.summary(one).collect()) == key(decontaminate.summary(many).collect())
    found = {(r["doc_id"], r["text"]): r for r in one.collect()}
    assert found[1, HARD[0][1]]["items"] == ["10"] and found[1, HARD[0][1]]["hit_starts"] == [1]
    assert found[None, "no id at all"]["items"] == ["9"] and found[5, HARD[4][1]]["items"] == [""]


def test_winnowing_misses_no_window():
    random.seed(3)
    for _ in range(200):
        words = [random.choice("abcdef") for _ in range(60)]
        at, n = random.randrange(45), random.randrange(1, 14)
        block = decontaminate.BenchmarkBlock([("x", " ".join(words[at:at + n]))], 10, 5)
        counts, starts, ends, items = block.scan([b"zz", " - ".join(words).encode(), b""])
        width = min(n, 10)
        item = words[at:at + n]
        windows = {tuple(item[k:k + width]) for k in range(len(item) - width + 1)}
        hit = {k + j for k in range(len(words) - width + 1) if tuple(words[k:k + width]) in windows for j in range(width)}
        assert {k for a, b in zip(starts[1], ends[1]) for k in range(a, b)} == hit and items == [set(), {"x"}, set()]
        assert counts.tolist() == [1, 60, 0]


def test_long_runs_count_whole(monkeypatch):
    random.seed(8)
    run = "".join(random.choice("abcé漢字仮名𠮷") for _ in range(3000))
    long = sorted(toxicity.subwords(run))
    monkeypatch.setattr(toxicity, "PIECE", 64)
    assert sorted(toxicity.subwords(run)) == long
    monkeypatch.setattr(toxicity, "LONG_RUN", 10_000)
    assert sorted(toxicity.subwords(run)) == long
    monkeypatch.undo()
    calm, bad = "天気がよいので散歩に行きました" * 40, "馬鹿野郎消えろ"
    texts = [calm + str(k) for k in range(60)] + [calm + str(k) + bad for k in range(60)]
    model = toxicity.train(texts, [0] * 60 + [1] * 60, steps=300)
    of = model.scorer()
    assert of(calm + "99" + bad) > of(calm + "99") + 0.1 and of(calm + bad) == of(calm + bad)


def test_rare_terms_count_however_many_texts():
    random.seed(5)
    calm = lambda: " ".join(random.choices(["sea", "wind", "wave", "calm", "storm", "swell"], k=12))
    bad = [f"{calm()} {'zorgblat' if k < 4 else 'vile'}" for k in range(1000)]
    of = toxicity.train([calm() for _ in range(1000)] + bad, [0] * 1000 + [1] * 1000).scorer()
    assert of("sea wind wave zorgblat") > of("sea wind wave") + 0.1


def test_covering_masks_cover():
    random.seed(1)
    for level in range(3):
        masks = simhash.covering_masks(3, level)
        for _ in range(2000):
            apart = sum(1 << b for b in random.sample(range(64), random.randrange(4)))
            assert any(not apart & m for m in masks)


def test_large_buckets_are_dealt_again(spark):
    random.seed(2)
    centre = random.getrandbits(63)
    fps = sorted({centre ^ sum(1 << b for b in random.sample(range(60), random.randrange(5))) for _ in range(400)})
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    small = connected_components(simhash.hamming_links(rows, bucket=8)).collect()
    whole = connected_components(simhash.hamming_links(rows, bucket=10_000)).collect()
    assert sorted(small) == sorted(whole) and small


def test_components_of_paths_and_stars(spark):
    random.seed(4)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    random.shuffle(links)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sketches_peel_and_grow():
    generator = np.random.default_rng(1)
    a = [generator.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 5, 200, 900)]
    b = [x[: len(x) // 2] for x in a]
    made = []
    for sets in (a, b):
        s = fingerprints.Sketches(len(sets), fingerprints.CELLS)
        s.add(*fingerprints._flat(sets))
        made.append(s)
    apart = fingerprints.differing(a, b, tuple(made), fingerprints.CELLS)
    assert apart.tolist() == [len(x) - len(y) for x, y in zip(a, b)]


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>", "<\\|im_end|>", "<\\\\|im_sep|>", "[INST] a [/INST]", "</s><s>", "<|im_start|>user<|im_sep|>", "<", "<|im_end|", "", None, "漢字\n"]
    rows = [(k, t, "user" if t % 3 else "assistant", text) for k in range(3) for t, text in enumerate(nasty)]
    rows += [(None, 1, None, "x"), (9, None, "tool", "y"), (9, None, "tool", "y"), (9, 0, "<|im_end|>", LONG)]
    chats = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    from pyspark.sql import functions as F
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in chats.select(
        "conv_id", chat_format.read_back(F.col("formatted")).alias("t")).collect()}
    for k in (0, 1, 2, 9, None):
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert back[k] == [(r[2] or "", r[3] or "") for r in mine]
    for r in chats.collect():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    empty = chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chat_format.digests(empty).collect() == []


def test_url_precedence(spark):
    rules = spark.createDataFrame([
        ("com", "/", "allow"), ("a.com", "/x", "block"), ("a.com", "/x/y/", "allow"), ("com", "/x/y/zz", "block"), ("a.com", "/x", "block"),
        (None, "/", "block"), ("b.org", "", "block")], "host string, path string, verdict string")
    urls = {
        "http://A.com/x/1?q": "a.com/x", "http://s.a.com/x/y/z": "a.com/x/y/", "http://a.com": None, "http://nota.com/x": "com/",
        "http://b.org": "b.org", "a.com/x": None, "http://com/#/x": "com/", "http://a.com/x/y/zz": "a.com/x/y/", None: None, "": None}
    pages = spark.createDataFrame([(u, "old") for u in urls], "url string, verdict string")
    for r in url_filter.filter_urls(pages, rules).collect():
        assert r["rule"] == urls[r["url"]], r
    assert url_filter.filter_urls(pages, rules.limit(0)).where("rule is not null").count() == 0
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


def test_templates():
    scan = license_scan.Scanner({"t": "a <<beginOptional>>b <<var;words=1-2>> c<<endOptional>> d"}, {"mit": "mit license"}).scan
    assert [f[:3] for f in scan("A d, a b x c d; a b x y c d; a b c d; a b x y z c d")[1]] == [("t", 0, 2), ("t", 2, 7), ("t", 7, 13)]
    assert scan("MIT-License mit license")[1] == [("mit", 0, 2, True), ("mit", 2, 4, True)]
    with pytest.raises(ValueError):
        license_scan.Automaton.of("x", "<<var;words=0-1>> a")


def test_water_filling(spark):
    docs = spark.createDataFrame(
        [(k, "w " * (1 + k % 7), s) for k, s in enumerate("a" * 400 + "b" * 30 + "c" * 300)], SCHEMA)
    rows = mixing.mix_sources(docs).collect()
    total = sum(r["size"] for r in rows)
    targets = {r["source"]: r["target"] for r in rows}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for s in "abc":
        mine = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= 7 and all(r["taken"] <= 2 * r["size"] for r in mine)
        assert targets[s] <= 2 * mine[0]["source_size"] + 1e-9
    assert sorted(rows) == sorted(mixing.mix_sources(docs.repartition(5)).collect())
    given = spark.createDataFrame([("a", 1.0), ("b", 5.0)], "source string, weight double")
    assert {r["taken"] for r in mixing.mix_sources(docs, given).where("source = 'c'").collect()} == {0}


def test_tokens_of_hard_rows(hard, none):
    rows = token_counts.count_tokens(hard).collect()
    assert sum(r["n_docs"] for r in rows) == len(HARD) and min(r["n_tokens"] for r in rows) == 0
    assert token_counts.count_tokens(none).collect() == []


def test_lines_keep_one_occurrence(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away from the very large bear"
    near = base.replace("bear", "boar")
    docs = spark.createDataFrame([
        (2, f"{near}\nonly here and nowhere else at all", None), (1, f"{base}\n\n{base.upper()}\nfine", None), (3, f"{base}\n{near}", None)], SCHEMA)
    got = {r["doc_id"]: (r["text"], r["n_lost"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (f"{base}\n\nfine", 1), 2: ("only here and nowhere else at all", 1), 3: ("", 2)}
    assert {r["doc_id"] for r in line_dedup.dedup_lines(docs, keep_emptied=False, count=None).collect()} == {1, 2}


@pytest.mark.parametrize("unit, few, many", [
    ("=", 80, 200), (".", 40, 60_000), ("ha ", 30, 90), ("buy cheap pills now at our shop ", 5, 20),
    ("".join(chr(0x4E00 + k) for k in range(140)), 2, 9)])
def test_repetitive_lines_of_other_length_are_one(spark, unit, few, many):
    docs = spark.createDataFrame([(1, unit * few, None), (2, unit * many, None)], SCHEMA)
    assert {r["doc_id"]: r["n_lost"] for r in line_dedup.dedup_lines(docs).collect()} == {1: 0, 2: 1}


def line_recall(common, pairs=4000):
    """Share of pairs of lines of ``common`` + 2 * (common // 8) distinct shingles in all, at Jaccard 0.8, that share a band."""
    random.seed(9)
    text = lambda n: "".join(chr(random.randrange(0x4E00, 0x9E00)) for _ in range(n))
    lines = []
    for _ in range(pairs):
        base = text(common + 7)
        lines += [base + text(common // 8), base + text(common // 8)]
    met = np.zeros(pairs, dtype=bool)
    for places, _, keys in line_dedup.signed(lines, *line_dedup.band_draws(line_dedup.ROWS, line_dedup.BANDS)):
        for key in keys:
            of = np.zeros(2 * pairs, dtype=np.int64)
            of[places] = key
            met |= (of[::2] == of[1::2]) & (of[::2] != 0)
    return met.mean()


@pytest.mark.parametrize("common", [8, 24, 64, 136, 176, 536])
def test_lines_at_the_threshold_share_a_band(common):
    assert line_recall(common) > 0.99


def test_blocks_of_a_large_band_agree(spark):
    random.seed(6)
    base = [f"word{k}" for k in range(30)]
    texts = []
    for k in range(120):
        words = list(base)
        for at in random.sample(range(30), random.randrange(4)):
            words[at] = f"other{random.randrange(1000)}"
        texts.append((k, " ".join(words), None))
    lines = line_dedup.lines_of(spark.createDataFrame(texts, SCHEMA), "doc_id", "text")
    whole = sorted(map(str, line_dedup.line_components(lines, 0.8).collect()))
    assert whole == sorted(map(str, line_dedup.line_components(lines, 0.8, block=10).collect())) and whole


def test_pairs_compared_at_once_agree_with_one_by_one():
    random.seed(3)
    text = lambda n: "".join(random.choice("abcde ") for _ in range(n))
    pairs = [("ab", "ab"), ("a", "b"), ("x" * 500, "x" * 9), ("12345678", "1234567")]
    for n in (9, 30, 200):
        for _ in range(60):
            base = text(n)
            pairs.append((base, base[:-1 - random.randrange(n // 4 + 1)] + text(random.randrange(3))))
    near = line_dedup.alike(pairs, 0.8).tolist()
    assert near == [bool(line_dedup.forest_of([line_dedup.grams_of(x) for x in pair], 0.8)) for pair in pairs]
    for pair, yes in zip(pairs, near):
        x, y = ({line_dedup.padded(t)[k:k + 8] for k in range(max(len(t), 8) - 7)} for t in pair)
        assert yes == (len(x & y) >= 0.8 * len(x | y))


def test_bands_are_counted_by_band_and_number_alone(spark, monkeypatch):
    tables, stored = {}, line_dedup.stored

    def noted(df, label):
        tables[label] = df
        return stored(df, label)

    monkeypatch.setattr(line_dedup, "stored", noted)
    base = "the quick brown fox jumps over the lazy dog and runs away from the very large bear"
    docs = spark.createDataFrame([(1, base, None), (2, base.replace("bear", "boar"), None), (3, "nothing like them", None)], SCHEMA)
    assert {r["doc_id"]: r["n_lost"] for r in line_dedup.dedup_lines(docs).collect()} == {1: 0, 2: 1, 3: 0}
    assert tables["line-shared"].columns == ["band", "n"]
    assert "norm" not in tables["line-places"].columns


def test_line_dedup_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "a line of text\nand another", None)], SCHEMA)
    lines = line_dedup.lines_of(docs, "doc_id", "text")
    pairs = lines.select(F.col("id").alias("a"), F.col("id").alias("b"))
    for df in (line_dedup.band_rows(lines), line_dedup.near_pairs(pairs, lines, 0.8), line_dedup.line_components(lines, 0.8)):
        plan = df._jdf.queryExecution().toString()
        assert "InPandas" not in plan and "Python" not in plan


@pytest.mark.parametrize("common", [8, 24, 136, 536])
def test_bands_taken_in_sql_hold_lines_at_the_threshold(spark, common):
    random.seed(9)
    text = lambda n: "".join(chr(random.randrange(0x4E00, 0x9E00)) for _ in range(n))
    lines = []
    for k in range(2000):
        base = text(common + 7)
        lines += [(2 * k, base + text(common // 8)), (2 * k + 1, base + text(common // 8))]
    bands = line_dedup.band_rows(spark.createDataFrame(lines, "id long, norm string"))
    met = bands.groupBy("band", F.floor(F.col("id") / 2).alias("pair")).agg(F.count_distinct("id").alias("n")).where("n = 2")
    assert met.select("pair").distinct().count() > 0.99 * 2000


def test_pairs_compared_in_sql_agree_with_sets(spark):
    random.seed(3)
    text = lambda n: "".join(random.choice("abcde \U0001F600") for _ in range(n))
    pairs = [("ab", "ab"), ("a", "b"), ("x" * 500, "x" * 9), ("12345678", "1234567")]
    for n in (9, 30, 200):
        for _ in range(40):
            base = text(n)
            pairs.append((base, base[:-1 - random.randrange(n // 4 + 1)] + text(random.randrange(3))))
    texts = spark.createDataFrame([(2 * k + j, 0, t) for k, p in enumerate(pairs) for j, t in enumerate(p)], "id long, id2 long, norm string")
    ids = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(pairs))], "a long, b long")
    near = {r["a"]["id"] // 2 for r in line_dedup.near_pairs(ids, texts, 0.8).collect()}
    for k, pair in enumerate(pairs):
        x, y = ({line_dedup.padded(t)[j:j + 8] for j in range(max(len(t), 8) - 7)} for t in pair)
        assert (k in near) == (len(x & y) >= 0.8 * len(x | y))


@pytest.mark.parametrize("large", [3, 50])
def test_groups_of_a_band_are_connected_as_by_all_pairs(spark, monkeypatch, large):
    monkeypatch.setattr(line_dedup, "LARGE", large)
    random.seed(6)
    words = lambda n: [f"{random.randrange(10 ** 6)}" for _ in range(n)]
    shared, texts = "the very same words stand at the beginning of every single line of them all", []
    for _ in range(8):
        base = words(12)
        for _ in range(8):
            line = list(base)
            line[random.randrange(12)] = "1"
            texts.append(f"{shared} {' '.join(line)}")
    docs = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], SCHEMA)
    lines = line_dedup.lines_of(docs, "doc_id", "text")
    # Bands of one minimum bring lines of all groups together.
    got = line_dedup.line_components(lines, 0.8, rows=1, bands=12, block=10)
    group = {r["norm"]: (r["id"], r["id2"]) for r in lines.collect()}
    root = {tuple(r["node"]): tuple(r["root"]) for r in got.collect()}
    links = line_dedup.forest_of([line_dedup.grams_of(t) for t in texts], 0.8)
    of = list(range(len(texts)))
    for a, b in links:
        of = [of[a] if x == of[b] else x for x in of]
    label = [root.get(group[t], group[t]) for t in texts]
    assert len(set(of)) > 1
    assert len(set(zip(of, label))) == len(set(of)) == len(set(label))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != "mix":
            assert docs.columns == columns
        docs = docs.cache()
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    assert simhash.near_duplicates(docs).where("doc_id <> component_id").count() == 0
    leaks = decontaminate.summary(decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    assert leaks.where("contaminated").count() == 0


def test_one_long_run_of_a_role_reads_back_in_linear_time(spark):
    import time
    turns = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "concat(repeat('long text ', 20), id, ' </s>') AS text")
    start = time.perf_counter()
    row = chat_format.digests(chat_format.format_chats(turns)).first()
    assert row["n_turns"] == 20_000 and time.perf_counter() - start < 60


def test_fingerprints_of_text_ids_and_of_many_rows_of_one_id(spark):
    rows = [(f"d{k:03d}", f"line {k}\nanother {k % 7}") for k in range(60)] + [("hot", f"text {k}\nmore of {k}") for k in range(80)] + [(None, f"none {k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    got = fingerprints.fingerprint_edits(docs).collect()
    assert len(got) == len(rows) and sum(r["doc_id"] is None for r in got) == 40 and sum(r["doc_id"] == "hot" for r in got) == 80
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] and r["doc_id"] != "hot"}
    import hashlib
    for k in range(59):
        text, after = rows[k][1], rows[k + 1][1]
        half = len(text) // 2
        assert by_id[rows[k][0]]["edited_sha256"] == hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()


def test_toxicity_training_holds_its_rows_once():
    import tracemalloc

    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(400)]
    texts = [" ".join(draw.choices(vocabulary, k=600)) for _ in range(200)]
    tracemalloc.start()
    try:
        starts, index, share = toxicity._bags(texts)
        bags, most = index.nbytes + share.nbytes, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert starts[-1] == len(index) == len(share) and most < 1.8 * bags


def test_fingerprint_places_are_found_in_two_steps(spark):
    edge = lambda x: F.struct(F.lit(x is None).alias("none"), F.lit(x).cast("long").alias("doc_id"))
    keys = spark.range(-3, 203).select("id").union(spark.sql("SELECT CAST(NULL AS long) AS id"))
    keys = keys.select("id", F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("doc_id")).alias("key"))
    for n in (0, 1, 2, 3, 8, 9, 10, 99):
        edges = [*range(0, 2 * n, 2)]
        got = {r["id"]: r["place"] for r in keys.select("id", fingerprints._place(F.col("key"), [edge(x) for x in edges]).alias("place")).collect()}
        assert got == {x: n if x is None else sum(e <= x for e in edges) for x in got}
    # No row is compared with all edges: none of the lists that are gone through has over ten of them.
    plan = keys.select(fingerprints._place(F.col("key"), [edge(x) for x in range(99)]))._jdf.queryExecution().analyzed().toString()
    first = plan.split("filter(array(", 1)[1].split("lambdafunction", 1)[0]
    assert first.count("struct(") <= 10


def test_slots_leave_out_only_pairs_that_are_not_alike(spark):
    draw, lines = random.Random(3), []
    for k in range(400):
        line = "".join(draw.choice("abcdefgh é漢") for _ in range(draw.choice([3, 8, 60, 300, 2000])))
        line = line * 3 if k % 7 == 0 else line  # few distinct shingles for its length
        cut = draw.randrange(len(line) + 1)
        other = line[:cut] + "".join(draw.choice("xyz") for _ in range(draw.choice([0, 1, 3, 20, 150]))) + line[cut:]
        lines += [line, other]
    texts = spark.createDataFrame([(k, k, x) for k, x in enumerate(lines)], "id long, id2 long, norm string")
    marked = line_dedup.marked_texts(texts).localCheckpoint()
    assert marked.count() == len(lines)
    pairs = spark.range(0, len(lines), 2).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = [sorted(map(str, line_dedup.near_pairs(pairs, t, 0.8).collect())) for t in (texts, marked)]
    assert found[0] == found[1] and 50 < len(found[0]) < 350
    sides = [marked.select(F.col("id").alias(f"{x}_id"), F.col("norm").alias(f"{x}_norm"), F.col("bits").alias(f"{x}_bits")) for x in "ab"]
    left = sides[0].join(sides[1], F.expr("a_id % 2 = 0 AND b_id = a_id + 1")).where(line_dedup._may_be_near(0.8)).count()
    # Most of those that are not alike need no comparison.
    assert left - len(found[0]) < (len(lines) // 2 - len(found[0])) / 2
