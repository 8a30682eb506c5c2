"""Collocations by direct-address tiling.

Texts become blocks of word ids. Frequent words are ranked by frequency; inside a block
the ranks of two neighbours address a cell of a matrix cut into tiles. Tiles with many
pairs are counted densely by ``bincount``, the others as sorted coordinates. Frequent
pairs are ranked in turn and take part, with the word after them, as the rows of the
next matrix, and so on to the longest phrase. Spark adds the blocks up.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from brinemark.llm.columns import quoted, stored
from brinemark.session import clear_work, work_mark

# What ends a piece, and the language of texts without one.
BREAKS, NO_LANGUAGE = b".,;:!?\n\x0b\x0c\r", "und"
LEAST_COUNT, LONGEST, TOP, ABSORBED_PERCENT = 10, 3, 2000, 50

BLOCK_WORDS = 1 << 20  # words of a block, at least; no effect on results
PART_WORDS = 1 << 21  # words of the corpus a part, which holds a share of all cells; no effect on results
SIDE = 16  # ranks on a side of the squares that are dealt to parts
TILE = 1024  # ranks on a side of a tile
DENSE = TILE * TILE // 16  # pairs from which a tile is counted densely
SALTS = 64

_LOWER = bytes(ord("!") if c in BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCKS = "lang string, words array<string>, counts array<long>, codes binary"
_BLOCKS = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary())])
# Cells of one block and part as packed numbers, in order; ``block`` is NULL where ids come back to a part.
CELLS = "part long, block long, size long, heads binary, tails binary, counts binary"
_CELLS = pa.schema([(c, pa.int64()) for c in ("part", "block", "size")] + [(c, pa.binary()) for c in ("heads", "tails", "counts")])
SUMS = "part long, head long, tail long, f long"
_SUMS = pa.schema([(c, pa.int64()) for c in ("part", "head", "tail", "f")])


class _Block:
    """Words of one language as local numbers; 0 marks the end of a piece."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[b"!"]
        self.parts: list[np.ndarray] = []

    def add(self, text: str) -> int:
        words = text.encode().translate(_LOWER).replace(b"!", b" ! ").split(b" ")
        # ``split`` on blanks alone: other control characters belong to words.
        words = [w for w in words if w]
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        return len(words)

    def row(self, lang: str) -> pa.RecordBatch:
        codes = np.concatenate(self.parts)
        counts = np.bincount(codes, minlength=len(self.numbers))[1:]
        words = [w.decode() for w in self.numbers][1:]
        return pa.RecordBatch.from_pylist([{"lang": lang, "words": words, "counts": counts, "codes": codes.tobytes()}], schema=_BLOCKS)


def number_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole texts, one language each."""
    open_: defaultdict[str, _Block] = defaultdict(_Block)
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held += open_[lang].add(text.as_py())
            if held >= BLOCK_WORDS:
                yield from (block.row(name) for name, block in open_.items())
                open_.clear()
                held = 0
    yield from (block.row(name) for name, block in open_.items())


def count_cells(rows: np.ndarray, columns: np.ndarray, n_rows: int, n_columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, column) and how often each occurs, tile by tile; cheap cells have small ranks."""
    wide = n_columns // TILE + 1
    tiles = (rows // TILE).astype(np.int64) * wide + columns // TILE
    numbers, of, sizes = np.unique(tiles, return_inverse=True, return_counts=True)
    found = []
    for k in np.flatnonzero(sizes >= DENSE):
        inside = of == k
        cells = np.bincount((rows[inside] % TILE) * TILE + columns[inside] % TILE, minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        found.append((numbers[k] // wide * TILE + at // TILE, numbers[k] % wide * TILE + at % TILE, cells[at]))
    thin = sizes[of] < DENSE
    codes, counts = np.unique(rows[thin].astype(np.int64) * n_columns + columns[thin], return_counts=True)
    found.append((codes // n_columns, codes % n_columns, counts))
    return tuple(np.concatenate(parts) for parts in zip(*found))


class _Sequence:
    """Ids of a block: the frequent word at every position, and phrases of a length that start there; -1 is none."""

    def __init__(self, codes: bytes, numbers: np.ndarray, ids: np.ndarray):
        codes = np.frombuffer(codes, np.int32)
        # Local ranks: positions among the block's ids, which are ordered by frequency.
        self.word_ids = np.sort(ids)
        rank = np.full(max(int(codes.max()), int(numbers.max())) + 1, -1, np.int64)
        rank[numbers] = np.searchsorted(self.word_ids, ids)
        self.words = rank[codes]
        self.heads, self.head_ids, self.length = self.words, self.word_ids, 1

    def neighbours(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where a frequent phrase stands before a frequent word, and the two ranks."""
        tails = self.words[self.length:]
        at = np.flatnonzero((self.heads[:len(tails)] >= 0) & (tails >= 0))
        return at, self.heads[at], tails[at]

    def lengthen(self, heads: np.ndarray, tails: np.ndarray, ids: np.ndarray) -> None:
        """Phrases one word longer take the ranks of ``ids``; all others are dropped."""
        at, rows, columns = self.neighbours()
        width = len(self.word_ids)
        known = np.searchsorted(self.head_ids, heads) * width + np.searchsorted(self.word_ids, tails)
        order = np.argsort(known)
        known, ids = known[order], ids[order]
        codes = rows * width + columns
        place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        hit = known[place] == codes
        new_ids = np.sort(ids)
        heads_ = np.full(len(self.words), -1, np.int64)
        heads_[at[hit]] = np.searchsorted(new_ids, ids[place[hit]])
        self.heads, self.head_ids, self.length = heads_, new_ids, self.length + 1


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in four bytes each where that is enough, else in eight."""
    return values.astype("<i4" if not len(values) or values.max() < 1 << 31 else "<i8").tobytes()


def _unpack(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // size}").astype(np.int64)


def _part_of(heads: np.ndarray, tails: np.ndarray, parts: int) -> np.ndarray:
    """The part of every cell: small squares of the matrix are dealt out, so that no part has all cells of frequent words."""
    mixed = (heads // SIDE).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (tails // SIDE).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(31)
    return (mixed % np.uint64(parts)).astype(np.int64)


def _cells(part: int, block: int | None, heads: np.ndarray, tails: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    row = {"part": part, "block": block, "size": len(heads), "heads": _pack(heads), "tails": _pack(tails), "counts": _pack(counts)}
    return pa.RecordBatch.from_pylist([row], schema=_CELLS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}


def _block_counter(parts: int):
    """Blocks to the cells of their next longer phrases, part by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            numbers = [np.asarray(row["words"].values.field(i)) for i in range(2)]
            block = _Sequence(row["codes"].as_py(), *numbers)
            for name in [n for n in row if n.startswith("links")]:
                links = [{k: (v if k == "size" else _unpack(v, r["size"])) for k, v in r.items()} for r in row[name].as_py()]
                block.lengthen(*(np.concatenate([r[k] for r in links]) for k in ("heads", "tails", "counts")))
            _, rows, columns = block.neighbours()
            if not len(rows):
                continue
            rows, columns, counts = count_cells(rows, columns, len(block.head_ids), len(block.word_ids))
            heads, tails = block.head_ids[rows], block.word_ids[columns]
            of = _part_of(heads, tails, parts)
            order = np.lexsort((tails, heads, of))
            heads, tails, counts, of = heads[order], tails[order], counts[order], of[order]
            for cut in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
                yield _cells(int(of[cut[0]]), row["block"].as_py(), heads[cut], tails[cut], counts[cut])

    return run


def _added(held: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    heads, tails, counts = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((tails, heads))
    heads, tails, counts = heads[order], tails[order], counts[order]
    first = np.flatnonzero(np.r_[True, (np.diff(heads) != 0) | (np.diff(tails) != 0)])
    return [(heads[first], tails[first], np.add.reduceat(counts, first))]


def _adder(least_count: int):
    """Cells that come sorted by part to the sums of at least ``least_count``; holds the distinct cells of one part."""

    def sums(part: int, held: list) -> Iterator[pa.RecordBatch]:
        heads, tails, counts = _added(held)[0]
        at = np.flatnonzero(counts >= least_count)
        columns = [np.full(len(at), part), heads[at], tails[at], counts[at]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, least = None, [], 0, 1 << 21
        for row in _rows(batches):
            if held and row["part"].as_py() != part:
                yield from sums(part, held)
                held, size, least = [], 0, 1 << 21
            part, n = row["part"].as_py(), row["size"].as_py()
            held.append(tuple(_unpack(row[c].as_py(), n) for c in ("heads", "tails", "counts")))
            size += n
            if size > least:
                held = _added(held)
                size = len(held[0][0])
                least = max(least, 2 * size)
        if held:
            yield from sums(part, held)

    return run


def send_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells that come by part, after the frequent cells of that part with their ids (``block`` NULL): the frequent
    cells of every block, with ids in place of counts."""
    part, known = None, None
    for row in _rows(batches):
        n = row["size"].as_py()
        heads, tails, numbers = (_unpack(row[c].as_py(), n) for c in ("heads", "tails", "counts"))
        if row["block"].as_py() is None:
            order = np.lexsort((tails, heads))
            part, known = row["part"].as_py(), (heads[order], tails[order], numbers[order])
        elif row["part"].as_py() == part:
            # Both sides by head, then tail: places among the known cells of the same head.
            low, high = np.searchsorted(known[0], heads, "left"), np.searchsorted(known[0], heads, "right")
            at = _within(known[1], tails, low, high)
            hit = np.flatnonzero(at >= 0)
            if len(hit):
                yield _cells(part, row["block"].as_py(), heads[hit], tails[hit], known[2][at[hit]])


def _within(values: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted stretches low to high of ``values``, else -1, by bisection of all at once."""
    ends, last = high.copy(), len(values) - 1
    while True:
        open_ = low < high
        if not open_.any():
            break
        middle = (low + high) // 2
        less = open_ & (values[np.minimum(middle, last)] < wanted)
        low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
    return np.where((low < ends) & (values[np.minimum(low, last)] == wanted), low, -1)


def _ranked(phrases: DataFrame, label: str) -> DataFrame:
    """``phrases`` with ids from 0 in order of language and frequency; the sort is dealt in ranges."""
    order = ["lang", F.desc("f"), "phrase"]
    sorted_ = phrases.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at_", F.monotonically_increasing_id())
    sorted_ = stored(sorted_, label).withColumn("range_", F.shiftright("at_", 33))
    sizes = sorted_.groupBy("range_").agg(F.min("at_").alias("first_"), F.count(F.lit(1)).alias("size_"))
    # One row a range of the sort, that is a task.
    before = F.coalesce(F.sum("size_").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("range_", (before - F.col("first_")).alias("shift_"))
    return stored(sorted_.join(F.broadcast(sizes), "range_").withColumn("id", F.col("at_") + F.col("shift_")).drop(
        "range_", "at_", "shift_"), label)


def _pack_ids(known: pa.Table) -> pa.Table:
    """The frequent cells of a part as one row."""
    part, heads, tails, ids = (known.column(c).to_numpy() for c in ("part", "head", "tail", "id"))
    return pa.Table.from_batches([_cells(int(part[0]), None, heads, tails, ids)])


def _by_block(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """One row a block with its ids; never more than the words of the block."""
    return rows.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias(name))


def frequent_phrases(docs: DataFrame, least_count: int, longest: int, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(``phrases``, ``totals``): lang, ids, phrase, f of all phrases of 1 to ``longest`` words that occur
    ``least_count`` times, and lang, n. Phrase f and all totals are exact."""
    texts = docs.select(F.coalesce(quoted(lang), F.lit(NO_LANGUAGE)).alias("lang"), quoted(text).alias("text"))
    spark, mark = docs.sparkSession, work_mark()
    blocks = texts.where(F.col("text").isNotNull()).mapInArrow(number_words, BLOCKS)
    blocks = stored(blocks.withColumn("block", F.monotonically_increasing_id()), "word-blocks")
    totals = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    totals = stored(totals, "language-words")

    local = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("k", "w")).select(
        "block", "lang", (F.col("k") + 1).cast("long").alias("number"), F.col("w.words").alias("phrase"), F.col("w.counts").alias("n"))
    words = local.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least_count)
    levels = [_ranked(words, "frequent-words").withColumn("ids", F.array("id"))]
    numbered = local.join(levels[0].select("lang", "phrase", "id"), ["lang", "phrase"])
    ready = blocks.select("block", "codes").join(_by_block(numbered, "words", "number", "id"), "block").select(
        "block", "codes", "words")
    if longest > 2:
        ready = stored(ready, "ranked-blocks")
        clear_work(spark, mark, [ready, totals, *levels])
    parts = 1 + (totals.agg(F.sum("n")).first()[0] or 0) // PART_WORDS
    for length in range(2, longest + 1):
        cells = ready.mapInArrow(_block_counter(parts), CELLS)
        if length < longest:
            cells = stored(cells, f"cells-{length}")
        found = cells.repartition("part").sortWithinPartitions("part").mapInArrow(_adder(least_count), SUMS)
        heads = levels[-1].select(F.col("id").alias("head"), "lang", F.col("phrase").alias("first_"), F.col("ids").alias("ids_"))
        tails = levels[0].select(F.col("id").alias("tail"), F.col("phrase").alias("last_"))
        named = found.join(heads, "head").join(tails, "tail").select(
            "lang", F.concat_ws(" ", "first_", "last_").alias("phrase"), F.concat("ids_", F.array("tail")).alias("ids"), "part", "head", "tail", "f")
        levels.append(_ranked(named, f"frequent-{length}"))
        if length < longest:
            known = levels[-1].groupBy("part").applyInArrow(_pack_ids, CELLS)
            sent = cells.unionByName(known).repartition("part").sortWithinPartitions("part", F.asc_nulls_first("block")).mapInArrow(send_ids, CELLS)
            sent = stored(sent, f"ids-{length}")
            clear_work(spark, mark, [ready, totals, sent, *levels])
            ready = ready.join(_by_block(sent, f"links{length}", "size", "heads", "tails", "counts"), "block")
    clear_work(spark, mark, [totals, *levels])
    phrases = levels[0].select("lang", "ids", "phrase", "f")
    for level in levels[1:]:
        phrases = phrases.unionByName(level.select("lang", "ids", "phrase", "f"))
    return phrases, totals


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut of least score (the first of equals): lang, ids, phrase, a, l, r, score."""
    cuts = phrases.where(F.size("ids") > 1).select("*", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    part = lambda name: phrases.select(F.col("ids").alias(f"{name}_ids"), F.col("f").alias(name))
    cuts = cuts.withColumn("l_ids", F.slice("ids", F.lit(1), F.col("k"))).withColumn("r_ids", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))
    cuts = cuts.join(part("l"), "l_ids").join(part("r"), "r_ids")
    exact = lambda a, b: f"cast({a} as decimal(19, 0)) * cast({b} as decimal(19, 0))"
    score = F.expr(f"({exact('f', 'f')} * 1000000) div ({exact('l', 'r')})")
    best = cuts.groupBy("ids").agg(
        F.first("lang").alias("lang"), F.first("phrase").alias("phrase"), F.first("f").alias("a"),
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "ids", "phrase", "a", "cut.l", "cut.r", "cut.score")


def standing_alone(candidates: DataFrame, percent: int) -> DataFrame:
    """``candidates`` without those that a longer one holds in at least ``percent`` of their places."""
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("ids") - n + 1), lambda at: F.slice("ids", at, n))))
    longer = candidates.where(F.size("ids") > 2).select(F.explode(F.array_distinct(spans)).alias("ids"), "a")
    longer = longer.groupBy("ids").agg(F.max("a").alias("inside_"))
    kept = candidates.join(longer, "ids", "left").where(
        F.col("inside_").isNull() | (F.lit(100) * F.col("inside_") < F.lit(percent) * F.col("a")))
    return kept.drop("inside_")


def top_per_language(candidates: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of every language, ranked from 1; a large language is first cut in ``SALTS`` parts."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", "salt_").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    salted = candidates.withColumn("salt_", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top).drop("salt_")


def mine_collocations(
    docs: DataFrame, least_count: int = LEAST_COUNT, longest: int = LONGEST, top: int = TOP, absorbed_percent: int = ABSORBED_PERCENT,
    lang: str = "lang", text: str = "text",
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut into pieces and words. ``a`` counts all places
    of a phrase within pieces, overlaps included; cut in two, its parts occur ``l`` and
    ``r`` times, and its score is floor(1000000 a a / (l r)) for the cut that makes it
    least, the first of equals. Phrases that a longer one holds in at least
    ``absorbed_percent`` of their places are left out. ``n`` counts a language's words.

    NULL languages are ``und``; NULL and empty texts have no words; repeated rows count
    each time; ties go by a, then by phrase in byte order; an empty table has no
    phrases; other columns are not read. Very long texts are a block of their own.
    Counts are exact and cover every text. What is shuffled are distinct words of a
    block, and its distinct cells packed by part, never word occurrences; the number of
    parts grows with the corpus, so that a task holds the distinct cells of one part.
    """
    phrases, totals = frequent_phrases(docs, least_count, longest, lang, text)
    candidates = stored(scored(phrases), "candidates")
    best = top_per_language(standing_alone(candidates, absorbed_percent), top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
