"""Quality rules: text statistics, and a decision list learned from labelled ones.

Sequential covering: rules are conjunctions of thresholds that catch poor texts. Each is
grown on two thirds of the rows that no rule covers yet and pruned on the last third;
the list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brinemark.llm.columns import packed, quoted, stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_capitals", "n_digits")
SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
CAPITALS, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
WINDOW = 8
# The base rule that always holds.
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30

FIT_ROWS = 20_000  # labelled rows a class that a list is learned from, at most
LEAST_PRECISION = 0.9  # of a rule, on the rows it is pruned on
MOST_CONDITIONS = 6
SEED = 17


def repeated(ids: np.ndarray, width: int = WINDOW) -> int:
    """Words that stand in a window of ``width`` (a power of two) words found twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    step = 1
    while step < width:
        pairs = ids[:-step].astype(np.int64) * (int(ids.max()) + 1) + ids[step:]
        distinct, ids = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        step *= 2
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    change = np.bincount(starts, minlength=n + width) - np.bincount(starts + width, minlength=n + width)
    return int((np.cumsum(change) > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    data = (text or "").encode()
    words, known = data.split(), {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    lines = Counter(line for line in data.split(b"\n") if line.strip(BLANKS))
    without = lambda drop: len(data) - len(data.translate(None, drop))
    return (
        len(words), len(text or "") - without(BLANKS), without(SYMBOLS), lines.total() - len(lines), repeated(ids), len(known),
        lines.total(), without(CAPITALS), without(DIGITS))


def _counts(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{name} long" for name in COUNTS))
    def all_counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([counts(t) for t in texts], columns=list(COUNTS))

    return all_counts(text)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with counts of every whole text.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a
    word equal to an earlier line), n_repeat_words (words in windows of eight words
    found twice or more, first included), n_distinct words, n_lines with a word,
    n_capitals and n_digits (ASCII). Words stand between ASCII blanks. NULL and empty
    texts have zeros. Repeated rows each get their counts; input columns named like an
    output are replaced. One scan, no shuffle; work is n log n in a text's words.
    """
    rows = docs.select(packed(docs, (*COUNTS, text)), _counts(quoted(text)).alias("found_"))
    return rows.select("row_.*", "found_.*")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED_PERCENT) * F.col("n_words"))


def features() -> dict[str, Column]:
    """Shares that the learner sees, by name; NULL never occurs."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"), "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words, "dup_lines_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words, "distinct_share": F.col("n_distinct") / words,
        "words_per_line": F.col("n_words") / lines, "capitals_share": F.col("n_capitals") / chars,
        "digits_share": F.col("n_digits") / chars}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def holds(self, values: pd.DataFrame) -> np.ndarray:
        column = values[self.feature].to_numpy()
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; the first that holds rejects a text, otherwise it is kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def rejects(self, values: pd.DataFrame) -> np.ndarray:
        return np.any([_all(rule, values) for rule in self.rules], axis=0) if self.rules else np.zeros(len(values), bool)

    def rule(self) -> Column:
        """Wording of the first rule that holds for a row of statistics, else NULL."""
        out = None
        for conditions in self.rules:
            holds = conditions[0].column()
            for condition in conditions[1:]:
                holds = holds & condition.column()
            wording = F.lit(" and ".join(map(str, conditions)))
            out = F.when(holds, wording) if out is None else out.when(holds, wording)
        return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None))

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}" for r in self.rules) + "\nkeep"


def _all(rule: tuple[Condition, ...], values: pd.DataFrame) -> np.ndarray:
    return np.all([c.holds(values) for c in rule], axis=0) if rule else np.ones(len(values), bool)


def best_condition(values: pd.DataFrame, poor: np.ndarray) -> Condition | None:
    """The condition of most FOIL gain over rows of one rule's cover; ties go to the first feature and least threshold."""
    total, p_all = len(poor), int(poor.sum())
    if p_all in (0, total):
        return None
    before, best, gain = np.log2(p_all / total), None, 1e-9
    for name in values.columns:
        column = values[name].to_numpy()
        order = np.argsort(column, kind="stable")
        ordered, hits = column[order], np.cumsum(poor[order])
        cuts = np.flatnonzero(ordered[1:] > ordered[:-1])
        if not len(cuts):
            continue
        p_low, n_low = hits[cuts], cuts + 1
        for above, p, n in ((False, p_low, n_low), (True, p_all - p_low, total - n_low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = np.where(p > 0, p * (np.log2(p / n) - before), 0.0)
            k = int(np.argmax(gains))
            if gains[k] > gain:
                low, high = ordered[cuts[k]], ordered[cuts[k] + 1]
                middle = (low + high) / 2
                best, gain = Condition(name, above, float(middle if low <= middle < high else low)), gains[k]
    return best


def grow(values: pd.DataFrame, poor: np.ndarray) -> tuple[Condition, ...]:
    rule, inside = (), np.ones(len(poor), bool)
    while len(rule) < MOST_CONDITIONS:
        condition = best_condition(values[inside], poor[inside])
        if condition is None:
            break
        rule, inside = (*rule, condition), inside & condition.holds(values)
    return rule


def prune(rule: tuple[Condition, ...], values: pd.DataFrame, poor: np.ndarray) -> tuple[Condition, ...]:
    """The beginning of ``rule`` with the best (hits - misses) / cover; the shortest of equals."""
    best, worth = rule, -2.0
    for k in range(1, len(rule) + 1):
        inside = _all(rule[:k], values)
        if inside.any():
            found = (2 * int(poor[inside].sum()) - int(inside.sum())) / int(inside.sum())
            if found > worth:
                best, worth = rule[:k], found
    return best


def cover(values: pd.DataFrame, poor: np.ndarray, least_precision: float = LEAST_PRECISION, seed: int = SEED) -> DecisionList:
    """Sequential covering over feature rows; ``poor`` marks those to reject.

    Stops when no poor row is left, or a rule that was grown and pruned finds no poor
    row or less than ``least_precision`` of them in what it covers of the pruning rows.
    One class only, or no rows, give an empty list, which keeps everything.
    """
    dice, made, left = np.random.default_rng(seed), DecisionList(), np.ones(len(poor), bool)
    turn = np.empty(len(poor))
    for kind in (False, True):
        members = np.flatnonzero(poor == kind)
        turn[members] = dice.permutation(len(members)) % 3
    while poor[left].any() and not poor[left].all():
        # A class of its own rotation, so that each third has its share of poor rows.
        growing, pruning = left & (turn != len(made.rules) % 3), left & (turn == len(made.rules) % 3)
        rule = grow(values[growing], poor[growing])
        rule = prune(rule, values[pruning], poor[pruning])
        inside = pruning & _all(rule, values)
        if not rule or not inside.any() or poor[inside].mean() < least_precision:
            break
        made.rules.append(rule)
        left &= ~_all(rule, values)
    return made


def learn(
    statistics: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", rows_per_class: int = FIT_ROWS,
    least_precision: float = LEAST_PRECISION,
) -> DecisionList:
    """A decision list from the ``statistics`` of labelled documents that pass the base rule.

    ``labels``: doc_id and quality (1 good, 0 poor); NULLs and ids labelled both ways
    are not used, nor are rows without an id. At most ``rows_per_class`` rows a class,
    those of least hash, come to the driver as a few numbers each. No labels, one class
    only or an empty table give a list without rules.
    """
    known = labels.select(quoted(doc_id).alias("l_id"), quoted(quality).alias("l_good"))
    known = known.where(F.col("l_good").isin(0, 1) & F.col("l_id").isNotNull()).groupBy("l_id").agg(
        F.min("l_good").alias("least"), F.max("l_good").alias("most"))
    known = known.where(F.col("least") == F.col("most")).select("l_id", (F.col("least") == 0).alias("poor"))
    rows = statistics.where(~base_failed()).select(quoted(doc_id).alias("s_id"), *[c.alias(n) for n, c in features().items()])
    rows = rows.join(known, F.col("s_id") == F.col("l_id")).withColumn("draw", F.xxhash64(F.col("s_id").cast("string"), F.lit(SEED)))
    taken = []
    for poor in (False, True):
        some = rows.where(F.col("poor") == F.lit(poor)).orderBy("draw", *features()).limit(rows_per_class)
        taken.append(some.select("poor", *features()).toPandas())
    frame = pd.concat(taken, ignore_index=True)
    return cover(frame[list(features())].astype(float), frame["poor"].to_numpy(dtype=bool), least_precision)


def judge(statistics: DataFrame, rules: DecisionList) -> DataFrame:
    """``statistics`` with ``base_failed``, ``rule`` (the first that rejects, else NULL) and ``kept``.

    A few comparisons of columns, all in the JVM. A text with NULL counts cannot occur;
    input columns named like an output are replaced.
    """
    rest = [quoted(c) for c in statistics.columns if c.lower() not in ("base_failed", "rule", "kept")]
    return statistics.select(
        *rest, base_failed().alias("base_failed"), rules.rule().alias("rule"),
        (~base_failed() & rules.rule().isNull()).alias("kept"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's statistics and verdict under rules learned from the labelled ones.

    Texts are read once; their counts are written to the shared folder, learned from
    and judged there.
    """
    statistics = stored(text_statistics(docs, text), "text-statistics")
    return judge(statistics, learn(statistics, labels, doc_id))
