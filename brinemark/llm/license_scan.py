"""License scans by template markup, compiled to token automata.

A template is plain wording with markup: what stands between ``<<beginOptional>>``
and ``<<endOptional>>`` may be missing, and ``<<var;words=a-b>>`` stands for any a to b
words. All other wording is mandatory and must match word for word.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brinemark.llm.columns import packed, quoted
from brinemark.llm.decontaminate import WORD_TABLE

OUTPUT = ("n_words", "places", "base_labels", "labels", "score")
MARKUP = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")

# Phrases whose places are the base count.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
# Wording of notices and licenses, shortened to their distinctive sentences.
TEMPLATES = {
    "apache-2.0": "licensed under <<beginOptional>>the<<endOptional>> apache license <<beginOptional>>version<<endOptional>> 2.0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by 4.0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by nc 4.0",
    "gpl-2.0": "licensed under the <<beginOptional>>gnu<<endOptional>> general public license <<beginOptional>>version<<endOptional>> 2",
    "gpl-3.0": "licensed under the <<beginOptional>>gnu<<endOptional>> general public license <<beginOptional>>version<<endOptional>> 3",
    "gpl-later": "under the terms of the <<beginOptional>>gnu<<endOptional>> general public license as published by the free software foundation either version <<var;words=1-2>> of the license or at your option any later version",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "released under <<beginOptional>>the terms of<<endOptional>> the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of <<var;words=1-8>> and associated documentation files",
    "mpl-2.0": "subject to the terms of the mozilla public license <<beginOptional>>v<<endOptional>> <<beginOptional>>version<<endOptional>> 2.0",
}
FOUND = "n_words long, places array<struct<label:string,start:long,end:long,base:boolean>>"


@dataclass
class Automaton:
    """States with word steps, free steps and steps over any word; state 0 starts, ``final`` accepts."""

    label: str
    base: bool
    steps: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    any_word: list[int | None] = field(default_factory=lambda: [None])
    final: int = 0
    needs: list[bytes] = field(default_factory=list)

    def _state(self) -> int:
        self.steps.append({})
        self.free.append([])
        self.any_word.append(None)
        return len(self.steps) - 1

    @classmethod
    def of(cls, label: str, template: str, base: bool = False) -> Automaton:
        made, at, optional, plain, last = cls(label, base), 0, [], [], 0
        for mark in [*MARKUP.finditer(template), None]:
            wording = template[last:mark.start() if mark else len(template)]
            for word in wording.encode().translate(WORD_TABLE).split():
                to = made._state()
                made.steps[at][word] = to
                at = to
                if not optional:
                    plain.append(word)
            if mark is None:
                break
            last = mark.end()
            if mark[1] == "beginOptional":
                optional.append(at)
            elif mark[1] == "endOptional":
                # A state of its own, so that going round an option does not open another one.
                to = made._state()
                made.free[at].append(to)
                made.free[optional.pop()].append(to)
                at = to
            else:
                ends = []
                for k in range(int(mark[3]) + 1):
                    if k >= int(mark[2]):
                        ends.append(at)
                    if k < int(mark[3]):
                        to = made._state()
                        made.any_word[at] = to
                        at = to
                to = made._state()
                for end in ends:
                    made.free[end].append(to)
                at = to
        if optional or not plain:
            raise ValueError(f"template {label!r} has an open option or no mandatory wording")
        made.final, made.needs = at, sorted(set(plain), key=len, reverse=True)
        if any(made.any_word[s] is not None for s in made._closed({0})):
            raise ValueError(f"template {label!r} must not start with a replaceable region")
        return made

    def _closed(self, states: set[int]) -> set[int]:
        found, todo = set(states), list(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in found:
                    found.add(to)
                    todo.append(to)
        return found

    def first_words(self) -> set[bytes]:
        return {word for s in self._closed({0}) for word in self.steps[s]}

    def match(self, words: list[bytes], start: int) -> int | None:
        """End of the shortest accepted run of words from ``start``."""
        now, at = self._closed({0}), start
        while now and self.final not in now:
            if at == len(words):
                return None
            after = {self.steps[s][words[at]] for s in now if words[at] in self.steps[s]}
            after |= {self.any_word[s] for s in now if self.any_word[s] is not None}
            now, at = self._closed(after), at + 1
        return at if now else None


class Scanner:
    """All automata, entered only at words that can start one, in texts that have their wording."""

    def __init__(self, templates: dict[str, str], base: dict[str, str]):
        self.automata = [
            *(Automaton.of(label, text, True) for label, text in base.items()),
            *(Automaton.of(label, text) for label, text in templates.items())]

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, int, int, bool]]]:
        data = (text or "").encode().translate(WORD_TABLE)
        words, found = data.split(), []
        for automaton in self.automata:
            if not all(word in data for word in automaton.needs):
                continue
            for first in automaton.first_words():
                at = -1
                while True:
                    try:
                        at = words.index(first, at + 1)
                    except ValueError:
                        break
                    end = automaton.match(words, at)
                    if end is not None:
                        found.append((automaton.label, at, end, automaton.base))
        return len(words), sorted(found, key=lambda f: (f[1], f[0], f[3]))


def find_places(text: Column, templates: dict[str, str], base: dict[str, str]) -> Column:
    @F.pandas_udf(FOUND)
    def places(texts: pd.Series) -> pd.DataFrame:
        scanner = Scanner(templates, base)
        rows = [scanner.scan(t) for t in texts]
        return pd.DataFrame({"n_words": [n for n, _ in rows], "places": [
            [{"label": label, "start": a, "end": b, "base": base_} for label, a, b, base_ in found] for _, found in rows]})

    return places(text)


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, base: dict[str, str] | None = None, text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, the ``places`` of licenses, ``base_labels``, ``labels`` and a ``score``.

    Texts are read as words (A-Z lower-cased; letters, digits and everything beyond
    ASCII). ``places``: label, start, end (in words, end exclusive), base, in order;
    from every start the shortest accepted run counts. ``base_labels``: labels of the
    phrases of ``base`` found; ``labels``: those of all automata; both distinct and
    sorted, comma-joined. ``score``: 1 where a template's wording is complete, 0.5
    where only a phrase of ``base`` stands, else 0.

    NULL and empty texts have no words, no labels and score 0. Repeated rows each get
    their result; input columns named like an output column are replaced. Texts are
    scanned where they are, without a shuffle; work is linear in a text's words.
    """
    templates, base = TEMPLATES if templates is None else templates, BASE if base is None else base
    rows = docs.select(packed(docs, OUTPUT), find_places(quoted(text), templates, base).alias("found_"))
    found = F.col("found_.places")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda p: p["label"]))), ",")
    score = F.when(F.exists(found, lambda p: ~p["base"]), 1.0).when(F.size(found) > 0, 0.5).otherwise(0.0)
    return rows.select(
        "row_.*", F.col("found_.n_words").alias("n_words"), found.alias("places"),
        joined(F.filter(found, lambda p: p["base"])).alias("base_labels"), joined(found).alias("labels"), score.alias("score"))


def summary(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts, first and last start of the base phrases, labels and score per document."""
    starts = F.transform(F.filter("places", lambda p: p["base"]), lambda p: p["start"])
    return scanned.select(
        doc_id, "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), "base_labels", "labels", "score")
