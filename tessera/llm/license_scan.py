"""License scans: an exact set-similarity join of text blocks with license templates.

Blocks are overlapping runs of words of the whole text, and of its lines where those are longer than
the overlap. A block matches a template when it holds at least a given share of the template's
distinct words. Words are ordered by how many documents of the corpus have
them, rare ones first; a matching block has to hold one of a template's first words (prefix
filter), enough words in all (length filter) and enough words after the first shared one
(positional filter). What passes is compared word by word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, in_text_groups, text_or_empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The phrases of the base rule and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Common license notices, in their owners' wording, with their usual short names.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

#: Blocks have at most BLOCK words, over twice the longest template; longer texts are cut into blocks that overlap by half.
BLOCK = 64
CONTAINMENT = 0.85


def lower_words(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER))


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]  # distinct, rarest in the corpus first
    needed: int
    length: int  # words of the notice, repeated ones too

    @property
    def prefix(self) -> tuple[str, ...]:
        """A block with ``needed`` of the words has one of these."""
        return self.words[: len(self.words) - self.needed + 1]


def order_templates(templates, documents_with: dict[str, int], containment: float = CONTAINMENT) -> list[Template]:
    out = []
    for label, text in templates:
        words = lower_words(text)
        distinct = sorted(set(words), key=lambda w: (documents_with.get(w, 0), w))
        out.append(Template(label, tuple(distinct), -(-round(containment * 1000) * len(distinct) // 1000), len(words)))
    return out


def word_frequencies(docs: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """How many documents have each word of ``vocabulary``, the templates' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for _, texts in in_text_groups(batches):
            for t in texts:
                n.update(vocabulary.intersection(lower_words(t)))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    counts = arrow_map(docs.select("doc_id", "text"), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {row["word"]: row["n"] for row in counts.collect()}  # at most one row for each word of the templates


class LicenseMatcher:
    """Base places, labels and score of one text."""

    def __init__(self, phrases, templates: list[Template], block: int = BLOCK):
        self.phrases = [(tuple(lower_words(p)), label) for p, label in phrases]
        self.any_phrase = re.compile("|".join(re.escape(p[0]) for p, _ in self.phrases))
        self.block = block
        self.by_word: dict[str, list[tuple[int, Template]]] = {}
        for template in templates:
            for at, word in enumerate(template.prefix):
                self.by_word.setdefault(word, []).append((at, template))
        self.rare = set(self.by_word)

    def base_places(self, words: list[str]) -> list[tuple[int, str]]:
        found = []
        for phrase, label in self.phrases:
            at = -1
            n = len(phrase)
            while True:
                try:
                    at = words.index(phrase[0], at + 1)
                except ValueError:
                    break
                if tuple(words[at:at + n]) == phrase:
                    found.append((at, label))
        return found

    def _cut(self, words: list[str]) -> Iterator[list[str]]:
        for start in range(0, max(1, len(words) - self.block // 2), self.block // 2):
            yield words[start:start + self.block]

    def blocks(self, text: str, words: list[str]) -> Iterator[list[str]]:
        """Of the whole text, whatever its line breaks, and of lines that no block of the text needs to hold whole."""
        yield from self._cut(words)
        if "\n" in text and len(words) > self.block:
            for line in text.split("\n"):
                # a word and what parts it from the next are two characters at least
                if len(line) > self.block and len(of_line := lower_words(line)) > self.block // 2:
                    yield from self._cut(of_line)

    @staticmethod
    def _explained(words: list[str], templates: list[Template]) -> set[Template]:
        """Those of ``templates`` whose shared words another label's shares too, with a larger share or more of them."""
        have = set(words)
        shared = {t: have.intersection(t.words) for t in templates}

        def rank(t: Template) -> tuple[float, int]:
            return len(shared[t]) / len(t.words), len(shared[t])

        return {t for t in templates for other in templates
                if other.label != t.label and shared[t] <= shared[other] and rank(other) > rank(t)}

    def nearest_labels(self, block: list[str], matched: list[Template]) -> set[str]:
        """Labels of the block's notices, without those that match only as relatives of another.

        Several notices can stand in one block, so matches are looked at where they stand, in runs of a
        notice's length: the largest share comes first, then what overlaps least with runs that came
        before, then the most words; a run counts unless half of it or more lies in those. A match
        without such a run, its words being scattered, counts unless another explains it in the whole block.
        """
        if len({t.label for t in matched}) < 2:
            return {t.label for t in matched}
        runs, scattered = [], []
        for t in matched:
            here = []
            for start in range(max(1, len(block) - t.length + 1)):
                shared = len(set(block[start:start + t.length]).intersection(t.words))
                if shared >= t.needed:
                    here.append((shared / len(t.words), shared, set(range(start, min(start + t.length, len(block)))), t.label))
            runs += here
            if not here:
                scattered.append(t)
        out, covered = set(), set()
        while runs := [r for r in runs if 2 * len(covered & r[2]) < len(r[2])]:
            _, _, places, label = max(runs, key=lambda r: (r[0], -len(covered & r[2]), r[1], r[3]))
            out.add(label)
            covered |= places
        if scattered:
            out |= {t.label for t in set(scattered) - self._explained(block, matched)}
        return out

    def templates_in(self, text: str, words: list[str]) -> tuple[dict[str, float], set[str]]:
        """Label -> largest share of a template's words that one block holds, if that is enough; the nearest labels."""
        best: dict[str, float] = {}
        nearest: set[str] = set()
        for block in self.blocks(text, words):
            have = set(block)
            first: dict[Template, int] = {}
            for word in have & self.rare:
                for at, template in self.by_word[word]:
                    first[template] = min(at, first.get(template, at))
            matched = []
            for template, at in first.items():
                size = len(template.words)
                # length filter, then positional: words before the first shared one are missing
                if len(have) < template.needed or size - at < template.needed:
                    continue
                shared = sum(w in have for w in template.words)
                if shared >= template.needed:
                    best[template.label] = max(best.get(template.label, 0.0), shared / size)
                    matched.append(template)
            nearest |= self.nearest_labels(block, matched)
        return best, nearest


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, containment: float = CONTAINMENT, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, candidate_labels.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lowered. Base places are
    where a phrase's words stand in a row, overlapping ones too; ``first_word`` and ``last_word`` are null
    without any. A template matches a block that holds the share ``containment`` of its distinct words or more; notices
    may be wrapped over lines. ``candidate_labels`` adds the labels of all matching templates, among them relatives that
    match each other's notices, such as the Creative Commons ones. ``labels`` adds only those that, in some block, stand where
    no other label's template has a larger share. The score is 1 with a base place, else the largest share, else 0.
    Null and empty texts have no words and no labels. Every row is scanned by itself, so repeated
    rows and null ids need no rule; an empty table gives an empty result; extra columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    vocabulary = {w for _, text in templates for w in lower_words(text)}
    ordered = order_templates(templates, word_frequencies(docs, vocabulary), containment)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = LicenseMatcher(phrases, ordered, block)
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                            ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                            ("candidate_labels", pa.string())])
        for ids, texts in in_text_groups(batches, most=4_000_000):
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                words = lower_words(text)
                places = matcher.base_places(words)
                base = {label for _, label in places}
                close, nearest = matcher.templates_in(text, words) if not matcher.rare.isdisjoint(words) else ({}, set())
                starts = [at for at, _ in places]
                rows.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(base)), ",".join(sorted(base | nearest)),
                             1.0 if base else max(close.values(), default=0.0), ",".join(sorted(base | set(close)))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return arrow_map(docs, run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                "base_labels string, labels string, score double, candidate_labels string")
