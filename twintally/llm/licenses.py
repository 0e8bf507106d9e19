"""License scan: named phrases, and an exact set-similarity join with license templates.

A text's blocks are the windows of its words, wherever its lines end, and a template is a set of
words. A template of ``n`` words is held against windows of ``n / threshold`` words, so that a
notice may have some words of its own in between; one of fewer than ``SHORT`` words must be there
whole, in a window of its own length. A block is found if it holds at least the threshold's share of
the template's distinct words. Words are put in one order, rarest first, by how often all
documents say them. With ``o`` the least overlap that meets the threshold,

- a block must share one of the template's first ``size - o + 1`` words in that order (prefix), so only
  windows around such words are looked at, and that word's reach is what they all lie in;
- a reach with fewer than ``o`` places of template words is out (length);
- if the shared word has ``p`` words of the template before it in the order, the reach must hold ``o - p``
  of the template's words from it on (position);
- the windows of what is left are counted one after another.

None of the filters loses a block. Only words of templates matter to an overlap, so the
frequencies that are gathered, and what every task holds, are as many as the templates
have words: a bound that does not depend on the corpus. A text is passed through once, with work
per template word in it, so a very long text without line ends costs as much as its words do.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintally.llm.scratch import quoted
from twintally.llm.words import ascii_words

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Paragraphs of license texts and notices by which licenses are named, and their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files the software to deal in the software without restriction including without limitation the"
            " rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions"
            " of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
               " the license you may obtain a copy of the license at"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is"
               " distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
            " public license as published by the free software foundation either version 3 of the license or at your"
            " option any later version"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program if not see"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
             " general public license as published by the free software foundation"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero"
             " general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the"
            " following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
            " following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
            " products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to"
             " alter it and redistribute it freely subject to the following restrictions"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code"
                  " form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to"
            " this work to the public domain worldwide"),
)

THRESHOLD = 0.8
SHORT = 10

_RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, blocks array<struct<start:long,words:int,template:int,containment:double>>"
)


def needed(words: list[bytes], threshold: float) -> tuple[int, int]:
    """How many of a template's distinct words a block must hold, and how many words a block has."""
    share = Fraction(str(threshold)) if len(words) >= SHORT else Fraction(1)
    return -(-len(set(words)) * share.numerator // share.denominator), int(len(words) / share)


class TemplateJoin:
    """The templates' side of the join: prefix index and filters for one word order."""

    def __init__(self, templates, threshold: float, frequency: dict[bytes, int]):
        self.labels = [label for label, _ in templates]
        texts = [ascii_words(text.encode("utf-8")) for _, text in templates]
        words = sorted(set().union(*texts), key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: r for r, w in enumerate(words)}
        self.words = self.rank.keys()
        self.sets = [{self.rank[w] for w in text} for text in texts]
        self.least, self.window = zip(*(needed(text, threshold) for text in texts)) if texts else ((), ())
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for t, s in enumerate(self.sets):
            for at, rank in enumerate(sorted(s)[: len(s) - self.least[t] + 1]):
                self.prefixes.setdefault(rank, []).append((t, at))
        self.starters = frozenset(words[rank] for rank in self.prefixes)

    def matches(self, text: list[bytes]) -> list[tuple[int, int, int, float]]:
        """Blocks of the text's words that meet a template: first word, number of words, template, containment.

        Blocks of one template that overlap are one, with the largest containment.
        """
        if self.starters.isdisjoint(text):
            return []
        places = [place for place, word in enumerate(text) if word in self.words]
        ranks = [self.rank[text[place]] for place in places]
        found = []
        for t, reaches in self._reaches(places, ranks).items():
            for low, high in reaches:
                found += self._count(t, places, ranks, low, high)
        return sorted(found)

    def _reaches(self, places: list[int], ranks: list[int]) -> dict[int, list[list[int]]]:
        """For each template what passes the filters, as ranges of ``places`` without overlaps."""
        reaches: dict[int, list[list[int]]] = {}
        for hit, rank in enumerate(ranks):
            for t, at in self.prefixes.get(rank, ()):
                window, least = self.window[t], self.least[t]
                low = bisect_left(places, places[hit] - window + 1)
                high = bisect_left(places, places[hit] + window)
                if high - low < least:
                    continue
                near = self.sets[t].intersection(ranks[low:high])
                if sum(other >= rank for other in near) < least - at:
                    continue
                known = reaches.setdefault(t, [])
                if known and low <= known[-1][1]:
                    known[-1][1] = max(known[-1][1], high)
                else:
                    known.append([low, high])
        return reaches

    def _count(self, t: int, places: list[int], ranks: list[int], low: int, high: int) -> list[tuple[int, int, int, float]]:
        """The blocks within a range: windows from each of the template's words on are counted in turn."""
        hits = [(places[k], ranks[k]) for k in range(low, high) if ranks[k] in self.sets[t]]
        inside: Counter[int] = Counter()
        blocks: list[list[int]] = []
        end = 0
        for place, rank in hits:
            while end < len(hits) and hits[end][0] < place + self.window[t]:
                inside[hits[end][1]] += 1
                end += 1
            if len(inside) >= self.least[t]:
                last = hits[end - 1][0]
                if blocks and place <= blocks[-1][1]:
                    blocks[-1][1:] = last, max(blocks[-1][2], len(inside))
                else:
                    blocks.append([place, last, len(inside)])
            inside[rank] -= 1
            if not inside[rank]:
                del inside[rank]
        return [(first, last - first + 1, t, n / len(self.sets[t])) for first, last, n in blocks]


def template_frequencies(docs: DataFrame, templates, text_column: str = "text") -> dict[bytes, int]:
    """How often all documents say each word of a template.

    Tasks count first; the driver gets one row per template word.
    """
    wanted = frozenset(w for _, text in templates for w in ascii_words(text.encode("utf-8")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(word for word in ascii_words((text or "").encode("utf-8")) if word in wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
        )

    counted = docs.select(quoted(text_column).cast("string").alias("text")).mapInArrow(count, "word binary, n long")
    return {bytes(word): n for word, n in counted.groupBy("word").agg(F.sum("n")).collect()}


def _phrase_starts(words: list[bytes], by_last: dict[bytes, list[tuple[list[bytes], str]]]) -> list[tuple[int, str]]:
    starts = []
    for last, phrases in by_last.items():
        at = -1
        try:
            while True:
                at = words.index(last, at + 1)
                for phrase, label in phrases:
                    start = at - len(phrase) + 1
                    if start >= 0 and words[start : at + 1] == phrase:
                        starts.append((start, label))
        except ValueError:
            pass
    return starts


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: the phrases' places, all labels, and the blocks that meet a template.

    ``n_words`` counts the text's words; ``n_base`` the places where a phrase's words stand
    one after another, of which ``first_word`` and ``last_word`` are the smallest and largest start
    (words from 0; null without any). ``base_labels`` are the phrases' labels, ``labels`` those and
    the templates', distinct, sorted and joined by commas. ``score`` is 1 with a phrase, else the
    largest containment of a template that meets the threshold, else 0. ``blocks`` has the first word
    (from 0), the number of words, the template's number and the containment of every match.

    - A null text is an empty text: no words, no labels, score 0.
    - Repeated rows and null identifiers are kept as they are; an empty table gives no rows.
    - Other columns are not read.
    """
    join = TemplateJoin(templates, threshold, template_frequencies(docs, templates, text_column))
    by_last: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for phrase, label in phrases.items():
        parts = ascii_words(phrase.encode("utf-8"))
        by_last.setdefault(parts[-1], []).append((parts, label))

    def scan(text: str | None) -> tuple:
        words = ascii_words((text or "").encode("utf-8"))
        starts = _phrase_starts(words, by_last)
        blocks = [dict(zip(("start", "words", "template", "containment"), match)) for match in join.matches(words)]
        base = {label for _, label in starts}
        labels = base | {join.labels[b["template"]] for b in blocks}
        places = [start for start, _ in starts]
        return (
            len(words),
            len(starts),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            1.0 if starts else max((b["containment"] for b in blocks), default=0.0),
            blocks,
        )

    block = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int32()), ("template", pa.int32()), ("containment", pa.float64())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), block]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = zip(*map(scan, batch.column(1).to_pylist()))
                columns = [pa.array(c, kind) for c, kind in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return rows.mapInArrow(scanned, _RESULT)
