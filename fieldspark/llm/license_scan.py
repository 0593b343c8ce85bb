"""License notices in texts, also misspelt ones, with where they stand and how much they differ.

A notice of L letters may be written with up to k edits. Cut in k + 1 parts, at least one part of any such writing is unchanged
(pigeonhole), so the parts are looked for exactly, all parts of all notices in one pass over the text. Around each
find a window is opened that any writing with that part must lie in, and there the bounded-error search of the regex
library tells whether it does, where, and with how many edits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fieldspark.llm.common import held, in_batches, quoted, slices
from fieldspark.llm.decontaminate import words

# fixed values: phrases that name a license wherever their words stand one after another
BASE_PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

#: Short notices that are found with edits: label and wording, in words as ``words`` cuts them.
NOTICES = [
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "licensed under the bsd license"),
    ("cc-by", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "subject to the terms of the mozilla public license"),
]

#: Letters of a notice for each edit that is allowed.
LETTERS_PER_EDIT = 12

SCHEMA = (
    "n_words long, base array<struct<label:string,word:long>>, "
    "notices array<struct<label:string,notice:string,first_word:long,last_word:long,edits:int,matched:string>>"
)


def allowed_edits(notice: str) -> int:
    return len(notice) // LETTERS_PER_EDIT


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """A notice in ``edits + 1`` parts of about one length: where each starts, and the part."""
    bounds = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(bounds, bounds[1:])]


class Scanner:
    """Finds phrases exactly and notices with edits in a text of words with one space around each."""

    def __init__(self, notices: list[tuple[str, str]], base: list[tuple[str, str]]):
        self.notices, self.base = notices, base
        self.patterns = []
        wanted = defaultdict(list)
        for number, (_, phrase) in enumerate(base):
            wanted[f" {phrase} "].append((None, number))
        for number, (_, notice) in enumerate(notices):
            edits = allowed_edits(notice)
            # a writing begins and ends where a word does; the closest one at a place is taken
            self.patterns.append(regex.compile(rf"(?<= )(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}(?= )", regex.ENHANCEMATCH))
            for offset, part in seeds(notice, edits):
                wanted[part].append((offset, number))
        self.parts = ahocorasick.Automaton()
        for part, uses in wanted.items():
            self.parts.add_word(part, (len(part), uses))
        self.parts.make_automaton()

    def find(self, text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Phrases as (place, number), and notices as (start, stop, edits, number)."""
        phrases, windows = [], defaultdict(list)
        for end, (size, uses) in self.parts.iter(text):
            for offset, number in uses:
                if offset is None:
                    phrases.append((end - size + 2, number))
                    continue
                notice = self.notices[number][1]
                edits, start = allowed_edits(notice), end - size + 1 - offset
                windows[number].append((max(0, start - 2 * edits), start + len(notice) + 2 * edits + 1))
        return phrases, [(*span, number) for number in sorted(windows) for span in self.verify(text, number, _merged(windows[number]))]

    def verify(self, text: str, number: int, windows: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """Writings of a notice inside windows of the text, from left to right."""
        for start, stop in windows:
            for m in self.patterns[number].finditer(text, start, min(stop, len(text))):
                yield m.start(), m.end(), sum(m.fuzzy_counts)

    def scan(self, text: str | None) -> tuple[int, list[dict], list[dict]]:
        own = words(text)
        if not own:
            return 0, [], []
        line = f" {b' '.join(own).decode()} "
        phrases, spans = self.find(line)
        spans = _best(spans)
        number = _word_numbers(line, [p for p, _ in phrases] + [x for a, b, *_ in spans for x in (a, b - 1)])
        base = [{"label": self.base[i][0], "word": number[p]} for p, i in phrases]
        notices = [
            {"label": self.notices[i][0], "notice": self.notices[i][1], "first_word": number[a], "last_word": number[b - 1], "edits": edits, "matched": line[a:b]}
            for a, b, edits, i in spans
        ]
        return len(own), base, notices


def _merged(windows: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    windows.sort()
    first, last = windows[0]
    for start, stop in windows[1:]:
        if start > last:
            yield first, last
            first = start
        last = max(last, stop)
    yield first, last


def _best(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Where writings of several notices overlap, the one with the fewest edits stays, of those the longest."""
    out: list[tuple[int, int, int, int]] = []
    cluster: list[tuple[int, int, int, int]] = []
    stop = -1

    def settle():
        kept: list[tuple[int, int, int, int]] = []
        for span in sorted(cluster, key=lambda s: (s[2], s[0] - s[1], s)):
            if all(span[1] <= k[0] or span[0] >= k[1] for k in kept):
                kept.append(span)
        out.extend(sorted(kept))

    for span in sorted(spans):
        if span[0] >= stop:
            settle()
            cluster = []
        cluster.append(span)
        stop = max(stop, span[1])
    settle()
    return out


def _word_numbers(line: str, places: list[int]) -> dict[int, int]:
    """The number of the word, from 0, that each place is in."""
    out, at, n = {}, 0, -1
    for place in sorted(set(places)):
        n += line.count(" ", at, place)
        at = place
        out[place] = n
    return out


def scan_licenses(
    docs: DataFrame, notices: list[tuple[str, str]] | None = None, base: list[tuple[str, str]] | None = None, id_column: str = "doc_id"
) -> DataFrame:
    """What stands in each text: the identifier, ``n_words``, ``base`` and ``notices``, a row for each row of ``docs``.

    Words of column ``text`` are runs of ASCII letters (A-Z in lower case), digits and any characters outside ASCII. ``base`` holds
    every place, a word number from 0, where the words of a phrase stand one after another. ``notices`` holds the writings of a
    notice with at most one edit (a letter put in, left out or changed) for every ``LETTERS_PER_EDIT`` letters, that begin and end
    with a word: label, notice, first and last word, edits, and the words as they stand. Writings of one notice do not overlap; where
    those of several do, the one with the fewest edits stays, then the longest. Null and empty texts have no words and
    empty lists. Null and repeated identifiers keep their rows; no rows give no rows; columns besides the two are not read.
    """
    notices, base = NOTICES if notices is None else notices, BASE_PHRASES if base is None else base
    schema = T.StructType.fromDDL(SCHEMA)
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = held(("licenses", repr((notices, base))), lambda: Scanner(notices, base))
        for batch in slices(batches, "text"):
            columns = zip(*map(scanner.scan, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, columns, kinds)], ["id", *schema.names])

    rows = docs.select(quoted(id_column).alias("id"), F.col("text").cast("string").alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), *schema.fields])
    return in_batches(rows, scan, out, keeps=True).withColumnRenamed("id", id_column)


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, places, labels and a score of what ``scan_licenses`` found, in place of the lists.

    ``score`` is the share of letters that agree in the closest writing: 1 where a phrase stands, 0 where nothing is found.
    """
    by_phrase = F.array_distinct(F.transform("base", lambda x: x["label"]))
    by_notice = F.transform("notices", lambda x: x["label"])
    places = F.transform("base", lambda x: x["word"])
    near = F.array_max(F.transform("notices", lambda x: 1 - x["edits"] / F.length(x["notice"])))
    return scanned.select(
        *[quoted(c) for c in scanned.columns if c not in ("base", "notices")],
        F.size("base").cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(by_phrase), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(by_phrase, by_notice)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(near, F.lit(0.0))).alias("score"), F.size("notices").cast("long").alias("n_notices"),
    )
