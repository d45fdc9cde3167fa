"""Fuzzy search for short licence notices.

A notice is a run of words and a number of edits (letters put in, left out or exchanged) that a place may be away from
it. Texts are lower-cased (A-Z) and cut into words; a *place* is a run of whole words within the notice's budget.

1. A notice with a budget of e is split into e + 1 pieces. Whatever e edits do, one piece stays as it is
   (pigeonhole), so every place shows an exact piece. All pieces of all notices are looked for in one pass.
2. A piece found says where its notice may lie: a window a little longer than the notice. The regex library matches
   the notice in it with at most e errors, the fewest first, at word ends, and reports the span.
3. Names that tell licences apart (``names``) must be in the span as they are. Of places of several notices that
   overlap, the one with the fewest edits for its length stands.

Notices with a budget of 0 are phrases: all their places count, also overlapping ones, and none gives way. Places of
another notice don't overlap each other; they are taken from left to right.

One pass over whole texts without a shuffle; notices are parameters of fixed size. Null and empty texts have no words
and no places; repeated rows get equal results; null keys pass; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstream.llm.shipping import ship
from docstream.llm.tokenizing import once

_SEPARATORS = [b for b in range(128) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]
_LOWERED = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Letters of a notice for each edit that it may be away.
LETTERS_PER_EDIT = 10
#: Windows whose matches a worker remembers.
REMEMBERED = 20_000

PLACES = "array<struct<label string, notice string, first_word long, last_word long, start long, end long, edits int>>"


@dataclass(frozen=True)
class Notice:
    """What a licence says of itself, in lower-case words with a blank between them."""

    label: str
    text: str
    edits: int
    names: tuple[str, ...] = ()


def phrase(label: str, text: str) -> Notice:
    return Notice(label, text, 0)


def notice(label: str, text: str, *names: str) -> Notice:
    return Notice(label, text, max(1, len(text) // LETTERS_PER_EDIT), names)


#: Exact phrases and their labels.
PHRASES = (
    phrase("mit", "mit license"),
    phrase("apache", "apache license"),
    phrase("gpl", "general public license"),
)

#: Opening or granting words of common licences.
NOTICES = (
    notice("agpl", "under the terms of the gnu affero general public license", "affero"),
    notice("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
    notice("apache", "licensed under the apache license version 2 0", "apache"),
    notice("apache", "you may not use this file except in compliance with the license"),
    notice("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    notice("bsd", "licensed under the bsd license", "bsd"),
    notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    notice("cc-by", "licensed under cc by 4 0", "cc", "by"),
    notice("cc-by", "licensed under a creative commons attribution 4 0 international license", "attribution"),
    notice("cc-by-nc", "licensed under cc by nc 4 0", "cc", "by", "nc"),
    notice("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "noncommercial"),
    notice("cc-by-sa", "licensed under cc by sa 4 0", "cc", "by", "sa"),
    notice("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "sharealike"),
    notice("cc0", "has waived all copyright and related or neighboring rights"),
    notice("gpl", "licensed under the gnu general public license version 3", "gnu"),
    notice("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    notice("lgpl", "under the terms of the gnu lesser general public license", "lesser"),
    notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    notice("mit", "released under the mit license", "mit"),
    notice("mit", "licensed under the mit license", "mit"),
    notice("mpl", "subject to the terms of the mozilla public license", "mozilla"),
    notice("unlicense", "this is free and unencumbered software released into the public domain"),
)


def pieces(said: Notice) -> list[tuple[int, str]]:
    """(offset, piece): the text of a notice in one piece more than it may have edits."""
    parts, size = said.edits + 1, len(said.text)
    cuts = [size * k // parts for k in range(parts + 1)]
    return [(a, said.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_LOWERED).split()


class Finder:
    """Finds the places of notices in texts, in a worker."""

    def __init__(self, notices: Sequence[Notice]):
        import ahocorasick
        import regex

        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, said in enumerate(notices):
            for offset, piece in pieces(said):
                seeds.setdefault(piece, []).append((number, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()
        self.patterns = [regex.compile(rf"(?b)(?<=[ ])(?=[^ ])(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.edits}}}(?<=[^ ])(?=[ ])") if n.edits else None for n in notices]
        self.nearest = lru_cache(REMEMBERED)(self._nearest)

    def _nearest(self, number: int, window: str) -> tuple[int, int, int] | None:
        """(start, end, edits) of the nearest run of words in a window of whole words between blanks."""
        found = self.patterns[number].search(window)
        if not found or not set(self.notices[number].names) <= set(found[0].split()):
            return None
        return found.start(), found.end(), sum(found.fuzzy_counts)

    def spans(self, line: str) -> list[tuple[int, int, int, int]]:
        """(start, end, edits, notice) in ``line``: words with a blank before, between and after them."""
        exact, near = [], []
        done = [0] * len(self.notices)
        tried: list[tuple[int, int]] = [(-1, -1)] * len(self.notices)
        for last, (size, uses) in self.seeds.iter(line):
            for number, offset in uses:
                said = self.notices[number]
                begin = last + 1 - size - offset
                end = begin + len(said.text)
                if not said.edits:
                    if line[begin - 1] == " " and line[end] == " ":
                        exact.append((begin, end, 0, number))
                    continue
                # Whole words between the furthest place that the piece allows to start and to end at.
                begin = line.find(" ", max(begin - said.edits - 1, done[number], 0)) + 1
                end = line.rfind(" ", 0, min(end + said.edits, len(line) - 1) + 1)
                if end - begin < len(said.text) - said.edits or tried[number] == (begin, end):
                    continue
                tried[number] = (begin, end)
                # With its blanks: the library misses some places at the very ends of a string.
                found = self.nearest(number, line[begin - 1 : end + 1])
                if found:
                    near.append((begin - 1 + found[0], begin - 1 + found[1], found[2], number))
                    done[number] = begin - 1 + found[1]
        return exact + self._standing(near)

    def _standing(self, near: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """The places that stand against those overlapping them: fewest edits for their length, then the longest."""
        near.sort()
        kept: list[tuple[int, int, int, int]] = []
        at = 0
        while at < len(near):
            # Runs of places that overlap one another are short: as many as notices fit into each other.
            stop, reach = at + 1, near[at][1]
            while stop < len(near) and near[stop][0] < reach:
                reach, stop = max(reach, near[stop][1]), stop + 1
            chosen: list[tuple[int, int, int, int]] = []
            for place in sorted(near[at:stop], key=lambda p: (p[2] / len(self.notices[p[3]].text), p[0] - p[1], p)):
                if all(place[1] <= a or b <= place[0] for a, b, _, _ in chosen):
                    chosen.append(place)
            kept += chosen
            at = stop
        return kept

    def places(self, text: str | None) -> tuple[int, list[dict]]:
        """The number of words and the places, by their first word."""
        words = words_of(text or "")
        line = f" {b' '.join(words).decode()} "
        found = sorted(self.spans(line)) if words else []
        if not found:
            return len(words), []
        own = [m.span() for m in _WORD.finditer(text)]
        told, at, word = [], 1, 0
        for start, end, edits, number in found:
            word, at = word + line.count(" ", at, start), start
            last = word + line.count(" ", start, end)
            said = self.notices[number]
            told.append({"label": said.label, "notice": said.text, "first_word": word, "last_word": last, "start": own[word][0], "end": own[last][1], "edits": edits})
        return len(words), told


def scan(docs: DataFrame, notices: Sequence[Notice] = PHRASES + NOTICES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_words`` and ``places`` of each row: words are counted from 0, letters of the text for ``start`` and ``end``."""
    ship(docs.sparkSession)
    notices = tuple(notices)
    kind = pa.list_(
        pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = once(("licences", notices), lambda: Finder(notices))
        for batch in batches:
            found = [finder.places(text) for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([p for _, p in found], kind)], names=["key", "n_words", "places"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"key long, n_words long, places {PLACES}").withColumnRenamed("key", key)


def labels(places: Column) -> Column:
    """The distinct labels of places, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def likeness(places: Column) -> Column:
    """How near the nearest place is to its notice: 1 without an edit, 0 without a place."""
    near = F.transform(places, lambda p: 1 - p["edits"] / F.length(p["notice"]))
    return F.coalesce(F.array_max(near), F.lit(0.0)).cast("double")
