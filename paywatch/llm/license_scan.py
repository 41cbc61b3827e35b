"""License notices: exact phrases by words, and short notices with typing errors by exact seeds."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from paywatch.llm.common import texts, utf8

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Short notices, in lower case, and their labels; each may have one edit for every EDIT_CHARS characters.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted, free of charge", "mit"),
    ("licensed under the apache license", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("licensed under cc by-nc", "cc-by-nc"),
    ("licensed under cc by-sa", "cc-by-sa"),
    ("licensed under a creative commons", "cc"),
    ("all rights reserved", "reserved"),
)
EDIT_CHARS = 9
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
WORD, GAP = rb"[0-9a-z\x80-\xff]", rb"[^0-9a-z\x80-\xff]+"
BASE = re.compile(rb"(?<!" + WORD + rb")(?:" + b"|".join(GAP.join(p.encode().split()) for p in PHRASES) + rb")(?!" + WORD + rb")")
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>,"
    " score double, notices array<struct<label:string,start:long,end:long,edits:long>>"
)


class Notice(NamedTuple):
    label: str
    size: int
    edits: int
    match: regex.Pattern


@cache
def _search() -> tuple[list[Notice], ahocorasick.Automaton]:
    """The notices and an automaton of their seeds.

    A notice with at most k edits is cut into k + 1 pieces; k edits leave one of them untouched, so every
    occurrence has an exact seed at its place, k characters more or less.
    """
    notices, seeds = [], {}
    for text, label in NOTICES:
        edits = len(text) // EDIT_CHARS
        notices.append(Notice(label, len(text), edits, regex.compile(rf"(?b)(?:{regex.escape(text)}){{e<={edits}}}")))
        cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
        for begin, end in zip(cuts, cuts[1:]):
            seeds.setdefault(text[begin:end], []).append((len(notices) - 1, begin))
    automaton = ahocorasick.Automaton()
    for seed, places in seeds.items():
        automaton.add_word(seed, (len(seed), places))
    automaton.make_automaton()
    return notices, automaton


def _matches(pattern: regex.Pattern, text: str, begin: int, end: int) -> Iterator[regex.Match]:
    """Every match in a stretch of text: the best one, and then what lies before and after it."""
    open_ = [(begin, end)]
    while open_:
        begin, end = open_.pop()
        found = pattern.search(text, begin, end) if begin < end else None
        if found is not None and found.end() > found.start():
            yield found
            open_ += [(begin, found.start()), (found.end(), end)]


def find_notices(text: str) -> list[tuple[str, int, int, int]]:
    """(label, start, end, edits) of every notice in a lower-case text, by start; code points, end exclusive."""
    notices, automaton = _search()
    windows: dict[int, list[list[int]]] = {}
    for last, (size, places) in automaton.iter(text):
        for which, offset in places:
            notice = notices[which]
            begin = last + 1 - size - offset - notice.edits
            end = begin + notice.size + 2 * notice.edits
            mine = windows.setdefault(which, [])
            if mine and begin <= mine[-1][1]:
                mine[-1][0] = min(mine[-1][0], begin)
                mine[-1][1] = max(mine[-1][1], end)
            else:
                mine.append([begin, end])
    found = set()
    for which, mine in windows.items():
        for begin, end in mine:
            for m in _matches(notices[which].match, text, max(0, begin), min(len(text), end)):
                found.add((notices[which].label, m.start(), m.end(), sum(m.fuzzy_counts), notices[which].size))
    # Of notices that overlap, the one with the fewest edits for its length is reported, the longest first.
    kept: list[tuple[str, int, int, int]] = []
    for label, start, end, edits, _ in sorted(found, key=lambda x: (x[3] / x[4], -x[4], x)):
        if not any(start < k[2] and k[1] < end for k in kept):
            kept.append((label, start, end, edits))
    return sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def scan(text: bytes) -> tuple:
    """The columns of SCHEMA after doc_id for one text."""
    lower = text.lower()
    inside = IN_WORD[np.frombuffer(lower, np.uint8)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    base = list(BASE.finditer(lower)) if b"license" in lower else []
    places = [int(np.count_nonzero(begins[: m.start() + 1])) - 1 for m in (base[:1] + base[-1:])]
    base_labels = {PHRASES[b" ".join(re.split(GAP, m.group())).decode()] for m in base}
    notices = find_notices(lower.decode())
    likeness = [1 - edits / max(end - start, 1) for _, start, end, edits in notices]
    return (
        int(np.count_nonzero(begins)), len(base), places[0] if base else None, places[-1] if base else None, sorted(base_labels),
        sorted(base_labels | {n[0] for n in notices}), 1.0 if base else max(likeness, default=0.0),
        [dict(zip(("label", "start", "end", "edits"), n)) for n in notices],
    )


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    strings = pa.list_(pa.string())
    spans = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), strings, strings, pa.float64(), spans]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
    for batch in batches:
        columns = list(zip(*(scan(t) for t in utf8(batch.column("text"))))) or [()] * len(kinds)
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)


def licenses(docs: DataFrame) -> DataFrame:
    """One row per document row with the columns of SCHEMA.

    n_base counts the places of the base phrases, first_word and last_word their outermost starts (null without
    any). `labels` adds those of the notices, whose spans and edits are in `notices`. The score is 1 with a base
    phrase, else the best notice's share of unedited characters, else 0.

    Null, empty and blank texts have no words, labels or score; repeated rows and rows without an id each give a
    row. An empty table gives an empty result. Other columns are not read.
    """
    return texts(docs).mapInArrow(_scanned, SCHEMA)
