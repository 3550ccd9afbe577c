"""License scans: exact phrases, and short notices with bounded errors.

A text is brought to its words (A-Z lower-cased, ASCII punctuation dropped)
with one space between.  Exact phrases are found in that.  A notice with up to
k edits holds one of its k + 1 parts unchanged (pigeonhole), so an automaton
over all notices' parts finds the candidates; the regex library's
bounded-error matching then verifies each window and gives its span and edits.

A row is judged on its own, without a shuffle.  Null and empty texts have no
words and no labels.  Repeated rows are each judged; other columns aren't read.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import kind, slices, utf8
from stratum.llm.decontaminate import WORD_BYTES

#: Exact phrases and their labels; fixed values.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Short notices of public licenses, in words, and their labels; fixed values.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("under the terms of the gnu general public license", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this work is licensed under a creative commons attribution", "cc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
#: A notice may have an edit (an inserted, lost or changed character) for each so many characters.
CHARS_PER_EDIT = 10

SPANS = "array<struct<label:string,first_word:bigint,last_word:bigint,edits:int,score:double>>"
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                             ("edits", pa.int32()), ("score", pa.float64())]))


class Scanner:
    def __init__(self, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT):
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, label) in enumerate(notices):
            k = len(notice) // chars_per_edit
            self.notices.append((len(notice), k, label, regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={k}}}")))
            cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(notice[a:b], []).append((number, a))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Of each notice, the stretches of the text where a seed of it lies; overlapping ones are joined."""
        out: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(text):
            start = last - size + 1
            for number, offset in places:
                n, k = self.notices[number][:2]
                out.setdefault(number, []).append([max(0, start - offset - k), min(len(text), start - offset + n + k)])
        for number, found in out.items():
            found.sort()
            joined = found[:1]
            for a, b in found[1:]:
                if a <= joined[-1][1]:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            out[number] = joined
        return out

    def spans(self, text: str) -> list[dict]:
        """Notices with bounded errors in words joined by spaces, by first word and label."""
        out = []
        for number, stretches in self.windows(text).items():
            n, k, label, pattern = self.notices[number]
            for a, b in stretches:
                for m in _matches(pattern, text, a, b, n - k):
                    edits = sum(m.fuzzy_counts)
                    inner = m[0].strip(" ")
                    if inner:
                        start = m.start() + m[0].index(inner)
                        first = text.count(" ", 1, start) if start > 1 else 0
                        out.append({"label": label, "first_word": first, "last_word": first + inner.count(" "),
                                    "edits": edits, "score": 1 - edits / n})
        return sorted(out, key=lambda s: (s["first_word"], s["label"], s["last_word"]))


def _matches(pattern, text: str, start: int, end: int, least: int):
    """Matches from the best one on, then the best ones of what lies before and behind it, and so on."""
    parts = [(start, end)]
    while parts:
        a, b = parts.pop()
        if b - a < max(least, 1) or not (m := pattern.search(text, a, b)):
            continue
        yield m
        if m.end() > m.start():
            parts.append((a, m.start()))
        parts.append((max(m.end(), m.start() + 1), b))


def phrase_places(text: bytes) -> tuple[list[int], set[str]]:
    """First words of all exact phrases, sorted, and their labels; text: words with a space around each."""
    places, labels = [], set()
    for phrase, label in PHRASES:
        sought, at = b" " + phrase.encode() + b" ", -1
        while (at := text.find(sought, at + 1)) >= 0:
            places.append(text.count(b" ", 0, at))
            labels.add(label)
    return sorted(places), labels


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES,
         chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """For each row ``id_col``, ``n_words``, the exact phrases' ``n_base``, ``first_word``, ``last_word``
    and ``base_labels``, all ``labels`` (distinct, sorted, comma-joined), ``score`` (1 for an exact phrase,
    else the best notice's share of characters that are right, else 0) and the notices' ``spans``."""

    def scanned(batches):
        scanner = Scanner(notices, chars_per_edit)
        for batch in slices(batches):
            rows: dict[str, list] = {c: [] for c in ("n_words", "n_base", "first_word", "last_word",
                                                     "base_labels", "labels", "score", "spans")}
            for data in utf8(batch.column(1)):
                words = data.translate(WORD_BYTES).split() if data else []
                text = b" " + b" ".join(words) + b" " if words else b""
                places, base = phrase_places(text)
                spans = scanner.spans(text.decode())
                rows["n_words"].append(len(words))
                rows["n_base"].append(len(places))
                rows["first_word"].append(places[0] if places else None)
                rows["last_word"].append(places[-1] if places else None)
                rows["base_labels"].append(",".join(sorted(base)))
                rows["labels"].append(",".join(sorted(base | {s["label"] for s in spans})))
                rows["score"].append(1.0 if base else max((s["score"] for s in spans), default=0.0))
                rows["spans"].append(spans)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, t) for v, t in zip(rows.values(), types))], [id_col, *rows])

    schema = (f"`{id_col}` {kind(docs, id_col)}, n_words long, n_base long, first_word long, last_word long, "
              f"base_labels string, labels string, score double, spans {SPANS}")
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(scanned, schema)
