"""License scans: fuzzy search for short notices.

Method.  A notice of L characters may be met with ``L // EDITS_EVERY`` edits.
By the pigeonhole principle, cut into one piece more than that, at least one
piece occurs unchanged.  One automaton finds the pieces of all notices in one
pass; around each hit the ``regex`` library matches the whole notice with
bounded errors, from word border to word border, and such a span is reported.

The words that tell licences apart (names, version numbers; in brackets in
``NOTICES``) must be there as they are, in order; edits fall elsewhere.  A
notice is not reported where the words behind it make it another licence
(``OTHERWISE``: "attribution noncommercial" is no CC BY).

The notices are compared with the document's words (lower case, joined by
single blanks), so line breaks and punctuation cost no edits.  The base
phrases, exact sequences of words, are found first and always reported.

Defined cases: a null or empty text has no words, no labels and score 0; any
text length is one pass plus the hits (word numbers are looked up among the
places of all blanks); repeated rows give repeated results;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import ensure_python_package, query, table

EDITS_EVERY = 14      # one edit is allowed per so many characters

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Short notices, as lower-case words, and their labels; words in
# brackets allow no edit.
NOTICES = {
    "licensed under the [apache] license version [2] [0]": "apache-2.0",
    "released under the [mit] license": "mit",
    "licensed under the [mit] license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "subject to the terms of the [mozilla] public license v [2] [0]": "mpl-2.0",
    "subject to the terms of the [mozilla] public license": "mpl",
    "made available under the terms of the [eclipse] public license": "epl",
    "this work is licensed under the gnu [general] public license": "gpl",
    "this program is free software you can redistribute it and or modify": "gpl",
    "under the terms of the gnu [lesser] general public license": "lgpl",
    "under the terms of the gnu [affero] general public license": "agpl",
    "distributed under the [boost] software license version [1] [0]": "bsl-1.0",
    "licensed under a creative commons [attribution]": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this software is provided as is without any express or implied warranty": "zlib",
    "proprietary and confidential unauthorized copying of this file": "proprietary",
}
# Words that follow a notice and make it another licence.
OTHERWISE = {"cc-by": {"noncommercial", "noderivatives", "noderivs", "sharealike", "non", "no", "share"}}

# words lower-cased, everything between them blank
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


class Notice:
    """A notice as it is searched: its words, edits, exact words, pattern."""

    def __init__(self, marked: str, label: str):
        self.text, self.label = marked.replace("[", "").replace("]", ""), label
        self.edits = len(self.text) // EDITS_EVERY
        self.exact = [w[1:-1] for w in marked.split(" ") if w.startswith("[")]
        # what stands between the exact words may differ, each part within the bound
        parts = [f"(?:{regex.escape(x)}){{e<={self.edits}}}" if k % 2 == 0 and x else regex.escape(x)
                 for k, x in enumerate(regex.split(r"\[(\w+)\]", marked))]
        self.search = regex.compile(f"(?e)(?<![^ ])(?:{''.join(parts)})(?![^ ])").search

    def holds(self, words: str, start: int, end: int, edits: int) -> bool:
        """Whether the span is this notice: few edits in all, its exact words
        in order, no other licence's words behind."""
        if edits > self.edits:
            return False
        found = iter(words[start:end].split(" "))
        return all(w in found for w in self.exact) and \
            words[end + 1:end + 20].split(" ")[0] not in OTHERWISE.get(self.label, ())


@cache
def _automaton():
    """Pieces of all notices; per piece the (notice, place of the piece)."""
    found: dict[str, list[tuple[int, int]]] = {}
    notices = [Notice(marked, label) for marked, label in NOTICES.items()]
    for n, notice in enumerate(notices):
        size = len(notice.text)
        cuts = [size * k // (notice.edits + 1) for k in range(notice.edits + 2)]
        for a, b in zip(cuts, cuts[1:]):
            found.setdefault(notice.text[a:b], []).append((n, a))
    automaton = ahocorasick.Automaton()
    for piece, places in found.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton, notices


def fuzzy(words: str) -> list[tuple[str, int, int, int, int]]:
    """(label, start, end, edits, notice length) of the notices in a document's
    words, joined by blanks; spans of one notice do not overlap."""
    automaton, notices = _automaton()
    windows: dict[int, list[list[int]]] = {}
    for last, (size, places) in automaton.iter(words):
        for n, at in places:
            notice = notices[n]
            start = last + 1 - size - at - notice.edits
            end = start + len(notice.text) + 2 * notice.edits
            spans = windows.setdefault(n, [])
            if spans and start <= spans[-1][1] and start >= spans[-1][0]:
                spans[-1][1] = max(end, spans[-1][1])  # overlapping windows of one notice are one
            else:
                spans.append([start, end])
    out = []
    for n, spans in windows.items():
        notice, done = notices[n], 0
        for a, b in spans:
            at = max(a, done, 0)
            # the window ends at a word's end, so that its last word is whole
            b = words.find(" ", max(b, 0))
            while (m := notice.search(words, at, len(words) if b < 0 else b)) and m.end() > m.start():
                edits = sum(m.fuzzy_counts)
                if notice.holds(words, m.start(), m.end(), edits):
                    out.append((notice.label, m.start(), m.end(), edits, len(notice.text)))
                    done = at = m.end()
                else:
                    at = m.start() + 1
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def base_places(words: str, blanks: np.ndarray) -> list[tuple[int, str]]:
    """(word number, label) of every base phrase, in order."""
    padded, out = f" {words} ", []
    for phrase, label in PHRASES.items():
        starts = []
        at = padded.find(f" {phrase} ")
        while at >= 0:
            starts.append(at)
            at = padded.find(f" {phrase} ", at + 1)
        out += [(int(n), label) for n in np.searchsorted(blanks, starts)]
    return sorted(out)


def scan_text(raw: bytes) -> dict:
    """Labels, score, base places and spans (word numbers) of one UTF-8 text."""
    words = b" ".join(raw.translate(_WORDS).split()).decode("utf-8", "replace")
    blanks = np.array([m.start() for m in re.finditer(" ", words)], np.int64)
    base, near = base_places(words, blanks), fuzzy(words)

    def number(at: int) -> int:
        return int(np.searchsorted(blanks, at))

    spans = [{"label": label, "first_word": number(a), "last_word": number(b), "edits": edits, "text": words[a:b]}
             for label, a, b, edits, _ in near]
    score = max([1.0 - e / size for *_, e, size in near] + [1.0] * bool(base), default=0.0)
    return {"n_words": len(blanks) + 1 if words else 0, "n_base": len(base),
            "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
            "base_labels": ",".join(sorted({x for _, x in base})),
            "labels": ",".join(sorted({x for _, x in base} | {s["label"] for s in spans})),
            "score": round(score, 6), "spans": spans}


FOUND = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                   ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                   ("score", pa.float64()), ("spans", pa.list_(pa.struct([
                       ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                       ("edits", pa.int64()), ("text", pa.string())])))])
COLUMNS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, spans array<struct<label: string, first_word: long, "
           "last_word: long, edits: long, text: string>>")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts, labels, score and the fuzzy spans (label,
    first and last word, edits, the words found)."""
    def run(batches):
        for b in batches:
            got = pa.array([scan_text(t.as_buffer().to_pybytes() if t.is_valid else b"")
                            for t in b.column("text").cast(pa.binary())], FOUND)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *got.flatten()],
                                             names=["doc_id", *[f.name for f in FOUND]])

    ensure_python_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, COLUMNS)


@query("op9_license_scan")
def op9(spark, sf_dir):
    """License labels of all ``documents``."""
    return scan(table(spark, sf_dir, "documents")).drop("spans")
