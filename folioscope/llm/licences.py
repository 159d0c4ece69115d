"""Licence notices in documents: fuzzy search for short notices with a bounded number of edits.

Method: a notice of m characters that may differ by k edits is split into k + 1 pieces; by the pigeonhole principle one piece
at least stands unchanged in every match. One automaton finds all pieces of all notices in one pass over a text.
Around each find, the regex library's bounded-error matching decides, and gives the span and the number of edits.
Texts are compared as their words, lower-cased and joined by single spaces, so line breaks and punctuation cost no edits.

The exact phrases of PHRASES are counted besides; their labels always stay. Null or empty texts: no words, no places, empty
labels, score 0. Texts are searched whole. Overlapping finds of one notice count once, with the fewest edits; of equals
the first. Repeated rows are scanned each by itself. Extra columns pass through; one with the name of an output is replaced.
"""

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType

from folioscope.llm.common import WORDS_ONLY, appended, text_bytes, with_columns

#: Exact phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices searched with edits, and their labels.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("this program is free software you can redistribute it and or modify it", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("licensed under cc by", "cc"),
    ("creative commons attribution", "cc"),
]

#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

SPAN = StructType().add("label", StringType()).add("first_word", LongType()).add("last_word", LongType()).add("edits", IntegerType())


def words_only(text: bytes) -> str:
    """The words, joined by single spaces, with a space before the first and after the last; empty without words."""
    words = text.translate(WORDS_ONLY).split()
    return f" {b' '.join(words).decode()} " if words else ""


class Finder:
    def __init__(self, notices: list[tuple[str, str]], chars_per_edit: int):
        self.notices = []
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, (notice, label) in enumerate(notices):
            pattern = f" {notice} "
            edits = len(notice) // chars_per_edit
            fuzzy = regex.compile(f"(?b)(?:{regex.escape(pattern, literal_spaces=True)}){{e<={edits}}}")
            self.notices.append((pattern, label, edits, fuzzy))
            cuts = [len(pattern) * i // (edits + 1) for i in range(edits + 2)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(pattern[begin:end], []).append((n, begin))
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """Matches in a text of words_only: notice, begin, end, edits."""
        windows: dict[tuple[int, int], int] = {}
        for last, (size, places) in self.automaton.iter(text):
            for n, offset in places:
                pattern, _, edits, _ = self.notices[n]
                begin = max(0, last + 1 - size - offset - edits)
                windows[n, begin] = min(len(text), last + 1 - size - offset + len(pattern) + edits)
        best: list[tuple[int, int, int, int]] = []
        for (n, begin), end in sorted(windows.items()):
            match = self.notices[n][3].search(text, begin, end)
            if match:
                found = (n, match.start(), match.end(), sum(match.fuzzy_counts))
                if best and best[-1][0] == n and found[1] < best[-1][2]:
                    best[-1] = min(best[-1], found, key=lambda x: (x[3], x[1]))
                else:
                    best.append(found)
        return best


def places(text: str, phrase: str) -> list[int]:
    """Offsets in a text of words_only at which a phrase's words stand consecutively."""
    out, at = [], text.find(f" {phrase} ")
    while at >= 0:
        out.append(at)
        at = text.find(f" {phrase} ", at + 1)
    return out


def report(text: str, finder: Finder) -> dict:
    """What scan() adds for one text of words_only."""
    phrases = [(at, label) for phrase, label in PHRASES.items() for at in places(text, phrase)]
    found = finder.find(text)
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32) if phrases or found else np.zeros(0, np.int64)

    def before(offsets: list[int]) -> list[int]:
        """The number of spaces before each offset."""
        return np.searchsorted(spaces, offsets).tolist()

    base = list(zip(before([at for at, _ in phrases]), [label for _, label in phrases], strict=True))
    spans, score = [], 1.0 if base else 0.0
    begins = before([begin + 1 if text[begin] == " " else begin for _, begin, _, _ in found])
    ends = before([end - 1 for _, _, end, _ in found])
    for (n, _, _, edits), begin, end in zip(found, begins, ends, strict=True):
        pattern, label, _, _ = finder.notices[n]
        first = begin - 1
        last = max(first, end - 1)
        spans.append({"label": label, "first_word": max(0, first), "last_word": last, "edits": edits})
        score = max(score, 1.0 - edits / len(pattern))
    starts = [at for at, _ in base]
    base_labels = {label for _, label in base}
    return {
        "n_words": max(0, text.count(" ") - 1),
        "n_base": len(base),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {s["label"] for s in spans})),
        "score": score,
        "spans": sorted(spans, key=lambda s: (s["first_word"], s["label"], s["last_word"])),
    }


OUTPUT = {
    "n_words": LongType(), "n_base": LongType(), "first_word": LongType(), "last_word": LongType(),
    "base_labels": StringType(), "labels": StringType(), "score": DoubleType(), "spans": ArrayType(SPAN),
}

_ARROW = {LongType(): pa.int64(), StringType(): pa.string(), DoubleType(): pa.float64()}
_ARROW_SPANS = pa.list_(
    pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])
)


def scan(
    docs: DataFrame, text: str = "text", notices: list[tuple[str, str]] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score and spans to each row."""
    schema = with_columns(docs.schema, **OUTPUT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(notices, chars_per_edit)
        for batch in batches:
            rows = [report(words_only(t), finder) for t in text_bytes(batch.column(text))]
            columns = {
                name: pa.array([r[name] for r in rows], _ARROW.get(kind, _ARROW_SPANS)) for name, kind in OUTPUT.items()
            }
            yield appended(batch, schema, **columns)

    return docs.mapInArrow(run, schema)
