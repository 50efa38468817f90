"""License scan: exact phrases and a fuzzy search for short notices.

Texts are normalised to words (a-z, 0-9 and everything beyond ASCII). The base
phrases are found where their words stand consecutively. For notices with up
to k edits, the pigeonhole principle gives the seeds: a notice cut into k + 1
pieces keeps at least one piece unedited, so exact searches for the pieces
locate every candidate; the regex library's bounded-error matching then
verifies the edits in the words around a seed and reports the span.

One pass over the texts, nothing is shuffled. Null texts are empty; texts
without words have no places, empty label lists, null first and last word and
score 0. Rows are independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import append_columns, quoted

# Fixed phrases and labels (whole words).
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Fixed notice texts with their label and the number of edits allowed.
NOTICES = (
    ("apache license version 2 0", "apache", 3),
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 8),
    ("licensed under the gnu general public license", "gpl", 4),
    ("gnu general public license version", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 8),
    ("creative commons attribution", "cc-by", 2),
    ("licensed under cc by nc", "cc-by-nc", 2),
    ("licensed under cc by sa", "cc-by-sa", 2),
    ("mozilla public license version", "mpl", 3),
    ("eclipse public license", "epl", 2),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 7),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6),
)

WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def seeds(phrase: str, edits: int) -> list[tuple[bytes, int]]:
    """The phrase cut into edits + 1 pieces of near equal length, with their offsets."""
    n, parts = len(phrase), edits + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(phrase[a:b].encode(), a) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds the phrases and notices in one text; built once per task."""

    def __init__(self, phrases=PHRASES, notices=NOTICES):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases]
        self.notices = []
        for text, label, edits in notices:
            pattern = regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(text, literal_spaces=True)}){{e<={edits}}}(?![^ ])")
            self.notices.append((text, label, edits, seeds(text, edits), pattern))

    def exact(self, norm: bytes) -> list[tuple[int, str]]:
        """(place in bytes, label) of every base phrase, overlapping ones too."""
        found = []
        for phrase, label in self.phrases:
            at = norm.find(phrase)
            while at >= 0:
                found.append((at, label))
                at = norm.find(phrase, at + 1)
        return found

    def fuzzy(self, norm: bytes) -> list[tuple[int, int, str, int, float]]:
        """(first byte, end byte, label, edits, likeness) of every notice found."""
        found = []
        for text, label, edits, pieces, pattern in self.notices:
            n, around = len(text.encode()), []
            slack = 4 * edits  # bytes: an edit may be a character of up to 4
            for piece, offset in pieces:
                at = norm.find(piece)
                while at >= 0:
                    # where the notice can lie, out to whole words
                    lo = norm.rfind(b" ", 0, max(at - offset - slack, 1))
                    hi = norm.find(b" ", min(at - offset + n + slack, len(norm) - 1))
                    around.append((max(lo, 0), len(norm) if hi < 0 else hi + 1))
                    at = norm.find(piece, at + 1)
            around.sort()
            merged: list[list[int]] = []
            for lo, hi in around:
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            for lo, hi in merged:
                window = norm[lo:hi].decode("utf-8", "replace")
                chars = end = 0  # up to the last match, in characters and bytes
                for m in pattern.finditer(window, concurrent=False):
                    first = end + len(window[chars:m.start()].encode())
                    end = first + len(m.group().encode())
                    chars = m.end()
                    errors = sum(m.fuzzy_counts)
                    found.append((lo + first, lo + end, label, errors, 1 - errors / n))
        return found

    def scan(self, raw: bytes) -> tuple:
        tokens = raw.translate(WORD_BYTES).split(b" ")
        tokens = [t for t in tokens if t]
        if not tokens:
            return 0, 0, None, None, "", "", 0.0, []
        norm = b" " + b" ".join(tokens) + b" "
        exact = self.exact(norm)
        fuzzy = self.fuzzy(norm)
        blanks = np.flatnonzero(np.frombuffer(norm, np.uint8) == 0x20)
        word = lambda at: int(np.searchsorted(blanks, at))
        places = [word(at) for at, _ in exact]
        base = {label for _, label in exact}
        spans = [{"label": label, "first_word": word(a + (norm[a:a + 1] == b" ")) - 1,
                  "n_words": len(norm[a:b].split()), "edits": e, "likeness": s} for a, b, label, e, s in fuzzy]
        return (len(tokens), len(exact), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | {f[2] for f in fuzzy})),
                1.0 if exact else max((f[4] for f in fuzzy), default=0.0), spans)


FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans array<struct<label: string, first_word: long, n_words: long, edits: int, "
          "likeness: double>>")


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per row: doc_id, n_words, the base places and labels, all labels, a
    score (1 for a base phrase, else the best notice's share of unedited
    characters) and the notices' spans in words."""
    made: list[Scanner] = []

    def compute(texts):
        import pyarrow as pa

        if not made:
            made.append(Scanner(phrases, notices))
        rows = [made[0].scan(t.as_py() or b"") for t in texts.cast(pa.large_binary())]
        cols = list(zip(*rows)) if rows else [[]] * 8
        span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                   ("edits", pa.int32()), ("likeness", pa.float64())]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
        return [pa.array(c, k) for c, k in zip(cols, kinds)]

    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("__text"))
    return append_columns(narrow, "__text", compute, FIELDS).drop("__text")


def flagged(scanned: DataFrame) -> DataFrame:
    """The rows in which a license was found."""
    return scanned.where(F.col("labels") != "")
