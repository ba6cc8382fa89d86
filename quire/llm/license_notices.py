"""License scans: exact phrases, and a fuzzy search for short notices.

A notice may occur with k edits or fewer.  Cut into k + 1 pieces, one of them then
occurs unchanged: an Aho-Corasick automaton finds these seeds in all notices at
once, and only around them the ``regex`` library looks for the notice with its
bounded number of edits.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

# Words that stand consecutively, and their label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices as lower-case words, their label, and the number of edits that is borne with.
NOTICES = (
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("gnu general public license version", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("mozilla public license version 2 0", "mpl", 3),
    ("eclipse public license version", "epl", 3),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 7),
    ("boost software license version 1 0", "bsl", 3),
    ("licensed under cc by 4 0", "cc-by", 1),
    ("licensed under cc by sa 4 0", "cc-by-sa", 1),
    ("licensed under cc by nc 4 0", "cc-by-nc", 1),
    ("licensed under cc by nd 4 0", "cc-by-nd", 1),
)

_SPACE, _LETTER = ord(" "), ord("a") - ord("A")
# Digits, letters and all beyond ASCII make words; the rest separates them.
_FOLD = bytes(
    c + _LETTER if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else _SPACE
    for c in range(256)
)

SPAN = "label string, first_word long, n_words long, edits int"
FOUND = f"n_words long, n_base long, first_word long, last_word long, base_labels array<string>, spans array<struct<{SPAN}>>, score double"


def normalized_words(text: bytes | None) -> bytes:
    """The text's words, lower-cased (A-Z), with a space before and after each."""
    words = (text or b"").translate(_FOLD).split(b" ")
    return b" " + b"".join(w + b" " for w in words if w)


def base_places(words: bytes, phrases=PHRASES) -> list[tuple[int, str]]:
    """(number of the first word, label) for each place of each phrase."""
    out = []
    for phrase, label in phrases:
        needle = b" " + phrase.encode() + b" "
        at = words.find(needle)
        while at >= 0:
            out.append((words.count(b" ", 0, at), label))
            at = words.find(needle, at + 1)
    return out


class NoticeSearch:
    """Finds notices in normalized words."""

    def __init__(self, notices=NOTICES):
        self.notices = notices
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(p, literal_spaces=True)}){{e<={k}}}") for p, _, k in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (phrase, _, k) in enumerate(notices):
            size, more = divmod(len(phrase), k + 1)
            at = 0
            for piece in range(k + 1):
                end = at + size + (piece < more)
                seeds.setdefault(phrase[at:end], []).append((number, end))
                at = end
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, places)
        self.automaton.make_automaton()

    def windows(self, text: str) -> list[tuple[int, int, int]]:
        """(notice, from, to) around the seeds, overlapping ones of a notice joined."""
        found = [
            (number, max(0, last + 1 - end - self.notices[number][2]), last + 1 - end + len(self.notices[number][0]) + self.notices[number][2])
            for last, places in self.automaton.iter(text)
            for number, end in places
        ]
        joined: list[list[int]] = []
        for number, begin, end in sorted(found):
            if joined and joined[-1][0] == number and begin <= joined[-1][2]:
                joined[-1][2] = max(joined[-1][2], end)
            else:
                joined.append([number, begin, end])
        return [(n, b, min(e, len(text))) for n, b, e in joined]

    def matches(self, number: int, text: str, begin: int, end: int) -> list[regex.Match]:
        """The best match from ``begin`` to ``end``, and those before and behind it."""
        phrase, _, k = self.notices[number]
        out, parts = [], [(begin, end)]
        while parts:
            begin, end = parts.pop()
            if end - begin >= len(phrase) - k and (m := self.patterns[number].search(text, begin, end)):
                out.append(m)
                parts += [(begin, m.start()), (m.end(), end)]
        return out

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, from, to, edits) of all matches; of those that overlap, the ones with the fewest edits."""
        hits = [
            (number, m.start(), m.end(), sum(m.fuzzy_counts))
            for number, begin, end in self.windows(text)
            for m in self.matches(number, text, begin, end)
        ]
        hits.sort(key=lambda h: (h[1], h[2]))
        best, cluster, reach = [], [], -1
        for hit in [*hits, None]:
            if hit is None or hit[1] >= reach:
                least = min((h[3] for h in cluster), default=0)
                best += [h for h in cluster if h[3] == least]
                cluster, reach = [], -1
            if hit is not None:
                cluster.append(hit)
                reach = max(reach, hit[2])
        return best


def scan(text: bytes | None, search: NoticeSearch) -> tuple:
    """One row of FOUND."""
    words = normalized_words(text)
    n_words = words.count(b" ") - 1
    places = base_places(words) if b"license" in words else []
    spans, score = [], 1.0 if places else 0.0
    as_text = words.decode("utf-8", "replace")
    for number, begin, end, edits in search.search(as_text):
        phrase, label, _ = search.notices[number]
        piece = as_text[begin:end]
        begin += len(piece) - len(piece.lstrip(" "))
        first = as_text.count(" ", 0, begin) - 1
        spans.append({"label": label, "first_word": first, "n_words": len(piece.split()), "edits": edits})
        score = max(score, 1 - edits / len(phrase))
    starts = [at for at, _ in places]
    return (
        n_words, len(places), min(starts, default=None), max(starts, default=None),
        sorted({label for _, label in places}), spans, score,
    )


def license_scan(text: Column, notices=NOTICES) -> Column:
    """A struct of FOUND for each text.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond
    ASCII; NULL has none.  ``n_base`` counts all places of PHRASES, first_word
    and last_word their smallest and largest number (NULL without any).
    ``spans`` are the notices found: label, first word, words spanned, edits.
    ``score`` is 1 for an exact phrase, else one less edits / length for the
    best notice, else 0.
    """

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        search = NoticeSearch(notices)
        rows = [scan(t.as_buffer().to_pybytes() if t.is_valid else None, search) for t in texts]
        span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32())])
        kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(span), pa.float64()]
        columns = list(zip(*rows)) or [()] * len(kinds)
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "spans", "score")
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    return found(text)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES) -> DataFrame:
    """doc_id and the fields of FOUND for every row of ``docs``; an empty table gives no rows."""
    out = docs.select(F.col(id_col).alias("doc_id"), license_scan(F.col(text_col), notices).alias("found"))
    return out.select("doc_id", "found.*")
