"""Text functions over columns.

"White space" means Unicode white space as Python's ``str.split`` and
``str.strip`` see it, so results do not depend on which side of the JVM a text
is handled on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quire import fixed_values as fixed

# The 29 characters for which Python's str.isspace() holds.
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
# The same set in regular expressions ((?U): Unicode white space for \s).
SPACES = r"(?U)[\s\x1c-\x1f]+"
NON_SPACES = r"(?U)[^\s\x1c-\x1f]+"

# Texts of Latin-1 characters only, without its compatibility characters, are
# equal to their NFKC form: nothing decomposes and no combining mark composes.
MAYBE_NOT_NFKC = r"[\xa0\xa8\xaa\xaf\xb2-\xb5\xb8-\xba\xbc-\xbe\x{100}-\x{10ffff}]"


@F.pandas_udf(T.StringType())
def _normalize_nfkc(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFKC")


def nfkc(text: Column) -> Column:
    """Unicode NFKC form; only texts that may change are sent to Python."""
    return F.coalesce(_normalize_nfkc(F.when(text.rlike(MAYBE_NOT_NFKC), text)), text)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_blanks(text: Column) -> Column:
    """Runs of spaces and tabs become one space; line breaks stay."""
    return F.regexp_replace(text, r"[ \t]{2,}|\t", " ")


def cap_blank_lines(text: Column) -> Column:
    """At most one empty line in a row."""
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def clean(text: Column) -> Column:
    """Normalized text; never NULL, so an absent text becomes ``''``."""
    return F.coalesce(strip(cap_blank_lines(collapse_blanks(nfkc(text)))), F.lit(""))


def words(text: Column) -> Column:
    """The non-empty pieces between white space, case kept."""
    return F.array_remove(F.split(text, SPACES), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NON_SPACES)), F.lit(0))


def tokens(text: Column) -> Column:
    """Lower-cased words; punctuation stays attached."""
    return words(F.lower(text))


# Bytes that are white space, and the first bytes of other white space in UTF-8.
_BLANK = np.isin(np.arange(256), [ord(c) for c in WHITESPACE if ord(c) < 0x80])
_WIDE = [np.frombuffer(c.encode(), np.uint8) for c in WHITESPACE if ord(c) >= 0x80]
_LEADS = np.isin(np.arange(256), [c[0] for c in _WIDE])


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words`` of many texts (no NULLs) in a task: those of all texts one after another, and how many each text has."""
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    cuts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    word = ~_BLANK[data]
    leads = np.flatnonzero(_LEADS[data])
    if len(leads):
        after = np.append(data, np.zeros(2, np.uint8))
        for char in _WIDE:
            same = np.logical_and.reduce([after[leads + i] == byte for i, byte in enumerate(char)])
            for i in range(len(char)):
                word[leads[same] + i] = False
    # A word ends before a blank and at the end of its text.
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    begin = np.flatnonzero(word & (edge[:-1] | ~np.append(False, word[:-1])))
    end = np.flatnonzero(word & (edge[1:] | ~np.append(word[1:], False)))
    to = np.append(0, np.cumsum(end + 1 - begin)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(begin), pa.py_buffer(to), pa.py_buffer(data[word]))
    return found, np.diff(np.searchsorted(begin, cuts))


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` where white space follows."""
    return F.array_remove(F.split(strip(text), r"(?<=[.!?])" + SPACES), "")


def file_suffix(name: Column) -> Column:
    """Lower-cased suffix with its dot, ``''`` when there is none."""
    return F.lower(F.regexp_extract(name, r"(?s)^.+([.][^.]+)$", 1))


def file_stem(name: Column) -> Column:
    """The name without its suffix."""
    return F.regexp_replace(name, r"(?s)(?<=.)[.][^.]+$", "")


def contains_ignoring_case(text: Column, needle: str) -> Column:
    return F.contains(F.lower(text), F.lit(needle.lower()))


def first_keyword(text: Column, keywords, default: str) -> Column:
    """Label of the first keyword, in list order, found in the text."""
    return F.coalesce(
        *[F.when(contains_ignoring_case(text, word), F.lit(label)) for word, label in keywords],
        F.lit(default),
    )


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often they are used.

    Catalyst copies an expression into every filter above it; through a
    generator it does not, which pays for costly text expressions.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def infer_category(file_name: Column) -> Column:
    return first_keyword(file_stem(file_name), fixed.CATEGORY_KEYWORDS, fixed.DEFAULT_CATEGORY)


def lookup(key: Column, table: dict, default: str) -> Column:
    """Value of ``key`` in a fixed table, else the default."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def uploader_for(category: Column) -> Column:
    return lookup(category, fixed.UPLOADER_BY_CATEGORY, fixed.DEFAULT_UPLOADER)


def reason_key(reason: Column) -> Column:
    """A rejection message without its variable tail."""
    for cut in fixed.REASON_CUTS:
        reason = F.substring_index(reason, cut, 1)
    return reason


def record_name(document_id: Column, file_name: Column) -> Column:
    """File-system safe name of a rejected record."""
    stem = file_stem(F.coalesce(file_name, F.lit("unknown")))
    return F.replace(
        F.concat(F.coalesce(document_id, F.lit("no-id")), F.lit("_"), stem, F.lit(".json")),
        F.lit(" "),
        F.lit("_"),
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of an instant, in UTC, microseconds kept."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
