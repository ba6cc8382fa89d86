"""Sharding along a Hilbert curve, from DataFrame functions only.

Each document is a point: language, source and size, each quantised to 8 bits.
Documents are ordered by their place on the Hilbert curve through these points
and the order is cut into runs of equal length.  Neighbours on the curve are near
in all three dimensions, so every shard covers small ranges of each, and a
filter on any of them skips most files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.common import free_name, ranked

BITS = 8
DIMENSIONS = 3


def _cells() -> tuple[list[int], list[int], list[int]]:
    """For each corner of a cube, numbered by its bits: its place along the
    curve (inverse Gray code), and for each place the corner where the curve
    enters the subcube and the axis along which it crosses it."""
    gray = [i ^ (i >> 1) for i in range(2**DIMENSIONS)]
    place = [gray.index(corner) for corner in range(2**DIMENSIONS)]
    ones = lambda i: (i ^ (i + 1)).bit_length() - 1  # noqa: E731  trailing 1 bits
    enter = [0 if i == 0 else gray[2 * ((i - 1) // 2)] for i in range(2**DIMENSIONS)]
    axis = [0 if i == 0 else (ones(i - 1) if i % 2 == 0 else ones(i)) % DIMENSIONS for i in range(2**DIMENSIONS)]
    return place, enter, axis


def hilbert_index(x: str, y: str, z: str, bits: int = BITS) -> Column:
    """Place of a cell on the Hilbert curve; ``x y z`` name integer columns below 2^bits.

    From the highest bit down, the three bits name a subcube; rotated and
    mirrored into the curve's current frame, they give the next digit of the
    index, and the digit gives the frame of the next level.
    """
    place, enter, axis = (f"array({', '.join(map(str, table))})" for table in _cells())
    turn_right = "(shiftright({v}, {k}) | shiftleft({v}, 3 - ({k}))) & 7"
    turn_left = "(shiftleft({v}, {k}) | shiftright({v}, 3 - ({k}))) & 7"
    corner = f"((shiftright({x}, i) & 1) * 4 + (shiftright({y}, i) & 1) * 2 + (shiftright({z}, i) & 1))"
    in_frame = turn_right.format(v=f"{corner} ^ s.enter", k="s.axis + 1")
    digit = f"element_at({place}, ({in_frame}) + 1)"
    turned = turn_left.format(v=f"element_at({enter}, w + 1)", k="s.axis + 1")
    step = (
        f"named_struct('index', s.index * 8 + w, 'enter', s.enter ^ ({turned}), "
        f"'axis', (s.axis + element_at({axis}, w + 1) + 1) % 3)"
    )
    return F.expr(
        f"aggregate(sequence({bits - 1}, 0, -1), named_struct('index', 0L, 'enter', 0, 'axis', 0), "
        f"(s, i) -> transform(array({digit}), w -> {step})[0]).index"
    )


def _category(value: Column) -> Column:
    """8 bits of a text; NULL is as ''."""
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 2), 16, 10).cast("int")


def _magnitude(size: Column) -> Column:
    """A quarter-octave of a positive integer: its number of binary digits and the two after the first."""
    digits = F.bin(size)
    after = F.rpad(F.substring(digits, 2, 2), 2, "0")
    return F.least(F.lit(255), (F.length(digits) - 1) * 4 + F.conv(after, 2, 10).cast("int")).cast("int")


def _measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    points = docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        _category(F.col(lang_col)).alias("x"),
        _category(F.col(source_col)).alias("y"),
        _magnitude(size).alias("z"),
    )
    return points.withColumn("curve", hilbert_index("x", "y", "z")).drop("x", "y", "z")


def hilbert_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve for every row of ``docs``.

    The law is ``rows``: with n documents in order of (curve, size, checksum,
    id), shard k takes those from k*n/shards on, so counts differ by one at
    most; ``slot`` counts from 0 within the shard.  Size is the text's UTF-8
    bytes and one (NULL text: 1).  Ties are rows equal in all of these, so which
    comes first changes nothing.  An empty table gives no rows.  grown_shard
    belongs to another law and is NULL.
    """
    placed = ranked(
        _measured(docs, id_col, text_col, lang_col, source_col), ["curve", "size", "text_crc32", "doc_id"], label="curve"
    )
    cut = placed.withColumn("n", F.lit(docs.count()).cast("long"))
    shard = F.expr(f"position * {shards} div n").cast("int")
    begins = F.expr(f"((position * {shards} div n) * n + {shards - 1}) div {shards}")
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.alias("shard"),
        (F.col("position") - begins).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write_curve_ordered(docs: DataFrame, path: str, files: int, **columns) -> None:
    """Write whole documents in runs along the curve, ``files`` of them; min and max of each file's columns then prune it."""
    curve, size = free_name(docs, "curve"), F.octet_length(F.coalesce(F.col(columns.get("text_col", "text")), F.lit("")))
    x, y, z = (free_name(docs, f"cell_{c}") for c in "xyz")
    placed = docs.withColumns(
        {
            x: _category(F.col(columns.get("lang_col", "lang"))),
            y: _category(F.col(columns.get("source_col", "source"))),
            z: _magnitude((size + 1).cast("long")),
        }
    ).withColumn(curve, hilbert_index(x, y, z))
    by = [F.col(curve), F.col(columns.get("id_col", "doc_id"))]
    placed.repartitionByRange(files, *by).sortWithinPartitions(*by).select(*docs.columns).write.parquet(path)
