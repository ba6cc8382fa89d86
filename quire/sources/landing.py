"""Landing folders: inventory of files, upload events, text extraction."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quire.functions import text as tx

INVENTORY_SCHEMA = "path string, file_name string, file_size_bytes long"

# Text of one output batch, in characters, before it is handed to Spark.
BATCH_CHARS = 8 * 1024 * 1024


def _is_uri(path: str) -> bool:
    return "://" in path or path.startswith("file:")


def _open_filesystem(path: str):
    """File system and the path in it, of a plain path or a URI as Spark writes it."""
    from pyarrow import fs

    if not _is_uri(path):
        return fs.LocalFileSystem(), os.path.abspath(path)
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _files_of(folder: str) -> Iterator[tuple[str, str, int]]:
    """Path, name and size of the files of one folder."""
    from pyarrow import fs

    filesystem, root = _open_filesystem(folder)
    base = folder.rstrip("/") if _is_uri(folder) else root
    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(root) as entries:
            for entry in entries:
                if entry.is_file():
                    yield f"{base}/{entry.name}", entry.name, entry.stat().st_size
    else:
        for info in filesystem.get_file_info(fs.FileSelector(root)):
            if info.is_file:
                yield f"{base}/{info.base_name}", info.base_name, info.size


def list_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """One row per file directly in the folders, empty files included.

    Each folder is listed by its own task and handed on in batches; pass the
    sub-folders or key prefixes of a large collection as separate entries.
    """

    def list_folder(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["folder"]:
                files = _files_of(folder)
                while part := list(islice(files, 10_000)):
                    yield pd.DataFrame(part, columns=["path", "file_name", "file_size_bytes"])

    roots = spark.createDataFrame([(f,) for f in folders], "folder string")
    return roots.repartition(len(folders), "folder").mapInPandas(list_folder, INVENTORY_SCHEMA)


def upload_events(inventory: DataFrame) -> DataFrame:
    """The raw, unvalidated event an upload of each file would send."""
    category = tx.infer_category(F.col("file_name"))
    return inventory.select(
        F.expr("uuid()").alias("document_id"),
        "file_name",
        F.col("path").alias("file_path"),
        F.ltrim(tx.file_suffix(F.col("file_name")), F.lit(".")).alias("file_type"),
        "file_size_bytes",
        category.alias("category"),
        tx.uploader_for(category).alias("uploaded_by"),
        tx.iso_utc(F.current_timestamp()).alias("upload_timestamp"),
    )


# --- extraction --------------------------------------------------------------


def text_of_txt(content: bytes) -> str:
    return content.decode("utf-8", errors="replace").replace("\r\n", "\n").replace("\r", "\n")


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _runs(paragraph) -> str:
    pieces = {_W + "t": lambda e: e.text or "", _W + "tab": lambda e: "\t", _W + "br": lambda e: "\n", _W + "cr": lambda e: "\n"}
    return "".join(pieces[e.tag](e) for e in paragraph.iter() if e.tag in pieces)


def text_of_docx(content: bytes) -> str:
    """Non-blank paragraphs, then table rows with cells joined by `` | ``; merged cells repeat."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(_W + "body")
    lines = [line for line in map(_runs, body.findall(_W + "p")) if line.strip()]
    for table in body.findall(_W + "tbl"):
        above: list[str] = []
        for row in table.findall(_W + "tr"):
            above = _grid_cells(row, above)
            lines.append(" | ".join(above))
    return "\n".join(lines)


def _grid_cells(row, above: list[str]) -> list[str]:
    """Text per grid column: a merged cell is repeated in each that it covers."""
    out: list[str] = []
    for cell in row.findall(_W + "tc"):
        span, merged = cell.find(f"{_W}tcPr/{_W}gridSpan"), cell.find(f"{_W}tcPr/{_W}vMerge")
        text = "\n".join(_runs(p) for p in cell.findall(_W + "p"))
        if merged is not None and merged.get(_W + "val") != "restart" and len(out) < len(above):
            text = above[len(out)]
        out += [text] * (1 if span is None else int(span.get(_W + "val")))
    return out


# Loader per document type; a PDF loader has to be supplied by the caller.
LOADERS: dict[str, Callable[[bytes], str]] = {"txt": text_of_txt, "docx": text_of_docx}


def _load(loaders, file_type, read_content) -> tuple[str | None, str | None]:
    """Text of one file, or why it cannot be had: one bad file is one NULL."""
    if file_type not in loaders:
        return None, f"no loader for {file_type}"
    try:
        return loaders[file_type](read_content()), None
    except Exception as error:
        return None, f"{type(error).__name__}: {error}"


def _extend(schema: T.StructType, error_col: str | None) -> T.StructType:
    added = ["raw_text"] + ([error_col] if error_col else [])
    return T.StructType([*schema.fields, *(T.StructField(name, T.StringType()) for name in added)])


def _with_text(batches, texts_of, error_col: str | None) -> Iterator[pd.DataFrame]:
    """Batches with ``raw_text`` (and the error) added, cut so that each stays bounded."""

    def part(batch, start, found):
        rows = batch.iloc[start : start + len(found)]
        for position, name in enumerate(["raw_text"] + ([error_col] if error_col else [])):
            rows = rows.assign(**{name: pd.Series([f[position] for f in found], dtype=object, index=rows.index)})
        return rows

    for batch in batches:
        found, start, held = [], 0, 0
        for text, error in texts_of(batch):
            found.append((text, error))
            held += len(text or "")
            if held > BATCH_CHARS:
                yield part(batch, start, found)
                start, found, held = start + len(found), [], 0
        if found:
            yield part(batch, start, found)


def extract_text(
    df: DataFrame, loaders: dict | None = None, content_col: str = "content", error_col: str | None = None
) -> DataFrame:
    """Add ``raw_text`` for rows that carry their bytes and ``file_type``.

    ``error_col`` names a column that says why a text is NULL.
    """
    loaders = {**LOADERS, **(loaders or {})}
    rest = [c for c in df.columns if c != content_col]
    schema = _extend(df.select(rest).schema, error_col)

    def texts_of(batch):
        for kind, content in zip(batch["file_type"], batch[content_col]):
            yield _load(loaders, kind, lambda: bytes(content))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in _with_text(batches, texts_of, error_col):
            yield out[schema.names]

    return df.mapInPandas(run, schema)


def read_and_extract(
    events: DataFrame,
    loaders: dict | None = None,
    bytes_per_task: int = 128 * 1024 * 1024,
    files_per_task: int = 1_000,
    error_col: str | None = None,
) -> DataFrame:
    """Add ``raw_text`` by reading ``file_path`` in the task that holds the row.

    Only the events are shuffled, never file contents.  The number of tasks
    follows the declared sizes and, as these may be wrong, the number of files.
    ``error_col`` names a column that says why a text is NULL.
    """
    loaders = {**LOADERS, **(loaders or {})}
    total, files = events.agg(F.coalesce(F.sum("file_size_bytes"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, -(-int(total) // bytes_per_task), -(-files // files_per_task))

    def texts_of(batch):
        for kind, path in zip(batch["file_type"], batch["file_path"]):
            yield _load(loaders, kind, lambda: _read_file(path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _with_text(batches, texts_of, error_col)

    # Round robin: no id or path, however often repeated, gathers in one task.
    return events.repartition(tasks).mapInPandas(run, _extend(events.schema, error_col))


def _read_file(path: str) -> bytes:
    filesystem, name = _open_filesystem(path)
    with filesystem.open_input_stream(name) as stream:
        return stream.read()
