"""Decoding of files that SQL functions cannot decode: legacy code pages, UTF-16 and DOCX."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.compute as pc

# Fixed names of the word-processing format.
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_MARKS = {"tab": "\t", "br": "\n", "cr": "\n", "noBreakHyphen": "‑", "softHyphen": "­"}
_SIDE_PARTS = re.compile(r"word/(?:(?:header|footer)[0-9]+|footnotes|endnotes|comments)\.xml")

SIDE_PART_NOTE = "DOCX auxiliary part retained in original file but not included in body baseline: "


def _paragraph(p: ElementTree.Element) -> str:
    """Text of all nodes below a paragraph; those of a nested paragraph count here and on their own."""
    out = []
    for node in p.iter():
        name = node.tag.removeprefix(_W) if isinstance(node.tag, str) and node.tag.startswith(_W) else ""
        out.append(node.text or "" if name == "t" else _MARKS.get(name, ""))
    return "".join(out)


def docx_text(content: bytes) -> tuple[str, list[str]]:
    """Body text, paragraphs separated by line feeds, and notes on parts that are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml"))
        notes = [SIDE_PART_NOTE + n for n in sorted(archive.namelist()) if _SIDE_PARTS.fullmatch(n)]
    paragraphs = [_paragraph(p) for p in body.iter(f"{_W}p")]
    if not paragraphs:
        raise ValueError("DOCX body contains no paragraphs")
    return "\n".join(paragraphs), notes


def decoded(kind: str, content: bytes) -> dict:
    """text and warnings, or the reason why there is none."""
    try:
        if kind == "docx":
            text, notes = docx_text(content)
        else:
            text, notes = content.decode("cp1252" if kind == "cp1252" else "utf-16"), []
        return {"text": text, "warnings": notes, "reason": None}
    except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError) as e:
        return {"text": None, "warnings": [], "reason": f"undecodable {kind}: {e}"}


_RESULT = pa.struct([("text", pa.string()), ("warnings", pa.list_(pa.string())), ("reason", pa.string())])
#: Bytes of content that are decoded before the rows go out; a single file may have more.
STEP_BYTES = 4 << 20


def steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of batches in slices of bounded bytes of one column. A batch has ten thousand rows, however long they are."""
    for b in batches:
        start = size = 0
        for k, n in enumerate(pc.binary_length(b.column(column)).to_pylist()):
            if size and size + (n or 0) > STEP_BYTES:
                yield b.slice(start, k - start)
                start, size = k, 0
            size += n or 0
        if start < b.num_rows:
            yield b.slice(start)


def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the struct `got` to batches with kind and content."""
    for b in steps(batches, "content"):
        got = [decoded(k.as_py(), c.as_py() or b"") for k, c in zip(b.column("kind"), b.column("content"), strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, _RESULT)], [*b.schema.names, "got"])
