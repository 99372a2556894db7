"""Landed source archives to text rows.

Spark reads and distributes the archives; a small helper unpacks one at a time
with the standard library. Limits are checked while unpacking, so one archive
cannot exhaust a worker.
"""

from __future__ import annotations

import io
import posixpath
import re
import sys
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from dayfolio.config import ARCHIVE
from dayfolio.functions.records import OPTIONAL_EXTENSIONS, TEXT_EXTENSIONS

# Workers get this helper with the task and need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "id STRING, path STRING, text STRING, reject STRING"
_CONTROLS = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
_TEX = re.compile(r"\\(?:documentclass|begin\s*\{document\}|section\s*\{|title\s*\{)")
_QUOTES = str.maketrans({"\x93": "“", "\x94": "”"})


class Rejected(ValueError):
    pass


def _text(content: bytes, name: str) -> str:
    try:
        text = content.decode("utf-8").translate(_QUOTES)
    except UnicodeDecodeError:
        raise Rejected(f"not valid UTF-8: {name}") from None
    if _CONTROLS.search(text):
        raise Rejected(f"disallowed control characters: {name}")
    return text


def _unpacked(content: bytes) -> bytes:
    if not 1 <= len(content) <= ARCHIVE["download"]:
        raise Rejected("download is empty or too large")
    if content[:2] != b"\x1f\x8b":
        return content
    stream = zlib.decompressobj(wbits=31)
    try:
        data = stream.decompress(content, ARCHIVE["unpacked"] + 1)
    except zlib.error as error:
        raise Rejected(f"gzip extraction failed: {error}") from None
    if len(data) > ARCHIVE["unpacked"]:
        raise Rejected("too large after decompression")
    if not stream.eof:
        raise Rejected("gzip extraction failed: unexpected end")
    return data


def _safe(path: str) -> str:
    normal = posixpath.normpath(re.sub(r"^(?:\./)+", "", path))
    bad = not 1 <= len(path) <= 1024 or path[0] == "/" or "\\" in path or re.search("[\x00-\x1f\x7f]", path)
    if bad or path.endswith("/") or normal in (".", "..") or normal.startswith("../"):
        raise Rejected(f"unsafe path or path traversal: {path!r}")
    return normal


def _kept(path: str, content: bytes) -> str | None:
    """The text of a member, or null for a member that is not source text."""
    extension = posixpath.splitext(path)[1].lower()
    if extension and extension not in TEXT_EXTENSIONS:
        return None
    if len(content) > ARCHIVE["file"]:
        if not extension and not _TEX.search(content[: 256 * 1024].decode("latin-1")):
            return None
        raise Rejected(f"text file is too large: {path}")
    try:
        text = _text(content, path)
    except Rejected:
        if extension in OPTIONAL_EXTENSIONS or not extension:
            return None
        raise
    return text if extension or _TEX.search(text[: 256 * 1024]) else None


def _members(data: bytes) -> Iterator[tuple[str, str]]:
    seen: set[str] = set()
    total = entries = 0
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:") as archive:
        for member in archive:
            entries += 1
            if entries > ARCHIVE["entries"]:
                raise Rejected("too many entries")
            if "path" in archive.pax_headers:
                raise Rejected("global path override")
            if member.type not in (tarfile.REGTYPE, tarfile.AREGTYPE):
                if member.type not in (tarfile.CONTTYPE, tarfile.DIRTYPE, tarfile.LNKTYPE, tarfile.SYMTYPE, tarfile.CHRTYPE, tarfile.BLKTYPE, tarfile.FIFOTYPE):
                    raise Rejected(f"unsupported tar entry type {member.type!r}")
                continue
            path = _safe(member.name)
            content = archive.extractfile(member).read()
            if len(content) != member.size:
                raise Rejected("contains a truncated entry")
            text = _kept(path, content)
            if text is None:
                continue
            total += len(text.encode("utf-8"))
            if path in seen:
                raise Rejected(f"repeats a text path: {path}")
            if total > ARCHIVE["text"] or len(seen) >= ARCHIVE["files"]:
                raise Rejected("contains too much text or too many text files")
            seen.add(path)
            yield path, text
        if data[archive.offset:].strip(b"\0"):  # the reader stops without a word at a header that it cannot read
            raise Rejected("damaged or truncated header")
    if not seen:
        raise Rejected("contains no readable TeX or text source")


def _unpack(paper: str, content: bytes) -> list[tuple[str, str | None, str | None, str | None]]:
    try:
        data = _unpacked(content)
        try:
            is_tar = len(data) >= 512 and tarfile.TarInfo.frombuf(data[:512], "utf-8", "strict") is not None
        except (tarfile.HeaderError, UnicodeDecodeError):
            is_tar = False
        if is_tar or data[257:262] == b"ustar":
            return [(paper, path, text, None) for path, text in _members(data)]
        text = _text(data, f"{paper}.tex")
        if not _TEX.search(text[: 256 * 1024]):
            raise Rejected("neither a supported tar archive nor a TeX source")
        if len(data) > ARCHIVE["file"]:
            raise Rejected(f"text file is too large: {paper}.tex")
        return [(paper, f"{paper}.tex", text, None)]
    except (Rejected, tarfile.TarError, EOFError) as error:
        return [(paper, None, None, str(error))]


def extract_sources(archives: DataFrame) -> DataFrame:
    """(id, path, text, reject) of archives with columns id and content.

    A task's input is bounded by ``spark.sql.files.maxPartitionBytes`` and one
    batch by ``spark.sql.execution.arrow.maxBytesPerBatch``; archives are
    unpacked one after the other.
    """
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for paper, content in zip(batch["id"], batch["content"]):
                rows = _unpack(paper, bytes(content))
                yield pd.DataFrame(rows, columns=["id", "path", "text", "reject"])

    return archives.select("id", "content").mapInPandas(unpack, OUTPUT)
