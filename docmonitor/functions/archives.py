"""Members of zip archives, as rows."""

from __future__ import annotations

import io
import struct
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING = T.StructType([
    T.StructField("error", T.StringType()),
    T.StructField("members", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()),
        T.StructField("member_path", T.StringType()),
        T.StructField("size", T.LongType()),
    ]))),
])

_MEMBER = {"pos": pa.int32(), "member_path": pa.string(), "size": pa.int64()}
_END = struct.Struct("<4s4H2LH")
_ENTRY = struct.Struct("<4s4B4HL2L5H2L")
_LAST_VERSION = 45  # beyond it, and for whatever else is out of the ordinary, `zipfile` decides


def _plain_entries(content: memoryview) -> list[tuple[str, int]] | None:
    """Names and sizes from the table of contents of an ordinary archive: one that ends with
    its end record and has no comment, prefix, extra field, encryption or 64-bit size.  None for others."""
    end = len(content) - _END.size
    if end < 0:
        return None
    mark, _, _, _, _, size, at, comment = _END.unpack_from(content, end)
    if mark != b"PK\5\6" or comment or at + size != end or bytes(content[max(end - 20, 0):end - 16]) == b"PK\6\7":
        return None
    found = []
    while at < end:
        if at + _ENTRY.size > end:
            return None
        (mark, _, _, version, _, flags, _, _, _, _, stored, length, name, extra, note, _, _, _, start) = _ENTRY.unpack_from(content, at)
        at += _ENTRY.size + name
        if mark != b"PK\1\2" or version > _LAST_VERSION or flags or extra or note or at > end:
            return None
        raw = bytes(content[at - name:at])
        if not raw.isascii() or b"\0" in raw or 0xFFFFFFFF in (stored, length, start):
            return None
        found.append((raw.decode(), length))
    return found


def _entries(content: memoryview) -> list[tuple[str, int]]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        infos = archive.infolist()
    if any(info.flag_bits & 1 for info in infos):
        raise zipfile.BadZipFile("encrypted member")
    return [(info.filename, info.file_size) for info in infos]


def _listing(content: memoryview) -> tuple[str | None, dict[str, int]]:
    """Why an archive cannot be listed, and the sizes of its regular files; paths as an
    extraction would create them."""
    sizes = {}
    try:
        entries = _plain_entries(content)
        for name, size in _entries(content) if entries is None else entries:
            parts = [p for p in name.split("/") if p not in ("", ".", "..")]
            if parts and not name.endswith("/"):
                sizes["/".join(parts)] = size  # a repeated path: last wins
    except (zipfile.BadZipFile, ValueError, NotImplementedError) as problem:
        return str(problem), {}
    return None, sizes


def _listings(content: pa.Array) -> pa.Array:
    errors, ends, columns = [], [0], ([], [], [])
    for archive in content:
        error, sizes = _listing(memoryview(archive.as_buffer() if archive.is_valid else b""))
        errors.append(error)
        ends.append(ends[-1] + len(sizes))
        for column, values in zip(columns, (range(len(sizes)), sizes, sizes.values())):
            column.extend(values)
    cells = [pa.array(c, type=t) for c, t in zip(columns, _MEMBER.values())]
    members = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(cells, list(_MEMBER)))
    return pa.StructArray.from_arrays([pa.array(errors, pa.string()), members], ["error", "members"])


# Reads only each archive's table of contents; nothing is extracted.  Declared
# non-deterministic so that a filter on the result does not list it once more.
zip_listing = F.arrow_udf(_listings, LISTING).asNondeterministic()
