"""Files by byte range, for sources that plan their own partitions.

Paths are what Spark lists: local ones and those of the stores that Arrow can open (hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator

from pyarrow import fs

BLOCK = 4 << 20
SCHEMES = {"": "file", "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs",
           "abfs": "abfs", "abfss": "abfss"}


def scheme(path: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else ""


def supported(path: str) -> bool:
    return scheme(path) in SCHEMES


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path inside it."""
    kind = scheme(path)
    if kind not in SCHEMES:
        raise ValueError(f"files of {kind}: cannot be read by range")
    if kind in ("", "file"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return fs.FileSystem.from_uri(re.sub(r"^[^:]+:", f"{SCHEMES[kind]}:", path))


def listed(path: str, pattern: str) -> list[tuple[str, int, int]]:
    """(path, modification in nanoseconds, length) of the files directly in a folder whose name
    matches; none if there is no folder."""
    store, inner = locate(path)
    found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted((f.path, f.mtime_ns or 0, f.size) for f in found
                  if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern))


def last_line_end(file, low: int, high: int) -> int:
    """The position after the last line end in the bytes low:high of an open file; `low` if there is
    none."""
    at = high
    while at > low:
        start = max(low, at - (64 << 10))
        file.seek(start)
        found = file.read(at - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        at = start
    return low


def lines(file, start: int, stop: int, limit: int) -> Iterator[list[bytes]]:
    """Lines that begin in the bytes start:stop of an open file, in lists; none is read beyond
    `limit`. Ranges that meet give every line once."""
    if start:
        file.seek(start - 1)
    at = max(0, start - 1)
    rest, begun = b"", start == 0
    while at < limit:
        block = file.read(min(BLOCK, limit - at))
        if not block:
            break
        if not begun:
            # The line that holds the byte before the range belongs to the range before.
            end = block.find(b"\n")
            if end < 0:
                at += len(block)
                continue
            at, block, begun = at + end + 1, block[end + 1:], True
        first = at - len(rest)
        at += len(block)
        data = rest + block
        if first >= stop:
            return
        if at >= stop:
            # The last line of the range begins before `stop` and may end after it.
            end = data.find(b"\n", max(0, stop - 1 - first))
            if end >= 0:
                yield data[:end].split(b"\n")
                return
        cut = data.rfind(b"\n")
        if cut >= 0:
            yield data[:cut].split(b"\n")
        rest = data[cut + 1:]
    if rest:
        yield [rest]
